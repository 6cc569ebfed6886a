"""Toxicity: held-out accuracy on the given tables, and edge cases."""

import math
import random
import zlib

from ringside.llm import toxicity


def accuracy(spark, sf):
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.score_texts(docs, toxicity.fit(docs, labels)).collect()}
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for d, r in got.items())
    truth = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if got[r.doc_id].held_out]
    hits = sum(p and t for p, t in truth)
    return hits / max(1, sum(p for p, _ in truth)), hits / sum(t for _, t in truth)


def test_held_out_accuracy(spark):
    precision, recall = accuracy(spark, "sf0.1")
    assert precision > 0.93 and recall > 0.9


def test_rare_words_back_off_to_their_beginnings():
    items = {f"vileXX{i}": (9, 0) for i in range(8)} | {f"calmyy{i}": (0, 9) for i in range(8)} | {"the": (90, 300), "once": (1, 0)}
    cut = lambda k: {x[:k]: tuple(sum(c[i] for y, c in items.items() if y[:k] == x[:k]) for i in (0, 1)) for x in items}
    model = toxicity.Model([items, cut(6), cut(4)], 0.1)
    assert model.top.ratio("vileXX99") > 1 > model.top.ratio("zzz") == 0 and model.top.ratio("calmyy77") < 0
    assert model.top.ratio("the") == 0 and model.top.ratio("once") == 0


def test_edges(spark):
    schema = "doc_id long, text string, toxic string, label_doc int"
    rnd = random.Random(1)
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(40)) + (" vile scum" if i % 5 == 0 else ""), "x", 1) for i in range(300)]
    docs = spark.createDataFrame([*rows, (None, "vile scum", None, None), (7, None, "", 0), (5, rows[5][1], "", 0), (900, "", "", 0)], schema)
    labels = spark.createDataFrame([(i, 0, int(i % 5 == 0)) for i in range(300)] + [(None, 1, 1), (3, None, None), (7, 0, 0), (999, 0, 1)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.score_texts(docs, model).collect()
    assert len(out) == docs.count()
    wrong = [r for r in out if r.doc_id is not None and r.doc_id < 300 and r.predicted != int(r.doc_id % 5 == 0) and not (r.doc_id == 7)]
    assert len(wrong) <= 3
    assert {r.doc_id for r in out if r.score != r.score} == set()
    kept = toxicity.keep_ordinary(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(1 - r.predicted for r in out)
    for few in (labels.limit(0), labels.where("toxic = 0")):
        flat = toxicity.score_texts(docs, toxicity.fit(docs, few)).collect()
        assert len({r.score for r in flat}) == 1 and flat[0].predicted == 0
    assert toxicity.score_texts(docs.limit(0), toxicity.fit(docs.limit(0), labels)).count() == 0


def ratio_by_hand(word, texts, toxic_of):
    """A word's log ratio from the texts themselves, by the definition."""
    def held(items):
        out = {}
        for text, toxic in zip(texts, toxic_of):
            for x in {i for w in set(toxicity.words_of(text)) for i in items(w)}:
                out.setdefault(x, [0, 0])[0 if toxic else 1] += 1
        return out

    words = held(lambda w: [w])
    levels = [{w: n for w, n in words.items() if sum(n) >= 2}]
    for k in toxicity.BACKOFF:
        level = {}
        for w, n in words.items():
            level.setdefault(w[:k], [0, 0])
            level[w[:k]][0] += n[0]
            level[w[:k]][1] += n[1]
        levels.append(level)

    def ratio(x, depth):
        if depth == len(levels):
            return 0.0
        counts = [c for n in levels[depth].values() for c in n]
        once, twice = counts.count(1), counts.count(2)
        d = min(0.95, max(0.5, once / (once + 2 * twice))) if once else 0.75
        nt, no = (1 + sum(n[i] for n in levels[depth].values()) for i in (0, 1))
        below = lambda: ratio(x[: toxicity.BACKOFF[depth]] if depth < len(toxicity.BACKOFF) else x, depth + 1)
        if x not in levels[depth]:
            return below()
        (t, o), prior = levels[depth][x], below()
        odds = math.exp(prior) * nt / no
        taken, share = min(t, d) + min(o, d), odds / (1 + odds)
        moved = math.log((max(t - d, 0) + taken * share) / nt) - math.log((max(o - d, 0) + taken * (1 - share)) / no) - prior
        beyond = abs(moved) - toxicity.MARGIN - toxicity.SPREADS * math.sqrt(1 / (t + 0.5) + 1 / (o + 0.5))
        return prior + math.copysign(beyond, moved) if beyond > 0 else prior

    return ratio(word, 0)


def test_ratios_against_the_definition(spark):
    rnd = random.Random(4)
    common, vile = [f"{a}{b}word" for a in "abcd" for b in "efgh"], [f"vilest{x}" for x in "abcdefgh"]
    rows = []
    for i in range(400):
        toxic = int(rnd.random() < 0.3)
        rows.append((i, " ".join(rnd.choice(common) for _ in range(12)) + (" " + rnd.choice(vile) if toxic else ""), toxic))
    docs, labels = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], 0, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    part = lambda i: zlib.crc32(str(i).encode()) % 4
    used = {t: y for i, t, y in rows if part(i) not in (2, 3)}
    for word in (*common, *vile, "vilestzz", "vilexx", "aeother", "qq"):
        assert abs(model.top.ratio(word) - ratio_by_hand(word, used.keys(), used.values())) < 1e-9
    assert model.top.ratio("vilesta") > 1
