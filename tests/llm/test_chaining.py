"""Chaining and fuzzy passages against planted cases and brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from ringside.llm import chaining


def test_chains_are_collinear_and_best():
    rnd = random.Random(1)
    for _ in range(200):
        n = rnd.randint(1, 12)
        pos, other = [rnd.randint(0, 30) for _ in range(n)], [rnd.randint(0, 30) for _ in range(n)]
        found = chaining.chains(pos, other)
        assert sorted(i for c in found for i in c) == list(range(n))
        for c in found:
            assert all(pos[a] < pos[b] and other[a] < other[b] for a, b in zip(c, c[1:]))
        best, order = [0.0] * n, sorted(range(n), key=lambda i: pos[i])
        for j in order:  # the quadratic recursion
            best[j] = chaining.K + max([0.0, *(best[i] - chaining.GAP_COST * (pos[j] - pos[i] + other[j] - other[i]) for i in range(n) if pos[i] < pos[j] and other[i] < other[j])])
        own = found[0]
        score = chaining.K * len(own) - chaining.GAP_COST * (pos[own[-1]] - pos[own[0]] + other[own[-1]] - other[own[0]])
        assert abs(score - max(best)) < 1e-9


def test_align_finds_edges_indels_and_splits():
    rnd = np.random.default_rng(2)
    core = rnd.integers(0, 10**6, 130).astype("<u4")
    a = np.concatenate([rnd.integers(10**6, 2 * 10**6, 40), core[:60], [7], core[60:]]).astype("<u4")
    b = np.concatenate([rnd.integers(2 * 10**6, 3 * 10**6, 9), core[:100], core[104:], rnd.integers(3 * 10**6, 4 * 10**6, 50)]).astype("<u4")
    [(s, e, t, f, n)] = chaining.align(a, b, [50, 105, 150], [19, 73, 114])
    assert (s, e, t, f, n) == (40, 171, 9, 135, 126)
    apart = np.concatenate([core, rnd.integers(5 * 10**6, 6 * 10**6, 30).astype("<u4"), core]), np.concatenate([core, rnd.integers(7 * 10**6, 8 * 10**6, 30).astype("<u4"), core])
    assert [x[:2] for x in chaining.align(*apart, [5, 170], [5, 170])] == [(0, 130), (160, 290)]


def planted(seed=3):
    rnd = random.Random(seed)
    vocab = [f"v{i}" for i in range(3000)]
    words = lambda n: [rnd.choice(vocab) for _ in range(n)]
    docs, truth = {}, {}
    passages = [words(n) for n in (56, 80, 140)]
    for d in range(80):
        body = words(rnd.choice([10, 60, 200, 500]))
        if d % 4 == 0:
            k = rnd.randrange(3)
            p = list(passages[k])
            for _ in range(rnd.choice([0, 0, len(p) // 25])):
                i = rnd.randrange(8, len(p) - 8)
                p[i : i + 1] = rnd.choice([[rnd.choice(vocab)], [], [p[i], rnd.choice(vocab)]])
            at = rnd.randint(0, len(body))
            body[at:at] = p
            truth.setdefault(k, []).append((d, at, at + len(p)))
        docs[d] = body
    docs[90], docs[91] = words(49), words(45)
    docs[92], docs[93] = list(docs[90]), docs[91] + words(20)  # shared, but below 50 words
    docs[94] = docs[1][:] if len(docs[1]) >= 50 else docs[2][:]
    return docs, truth


def rows(spark, docs):
    data = [(d, " ".join(w).replace("v1", "V1"), "z", 0) for d, w in docs.items()] + [(95, None, "z", 0), (96, "", "z", 0), (None, "q " * 100, "z", 0), (97, "same " * 300, "z", 0), (98, "same " * 280, "z", 0)]
    return spark.createDataFrame(data, "doc_id long, text string, seed string, pos int")


def test_planted_passages(spark, monkeypatch):
    for limit in (chaining.JOIN_BYTES, 3000):  # one slice, and many
        monkeypatch.setattr(chaining, "JOIN_BYTES", limit)
        docs, truth = planted()
        found = chaining.repeated_passages(rows(spark, docs).repartition(3)).collect()
        by_doc = {}
        for r in found:
            assert r.other_id < r.doc_id and r.end_word - r.start_word >= 50
            by_doc.setdefault(r.doc_id, []).append(r)
        want = {d for own in truth.values() for d, _, _ in sorted(own)[1:]}
        assert want <= set(by_doc)
        assert set(by_doc) - want <= {94, 98}
        assert 94 in by_doc
        for own in truth.values():
            for d, s, e in sorted(own)[1:]:
                covered = max(min(e, r.end_word) - max(s, r.start_word) for r in by_doc[d])
                spill = max(r.end_word for r in by_doc[d]) - e, s - min(r.start_word for r in by_doc[d])
                assert covered >= 0.9 * (e - s) - 2 and max(spill) <= 6


def test_repeated_rows_and_empty(spark):
    docs, _ = planted()
    df = rows(spark, docs)
    once = sorted(map(tuple, chaining.repeated_passages(df).collect()))
    twice = sorted(set(map(tuple, chaining.repeated_passages(df.union(df)).collect())))
    assert once == twice
    assert chaining.repeated_passages(df.limit(0)).count() == 0


def test_a_passage_twice_in_one_document_of_another_slice(spark, monkeypatch):
    monkeypatch.setattr(chaining, "JOIN_BYTES", 1)  # a slice a batch
    rnd = random.Random(11)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage = words(70)
    docs = {1: words(40) + passage + words(40), 7: words(30) + passage + words(90) + passage + words(30)}
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string").repartitionByRange(2, "doc_id")
    found = chaining.repeated_passages(df).collect()
    for s in (30, 190):
        assert any(r.doc_id == 7 and r.other_id == 1 and r.start_word <= s + 2 and r.end_word >= s + 68 for r in found)


def test_evenly_edited_passages(spark):
    rnd = random.Random(12)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    docs = {}
    for k in range(60):  # identities 0.83, 0.86, 0.88 and 0.9
        passage, every = words(60), (6, 7, 8, 10)[k % 4]
        edited = [rnd.choice(words(1)) if i % every == every - 1 else w for i, w in enumerate(passage)]
        docs[k], docs[100 + k] = words(30) + passage + words(30), words(40) + edited + words(30)
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    found = {(r.doc_id, r.other_id) for r in chaining.repeated_passages(df).collect()}
    assert found == {(100 + k, k) for k in range(60)}


def test_passages_of_lines_that_earlier_documents_hold(spark):
    rnd = random.Random(13)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    docs, want = {}, set()
    for k in range(0, 200, 10):
        x, y = words(30), words(30)
        docs[k], docs[k + 1] = words(30) + x + words(30), words(30) + y + words(30)
        for d in (k + 2, k + 3):  # a word of their own at the border in every second pair
            docs[d] = words(20) + x + words(k // 10 % 2) + y + words(20)
        want.add((k + 3, k + 2))
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string")
    found = chaining.repeated_passages(df).collect()
    assert {(r.doc_id, r.other_id) for r in found} == want
    assert all(r.start_word <= 22 and r.end_word >= 78 for r in found)


def test_cut(spark):
    assert chaining.remove_words("a  b\nc d", [(1, 3)]) == "a  d"
    assert chaining.remove_words("a b c", [(1, 9)]) == "a" and chaining.remove_words("é ü", [(0, 2)]) == ""
    assert chaining.remove_words("a b ", []) == "a b "
    docs, truth = planted()
    df = rows(spark, docs)
    cut = chaining.cut_passages(df, chaining.repeated_passages(df))
    assert cut.columns == df.columns
    out = {r.doc_id: r.text for r in cut.collect()}
    assert len(out) == df.count() and out[95] is None and out[1] == " ".join(docs[1]).replace("v1", "V1")
    twice = chaining.cut_passages(df.union(df), chaining.repeated_passages(df))
    assert twice.count() == 2 * df.count() and chaining.cut_passages(df.limit(0), chaining.repeated_passages(df)).count() == 0
    assert chaining.cut_passages(df, chaining.repeated_passages(df.limit(0))).count() == df.count()
    clash = df.withColumns({c: F.lit(c) for c in ("__passage_doc", "__passage_spans", "__filterw", "__filterslot")}).unionByName(df.where("doc_id = 1").selectExpr("cast(null as long) doc_id", "text"), allowMissingColumns=True)
    kept = chaining.cut_passages(clash, chaining.repeated_passages(df))
    alone = lambda t: sorted(r.text or "" for r in t.where("doc_id is null").collect())
    assert kept.columns == clash.columns and alone(kept) == alone(clash)
    assert {r.doc_id: r.text for r in kept.where("doc_id is not null").collect()} == {r.doc_id: r.text for r in cut.where("doc_id is not null").collect()}
    assert all(r["__passage_doc"] == "__passage_doc" and r["__filterslot"] == "__filterslot" for r in kept.where("doc_id is not null").collect())
    for own in truth.values():
        for k, (d, s, e) in enumerate(sorted(own)):
            left = len(out[d].split())
            assert left == len(docs[d]) if k == 0 else left <= len(docs[d]) - 0.9 * (e - s) + 2


def frame(spark, docs):
    return spark.createDataFrame([(d, " ".join(w)) for d, w in docs.items()], "doc_id long, text string").repartition(3)


def test_a_passage_whose_parts_smaller_documents_quote(spark, monkeypatch):
    rnd = random.Random(14)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage = words(80)
    docs = {k: words(30) + passage[a : a + 45] + words(30) for k, a in enumerate((0, 17, 35))}
    docs |= {40 + k: words(9) + passage[a : a + 45] + words(9) for k, a in enumerate((0, 17, 35))}
    docs[30], docs[101] = words(25) + passage + words(40), words(50) + passage + words(10)  # quotes before and between
    for limit in (chaining.JOIN_BYTES, 1):
        monkeypatch.setattr(chaining, "JOIN_BYTES", limit)
        found = chaining.repeated_passages(frame(spark, docs)).collect()
        assert {(r.doc_id, r.other_id, r.start_word, r.end_word, r.other_start) for r in found} == {(101, 30, 50, 130, 25)}


def test_every_unchanged_run_of_fifty_words_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(chaining, "JOIN_BYTES", 4000)
    rnd = random.Random(15)
    lines = [[f"w{rnd.randrange(10**6)}" for _ in range(rnd.randint(8, 40))] for _ in range(25)]
    docs = {d: [w for _ in range(rnd.randint(1, 9)) for w in rnd.choice(lines)] for d in range(150)}
    docs |= {200 + d: [rnd.choice("ab") for _ in range(rnd.randint(40, 160))] for d in range(10)}
    held, want, covered = {}, 0, 0
    rows = {}
    for r in chaining.repeated_passages(frame(spark, docs)).collect():
        assert r.other_id < r.doc_id and min(r.end_word - r.start_word, r.other_end - r.other_start) >= 50
        a, b = docs[r.doc_id][r.start_word : r.end_word], docs[r.other_id][r.other_start : r.other_end]
        assert r.equal_words <= min(len(a), len(b)) and r.equal_words >= 0.8 * max(len(a), len(b))
        if len(a) == len(b) == r.equal_words:
            assert a == b
        rows.setdefault(r.doc_id, []).append((r.start_word, r.end_word))
    for d, w in docs.items():
        runs = {i: tuple(w[i : i + 50]) for i in range(len(w) - 49)}
        inside = np.zeros(len(w), dtype=bool)
        for s, e in rows.get(d, []):
            inside[s:e] = True
        for i, run in runs.items():
            if run in held:
                want += 1
                covered += bool(inside[i : i + 50].all())
        held |= dict.fromkeys(runs.values())
    assert want > 1000 and covered == want


def test_all_pairs_of_edited_passages(spark):
    """Recall of edited passages, by whether any smaller holder of a passage is named; the rest of each text is its own."""
    rnd = random.Random(16)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    docs, truth = {}, []
    for k in range(40):
        passage = words(rnd.randint(60, 120))
        holders = rnd.sample(range(1000 * k, 1000 * k + 1000), 4)
        for d in holders:
            edited = [rnd.choice(words(1)) if rnd.random() < 0.09 else w for w in passage]
            docs[d] = words(20) + edited + words(20)
        for d in holders:
            same = [o for o in holders if o < d and sum(x == y for x, y in zip(docs[o][20:-20], docs[d][20:-20])) >= 0.8 * len(passage)]
            if same:
                truth.append((d, set(holders)))
    found = {}
    for r in chaining.repeated_passages(frame(spark, docs)).collect():
        found.setdefault(r.doc_id, set()).add(r.other_id)
    assert all(o // 1000 == d // 1000 for d, own in found.items() for o in own)
    caught = sum(bool(found.get(d, set()) & own) for d, own in truth)
    assert len(truth) > 20 and caught >= 0.9 * len(truth), (caught, len(truth))


def test_extension_beyond_the_window(spark, monkeypatch):
    monkeypatch.setattr(chaining, "REACH", 3)
    monkeypatch.setattr(chaining, "SHORT_REACH", 3)
    rnd = random.Random(17)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage = words(200)
    docs = {0: words(9) + passage[:90], 1: passage[70:], 2: words(5) + passage + words(5), 3: words(8) + passage + words(2)}
    found = chaining.repeated_passages(frame(spark, docs)).collect()
    assert {r.doc_id for r in found} == {2, 3}
    assert (3, 2, 8, 208, 5, 205, 200) in set(map(tuple, found))
