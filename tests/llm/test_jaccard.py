"""The Jaccard join and components against brute force."""

import random

import numpy as np
import pyarrow as pa

from ringside.llm import jaccard, words
from ringside.llm.components import connected_components


def brute_set(text):
    w = (text or "").encode().lower().split()
    if len(w) < 5:
        return frozenset({tuple(w)} if w else ())
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4))


def brute_components(rows, percent=80):
    sets = {}
    for d, t in rows:
        sets.setdefault(brute_set(t), set()).add(d)
    keys = [k for k in sets if k]
    parent = {d: d for d, _ in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    def join(x, y):
        x, y = find(x), find(y)
        parent[max(x, y)] = min(x, y)

    for k in keys:
        for d in sets[k]:
            join(d, min(sets[k]))
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if 100 * len(a & b) >= percent * len(a | b):
                join(min(sets[a]), min(sets[b]))
    return {d: find(d) for d in parent}


def corpus(seed=1, n=60):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)] + ["É", "ß,", "Ärger", "日本"]
    passage = [rnd.choice(vocab) for _ in range(30)]
    texts = [None, "", " \n\t", "one", "one two three four", "One two THREE four", "one two three four five", "a a a a a a a a a a", "a a a a a a a"]
    for _ in range(n):
        w = [rnd.choice(vocab) for _ in range(rnd.choice([3, 6, 20, 60, 150]))]
        if rnd.random() < 0.4:
            w[len(w) // 2 : len(w) // 2] = passage
        texts.append(" ".join(w))
        for _ in range(rnd.choice([0, 0, 1, 4, 12])):  # near copies, some on the edge of the threshold
            v = list(w)
            for _ in range(rnd.randint(0, max(1, len(v) // 35))):
                v[rnd.randrange(len(v))] = rnd.choice(vocab)
            texts.append(rnd.choice([" ", "\n", "  "]).join(v).replace("w1", "W1"))
    order = list(range(len(texts)))
    rnd.shuffle(order)
    return [(int(i) * 3 - 7, texts[k]) for i, k in enumerate(order)]


def check(spark, rows, **kw):
    df = spark.createDataFrame([(d, t, "x", 0) for d, t in rows], "doc_id long, text string, token string, n int")
    got = jaccard.jaccard_components(df.repartition(3), **kw).collect()
    want = brute_components(rows, kw.get("percent", 80))
    assert len(got) == len(rows)
    assert {r.doc_id: r.component_id for r in got} == want
    sizes = {d: len(brute_set(t)) for d, t in rows}
    assert {r.doc_id: r.n_shingles for r in got} == sizes


def test_random_corpora(spark):
    for seed in (1, 2):
        check(spark, corpus(seed))


def test_blocks_and_salts(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "WIDE_FROM", 4)
    check(spark, corpus(3, 40))


def test_nulls_and_empties(spark):
    schema = "doc_id long, text string"
    df = spark.createDataFrame([(None, "a b c d e f"), (4, "a b c d e f"), (4, "a b c d e f"), (2, "A B C D E F"), (9, None), (8, "")], schema)
    got = sorted((r.doc_id is None, r.doc_id, r.n_shingles, r.component_id) for r in jaccard.jaccard_components(df).collect())
    assert got == [(False, 2, 2, 2), (False, 4, 2, 2), (False, 4, 2, 2), (False, 8, 0, 8), (False, 9, 0, 9), (True, None, 2, None)]
    assert jaccard.jaccard_components(df.limit(0)).count() == 0


def test_prefix_loses_nothing():
    for n in range(1, 200):
        need = -(-80 * n // 100)  # the least overlap with any set that similar
        assert jaccard.prefix_length(n, 80) == n - need + 1


def test_bitmap_bound_holds():
    rnd = np.random.default_rng(3)
    for _ in range(200):
        pool = rnd.integers(0, 2**63, 300, dtype=np.uint64)
        a, b = (np.unique(rnd.choice(pool, rnd.integers(1, 250))) for _ in range(2))
        wa, wb = jaccard.bitmap_width(len(a)), jaccard.bitmap_width(len(b))
        w = min(wa, wb)
        x, y = jaccard.fold(jaccard.bitmap(a, wa), w), jaccard.fold(jaccard.bitmap(b, wb), w)
        assert np.array_equal(x, jaccard.bitmap(a, w))
        assert jaccard.overlap_bound(x, y, len(a), len(b)) >= len(np.intersect1d(a, b))


def test_shingle_sets_match_brute_force():
    texts = [t for _, t in corpus(5)]
    seen = {}
    for i, own in words.shingle_sets(pa.array(texts)):
        want = brute_set(texts[i])
        assert len(own) == len(want) and seen.setdefault(want, own.tolist()) == own.tolist()


def test_connected_components(spark):
    rnd = random.Random(4)
    edges = [(i, i + 1) for i in range(100, 140)] + [(1, i) for i in range(2, 30)] + [(rnd.randrange(200, 400), rnd.randrange(200, 400)) for _ in range(150)] + [(5, 5), (2, 1)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    loops = {a for a, b in edges if a == b} - set(got)
    assert got == {x: find(x) for x in parent if x not in loops}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_long_texts_are_hashed_alike(monkeypatch):
    text = " ".join(f"word{i % 977}" for i in range(5000)) + "\n" + "x" * 3000 + " end"
    whole = [own.tolist() for _, own in words.shingle_sets(pa.array([text, "a b"]))]
    monkeypatch.setattr(words, "SLICE_BYTES", 500)
    assert [own.tolist() for _, own in words.shingle_sets(pa.array([text, "a b"]))] == whole


def sets_of(docs):
    out = {}
    for d, t in docs:
        w = t.lower().split()
        out[d] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    return out


def by_hand(docs, percent):
    sets, comp = sets_of(docs), {d: d for d, _ in docs}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                comp[y] = x
    return {d: root(d) for d, _ in docs}


def test_lower_thresholds_blocks_of_bands_and_large_classes(spark, monkeypatch):
    rnd = random.Random(9)
    base = [f"w{i}" for i in range(400)]
    docs = [(d, " ".join(base[: rnd.choice([5, 6, 7, 8, 40, 60, 90, 120, 200]) + rnd.randint(0, 9)] + [f"x{d}"] * rnd.randint(0, 3) + [rnd.choice("pqr")] * rnd.randint(0, 4))) for d in range(160)]
    docs += [(1000 + d, "one text that very many documents hold") for d in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    monkeypatch.setattr(jaccard, "STAR_LINKS", 2.0)
    monkeypatch.setattr(jaccard, "LARGE_CLASS", 10)
    for percent in (60, 80):
        got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(df, percent=percent).collect()}
        assert got == by_hand(docs, percent)
