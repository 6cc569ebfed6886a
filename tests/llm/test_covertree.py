"""Dual-tree top-k against brute force."""

import math

import numpy as np

from ringside.llm import covertree


def brute(rows, k, every):
    good = [(i, [math.floor(1024 * float(c)) for c in v]) for i, v in rows if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v)]
    out = []
    for q, a in dict(reversed([(i, v) for i, v in good if i % every == 0])).items():
        best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in good if i != q and len(b) == len(a))[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **kw):
    df = spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], "vec_id long, embedding array<float>, rank int, score double")
    got = sorted(map(tuple, covertree.top_k(df, **kw).collect()))
    f32 = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v]) for i, v in rows]
    assert got == brute(f32, kw.get("k", 10), kw.get("every", 100))


def test_random_ties_and_blocks(spark):
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(5, 8))
    rows = [(i, (centres[i % 5] + 0.1 * rnd.normal(size=8)).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # many equal vectors
    run(spark, rows, every=10)
    run(spark, rows, every=10, block=50, query_block=7)
    run(spark, rows, every=10, k=3, block=100)


def test_edges(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (100, [-1.0, 0.3]), (5, [0.1, -0.7]), (6, [1.0, 2.0, 3.0]), (200, []), (7, []), (300, [1.0, 1.0, 1.0, 1.0]), (None, [1.0, 1.0])]
    run(spark, rows)
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert covertree.top_k(df.limit(0)).count() == 0


def test_tree_covers_and_prunes():
    rnd = np.random.default_rng(2)
    centres = 50 * rnd.normal(size=(12, 6))
    x = np.repeat(centres, 400, axis=0) + rnd.normal(size=(4800, 6))

    def walk(node):
        assert (np.sqrt(((x[node.rows] - node.centre) ** 2).sum(axis=1)) <= node.radius * (1 + 1e-12)).all()
        if node.children:
            assert sorted(np.concatenate([c.rows for c in node.children]).tolist()) == sorted(node.rows.tolist())
        for c in node.children:
            walk(c)

    walk(covertree.cover_tree(x))
    assert covertree.compared_share(x, x[::20], 5) < 0.5
