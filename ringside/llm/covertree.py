"""Exact top-k inner products by a dual-tree search of cover trees.

Vectors become integers first, so scores are exact and ties are real ties.
Queries and candidates are dealt into cells of a grid of blocks of bounded
size; in each cell both sides' vectors are indexed by a cover tree (all points
of a node lie within its radius, halved from level to level), and pairs of
nodes are searched together. For a query node with centre a and radius r and a
candidate node with centre b and radius s no inner product exceeds

    <a, b> + r |b| + s |a| + r s

so a pair of nodes whose bound lies below the worst k-th score of the query
node's queries is pruned. Cells give k candidates a query; a last top-k over
the cells of a query merges them.
"""

from __future__ import annotations

import math


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Vectors of a block of queries and of candidates, about.
QUERY_BLOCK, BLOCK = 1024, 4096
#: A node of at most so many vectors is a leaf, among candidates and among queries.
LEAF, QUERY_LEAF = 256, 32


class Node:
    __slots__ = ("centre", "norm", "radius", "children", "rows")

    def __init__(self, centre: np.ndarray, radius: float, rows: np.ndarray, children: list[Node]):
        self.centre, self.radius, self.rows, self.children = centre, radius, rows, children
        self.norm = math.sqrt(float(centre @ centre))


def cover_tree(x: np.ndarray, rows: np.ndarray | None = None, leaf: int = LEAF) -> Node:
    """A cover tree over rows of ``x``: children's centres lie more than half the node's radius apart."""
    rows = np.arange(len(x)) if rows is None else rows
    centre = x[rows[0]]
    far = np.sqrt(((x[rows] - centre) ** 2).sum(axis=1))
    radius = float(far.max()) * (1 + 1e-9)
    if len(rows) <= leaf or radius == 0:
        return Node(centre, radius, rows, [])
    cover, left, children = radius / 2, rows, []
    while len(left):
        d = np.sqrt(((x[left] - x[left[0]]) ** 2).sum(axis=1))
        near = d <= cover
        children.append(left[near])
        left = left[~near]
        if len(children) >= 64 and len(left):  # points that are all far apart: group the rest by their nearest centre
            heads = x[[c[0] for c in children]]
            nearest = ((x[left][:, None, :] - heads[None]) ** 2).sum(axis=2).argmin(axis=1) if len(left) * 64 * x.shape[1] < 3e7 else np.concatenate([((x[p][:, None, :] - heads[None]) ** 2).sum(axis=2).argmin(axis=1) for p in np.array_split(left, len(left) // 1000 + 1)])
            children = [np.concatenate([c, left[nearest == i]]) for i, c in enumerate(children)]
            break
    if len(children) == 1:
        return Node(centre, radius, rows, [])
    return Node(centre, radius, rows, [cover_tree(x, c, leaf) for c in children])


class Search:
    """A dual-tree search for each query's k best candidates."""

    def __init__(self, q: np.ndarray, q_ids: np.ndarray, x: np.ndarray, x_ids: list[np.ndarray], k: int):
        self.q, self.q_ids, self.x, self.x_ids, self.k = q, q_ids, x, x_ids, k
        self.score = np.full((len(q), k), -np.inf)
        self.ids = np.full((len(q), k), np.iinfo(np.int64).max)
        self.compared = 0

    def run(self) -> None:
        if len(self.q) and len(self.x):
            self._pair(cover_tree(self.q, leaf=QUERY_LEAF), cover_tree(self.x))

    def _bound(self, a: Node, b: Node) -> float:
        return (float(a.centre @ b.centre) + a.radius * b.norm + b.radius * a.norm + a.radius * b.radius) * (1 + 1e-12) + 1e-6

    def _pair(self, a: Node, b: Node) -> None:
        if self._bound(a, b) < self.score[a.rows, -1].min():
            return
        if not a.children and not b.children:
            return self._leaves(a, b)
        if a.children and (not b.children or 2 * a.radius >= b.radius):  # tight query groups have tight bounds
            for child in a.children:
                self._pair(child, b)
        else:
            for child in sorted(b.children, key=lambda c: -self._bound(a, c)):
                self._pair(a, child)

    def _leaves(self, a: Node, b: Node) -> None:
        products = self.q[a.rows] @ self.x[b.rows].T
        self.compared += products.size
        worst = self.score[a.rows, -1]
        columns = np.flatnonzero((products >= worst[:, None]).any(axis=0))
        rows = np.flatnonzero((products[:, columns] >= worst[:, None]).any(axis=1))
        if not len(rows):
            return
        owners = [self.x_ids[j] for j in b.rows[columns].tolist()]
        own = a.rows[rows]
        scores = np.repeat(products[np.ix_(rows, columns)], [len(c) for c in owners], axis=1)
        ids = np.broadcast_to(np.concatenate(owners), scores.shape)
        scores = np.where(ids == self.q_ids[own][:, None], -np.inf, scores)  # a query is none of its own candidates
        scores, ids = np.hstack([self.score[own], scores]), np.hstack([self.ids[own], ids])
        best = np.lexsort((ids, -scores), axis=-1)[:, : self.k]
        self.score[own], self.ids[own] = np.take_along_axis(scores, best, 1), np.take_along_axis(ids, best, 1)


def _cell(k: int):
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not left.num_rows or not right.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        q_ids, x_ids = left.column("vec_id").to_numpy(), right.column("vec_id").to_numpy()
        q = np.array(left.column("whole").to_pylist(), dtype=np.float64).reshape(len(q_ids), -1)
        x = np.array(right.column("whole").to_pylist(), dtype=np.float64).reshape(len(x_ids), -1)
        same, inverse = np.unique(x, axis=0, return_inverse=True)  # equal vectors are one point
        order = np.lexsort((x_ids, inverse.ravel()))
        owners = np.split(x_ids[order], np.flatnonzero(np.diff(inverse.ravel()[order])) + 1)
        search = Search(q, q_ids, same, [o[: k + 1] for o in owners], k)  # a tie keeps the smallest ids; one may be the query
        search.run()
        i, j = np.nonzero(np.isfinite(search.score))
        return pa.table([pa.array(q_ids[i], pa.int64()), pa.array(search.ids[i, j], pa.int64()), pa.array(search.score[i, j].astype(np.int64))], names=names)

    return run


def whole_numbers(vector: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component, as a double holds x."""
    return F.transform(vector, lambda v: F.floor(F.lit(float(scale)) * v.cast("double")))


def top_k(vectors: DataFrame, *, k: int = 10, every: int = 100, scale: int = 1024, id_column: str = "vec_id", vector_column: str = "embedding", block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best other rows of each row whose id is divisible by ``every``.

    Ranked by score, ties by the smaller id; fewer rows if there are fewer
    others. Vectors that are null or hold a null or non-finite component, and
    rows without id, take no part; queries meet vectors of their own length
    only; an empty vector scores 0. Rows of one id are told apart only as
    candidates (each is one; none is its own query's). An empty table gives no
    rows. Sums must stay below 2**53, which 64-bit scores of 1024 x allow.
    """
    fine = F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v")).where("vec_id is not null").where(fine)
    rows = rows.select("vec_id", F.size("v").alias("dim"), whole_numbers(F.col("v"), scale).alias("whole"))
    queries = rows.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id"])
    n, m = rows.count(), queries.count()
    across, down = max(1, math.ceil(n / block)), max(1, math.ceil(m / query_block))
    x = rows.withColumn("col", F.pmod(F.xxhash64("vec_id", "whole"), F.lit(across)).cast("int")).withColumn("row", F.explode(F.sequence(F.lit(0), F.lit(down - 1))))
    q = queries.withColumn("row", F.pmod(F.xxhash64("vec_id"), F.lit(down)).cast("int")).withColumn("col", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    cells = q.groupBy("dim", "row", "col").cogroup(x.groupBy("dim", "row", "col")).applyInArrow(_cell(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return cells.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def compared_share(x: np.ndarray, q: np.ndarray, k: int) -> float:
    """The share of all pairs that a search compares (for tests and tuning)."""
    search = Search(q, np.full(len(q), -1), x, [np.array([i]) for i in range(len(x))], k)
    search.run()
    return search.compared / max(1, len(x) * len(q))


