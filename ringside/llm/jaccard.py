"""N-gram Jaccard join: which texts share at least a given part of their word shingles.

Exact, and without a pair for pairs' sake:

1. Every text becomes its sorted set of shingle hashes. Texts of equal sets
   form a class, and only the class goes on; its size band (steps of 6 %)
   stands in the high bits of its id.
2. Two sets of Jaccard similarity t share a shingle among the first
   n - ceil(t n) + 1 of each under any order common to all sets. The order
   puts frequent shingles last: how frequent comes from a sketch of fixed size
   over all texts. It steers the cost only; any order loses nothing.
3. Classes that share such a shingle stand together in tiles, one for each
   shingle and size band. Rounds of stars join each tile's classes to the
   tile's smallest; classes found linked then count as one and join the stars
   of whole shingles, so n near copies cost about n comparisons. When stars find nothing new, all
   pairs of differing components that share a shingle are compared, those of
   a frequent shingle block by block: a block is of one size band, and meets
   only blocks of bands whose sizes are near enough.
4. A pair is compared by the sets' bitmaps first: bits set in one bitmap alone
   bound the overlap from above. Only pairs that may reach the threshold have
   their sorted arrays intersected.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .storage import Tables, bounded_batches, id_filter, may_hold
from .words import SHINGLE, SLICE_BYTES, mix, shingle_sets, tidy

#: log2 of the sketch's counters (one byte each when broadcast: 4 MB).
SKETCH_BITS = 22
#: Texts are counted in groups of about so many shingles; a shingle of fewer texts in a group is not counted.
SKETCH_SHINGLES, SKETCH_LEAST = 1_000_000, 3
#: Shingles of at least this level (log2 of their count) are salted in the exchange.
SALT_LEVEL = 11
#: Bytes of the smallest bitmap; larger sets have wider ones, which fold onto a narrower partner's.
LEAST_BITMAP = 64
#: Bits a shingle of the wide bitmaps, which residual tiles of so many classes or more compare.
WIDE_BITS, WIDE_FROM = 8, 48
#: Classes of a residual block.
BLOCK = 256
#: Star rounds go on while one links at least this share of the classes (it sets the cost, not the result).
STAR_LINKS = 0.002
#: A class of more documents than both the first and the share of all that the second names is joined by broadcast.
LARGE_CLASS, LARGE_CLASSES = 1_000, 10_000
_STEP = 1.06
_LOW56 = (1 << 56) - 1


def bands(sizes: np.ndarray) -> np.ndarray:
    """The size band of each set: steps of 6 %."""
    return np.minimum(np.log(np.maximum(sizes, 1)) / np.log(_STEP), 255).astype(np.int64)


def _signature(own: np.ndarray) -> tuple[int, int]:
    a = int(np.sum(mix(own ^ np.uint64(0xA5A5A5A5DEADBEEF)), dtype=np.uint64))
    b = int(np.sum(mix(own + np.uint64(0x1234567890ABCDEF)), dtype=np.uint64))
    return a, b - (1 << 64) if b >> 63 else b


def class_id(own: np.ndarray) -> tuple[int, int]:
    """(band and 56 bits of the set's hash, 64 further bits): the id of a class of equal sets."""
    a, b = _signature(own)
    c = int(bands(np.array([len(own)]))[0]) << 56 | (a & _LOW56)
    return c - (1 << 64) if c >> 63 else c, b


def _fingerprints(size: int):
    """Rows of kind 0 (doc_id, set size, class) and of kind 1 (sketch counter, texts)."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, many, seen = [], 0, set()

        def counts() -> pa.RecordBatch:
            values, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= SKETCH_LEAST
            slots, inverse = np.unique(values[keep] >> np.uint64(64 - SKETCH_BITS), return_inverse=True)
            most = np.zeros(len(slots), dtype=np.int64)
            np.maximum.at(most, inverse, n[keep])
            nothing = pa.nulls(len(slots), pa.int64())
            return pa.RecordBatch.from_arrays([pa.array(np.ones(len(slots), np.int32)), pa.array(slots.astype(np.int64)), pa.array(most), nothing, nothing], names=["kind", "doc_id", "n", "cid", "check"])

        for batch in batches:
            n, cid, check = [], [], []
            for _, own in shingle_sets(batch.column(1), size):
                a, b = class_id(own)
                n.append(len(own))
                cid.append(a)
                check.append(b)
                if len(own) and (a, b) not in seen:
                    seen.add((a, b))
                    held.append(own)
                    many += len(own)
                    if many >= SKETCH_SHINGLES:
                        yield counts()
                        held, many = [], 0
            yield pa.RecordBatch.from_arrays([pa.array(np.zeros(len(n), np.int32)), batch.column(0), pa.array(n, pa.int64()), pa.array(cid, pa.int64()), pa.array(check, pa.int64())], names=["kind", "doc_id", "n", "cid", "check"])
        if held:
            yield counts()

    return run


def _sketch(rows: DataFrame) -> np.ndarray:
    """A level (log2 of the count) for every counter."""
    sums = rows.where("kind = 1").groupBy("doc_id").agg(F.floor(F.log2(F.sum("n"))).cast("byte").alias("level")).toArrow()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint8)
    out[sums["doc_id"].to_numpy()] = sums["level"].to_numpy()
    return out


def prefix_length(n: int, percent: int) -> int:
    """How many of a set's first shingles must hold one shared with any set that similar."""
    return n - -(-percent * n // 100) + 1


def _postings(sketch, percent: int, size: int):
    """The prefix shingles of each class: (token, salt, cid); a class once a task."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level, seen = sketch.value, set()
        for batch in batches:
            tokens, salts, cids = [], [], []
            for _, own in shingle_sets(batch.column(0), size):
                n = len(own)
                if 100 * n < percent * (n + 1):  # only equal sets are that similar
                    continue
                cid, check = class_id(own)
                if (cid, check) in seen:
                    continue
                seen.add((cid, check))
                lv = level[own >> np.uint64(64 - SKETCH_BITS)]
                k = prefix_length(n, percent)
                if lv.any():
                    at = np.argsort(lv, kind="stable")[:k]
                    top, lv = own[at], lv[at].astype(np.int64)
                    some = (cid * 0x9E3779B1 >> 20) & 0xFFFFFF
                    salts.append(np.where(lv >= SALT_LEVEL, 1 + (some & ((1 << np.maximum(lv - SALT_LEVEL, 0)) - 1)), 0).astype(np.int32))
                else:
                    top = own[:k]
                    salts.append(np.zeros(len(top), np.int32))
                tokens.append(top.view(np.int64))
                cids.append(np.full(len(top), cid, dtype=np.int64))
            if tokens:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (tokens, salts, cids)], names=["token", "salt", "cid"])

    return run


@tidy
def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (token, salt, cid): the distinct ones whose token has a second class, or is salted."""
    tail: pa.Table | None = None

    def keep(t: pa.Table, last: bool):
        token, salt, cid = (t.column(i).to_numpy() for i in range(3))
        n = len(token)
        new = np.ones(n, dtype=bool)
        new[1:] = (token[1:] != token[:-1]) | (salt[1:] != salt[:-1])
        first = np.ones(n, dtype=bool)
        first[1:] = new[1:] | (cid[1:] != cid[:-1])
        starts = np.flatnonzero(new)
        cut = n if last else int(starts[-1])
        if not last and cut == 0:  # one group fills all: its distinct rows are enough
            return None, t.filter(pa.array(first))
        group = np.cumsum(new) - 1
        several = np.bincount(group, weights=first) > 1
        good = first & (several[group] | (salt > 0))
        good[cut:] = False
        return t.filter(pa.array(good)), t.slice(cut)

    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = t if tail is None else pa.concat_tables([tail, t]).combine_chunks()
        out, tail = keep(t, False) if t.num_rows else (None, t)
        if out is not None:
            yield from out.to_batches()
    if tail is not None and tail.num_rows:
        yield from keep(tail, True)[0].to_batches()


def bitmap(own: np.ndarray, width: int) -> np.ndarray:
    """A set hashed to ``width`` bytes of bits."""
    bits = np.zeros(width * 8, dtype=np.uint8)
    bits[(own & np.uint64(width * 8 - 1)).astype(np.int64)] = 1
    return np.packbits(bits, bitorder="little")


def bitmap_width(n: int, bits: int = 2) -> int:
    """Bytes of a set's own bitmap: a power of two with ``bits`` to twice as many bits a shingle."""
    return max(LEAST_BITMAP, 1 << max(0, (bits * n - 1).bit_length() - 3))


def fold(bits: np.ndarray, width: int) -> np.ndarray:
    """A bitmap as it would be at a smaller width."""
    return np.bitwise_or.reduce(bits.reshape(-1, width), axis=0) if len(bits) > width else bits


def overlap_bound(a: np.ndarray, b: np.ndarray, n_a: int, n_b: int) -> int:
    """At most so many shingles are common: each bit that one bitmap has alone is a shingle of it alone."""
    return min(n_a - int(np.bitwise_count(a & ~b).sum()), n_b - int(np.bitwise_count(b & ~a).sum()))


def _reaches(overlap: int, n_a: int, n_b: int, percent: int) -> bool:
    return 100 * overlap >= percent * (n_a + n_b - overlap)


def _members(slots, size: int, arrays: bool):
    """Of classes' representatives, for ids that the filter may hold: (node, n, class, bitmaps or sorted array)."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            some = batch.filter(pa.array(may_hold(table, batch.column(2).to_numpy())))
            rows, ids, held = [], some.column(0).to_pylist(), 0
            for i, own in shingle_sets(some.column(1), size):
                if arrays:
                    data, wide = own.tobytes(), None
                else:
                    data, wide = (bitmap(own, bitmap_width(len(own), bits)).tobytes() for bits in (2, WIDE_BITS))
                rows.append((ids[i], len(own), *class_id(own), data, wide))
                held += len(data) + len(wide or b"")
                if held >= SLICE_BYTES:
                    yield _member_batch(rows)
                    rows, held = [], 0
            if rows:
                yield _member_batch(rows)

    return run


def _member_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=["node", "n", "cid", "check", "data", "wide"])


def _may_link(percent: int):
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            na, nb, ba, bb = (batch.column(i).to_pylist() for i in range(2, 6))
            good = []
            for x, y, p, q in zip(na, nb, ba, bb):
                ok = _reaches(min(x, y), x, y, percent)
                if ok:
                    p, q = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
                    w = min(len(p), len(q))
                    ok = _reaches(overlap_bound(fold(p, w), fold(q, w), x, y), x, y, percent)
                good.append(ok)
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


def _links(percent: int):
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for p, q in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(p.as_buffer(), np.uint64), np.frombuffer(q.as_buffer(), np.uint64)
                both = np.concatenate([x, y])
                both.sort()
                good.append(_reaches(int(np.count_nonzero(both[1:] == both[:-1])), len(x), len(y), percent))
            yield batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    return run


class _Comparison:
    """Compares pairs of nodes: first by bitmaps of all nodes, then by arrays fetched for what is left."""

    def __init__(self, tables: Tables, rows: DataFrame, classes: DataFrame, nodes: DataFrame, percent: int, size: int):
        self.tables, self.rows, self.classes, self.percent, self.size = tables, rows, classes, percent, size
        self.bits = tables.stored(self._fetch(nodes, False), "bitmaps")

    def _fetch(self, nodes: DataFrame, arrays: bool) -> DataFrame:
        slots, slot = id_filter(nodes, "node")
        texts = self.rows.select("doc_id", "text", slot(F.col("doc_id")).alias("slot")).where("doc_id is not null")
        sets = texts.mapInArrow(_members(slots, self.size, arrays), "node long, n long, cid long, check long, data binary, wide binary")
        wanted = self.classes.join(nodes, "node", "left_semi")
        return sets.join(wanted, ["node", "cid", "check"], "left_semi").select("node", "n", "data", "wide").dropDuplicates(["node"])

    def links(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) that link."""
        side = lambda table, x, *cols: table.select(F.col("node").alias(x), *(F.col(c).alias(f"{c}_{x}") for c in cols))
        both = pairs.join(side(self.bits, "a", "n", "data"), "a").join(side(self.bits, "b", "n", "data"), "b")
        near = self.tables.stored(both.select("a", "b", "n_a", "n_b", "data_a", "data_b").mapInArrow(_may_link(self.percent), "a long, b long"), "near")
        if near.isEmpty():
            return near
        arrays = self.tables.stored(self._fetch(near.select(F.explode(F.array("a", "b")).alias("node")).distinct(), True), "arrays")
        both = near.join(side(arrays, "a", "data"), "a").join(side(arrays, "b", "data"), "b").select("a", "b", "data_a", "data_b")
        return self.tables.stored(both.mapInArrow(_links(self.percent), "a long, b long"), "links")


def _blocks(percent: int):
    """Of tiles' rows sorted by tile: pairs of different components whose bitmaps allow a link."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def pairs(t: pa.Table) -> Iterator[pa.RecordBatch]:
            key = [t.column(c).to_numpy() for c in ("token", "lo", "hi")]
            new = np.flatnonzero(np.concatenate([[True], np.any([k[1:] != k[:-1] for k in key], axis=0)])) if t.num_rows else []
            node, comp, n, block = (t.column(c).to_numpy() for c in ("node", "comp", "n", "block"))
            data = t.column("data").to_pylist()
            found_a, found_b = [], []
            for s, e in zip(new, [*new[1:], t.num_rows]):
                lo, hi = key[1][s], key[2][s]
                bits = [np.frombuffer(x, np.uint8) for x in data[s:e]]
                width = np.array([len(x) for x in bits])
                level = {w: np.array([fold(x, w) for x in bits if len(x) >= w]).view(np.uint64) for w in np.unique(width).tolist()}
                at = {w: np.cumsum(width >= w) - 1 for w in level}
                left = np.flatnonzero(block[s:e] == lo)
                right = left if lo == hi else np.flatnonzero(block[s:e] == hi)
                own_n, own_node, own_comp = n[s:e], node[s:e], comp[s:e]
                for i in left.tolist():
                    x, y = own_n[i], own_n[right]
                    sized = 100 * np.minimum(x, y) >= percent * np.maximum(x, y)
                    others = right[sized & (own_comp[right] != own_comp[i]) & ((own_node[right] > own_node[i]) if lo == hi else True)]
                    for w in level:
                        some = others[width[others] >= w] if w == width[i] else others[width[others] == w] if w < width[i] else others[:0]
                        if not len(some):
                            continue
                        p, q, y = level[w][at[w][i]], level[w][at[w][some]], own_n[some]
                        most = np.minimum(x - np.bitwise_count(p & ~q).sum(axis=1), y - np.bitwise_count(q & ~p).sum(axis=1)).astype(np.int64)
                        ok = own_node[some[100 * most >= percent * (x + y - most)]]
                        found_a += [own_node[i]] * len(ok)
                        found_b += ok.tolist()
            if found_a:
                a, b = np.array(found_a), np.array(found_b)
                both = np.unique(np.column_stack([np.minimum(a, b), np.maximum(a, b)]), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["a", "b"])

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t]).combine_chunks()
            if not t.num_rows:
                continue
            same = np.all([t.column(c).to_numpy() == t.column(c)[-1].as_py() for c in ("token", "lo", "hi")], axis=0)
            cut = t.num_rows - int(np.argmin(same[::-1])) if not same.all() else 0
            yield from pairs(t.slice(0, cut).combine_chunks())
            held = t.slice(cut)
        if held is not None and held.num_rows:
            yield from pairs(held.combine_chunks())

    return run


def _residual(shared: DataFrame, comps: DataFrame, bits: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components that share a token and may link by size and bitmap.

    Classes of a token with more than ``BLOCK`` stand in blocks of their tile
    (four size bands); a block is compared with those of tiles in ``reach``.
    """
    reach = int(math.log(100 / percent) / (4 * math.log(_STEP))) + 1
    rows = shared.join(comps, "node", "left").select("token", "tile", "node", F.coalesce("comp", "node").alias("comp"))
    mixed = rows.groupBy("token").agg(F.count("*").alias("many"), F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("who")).where("c0 <> c1")
    # tokens that the same classes share would give the same pairs: one of them is enough
    mixed = mixed.groupBy("many", "who").agg(F.min("token").alias("token"))
    data = F.when(F.col("many") >= WIDE_FROM, F.col("wide")).otherwise(F.col("data")).alias("data")
    placed = rows.join(mixed.select("token", "many"), "token")
    sizes = placed.where(F.col("many") > BLOCK).groupBy("token", "tile").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("blocks"))
    cut = sizes.groupBy("token").agg(F.map_from_entries(F.collect_list(F.struct("tile", "blocks"))).alias("cut"))  # at most 64 tiles
    placed = placed.join(cut, "token", "left")
    name = lambda tile, block: F.shiftleft(tile.cast("long"), 32) + block
    own = F.when(F.col("cut").isNull(), F.lit(0).cast("long")).otherwise(name(F.col("tile"), F.pmod(F.xxhash64("node", F.lit(7)), F.col("cut")[F.col("tile")])))
    near = F.filter(F.map_entries("cut"), lambda e: F.abs(e["key"] - F.col("tile")) <= reach)
    others = F.flatten(F.transform(near, lambda e: F.transform(F.sequence(F.lit(0), e["value"] - 1), lambda j: name(e["key"], j))))
    placed = placed.withColumns({"block": own, "other": F.explode(F.coalesce(others, F.array(F.lit(0).cast("long"))))})
    spread = placed.select("token", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node", "comp", "many")
    tiles = spread.join(bits, "node").select("token", "lo", "hi", "block", "node", "comp", "n", data)
    pairs = tiles.repartition("token", "lo", "hi").sortWithinPartitions("token", "lo", "hi").mapInArrow(_blocks(percent), "a long, b long")
    return pairs.distinct()


def jaccard_components(docs: DataFrame, *, percent: int = 80, size: int = SHINGLE, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, class_id`` for every row.

    Two documents link when ``100 * |A ∩ B| >= percent * |A ∪ B|`` of their
    shingle sets; ``component_id`` is the smallest doc_id that links reach,
    ``class_id`` the smallest of equal sets. A text without words (null, empty,
    white space) has an empty set, links with nothing and is its own component.
    A row without doc_id links with nothing: its component and class are null.
    Repeated rows give a row each. An empty table gives no rows.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.selectExpr(f"cast(`{id_column}` as long) doc_id", f"cast(`{text_column}` as string) text")
    tables = Tables(spark)
    prints = tables.stored(rows.mapInArrow(_fingerprints(size), "kind int, doc_id long, n long, cid long, check long"), "prints")
    documents = prints.where("kind = 0").drop("kind")
    linked = documents.where("doc_id is not null and n > 0")
    classes = linked.groupBy("cid", "check").agg(F.min("doc_id").alias("node"), F.count("*").alias("many"))
    sketch = spark.sparkContext.broadcast(_sketch(prints))

    posted = rows.where("doc_id is not null").select("text").mapInArrow(_postings(sketch, percent, size), "token long, salt int, cid long")
    together = posted.repartition("token", "salt").sortWithinPartitions("token", "salt", "cid").mapInArrow(_shared, "token long, salt int, cid long")
    # a salted token's classes stand together from here on, in tiles of four size bands
    shared = tables.stored(together.join(classes.select("cid", "node"), "cid").select("token", F.shiftrightunsigned("cid", 58).cast("int").alias("tile"), "node").distinct(), "shared")

    nodes = shared.select("node").distinct()
    compare = _Comparison(tables, rows, classes, nodes, percent, size)

    links: DataFrame | None = None
    comps: DataFrame = nodes.select("node", F.col("node").alias("comp"))

    def join(found: DataFrame) -> None:
        nonlocal links, comps
        links = found if links is None else links.unionByName(found)
        comps = tables.stored(connected_components(links, tables).select("node", F.col("component").alias("comp")), "components")

    many = nodes.count()
    while many:
        now = shared.join(comps, "node", "left").select("token", "tile", F.coalesce("comp", "node").alias("comp"), "node")
        if links is None:  # within tiles first; then each component sends one class to the token's star
            heads, tile = now, ["token", "tile"]
        else:
            heads, tile = now.groupBy("token", "comp").agg(F.min("node").alias("node")), ["token"]
        lead = heads.groupBy(*tile).agg(F.min("comp").alias("c"), F.max("comp").alias("c1"), F.min_by("node", "comp").alias("a")).where("c <> c1").drop("c1")
        pairs = heads.join(lead, tile).where("comp <> c").select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        found, first = compare.links(pairs), links is None
        new = found.count()
        if new:
            join(found)
        if not first and new < STAR_LINKS * many or not new:  # few are left: the rest is compared whole
            break
    if many:
        found = compare.links(_residual(shared, comps, compare.bits, percent))
        if not found.isEmpty():
            join(found)

    whole = classes.join(comps, "node", "left").select("cid", "check", "many", F.col("node").alias("class_id"), F.coalesce("comp", "node").alias("component_id"))
    # classes of more than a ten-thousandth of all documents are at most so many: they are broadcast, so none meets in one task
    large = F.col("many") > F.lit(max(LARGE_CLASS, linked.count() // LARGE_CLASSES))
    names = ["cid", "check"]
    heavy = F.broadcast(whole.where(large).drop("many"))
    held = documents.join(heavy, names)
    out = held.unionByName(documents.join(heavy.select(*names), names, "left_anti").join(whole.where(~large).drop("many"), names, "left"))
    own = F.col("doc_id")
    out = out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(own.isNotNull(), F.when(F.col("n") > 0, F.col("component_id")).otherwise(own)).alias("component_id"),
        F.when(own.isNotNull(), F.when(F.col("n") > 0, F.col("class_id")).otherwise(own)).alias("class_id"),
    )
    return tables.result(out, "groups")
