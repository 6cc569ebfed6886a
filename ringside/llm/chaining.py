"""Fuzzy repeated passages by collinear chaining of shared k-mer seeds.

1. Seeds: the hashes of all k-mers (runs of ``K`` words).
2. Join: a task cuts its texts into slices of bounded size. Of each slice and
   seed one occurrence, that in the smallest document, goes to the seed's
   bucket, packed with others into a few binary cells. There it meets the
   heads of other slices. The answer to each slice holds the seed's smallest
   document of all (its head) and the one before. So a seed costs its bucket
   a few bytes a slice, however many documents hold it, and seeds of one
   document, which are most, end there. In its slice the answer reaches all
   other occurrences. So every occurrence is matched with its head (a star)
   and, where that explains nothing, with a neighbour (a path).
3. Runs: parts of a passage may have different heads, none of which holds the
   whole. A run of ``MIN_WORDS`` words all of whose seeds are shared but whose
   heads differ is a seed itself, with a star of its own. So every unchanged
   passage of so many words is found, whatever other documents hold of it.
4. Chain: a document's matches stand in its slice. Those on one diagonal are
   anchors; anchors are chained in both texts by a Fenwick tree of best
   prefixes, a gap costing in proportion to its length.
5. Filter: one byte a word around a chain bounds its equal words from above.
6. Align: chains are extended word by word along their ends, joined by
   alignments with one indel between anchors, and split where they stop
   matching. What has at least ``MIN_WORDS`` words on both sides and a share
   of ``MIN_IDENTITY`` equal words is a passage. Texts are cut to windows
   around a chain; what reaches a window's end is aligned on whole texts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .storage import Tables, bounded_batches, filter_words, id_filter, may_hold, split_by_ids
from .words import SHINGLE, SLICE_BYTES, mix, shingle_hashes, slices, text_buffer, tidy, word_hashes, word_spans

K = SHINGLE
MIN_WORDS, MIN_IDENTITY = 50, 0.8
#: Equal words of a passage, at least.
LEAST_EQUAL = MIN_WORDS * MIN_IDENTITY
#: Seeds of a run.
RUN = MIN_WORDS - K + 1
#: A chain's score is K a seed less this much a word of gap, in both documents.
GAP_COST = 0.1
#: Seeds of a chain that is aligned.
MIN_SEEDS = 2
#: An extension ends when its score (+1 a match, -1 a mismatch) falls so far below its best.
DROP = 8
#: A run of so many columns without a match splits an alignment.
SPLIT = 12
#: Bytes of text of a slice.
JOIN_BYTES = 4_000_000
#: Bytes of text whose seeds share a bucket, about, and buckets of a partition.
BUCKET_BYTES, PARTITION_BUCKETS = 32_000_000, 8
#: A bucket has so many bytes of text at least, lest cells be a few seeds each.
LEAST_BUCKET = 200_000
#: Bits of a seed's name within its bucket.
NAME_BITS = 40
#: Words around a chain that are looked at first, by one byte each, and those that are aligned first.
SHORT_REACH, REACH = 24, 400

_CELLS = "key int, kind int, slice long, names binary, docs binary, counts binary, pos binary, more binary"
_ANSWERS = "slice long, names binary, docs binary, pos binary, heads binary, head_pos binary, befores binary, before_pos binary"
_CHAIN = "doc long, other long, pos array<int>, other_pos array<int>"
_FOUND = "doc long, other long, pos array<int>, other_pos array<int>, cell struct<key:int,kind:int,slice:bigint,names:binary,docs:binary,counts:binary,pos:binary,more:binary>"


def _planes(x: np.ndarray, width: int) -> np.ndarray:
    """The lowest ``width`` bytes of little-endian numbers, byte by byte: high bytes are mostly equal and compress well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1)[:, :width].T)


def _unplaned(data, width: int, dtype: str) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], np.dtype(dtype).itemsize), np.uint8)
    out[:, :width] = raw.T
    return out.reshape(-1).view(dtype)


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields])


def _slice_cells(seed: np.ndarray, doc: np.ndarray, pos: np.ndarray, bits: int, slice_id: int) -> list[tuple]:
    """Rows of a slice's seeds: a cell a bucket with the head of each seed (kind 0), and all other occurrences (kind 1)."""
    if (doc[1:] < doc[:-1]).any():
        order = np.argsort(doc, kind="stable")
        seed, doc, pos = seed[order], doc[order], pos[order]
    name = seed >> np.uint64(64 - bits - NAME_BITS)
    del seed
    order = np.argsort(name, kind="stable")
    name, doc, pos = name[order], doc[order], pos[order].astype(np.int32)
    del order
    new = np.ones(len(name), dtype=bool)
    new[1:] = name[1:] != name[:-1]
    starts = np.flatnonzero(new)
    another = np.zeros(len(name), dtype=bool)
    another[1:] = ~new[1:] & (doc[1:] != doc[:-1])
    several = np.add.reduceat(another, starts) > 0
    rows: list[tuple] = []
    rest = np.flatnonzero(~new)
    if len(rest):
        steps = np.diff(name[rest], prepend=np.uint64(0))  # names ascend
        rows.append((slice_id & ((1 << bits) - 1), 1, slice_id, *(_planes(x, x.itemsize).tobytes() for x in (steps, doc[rest])), None, _planes(pos[rest], 4).tobytes(), None))
    head_name, head_doc, head_pos = name[starts], doc[starts], pos[starts]
    bucket = (head_name >> np.uint64(NAME_BITS)).astype(np.int64)
    order = np.lexsort((head_doc, bucket))
    head_name, head_doc, head_pos, several, bucket = (x[order] for x in (head_name, head_doc, head_pos, several, bucket))
    names, places = _planes(head_name, NAME_BITS // 8), _planes(head_pos, 4)
    own = np.flatnonzero(np.concatenate([[True], (bucket[1:] != bucket[:-1]) | (head_doc[1:] != head_doc[:-1])]))
    counts = np.diff(np.append(own, len(bucket))).astype(np.uint32)
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]]))
    cuts = np.searchsorted(own, edges)
    for a, b, c, d in zip(edges[:-1].tolist(), edges[1:].tolist(), cuts[:-1].tolist(), cuts[1:].tolist()):
        docs = np.diff(head_doc[own[c:d]], prepend=np.int64(0))  # they ascend
        rows.append((int(bucket[a]), 0, slice_id, names[:, a:b].tobytes(), _planes(docs, 8).tobytes(), _planes(counts[c:d], 4).tobytes(), places[:, a:b].tobytes(), np.packbits(several[a:b]).tobytes()))
    return rows


def _seed_cells(bits: int):
    """The cells of all k-mers of texts that can hold a passage."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, mark = 0, xxhash.xxh3_64()

        def flush() -> pa.RecordBatch:
            seed, doc, pos = (np.concatenate(x) for x in zip(*held))
            held.clear()
            # the slice's name comes from what it holds, so a task that runs again gives it again
            return _batch(_slice_cells(seed, doc, pos, bits, mark.intdigest() >> 1), _CELLS)

        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            ids = batch.column(0).to_numpy()
            for i, j in slices(offsets, min(SLICE_BYTES, JOIN_BYTES)):
                words, per_text = word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                shingles, count = shingle_hashes(words, per_text, K)
                text = np.repeat(np.arange(len(count)), count)
                at = np.flatnonzero(per_text[text] >= MIN_WORDS)
                if len(at):
                    text = text[at]
                    held.append((shingles[at], ids[i:j][text], (at - (np.cumsum(count) - count)[text]).astype(np.int32)))
                    mark.update(np.ascontiguousarray(ids[i:j]).tobytes() + per_text.tobytes())
                size += int(offsets[j] - offsets[i])
                if size >= JOIN_BYTES and held:
                    yield flush()
                    size, mark = 0, xxhash.xxh3_64()
        if held:
            yield flush()

    return run


@tidy
def _answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket: to each slice, of its seeds that two documents hold, the head and the one before.

    A slice's other occurrences go on as they are. Numbers are packed in byte
    planes; the one before is told as its difference from the head.
    """

    def answer(key: int, cells: list[tuple]) -> pa.RecordBatch | None:
        name = np.concatenate([_unplaned(c[1], NAME_BITS // 8, "<u8") for c in cells])
        doc = np.concatenate([np.repeat(np.cumsum(_unplaned(c[2], 8, "<i8")), _unplaned(c[3], 4, "<u4")) for c in cells])
        pos = np.concatenate([_unplaned(c[4], 4, "<i4") for c in cells])
        sizes = [len(c[1]) // (NAME_BITS // 8) for c in cells]
        several = np.concatenate([np.unpackbits(np.frombuffer(c[5], np.uint8), count=n) for c, n in zip(cells, sizes)]).astype(bool)
        order = np.lexsort((pos, doc, name))
        name, doc, pos, several = name[order], doc[order], pos[order], several[order]
        new = np.concatenate([[True], name[1:] != name[:-1]])
        starts = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        last = np.append(starts[1:], len(name)) - 1
        shared = (doc[last] != doc[starts]) | np.bitwise_or.reduceat(several, starts)
        some = np.flatnonzero(shared[group])
        if not len(some):
            return None
        head = starts[group[some]]
        before = np.maximum(some - 1, head)
        whose = np.repeat(np.arange(len(cells)), sizes)[order][some]
        by = np.lexsort((pos[some], doc[some], whose))
        some, head, before, whose = some[by], head[by], before[by], whose[by]
        full = name + (np.uint64(key) << np.uint64(NAME_BITS))
        told = (full[some], doc[some], pos[some], doc[head], pos[head], doc[before] ^ doc[head], pos[before] ^ pos[head])
        edges = np.flatnonzero(np.concatenate([[True], whose[1:] != whose[:-1], [True]])).tolist()
        rows = []
        for a, b in zip(edges[:-1], edges[1:]):
            rows.append((cells[int(whose[a])][0], *(_planes(x[a:b], x.itemsize).tobytes() for x in told)))
        return _batch(rows, _ANSWERS)

    key, cells = None, []
    for batch in batches:
        keys, kinds, ids = (batch.column(i).to_pylist() for i in range(3))
        rest = [k for k, kind in enumerate(kinds) if kind == 1]
        if rest:
            value = lambda i, k: batch.column(i)[k].as_buffer().to_pybytes()
            yield _batch([(ids[k], value(3, k), value(4, k), value(6, k), None, None, None, None) for k in rest], _ANSWERS)
        for k, kind in enumerate(kinds):
            if kind == 1:
                continue
            if keys[k] != key:
                if cells and (out := answer(key, cells)) is not None:
                    yield out
                key, cells = keys[k], []
            cells.append((ids[k], *(batch.column(i)[k].as_buffer() for i in range(3, 8))))
    if cells and (out := answer(key, cells)) is not None:
        yield out


class Fenwick:
    """Best (value, owner) of prefixes."""

    def __init__(self, n: int):
        self.n, self.best = n, [(float("-inf"), -1)] * (n + 1)

    def put(self, i: int, item: tuple[float, int]) -> None:
        i += 1
        while i <= self.n:
            if item > self.best[i]:
                self.best[i] = item
            i += i & -i

    def before(self, i: int) -> tuple[float, int]:
        """The best among places 0 .. i - 1."""
        out = (float("-inf"), -1)
        while i > 0:
            if self.best[i] > out:
                out = self.best[i]
            i -= i & -i
        return out


def chains(pos: list[int], other: list[int], seeds: list[int] | None = None) -> list[list[int]]:
    """Collinear chains (lists of indexes) of anchors, best first; each anchor is in one at most.

    An anchor is ``seeds`` matches (one, if not given) in a row from its place.
    A chain's places grow in both texts: an anchor's first seed comes after the
    last one of the anchor before. Starts and ends of anchors are swept in
    order of the first text; the tree holds the chains ended so far by their
    end in the other.
    """
    n = len(pos)
    seeds = [1] * n if seeds is None else seeds
    p_end, q_end = [p + k - 1 for p, k in zip(pos, seeds)], [q + k - 1 for q, k in zip(other, seeds)]
    ranks = {v: r for r, v in enumerate(sorted(set(q_end) | set(other)))}
    tree, score, back = Fenwick(len(ranks)), [0.0] * n, [-1] * n
    for place, ends, i in sorted([(p, 0, i) for i, p in enumerate(pos)] + [(p, 1, i) for i, p in enumerate(p_end)]):
        if ends:
            tree.put(ranks[q_end[i]], (score[i] + GAP_COST * (p_end[i] + q_end[i]), i))
            continue
        value, owner = tree.before(ranks[other[i]])
        follow = value - GAP_COST * (pos[i] + other[i])
        score[i] = K * seeds[i] - 2 * GAP_COST * (seeds[i] - 1)
        if follow > 0:
            score[i], back[i] = score[i] + follow, owner
    used, out = [False] * n, []
    for i in sorted(range(n), key=lambda i: (-score[i], pos[i])):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if chain:
            out.append(chain[::-1])
    return out


def _apart(found: list[list[int]], pos: list[int], seeds: list[int]) -> list[list[int]]:
    """Chains, best first, without those most of whose words better ones hold: a period of a text matches at many places."""
    base, out = min(pos), []
    held = np.zeros(max(p + n for p, n in zip(pos, seeds)) + K - base, dtype=bool)
    for chain in found:
        words = [slice(pos[i] - base, pos[i] - base + seeds[i] + K - 1) for i in chain]
        if 2 * sum(int(held[w].sum()) for w in words) <= sum(w.stop - w.start for w in words):
            out.append(chain)
            for w in words:
                held[w] = True
    return out


def match_chains(doc: np.ndarray, pos: np.ndarray, other: np.ndarray, other_pos: np.ndarray, seeds: int = 1) -> list[tuple[int, int, list[tuple[int, int, int]]]]:
    """Chains (doc, other, anchors as (pos, other_pos, seeds)) worth aligning among matches of ``seeds`` seeds each.

    Where nothing is collinear, as between two runs of one word, the first match stands alone.
    """
    if not len(doc):
        return []
    slope = pos.astype(np.int64) - other_pos
    order = np.lexsort((pos, slope, other, doc))
    doc, pos, other, other_pos, slope = (x[order] for x in (doc, pos, other, other_pos, slope))
    pair = np.concatenate([[True], (doc[1:] != doc[:-1]) | (other[1:] != other[:-1])])
    line = pair | np.concatenate([[True], slope[1:] != slope[:-1]])
    again = ~line & np.concatenate([[False], pos[1:] == pos[:-1]])  # repeated rows give a match again
    if again.any():
        doc, pos, other, other_pos, pair, line = (x[~again] for x in (doc, pos, other, other_pos, pair, line))
    first = line | np.concatenate([[True], pos[1:] != pos[:-1] + 1])
    at = np.flatnonzero(first)
    size = np.diff(np.append(at, len(pos))) + seeds - 1
    doc, pos, other, other_pos, pair = doc[at], pos[at], other[at], other_pos[at], pair[at]
    groups = np.flatnonzero(pair)
    total = np.add.reduceat(size, groups)
    ends = np.append(groups[1:], len(pos))
    out = []
    for g in np.flatnonzero(total >= MIN_SEEDS).tolist():
        a, b = int(groups[g]), int(ends[g])
        p, q, n = pos[a:b].tolist(), other_pos[a:b].tolist(), size[a:b].tolist()
        if b == a + 1:
            found = [[0]]
        else:
            found = _apart([c for c in chains(p, q, n) if sum(n[i] for i in c) >= MIN_SEEDS], p, n) or [[min(range(b - a), key=lambda i: p[i])]]
        out += [(int(doc[a]), int(other[a]), [(p[i], q[i], n[i]) for i in c]) for c in found]
    return out


def _settled(chain: list[tuple[int, int, int]]) -> tuple[int, int] | None:
    """The words that a chain explains, if its seeds alone make it a passage."""
    (p, q, _), (r, s, n) = chain[0], chain[-1]
    length, other = r + n + K - 1 - p, s + n + K - 1 - q
    sure = min(length, other) >= MIN_WORDS and sum(k + K - 1 for *_, k in chain) >= MIN_IDENTITY * max(length, other)
    return (p, p + length) if sure else None


def _outside(doc: np.ndarray, pos: np.ndarray, spans: list[tuple[int, int, int]]) -> np.ndarray:
    """Which seeds (doc, pos) don't lie whole in a span (doc, start, end) of words."""
    if not spans or not len(doc):
        return np.ones(len(doc), dtype=bool)
    docs, rank = np.unique(doc, return_inverse=True)
    d, s, e = (np.array(x, dtype=np.int64) for x in zip(*spans))
    known = np.isin(d, docs)
    d, s, e = np.searchsorted(docs, d[known]), s[known], e[known]
    order = np.lexsort((s, d))
    d, s, e = d[order], s[order], e[order]
    wide = np.int64(1) << 34
    reach = np.maximum.accumulate(d * wide + e) if len(d) else d  # spans of one document reach the farthest end so far
    at = np.searchsorted(d * wide + s, rank * wide + pos, side="right") - 1
    inside = (at >= 0) & (reach[np.maximum(at, 0)] >= rank * wide + pos + K) & (d[np.maximum(at, 0)] == rank) if len(d) else np.zeros(len(doc), bool)
    return ~inside


def _scattered(name: np.ndarray, doc: np.ndarray, pos: np.ndarray, head: np.ndarray, head_pos: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(run hash, index of its first seed) of runs of ``RUN`` shared seeds whose heads don't hold them whole; rows sorted by (doc, pos)."""
    n = len(doc)
    if n < RUN:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    next_ = (doc[1:] == doc[:-1]) & (pos[1:] == pos[:-1] + 1)
    same = next_ & (head[1:] == head[:-1]) & (head_pos[1:] == head_pos[:-1] + 1)
    steps, alike = (np.concatenate([[0], np.cumsum(x)]) for x in (next_, same))
    at = np.arange(n - RUN + 1)
    whole = steps[at + RUN - 1] - steps[at] == RUN - 1
    at = at[whole & (alike[at + RUN - 1] - alike[at] < RUN - 1)]
    run = np.zeros(len(at), dtype=np.uint64)
    for k in range(0, MIN_WORDS, K):
        run = mix(run + name[at + k] + np.uint64(k + 1))
    return run, at


def _found(bits: int, seeds: int):
    """Rows sorted by slice: chains of its documents, and (of single seeds) cells of the runs that heads don't explain."""

    def close(slice_id: int, told: list[tuple], rest: list[tuple]) -> Iterator[pa.RecordBatch]:
        def column(rows: list[tuple], i: int, dtype) -> np.ndarray:
            return np.concatenate([_unplaned(r[i], np.dtype(dtype).itemsize, dtype) for r in rows]) if rows else np.zeros(0, dtype)

        kinds = ("<u8", "<i8", "<i4", "<i8", "<i4", "<i8", "<i4")
        name, doc, pos, head, head_pos, before, before_pos = (column(told, i, t) for i, t in enumerate(kinds))
        if not len(name):
            return
        before, before_pos = before ^ head, before_pos ^ head_pos
        order = np.argsort(name, kind="stable")
        name, doc, pos, head, head_pos, before, before_pos = (x[order] for x in (name, doc, pos, head, head_pos, before, before_pos))
        n2 = np.concatenate([np.cumsum(_unplaned(r[0], 8, "<u8"), dtype=np.uint64) for r in rest]) if rest else np.zeros(0, np.uint64)
        d2, p2 = (column(rest, i, kinds[i]) for i in (1, 2))
        if len(n2):
            k = np.minimum(np.searchsorted(name, n2), len(name) - 1)
            here = np.flatnonzero(name[k] == n2)
            n2, d2, p2, k = n2[here], d2[here], p2[here], k[here]
        near = np.zeros(len(name), dtype=bool)
        if len(n2):
            # the occurrence before: the last one of the document before in the slice, else the slice's head, else what the head was told
            start = np.concatenate([[True], (n2[1:] != n2[:-1]) | (d2[1:] != d2[:-1])])
            j = np.maximum.accumulate(np.where(start, np.arange(len(n2)), 0)) - 1
            inner = (j >= 0) & (n2[np.maximum(j, 0)] == n2) & (d2[np.maximum(j, 0)] < d2)
            own = d2 == doc[k]
            b2 = np.where(inner, d2[np.maximum(j, 0)], np.where(own, before[k], doc[k]))
            q2 = np.where(inner, p2[np.maximum(j, 0)], np.where(own, before_pos[k], pos[k])).astype(np.int32)
            # a seed that comes again within the words of a passage is matched once: chains from there are extended, and runs have their own star
            p0 = np.where(start, np.where(own, pos[k], -MIN_WORDS), p2[np.maximum(np.arange(len(n2)) - 1, 0)])
            near = np.concatenate([near, p2 - p0 < MIN_WORDS])
            joined = ((name, n2), (doc, d2), (pos, p2), (head, head[k]), (head_pos, head_pos[k]), (before, b2), (before_pos, q2))
            name, doc, pos, head, head_pos, before, before_pos = (np.concatenate(x) for x in joined)
        order = np.lexsort((pos, doc))
        order = order[np.concatenate([[True], (doc[order[1:]] != doc[order[:-1]]) | (pos[order[1:]] != pos[order[:-1]])])]  # repeated rows of a document
        name, doc, pos, head, head_pos, before, before_pos, near = (x[order] for x in (name, doc, pos, head, head_pos, before, before_pos, near))
        near &= seeds == 1
        star = np.flatnonzero((doc != head) & ~near)
        found = match_chains(doc[star], pos[star], head[star], head_pos[star], seeds)
        if seeds == 1:
            spans = [(c[0], *s) for c in found if (s := _settled(c[2])) is not None]
            path = np.flatnonzero((before < doc) & (before != head) & ~near & _outside(doc, pos, spans))
            found += match_chains(doc[path], pos[path], before[path], before_pos[path], seeds)
        cells: list[tuple] = []
        if seeds == 1:
            run, at = _scattered(name, doc, pos, head, head_pos)
            if len(run):
                cells = _slice_cells(run, doc[at], pos[at], bits, slice_id)
        if not found and not cells:
            return
        none = len(cells)
        points = [[x for p, q, n in c[2] for x in ((p, q), (p + n - 1, q + n - 1))[: 2 if n > 1 else 1]] for c in found]
        columns = [
            pa.array([c[0] for c in found] + [None] * none, pa.int64()),
            pa.array([c[1] for c in found] + [None] * none, pa.int64()),
            pa.array([[p for p, _ in c] for c in points] + [None] * none, pa.list_(pa.int32())),
            pa.array([[q for _, q in c] for c in points] + [None] * none, pa.list_(pa.int32())),
        ]
        names = [f.split()[0] for f in _CELLS.split(", ")]
        kinds_ = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
        inner_ = pa.array([None] * len(found) + [dict(zip(names, c)) for c in cells], pa.struct(list(zip(names, kinds_))))
        whole = pa.RecordBatch.from_arrays([*columns, inner_], names=["doc", "other", "pos", "other_pos", "cell"])
        for i in range(0, whole.num_rows, 1000):
            yield whole.slice(i, 1000)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, told, rest = None, [], []
        for batch in batches:
            for k, one in enumerate(batch.column(0).to_pylist()):
                if one != key:
                    if key is not None:
                        yield from close(key, told, rest)
                    key, told, rest = one, [], []
                if batch.column(4)[k].is_valid:
                    told.append(tuple(batch.column(i)[k].as_buffer() for i in range(1, 8)))
                else:
                    rest.append(tuple(batch.column(i)[k].as_buffer() for i in range(1, 4)))
        if key is not None:
            yield from close(key, told, rest)

    return run


def _extend(a: np.ndarray, b: np.ndarray) -> tuple[int, bool]:
    """How far two texts go on alike from their start, mismatches allowed while they pay; and whether that is all there is."""
    n, step, best, total, at = min(len(a), len(b)), 64, 0, 0, 0
    end = 0
    while at < n:
        eq = a[at : at + step][: n - at] == b[at : at + step][: n - at]
        run = total + np.cumsum(np.where(eq, 1, -1))
        peak = np.maximum.accumulate(np.maximum(run, best))
        stop = np.flatnonzero(peak - run >= DROP)
        upto = int(stop[0]) if len(stop) else len(run)
        if upto:
            top = int(np.argmax(run[:upto]))
            if run[top] > best:
                best, end = int(run[top]), at + top + 1
        if len(stop):
            return end, False
        total, at, step = int(run[-1]), at + len(run), 4 * step
    return end, True


def open_ended(a: np.ndarray, b: np.ndarray, pos: list[int], other: list[int], cut: tuple[bool, bool, bool, bool]) -> bool:
    """Whether a chain's extension uses up a window that its text goes on beyond (left of a, of b, right of a, of b)."""
    sides = (a[: pos[0]][::-1], b[: other[0]][::-1]), (a[pos[-1] :], b[other[-1] :])
    for (x, y), (cut_x, cut_y) in zip(sides, (cut[:2], cut[2:])):
        if (cut_x or cut_y) and _extend(x, y)[1] and ((cut_x and len(x) <= len(y)) or (cut_y and len(y) <= len(x))):
            return True
    return False


def _columns(a: np.ndarray, b: np.ndarray, pos: list[int], other: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The aligned words of two texts along a chain: places in either, and whether they are equal."""
    left, _ = _extend(a[: pos[0]][::-1], b[: other[0]][::-1])
    right, _ = _extend(a[pos[-1] :], b[other[-1] :])
    p = [pos[0] - left, *pos, pos[-1] + right]
    q = [other[0] - left, *other, other[-1] + right]
    rows, cols, same = [], [], []
    for p0, q0, p1, q1 in zip(p, q, p[1:], q[1:]):
        x, y = a[p0:p1], b[q0:q1]
        n = min(len(x), len(y))
        if len(x) == len(y):
            eq = x == y
            cut = n
        else:  # one indel, where the two diagonals together match most
            head, tail = x[:n] == y[:n], x[len(x) - n :] == y[len(y) - n :]
            total = np.concatenate([[0], np.cumsum(head)]) + np.concatenate([np.cumsum(tail[::-1])[::-1], [0]])
            cut = int(np.argmax(total))
            eq = np.concatenate([head[:cut], tail[cut:]])
        i = np.arange(n)
        rows.append(p0 + i + np.where(i >= cut, len(x) - n, 0))
        cols.append(q0 + i + np.where(i >= cut, len(y) - n, 0))
        same.append(eq)
    return np.concatenate(rows), np.concatenate(cols), np.concatenate(same)


def align(a: np.ndarray, b: np.ndarray, pos: list[int], other: list[int]) -> list[tuple[int, int, int, int, int]]:
    """Passages (start, end, other start, other end, equal words) along a chain of k-mer matches of two texts."""
    i, j, eq = _columns(a, b, pos, other)
    hits = np.flatnonzero(eq)
    if len(hits) < LEAST_EQUAL:
        return []
    gaps = np.maximum(np.diff(i[hits]), np.diff(j[hits]))
    out = []
    for part in np.split(hits, np.flatnonzero(gaps > SPLIT) + 1):
        s, e, t, f = int(i[part[0]]), int(i[part[-1]]) + 1, int(j[part[0]]), int(j[part[-1]]) + 1
        if min(e - s, f - t) >= MIN_WORDS and len(part) >= MIN_IDENTITY * max(e - s, f - t):
            out.append((s, e, t, f, len(part)))
    return out


def _word_rows(slots, bits: int):
    """(doc, words as hashes of ``bits`` bits) of documents that the filter may hold."""

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        for batch in batches:
            some = batch.filter(pa.array(may_hold(table, batch.column(2).to_numpy())))
            raw, offsets = text_buffer(some.column(1))
            for i, j in slices(offsets):
                words, per_text = word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                short = (words >> np.uint64(64 - bits)).astype(f"<u{bits // 8}")
                ends = np.cumsum(per_text).tolist()
                own = [short[e - n : e].tobytes() for e, n in zip(ends, per_text.tolist())]
                yield pa.RecordBatch.from_arrays([some.column(0).slice(i, j - i), pa.array(own, pa.binary())], names=["doc", "words"])

    return run


PASSAGES = "doc_id long, other_id long, start_word int, end_word int, other_start int, other_end int, equal_words int"
_ALIGNED = PASSAGES + ", again_pos array<int>, again_other array<int>"


def _windows(batch: pa.RecordBatch) -> Iterator[tuple]:
    """Chains (doc, other, pos, other_pos), where their windows begin, the windows, and which of their ends are cut."""
    doc, other, pos, other_pos, base, full, other_base, other_full = (batch.column(i).to_pylist() for i in (0, 1, 2, 3, 4, 6, 7, 9))
    for k, (p, q, s, t) in enumerate(zip(pos, other_pos, base, other_base)):
        a, b = (np.frombuffer(batch.column(c)[k].as_buffer(), "<u4") for c in (5, 8))
        if p[-1] - s + K <= len(a) and q[-1] - t + K <= len(b):  # else rows of one id with different texts
            yield doc[k], other[k], p, q, s, t, a, b, (s > 0, t > 0, s + len(a) < full[k] // 4, t + len(b) < other_full[k] // 4)


def _near_words(column: pa.Array, back: bool) -> tuple[np.ndarray, np.ndarray]:
    """A column of up to ``SHORT_REACH`` bytes as a matrix (the last byte first, if ``back``), and where it has any."""
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    step = np.arange(SHORT_REACH)
    raw = np.frombuffer(data, np.uint8) if data is not None and len(data) else np.zeros(1, np.uint8)
    place = at[1:, None] - 1 - step if back else at[:-1, None] + step
    return raw[np.clip(place, 0, len(raw) - 1)], step < np.diff(at)[:, None]


@tidy
def _hopeful(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chains that may be passages, by the first bytes of the hashes of words before and after them.

    Equal words have equal bytes, so extensions go at least as far as those of
    whole words. A chain goes on if an extension comes to the end of what is
    looked at, or the words within and the equal ones beside are enough.
    """
    for batch in batches:
        some = batch.column(4).to_numpy().astype(np.int64)
        for left, right, back in ((5, 7, True), (6, 8, False)):
            (a, in_a), (b, in_b) = _near_words(batch.column(left), back), _near_words(batch.column(right), back)
            eq = (a == b) & in_a & in_b
            run = np.cumsum(np.where(eq, 1, -1), axis=1)
            stop = np.maximum.accumulate(np.maximum(run, 0), axis=1) - run >= DROP
            ends, last = stop.any(axis=1), stop.argmax(axis=1)
            hits = np.cumsum(eq, axis=1)[np.arange(len(eq)), np.where(ends, last, SHORT_REACH - 1)]
            some += np.where(ends, hits, MIN_WORDS)
        yield batch.filter(pa.array(some >= LEAST_EQUAL)).select([0, 1, 2, 3])


@tidy
def _align_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Passages of chains (doc, other, pos, other_pos, base, words, length of the text, and the other's); chains whose windows are too short are given back."""
    kinds = [pa.int64(), pa.int64(), *[pa.int32()] * 5, pa.list_(pa.int32()), pa.list_(pa.int32())]
    for batch in batches:
        out = []
        for doc, other, pos, opos, s, t, a, b, cut in _windows(batch):
            p, q = [x - s for x in pos], [x - t for x in opos]
            if open_ended(a, b, p, q, cut):
                out.append((doc, other, *[None] * 5, pos, opos))
                continue
            for x, y, u, v, n in align(a, b, p, q):
                out.append((doc, other, x + s, y + s, u + t, v + t, n, None, None))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=[x.split()[0] for x in _ALIGNED.split(", ")])


def _beside(chained: DataFrame, words: DataFrame) -> DataFrame:
    """Chains with the number of words they can hold and those just before and after them in both documents, a byte a word."""
    first, last = (lambda c: F.element_at(c, 1)), (lambda c: F.element_at(c, -1))

    def near(c: str, words_: str) -> tuple[Column, Column]:
        begin = F.greatest(first(c) - SHORT_REACH, F.lit(0))
        return F.substring(F.col(words_), begin + 1, first(c) - begin), F.substring(F.col(words_), last(c) + K + 1, F.lit(SHORT_REACH))

    inside = F.least(last("pos") - first("pos"), last("other_pos") - first("other_pos")) + K
    a1, a2 = near("pos", "words")
    one = chained.join(words, "doc").select("doc", "other", "pos", "other_pos", inside.alias("inside"), a1.alias("a1"), a2.alias("a2"))
    b1, b2 = near("other_pos", "words")
    return one.join(words.withColumnRenamed("doc", "other"), "other").select("doc", "other", "pos", "other_pos", "inside", "a1", "a2", b1.alias("b1"), b2.alias("b2"))


def _with_words(chained: DataFrame, words: DataFrame, reach: int | None) -> DataFrame:
    """Chains beside the words of both documents, whole or up to ``reach`` words beyond the chain."""
    first, last = (lambda c: F.element_at(c, 1)), (lambda c: F.element_at(c, -1))

    def cut(c: str, words_: str) -> tuple[Column, Column, Column]:
        begin = F.greatest(first(c) - reach, F.lit(0)) if reach is not None else F.lit(0)
        own = F.substring(F.col(words_), begin * 4 + 1, (last(c) + K + reach - begin) * 4) if reach is not None else F.col(words_)
        return begin, own, F.length(words_)

    b1, w1, l1 = cut("pos", "words")
    one = chained.join(words, "doc").select("doc", "other", "pos", "other_pos", b1.alias("base"), w1.alias("a"), l1.alias("full"))
    b2, w2, l2 = cut("other_pos", "words")
    two = one.join(words.withColumnRenamed("doc", "other"), "other")
    return two.select("doc", "other", "pos", "other_pos", "base", "a", "full", b2.alias("other_base"), w2.alias("b"), l2.alias("other_full"))


def repeated_passages(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Passages that a document shares with a smaller one:
    ``doc_id, other_id, start_word, end_word, other_start, other_end, equal_words``.

    Every document that repeats ``MIN_WORDS`` unchanged words of a smaller one
    has a row for them, whatever other documents hold; an edited passage has
    one if at least ``MIN_SEEDS`` of its k-mers lead to one document that holds
    it (see the module's text). A row whose words lie within those of another
    row of the same two documents is left out. ``other_id < doc_id``; places
    count words from 0, ends are exclusive. Rows without doc_id take no part;
    rows of one doc_id are one document and are not compared with each other
    (if their texts differ, what they share with others may be missed). Joins
    on a document that very many others repeat are left to Spark's splitting
    of skewed partitions. Null, empty and short texts share nothing, an empty
    table gives no rows, other columns are ignored.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    tables = Tables(spark)
    rows = docs.selectExpr(f"cast(`{id_column}` as long) doc_id", f"cast(`{text_column}` as string) text").where("doc_id is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // (BUCKET_BYTES * PARTITION_BUCKETS))
    bits = min(20, max(1, (min(PARTITION_BUCKETS * parts, size // LEAST_BUCKET) - 1).bit_length()))

    def found(cells: DataFrame, seeds: int) -> DataFrame:
        answers = cells.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_answers, _ANSWERS)
        return answers.repartition("slice").sortWithinPartitions("slice").mapInArrow(_found(bits, seeds), _FOUND)

    single = tables.stored(found(rows.mapInArrow(_seed_cells(bits), _CELLS), 1), "seeds")
    tables.release()
    runs = tables.stored(found(single.where("cell is not null").select("cell.*"), RUN), "runs")
    chained = single.unionByName(runs).where("doc is not null").drop("cell")

    def words_of(chained: DataFrame, bits: int) -> DataFrame:
        slots, slot = id_filter(chained.select(F.explode(F.array("doc", "other")).alias("doc")), "doc")
        texts = rows.select("doc_id", "text", slot(F.col("doc_id")).alias("slot")).mapInArrow(_word_rows(slots, bits), "doc long, words binary")
        return texts.dropDuplicates(["doc"])

    short = tables.stored(words_of(chained, 8), "bytes")
    tables.release()
    hopeful = tables.stored(_beside(chained, short).mapInArrow(_hopeful, _CHAIN), "chains")
    tables.release()
    words = tables.stored(words_of(hopeful, 32), "words")
    near = tables.stored(_with_words(hopeful, words, REACH).mapInArrow(_align_rows, _ALIGNED), "near")
    tables.release()
    again = near.where("again_pos is not null").select(F.col("doc_id").alias("doc"), F.col("other_id").alias("other"), F.col("again_pos").alias("pos"), F.col("again_other").alias("other_pos"))
    far = _with_words(again, words, None).mapInArrow(_align_rows, _ALIGNED)
    out = near.where("again_pos is null").unionByName(far).select(*(f.split()[0] for f in PASSAGES.split(", ")))
    before = Window.partitionBy("doc_id", "other_id").orderBy("start_word", F.desc("end_word"), *(f.split()[0] for f in PASSAGES.split(", ")[4:])).rowsBetween(Window.unboundedPreceding, -1)
    out = out.withColumn("__reach", F.max("end_word").over(before)).where("__reach is null or end_word > __reach").drop("__reach")
    return tables.result(out, "passages")


def cut_passages(docs: DataFrame, passages: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the words of passages that a smaller document holds; the columns stay.

    Between the words that remain the text is as it was, and each cut leaves
    the white space before it. Null texts stay null, rows without id stay as
    they are. A row whose passages cover it keeps an empty text. Repeated rows
    are cut alike; an empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    spans = passages.groupBy("doc_id").agg(F.collect_set(F.struct("start_word", "end_word")).alias("spans"))
    schema = docs.schema

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            where = batch.schema.get_field_index(text_column)
            texts = batch.column(where).to_pylist()
            cuts = batch.column(batch.num_columns - 1).to_pylist()
            out = [t if t is None or not c else remove_words(t, [(x["start_word"], x["end_word"]) for x in c]) for t, c in zip(texts, cuts)]
            columns = batch.columns[:-1]
            columns[where] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    # only texts that may have passages are shuffled: a bitmap of fixed size tells most others
    own = F.col(f"`{id_column}`").cast("long")
    held, others = split_by_ids(docs, own, filter_words(spans, "doc_id"))
    key, cuts = (_free(docs, x) for x in ("__passage_doc", "__passage_spans"))
    joined = held.join(spans.select(F.col("doc_id").alias(key), F.col("spans").alias(cuts)), own == F.col(key), "left").drop(key)
    return others.unionByName(joined.mapInArrow(run, schema))


def _free(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` doesn't have."""
    while name in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def remove_words(text: str, spans: list[tuple[int, int]]) -> str:
    """A text without the words of some spans."""
    raw = np.frombuffer(text.encode(), np.uint8)
    starts, ends, _ = word_spans(raw, np.array([0, len(raw)]))
    keep = np.ones(len(raw), dtype=bool)
    for a, b in spans:
        if a < min(b, len(starts)):
            stop = starts[b] if b < len(starts) else len(raw)
            keep[starts[a] : stop] = False
    return raw[keep].tobytes().decode().rstrip() if not keep.all() else text
