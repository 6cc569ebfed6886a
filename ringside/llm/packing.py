"""Hierarchical residual best-fit packing of token sequences.

Every partition packs its items best-fit decreasing into bins of ``capacity``
and emits the bins that are nearly full. The underfull bins go on as items of
their own: a tree merges partitions, packs again, emits again, until the last
round closes all bins. A bin carries its pieces (at most one a token), so an
item stays bounded by the capacity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .encoders import encoder
from .storage import bounded_batches, stored
from .words import slices, text_buffer, tidy

#: Partitions that a round merges into one.
FAN_IN = 8
#: A bin with at most this share of its capacity free is nearly full.
SLACK = 1 / 256
#: Bins that a merging task is meant to hold at most; it sets how many tasks a round has.
TASK_BINS = 8_000
#: Items that a first-round task packs at once.
PACK_ITEMS = 50_000

PIECE = "struct<doc_id:bigint,copy:bigint,piece:int,start:bigint,length:bigint,ids_crc32:bigint>"


def best_fit(sizes: np.ndarray, capacity: int) -> list[list[int]]:
    """Bins (lists of indexes) of items put, the largest first, into the fullest bin that holds them.

    Open bins stand in stacks by the room left; a bit set of the rooms in use
    finds the tightest fit in constant time.
    """
    bins: list[list[int]] = []
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        fits = rooms >> s
        if fits:
            room = s + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            if not stacks[room]:
                rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        room -= s
        stacks[room].append(b)
        rooms |= 1 << room
    return bins


def cut_pieces(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: only a longer one is cut, its first piece takes the remainder."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    return ([(0, head)] if head else []) + [(a, capacity) for a in range(head, n, capacity)]


_NAMES = ["doc_id", "copy", "piece", "start", "length", "ids_crc32"]
_KINDS = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]


def _pieces(tokenizer_path: str, capacity: int, end_id: int):
    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(tokenizer_path), np.array([end_id], dtype="<u4").tobytes()
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            docs = batch.column(0).to_pylist()
            for i, j in slices(offsets):
                ids, counts = enc.encode_many(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                data, at, out = ids.tobytes(), 0, []
                for d, n in zip(docs[i:j], (4 * counts).tolist()):
                    own = data[at : at + n] + end
                    at += n
                    out += [(d, row, k, start, length, zlib.crc32(own[4 * start : 4 * (start + length)])) for k, (start, length) in enumerate(cut_pieces(len(own) // 4, capacity))]
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _KINDS)], names=_NAMES)

    return run


def tokenize_pieces(docs: DataFrame, tokenizer_path: str, *, capacity: int, end_id: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Pieces of every document: ``doc_id, copy, piece, start, length, ids_crc32``.

    ``copy`` tells rows apart that share a doc_id. A null text is empty and
    gives one piece, the end id.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{id_column}` as long) doc_id", f"cast(`{text_column}` as string) text")
    return rows.mapInArrow(_pieces(tokenizer_path, capacity, end_id), "doc_id long, copy long, piece int, start long, length long, ids_crc32 long")


def _as_bins(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each piece as a bin of its own: (used, pieces)."""
    for batch in batches:
        one = pa.StructArray.from_arrays(batch.columns, names=_NAMES)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32)), one)
        yield pa.RecordBatch.from_arrays([batch.column(4), lists], names=["used", "pieces"])


_BINS = f"level int, task int, number int, used long, done boolean, pieces array<{PIECE}>"
_PIECES = pa.list_(pa.struct([("doc_id", pa.int64()), ("copy", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]))


def _round(level: int, capacity: int, final: bool):
    """A task's packing of bins (rows used, pieces) into new bins."""
    full = capacity - int(capacity * SLACK)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        rows = 0

        def pack() -> Iterator[pa.RecordBatch]:
            nonlocal number
            if not rows:
                return
            table = pa.Table.from_batches(held).combine_chunks()
            used = table.column(0).to_numpy()
            lists = table.column(1).combine_chunks()
            if isinstance(lists, pa.ChunkedArray):
                lists = pa.concat_arrays(lists.chunks)
            at, flat = lists.offsets.to_numpy().astype(np.int64), lists.values
            bins = best_fit(used, capacity)
            for lo in range(0, len(bins), 4096):
                some = bins[lo : lo + 4096]
                sums = np.array([int(used[b].sum()) for b in some], dtype=np.int64)
                order = np.concatenate([np.arange(at[i], at[i + 1]) for b in some for i in b])
                sizes = np.array([int(sum(at[i + 1] - at[i] for i in b)) for b in some])
                offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
                pieces = pa.ListArray.from_arrays(offsets, flat.take(pa.array(order)))
                n = len(some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, level, np.int32)), pa.array(np.full(n, task, np.int32)), pa.array(np.arange(number, number + n, dtype=np.int32)), pa.array(sums), pa.array((sums >= full) | final), pieces.cast(_PIECES)],
                    names=["level", "task", "number", "used", "done", "pieces"],
                )
                number += n

        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= PACK_ITEMS:
                yield from pack()
                held.clear()
                rows = 0
        yield from pack()

    return run


def pack(pieces: DataFrame, *, capacity: int) -> DataFrame:
    """Pack pieces into sequences: their columns and ``sequence_id, offset``. An empty table gives no rows."""
    first = _round(0, capacity, False)
    return _merged(stored(pieces.select(*_NAMES).mapInArrow(lambda batches: first(_as_bins(batches)), _BINS), "bins"), capacity)


def _merged(bins: DataFrame, capacity: int) -> DataFrame:
    """The rounds after the first, over its bins.

    Every round is written to the shared folder before the next reads it, so
    a lost executor cannot change a bin that others have built on. The last
    round's tasks hold at most about ``TASK_BINS`` bins each, however many
    there are.
    """
    done, level = [bins.where("done")], 0
    while True:
        level += 1
        open_bins = bins.where("not done").select("used", "pieces")
        many = bins.where("not done").agg(F.count("*").alias("n"), F.countDistinct("task").alias("tasks")).first()
        if not many["n"]:
            break
        least = -(-many["n"] // TASK_BINS)
        tasks = max(least, -(-many["tasks"] // FAN_IN))
        final = tasks <= least
        bins = stored(open_bins.repartition(tasks).mapInArrow(_round(level, capacity, final), _BINS), "bins")
        done.append(bins.where("done"))
        if final:
            break
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    sequence = F.expr("shiftleft(cast(level as long), 56) + shiftleft(cast(task as long), 32) + number")
    # offsets by one fold over a bin's pieces
    ahead = F.expr("slice(aggregate(pieces, array(0L), (s, p) -> concat(s, array(element_at(s, -1) + p.length))), 1, size(pieces))")
    rows = out.select(sequence.alias("sequence_id"), F.explode(F.arrays_zip("pieces", ahead.alias("offset"))).alias("x"))
    return rows.select("x.pieces.*", "sequence_id", F.col("x.offset").alias("offset"))


def pack_documents(docs: DataFrame, tokenizer_path: str, *, capacity: int = 1024, end_id: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Tokenize, cut and pack documents: ``doc_id, copy, piece, start, length, ids_crc32, sequence_id, offset``.

    One Python pass tokenizes and packs for the first time; a null text is
    empty and gives one piece, the end id.
    """
    bounded_batches(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{id_column}` as long) doc_id", f"cast(`{text_column}` as string) text")
    cut, first = _pieces(tokenizer_path, capacity, end_id), _round(0, capacity, False)
    return _merged(stored(rows.mapInArrow(lambda batches: first(_as_bins(cut(batches))), _BINS), "bins"), capacity)
