"""Token ids in a binary format of patched frame-of-reference blocks.

A segment holds the ids of a run of documents in ascending ``doc_id`` order.
Its ids are cut into blocks of ``BLOCK`` ids. Of each block the minimum is
subtracted; the differences are packed at the width that covers a given
percentile of them; what does not fit goes, with its high bits, to the block's
exception list. The segment's index holds the byte at which each block starts,
so any document can be read alone.

Layout of a segment, all little-endian:

    magic "RSPF" | u8 version | u8 0 | u16 block size
    u64 first: ids in earlier segments of the same part
    u32 documents | u32 blocks | u64 ids
    documents x (i64 doc_id, u8 null flag, u32 ids)
    blocks x u64 start byte, from the first block's byte
    blocks: u32 minimum | u8 width | u8 high width | u16 exceptions
            packed differences | exceptions x u16 place | packed high bits

Segments are the rows of a Parquet table that Spark writes, so the files are
committed as Spark commits output and can live in any store that Spark writes.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .encoders import encoder
from .storage import bounded_batches, write_table
from .words import slices, text_buffer

#: Ids of a block.
BLOCK = 512
#: Percentile of a block's differences that the packed width covers.
PERCENTILE = 90
#: Ids after which a segment is closed.
SEGMENT_IDS = 262_144
_HEAD = struct.Struct("<4sBBHQIIQ")
_BLOCK_HEAD = struct.Struct("<IBBH")
_DOC = np.dtype([("doc_id", "<i8"), ("null", "u1"), ("n", "<u4")])


def _pack(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of unsigned 32-bit values, one after another."""
    if not width or not len(values):
        return b""
    bits = np.unpackbits(values.astype("<u4").view(np.uint8).reshape(len(values), 4), axis=1, bitorder="little")
    return np.packbits(bits[:, :width].ravel(), bitorder="little").tobytes()


def _unpack(data: bytes, width: int, n: int) -> np.ndarray:
    if not width:
        return np.zeros(n, dtype=np.uint32)
    room = 16 if width <= 16 else 32
    bits = np.zeros((n, room), dtype=np.uint8)
    bits[:, :width] = np.unpackbits(np.frombuffer(data, dtype=np.uint8), count=n * width, bitorder="little").reshape(n, width)
    return np.packbits(bits, axis=1, bitorder="little").view(f"<u{room // 8}").ravel().astype(np.uint32)


def _widths(values: np.ndarray) -> np.ndarray:
    """Bits of each value."""
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> list[bytes]:
    """The blocks of a run of unsigned 32-bit ids."""
    out = []
    for at in range(0, len(ids), BLOCK):
        own = ids[at : at + BLOCK].astype(np.uint32)
        low = own.min()
        rest = own - low
        bits = _widths(rest)
        width = int(np.sort(bits)[min(len(own) - 1, len(own) * percentile // 100)])
        over = np.flatnonzero(bits > width)
        high = rest[over] >> np.uint32(width) if len(over) else rest[:0]
        high_width = int(_widths(high).max()) if len(over) else 0
        small = rest & np.uint32((1 << width) - 1) if width < 32 else rest
        out.append(_BLOCK_HEAD.pack(int(low), width, high_width, len(over)) + _pack(small, width) + over.astype("<u2").tobytes() + _pack(high, high_width))
    return out


def unpack_block(data: bytes, at: int, n: int) -> np.ndarray:
    """The ``n`` ids of the block at byte ``at``."""
    low, width, high_width, many = _BLOCK_HEAD.unpack_from(data, at)
    at += _BLOCK_HEAD.size
    size = (n * width + 7) // 8
    out = _unpack(data[at : at + size], width, n)
    at += size
    if many:
        where = np.frombuffer(data, dtype="<u2", count=many, offset=at)
        at += 2 * many
        out[where] |= _unpack(data[at : at + (many * high_width + 7) // 8], high_width, many) << np.uint32(width)
    return out + np.uint32(low)


def write_segment(docs: list[tuple[int | None, int]], ids: np.ndarray, first: int) -> bytes:
    """A segment from (doc_id, number of ids) in order, and all their ids."""
    blocks = pack_blocks(ids)
    table = np.array([(d or 0, d is None, n) for d, n in docs], dtype=_DOC)
    starts = np.concatenate([[0], np.cumsum([len(b) for b in blocks])[:-1]]).astype("<u8") if blocks else np.zeros(0, "<u8")
    return b"".join([_HEAD.pack(b"RSPF", 1, 0, BLOCK, first, len(docs), len(blocks), len(ids)), table.tobytes(), starts.tobytes(), *blocks])


def _head(data: bytes) -> tuple[int, np.ndarray, np.ndarray, int, int]:
    magic, version, _, block, first, n_docs, n_blocks, n_ids = _HEAD.unpack_from(data)
    if magic != b"RSPF" or version != 1 or block != BLOCK:
        raise ValueError("not a segment of this format")
    at = _HEAD.size
    docs = np.frombuffer(data, dtype=_DOC, count=n_docs, offset=at)
    starts = np.frombuffer(data, dtype="<u8", count=n_blocks, offset=at + docs.nbytes)
    return first, docs, starts, n_ids, at + docs.nbytes + starts.nbytes


def read_segment(data: bytes) -> tuple[int, list[tuple[int | None, np.ndarray]]]:
    """The ids before a segment in its part, and (doc_id, ids) of its documents."""
    first, docs, starts, n_ids, base = _head(data)
    parts = [unpack_block(data, base + int(s), min(BLOCK, n_ids - k * BLOCK)) for k, s in enumerate(starts)]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.uint32)
    ends = np.cumsum(docs["n"], dtype=np.int64)
    return first, [(None if d["null"] else int(d["doc_id"]), ids[e - int(d["n"]) : e]) for d, e in zip(docs, ends)]


def read_document(data: bytes, k: int) -> np.ndarray:
    """The ids of a segment's ``k``-th document alone, through the block index."""
    _, docs, starts, n_ids, base = _head(data)
    a = int(docs["n"][:k].sum(dtype=np.int64))
    b = a + int(docs["n"][k])
    if a == b:
        return np.zeros(0, np.uint32)
    blocks = range(a // BLOCK, (b - 1) // BLOCK + 1)
    ids = np.concatenate([unpack_block(data, base + int(starts[i]), min(BLOCK, n_ids - i * BLOCK)) for i in blocks])
    return ids[a - blocks[0] * BLOCK : b - blocks[0] * BLOCK]


def _each(docs: list, ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple[int | None, bytes]]:
    """Each document with its own ids' bytes."""
    data, at = ids.tobytes(), 0
    for d, n in zip(docs, (4 * counts).tolist()):
        yield d, data[at : at + n]
        at += n


def write_token_files(docs: DataFrame, tokenizer_path: str, *, end_id: int | None = 1, path: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> str:
    """Encode every text and write segments in ascending ``doc_id`` order; return the table's path.

    Rows ``part, seq, data``: part k holds a range of ids below those of part
    k + 1, and segment ``seq`` follows ``seq - 1`` within it. One exchange, of
    the texts by ranges of the id. A null text is empty (only the end id), null
    ids come first, rows of one id keep an order by their text, an empty table
    gives no segment; other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        end = b"" if end_id is None else np.array([end_id], dtype="<u4").tobytes()
        held: list[tuple[int | None, int]] = []
        ids: list[bytes] = []
        count, first, seq = 0, 0, 0

        def segment() -> pa.RecordBatch:
            nonlocal count, first, seq
            data = write_segment(held, np.frombuffer(b"".join(ids), dtype="<u4"), first)
            out = pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([seq], pa.int32()), pa.array([count], pa.int64()), pa.array([data], pa.binary())], names=["part", "seq", "n_ids", "data"])
            first, seq, count = first + count, seq + 1, 0
            held.clear()
            ids.clear()
            return out

        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            docs = batch.column(0).to_pylist()
            texts = (
                (d, own)
                for i, j in slices(offsets)
                for d, own in _each(docs[i:j], *enc.encode_many(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]))
            )
            for d, own in texts:
                own += end
                held.append((d, len(own) // 4))
                ids.append(own)
                count += len(own) // 4
                if count >= SEGMENT_IDS:
                    yield segment()
        if held:
            yield segment()

    bounded_batches(docs.sparkSession)
    rows = docs.selectExpr(f"cast(`{id_column}` as long) doc_id", f"cast(`{text_column}` as string) text")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    segments = rows.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, "part int, seq int, n_ids long, data binary")
    if path is None:
        return write_table(segments, "tokens")
    segments.write.option("compression", "none").parquet(path)
    return path


def read_token_files(spark: SparkSession, path: str, *, keep_ids: bool = True) -> DataFrame:
    """Read segments back: ``doc_id, start, n_tokens, ids, ids_crc32``.

    ``start`` is the number of ids before the document over all parts; the
    parts' totals (one row a part) are summed in a window and joined.
    """
    table = spark.read.schema("part int, seq int, n_ids long, data binary").parquet(path)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                first, docs = read_segment(data.as_buffer().to_pybytes())
                n = np.array([len(x) for _, x in docs], dtype=np.int64)
                starts = first + np.concatenate([[0], np.cumsum(n)[:-1]]).astype(np.int64)
                raw = [x.astype("<u4").tobytes() for _, x in docs]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part] * len(docs), pa.int32()), pa.array([d for d, _ in docs], pa.int64()), pa.array(starts), pa.array(n), pa.array(raw if keep_ids else [None] * len(docs), pa.binary()), pa.array([zlib.crc32(x) for x in raw], pa.int64())],
                    names=["part", "doc_id", "own_start", "n_tokens", "ids", "ids_crc32"],
                )

    totals = table.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = totals.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # a row a part
    docs = table.select("part", "data").mapInArrow(run, "part int, doc_id long, own_start long, n_tokens long, ids binary, ids_crc32 long")
    return docs.join(F.broadcast(before), "part").select("doc_id", (F.col("before") + F.col("own_start")).alias("start"), "n_tokens", "ids", "ids_crc32")


