"""Lossless media columns: bytes as greyscale PNG, and perceptual hashes of them.

A payload becomes an 8-bit greyscale PNG of ``WIDTH`` pixels a row, its rows
each by the filter that leaves the smallest differences, compressed with zlib
and split into IDAT chunks with checksums. Reading tests every chunk's CRC-32
and undoes all five row filters with numpy, for many pictures at once: pixels
on one anti-diagonal depend only on those of the two before.
The hash keeps the signs of the low frequencies of a two-dimensional cosine
transform of the picture shrunk to 32 x 32.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .storage import bounded_batches
from .words import SLICE_BYTES, slices, text_buffer

#: Bytes (pixels) of a picture's row.
WIDTH = 64
#: zlib's level, and the most bytes of an IDAT chunk.
LEVEL, IDAT_BYTES = 6, 1 << 20
#: Rows that are filtered at once, and bytes of pictures that are undone at once.
BAND, GROUP_BYTES = 4096, 2_000_000
#: Side of the shrunk picture, and of its block of low frequencies.
SIDE, LOW = 32, 8
# Fixed value: the signature that begins a PNG file.
SIGNATURE = b"\x89PNG\r\n\x1a\n"
NONE, SUB, UP, AVERAGE, PAETH = range(5)


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))


def _guesses(pixels: np.ndarray) -> np.ndarray:
    """What each of the five filters guesses for every pixel, as (filter, row, column)."""
    x = pixels.astype(np.int16)
    a = np.pad(x, ((0, 0), (1, 0)))[:, :-1]
    b = np.pad(x, ((1, 0), (0, 0)))[:-1]
    c = np.pad(x, ((1, 0), (1, 0)))[:-1, :-1]
    return np.stack([np.zeros_like(x), a, b, (a + b) >> 1, _paeth(a, b, c)])


def _paeth(a, b, c):
    p = a + b - c
    da, db, dc = abs(p - a), abs(p - b), abs(p - c)
    return np.where((da <= db) & (da <= dc), a, np.where(db <= dc, b, c))


def filter_rows(pixels: np.ndarray, kinds: np.ndarray | None = None) -> bytes:
    """The filtered rows of a picture, each after its filter's number; by default the one of the least absolute differences."""
    out = np.empty((pixels.shape[0], pixels.shape[1] + 1), dtype=np.uint8)
    for i in range(0, len(pixels), BAND):  # a band of rows at a time; it looks at the row above it
        above = pixels[max(0, i - 1) : i + BAND]
        left = ((above - _guesses(above)) & 255).astype(np.uint8)[:, min(i, 1) :]
        if kinds is None:
            own = np.abs(left.view(np.int8).astype(np.int16)).sum(axis=2, dtype=np.int64).argmin(axis=0)
        else:
            own = kinds[i : i + BAND]
        out[i : i + BAND, 0] = own
        out[i : i + BAND, 1:] = left[own, np.arange(left.shape[1])]
    return out.tobytes()


def unfilter_pictures(rows: list[np.ndarray]) -> list[np.ndarray]:
    """The pixels of pictures of one width, given as their filtered rows after the filters' numbers.

    Pictures of like height are undone together, anti-diagonal by anti-diagonal.
    """
    out: list[np.ndarray] = [np.zeros((0, 0), np.uint8)] * len(rows)
    order = sorted(range(len(rows)), key=lambda i: len(rows[i]))
    while order:
        most = 2 * max(1, len(rows[order[0]]))
        some = [i for i in order if len(rows[i]) <= most][: max(1, GROUP_BYTES // (most * rows[order[0]].shape[1]))]
        order = order[len(some) :]
        height, width = max(len(rows[i]) for i in some), rows[some[0]].shape[1] - 1
        if not any(rows[i][:, 0].any() for i in some):
            for i in some:
                out[i] = rows[i][:, 1:]
            continue
        raw = np.zeros((height, width, len(some)), np.int16)
        kind = np.zeros((height, len(some)), np.int16)
        for k, i in enumerate(some):
            raw[: len(rows[i]), :, k], kind[: len(rows[i]), k] = rows[i][:, 1:], rows[i][:, 0]
        if kind.max() > PAETH:
            raise ValueError("unknown filter")
        done = np.zeros((height + 1, width + 1, len(some)), np.int16)
        for d in range(height + width - 1):
            r = np.arange(max(0, d - width + 1), min(height, d + 1))
            a, b, c, f = done[r + 1, d - r], done[r, d - r + 1], done[r, d - r], kind[r]
            guess = np.where(f == SUB, a, 0) + np.where(f == UP, b, 0) + np.where(f == AVERAGE, (a + b) >> 1, 0) + np.where(f == PAETH, _paeth(a, b, c), 0)
            done[r + 1, d - r + 1] = (raw[r, d - r] + guess) & 255
        for k, i in enumerate(some):
            out[i] = np.ascontiguousarray(done[1 : len(rows[i]) + 1, 1:, k]).astype(np.uint8)
    return out


def encode_png(payload: bytes, kind: int | None = None) -> bytes:
    """A greyscale PNG whose pixels are a payload of a positive multiple of ``WIDTH`` bytes; all rows by one filter, if given."""
    height = len(payload) // WIDTH
    if not height or len(payload) % WIDTH:
        raise ValueError("a payload is a positive multiple of the width")
    rows = filter_rows(np.frombuffer(payload, dtype=np.uint8).reshape(height, WIDTH), None if kind is None else np.full(height, kind))
    packed = zlib.compress(rows, LEVEL)
    idat = [_chunk(b"IDAT", packed[i : i + IDAT_BYTES]) for i in range(0, len(packed), IDAT_BYTES)]
    return b"".join([SIGNATURE, _chunk(b"IHDR", struct.pack(">IIBBBBB", WIDTH, height, 8, 0, 0, 0, 0)), *idat, _chunk(b"IEND", b"")])


def png_rows(data: bytes) -> np.ndarray:
    """The filtered rows of an 8-bit greyscale PNG; a broken signature, checksum or order raises ValueError."""
    if data[:8] != SIGNATURE:
        raise ValueError("no PNG signature")
    at, head, parts, ended = 8, None, [], False
    while at < len(data):
        size, kind = struct.unpack_from(">I4s", data, at)
        body = data[at + 8 : at + 8 + size]
        if len(body) != size or zlib.crc32(kind + body) != struct.unpack_from(">I", data, at + 8 + size)[0]:
            raise ValueError(f"chunk {kind!r} is broken")
        at += size + 12
        if kind == b"IHDR":
            head = struct.unpack(">IIBBBBB", body)
        elif kind == b"IDAT":
            parts.append(body)
        elif kind == b"IEND":
            ended = True
    if head is None or not ended or head[2:] != (8, 0, 0, 0, 0):
        raise ValueError("not an 8-bit greyscale PNG")
    width, height = head[:2]
    return np.frombuffer(zlib.decompress(b"".join(parts)), np.uint8).reshape(height, width + 1)


def decode_png(data: bytes) -> np.ndarray:
    """The pixels of an 8-bit greyscale PNG."""
    return unfilter_pictures([png_rows(data)])[0]


def _cosines() -> np.ndarray:
    k, n = np.arange(LOW)[:, None], np.arange(SIDE)
    return np.cos(np.pi * k * (2 * n + 1) / (2 * SIDE))


_COSINES = _cosines()


def _shrunk(pixels: np.ndarray, axis: int) -> np.ndarray:
    n = pixels.shape[axis]
    edges = np.arange(SIDE) * n // SIDE
    ends = np.maximum((np.arange(SIDE) + 1) * n // SIDE, edges + 1)
    total = np.insert(np.cumsum(pixels, axis=axis, dtype=np.int64 if pixels.dtype.kind in "ui" else np.float64), 0, 0, axis=axis)
    shape = [1, 1]
    shape[axis] = SIDE
    return (total.take(ends, axis) - total.take(edges, axis)) / (ends - edges).reshape(shape)


def cosine_hash(pixels: np.ndarray) -> bytes:
    """64 bits: which low frequencies of the shrunk picture lie above their median."""
    small = _shrunk(_shrunk(pixels, 0), 1)
    low = _COSINES @ small @ _COSINES.T
    flat = np.round(low.ravel(), 6)
    return np.packbits(flat > np.median(flat[1:])).tobytes()


def to_media(docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every text as a PNG: ``doc_id, n_bytes, media`` (binary).

    A null text is empty: one row of zeros. A null doc_id stays null, repeated
    rows give repeated rows, equal texts equal pictures; an empty table gives
    no rows, other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for i, j in slices(offsets, 4 * SLICE_BYTES):
                at = offsets[i : j + 1].tolist()
                own = [raw[a:b].tobytes() for a, b in zip(at, at[1:])]
                media = [encode_png(x + bytes(-len(x) % WIDTH if x else WIDTH)) for x in own]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array([len(x) for x in own], pa.int64()), pa.array(media, pa.binary())], names=["doc_id", "n_bytes", "media"])

    bounded_batches(docs.sparkSession)
    return docs.selectExpr(f"cast(`{id_column}` as long) doc_id", f"cast(`{text_column}` as string) text").mapInArrow(run, "doc_id long, n_bytes long, media binary")


FEATURES = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, cosine_hash binary"


def media_features(media: DataFrame) -> DataFrame:
    """Digests and hashes of the pixels that are read back from a ``media`` column of ``to_media``, a row for each of its rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            cells = [cell.as_buffer().to_pybytes() for cell in batch.column(2)]
            for data, pixels in zip(cells, unfilter_pictures([png_rows(x) for x in cells])):
                payload = pixels.tobytes()
                out.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-WIDTH:]), len(data), hashlib.sha256(data).hexdigest(), cosine_hash(pixels)))
            if out:
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(c, t) for c, t in zip(zip(*out), kinds))], names=[x.split()[0] for x in FEATURES.split(", ")])

    return media.select("doc_id", "n_bytes", "media").mapInArrow(run, FEATURES)
