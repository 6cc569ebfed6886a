"""Vectorised words and word shingles over Arrow string columns.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D; A-Z are
lower-cased first. Everything works on the raw UTF-8 buffer of a column, so a
batch of texts is hashed by a few numpy passes, without Python strings.
Words and shingles are named by 64-bit hashes.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Words of a shingle.
SHINGLE = 5
#: Bytes of text that are hashed at once (a longer text is hashed alone).
SLICE_BYTES = 400_000

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20_240_229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[65:91] = _BYTE[97:123]  # A-Z count as a-z
_STEP = _RNG.integers(1, 2**62, 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = np.uint64(0x9E3779B97F4A7C15)
_P_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 2 * SLICE_BYTES + 1)
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * SLICE_BYTES:
            _powers[name] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit words (the splitmix64 finaliser)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its values; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]] if len(at) else raw[:0], at - at[0]


def _allocator():
    """The C library, if it can give freed memory back to the system."""
    try:
        return ctypes.CDLL(None, use_errno=False).malloc_trim
    except (OSError, AttributeError):
        return None


_TRIM = _allocator()


def release_memory() -> None:
    """Give memory that a batch has freed back to the system: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def tidy(run: Callable) -> Callable:
    """A function of batches that gives memory back when a task ends: idle workers stay beside those of other tasks."""

    @functools.wraps(run)
    def wrapped(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        release_memory()

    return wrapped


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of texts of at most ``limit`` bytes together, or one longer text."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)
    release_memory()


def word_spans(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and how many words each text has."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    np.logical_not(_SPACE[raw], out=inside[1:-1])
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    per_text = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, per_text


def span_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, letters: np.ndarray = _BYTE) -> np.ndarray:
    """A hash of each span of bytes (spans in order); a long text is hashed window by window."""
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + 2 * SLICE_BYTES, side="right")))
        some = raw[base : int(ends[j - 1])]
        total = np.zeros(len(some) + 1, dtype=np.uint64)
        np.cumsum(letters[some] * _power("up", _P, len(some)), out=total[1:])
        a, b = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (total[b] - total[a]) * _power("down", _P_INVERSE, len(some) + 1)[a]
        i = j
    return mix(out)


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every word, and how many words each text has."""
    starts, ends, per_text = word_spans(raw, offsets)
    return span_hashes(raw, starts, ends), per_text


def shingle_hashes(words: np.ndarray, per_text: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """A hash for every run of ``size`` words, and how many each text has.

    A text of fewer words has one, of all its words; a text without words none.
    """
    count = np.where(per_text >= size, per_text - size + 1, np.minimum(per_text, 1))
    n = len(words)
    padded = np.concatenate([words, np.zeros(size, dtype=np.uint64)])
    left = np.repeat(np.cumsum(per_text), per_text) - np.arange(n)  # words from here to the text's end
    length = np.repeat(per_text, per_text)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        term = padded[k : k + n] * _STEP[k]
        out += term if not (length < size).any() else np.where(left > k, term, np.uint64(0))
    out += np.minimum(length, size).astype(np.uint64)
    keep = (left >= size) | ((length < size) & (left == length))
    return mix(out[keep]), count


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """For each text in order: its index and the sorted distinct shingle hashes."""
    raw, offsets = text_buffer(texts)
    for i, j in slices(offsets):
        words, per_text = word_hashes(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        shingles, count = shingle_hashes(words, per_text, size)
        at = 0
        for k, c in enumerate(count.tolist()):
            own = np.sort(shingles[at : at + c])
            if c > 1:
                keep = np.empty(c, dtype=bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                own = own[keep]
            at += c
            yield i + k, own
