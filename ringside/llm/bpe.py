"""BPE encoding and decoding by forced-boundary splitting.

Two neighbouring bytes that occur inside no token of the vocabulary are never
merged, so the place between them is a certain cut: the fragments between
certain cuts are encoded independently and their ids concatenated. The table
of such byte pairs is computed from the vocabulary. A cut is used only where
the pre-tokenizer's pattern cannot look across it either: after a character
that is certainly no white space, on a character boundary, not before an
apostrophe (a contraction) and not before further white space. Fragments
repeat like words do, so their ids are kept in a bounded table per worker.

Null texts count as empty and give no ids. The file's path is a parameter.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .storage import bounded_batches
from .words import SLICE_BYTES, slices, text_buffer

#: Fragments kept per worker before the table starts anew (memory bound only).
CACHE_FRAGMENTS = 300_000
#: Fragments longer than this many bytes are encoded anew each time.
CACHE_BYTES = 64

# The pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_alphabet() -> dict[str, int]:
    """The byte that each printable character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteBPE:
    """A byte-level BPE vocabulary file of the tokenizers library, used without that library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *self.special.values()]) + 1
        self.token_bytes: list[bytes] = [b""] * size
        self.ids: dict[bytes, int] = {}
        for token, i in vocab.items():
            if token not in self.special:
                self.token_bytes[i] = bytes(alphabet[c] for c in token)
                self.ids[self.token_bytes[i]] = i
        for token, i in self.special.items():
            self.token_bytes[i] = token.encode()
        self.rank: dict[tuple[int, int], tuple[int, int]] = {}
        for r, pair in enumerate(spec["model"]["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = (r, vocab[a + b])
        self.pattern = regex.compile(PATTERN)
        self.special_pattern = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._tables()
        self.cache: dict[bytes, tuple[bytes, bytes]] = {}

    def _tables(self) -> None:
        joined = np.zeros(1 << 16, dtype=bool)
        for token in self.ids:
            for a, b in zip(token, token[1:]):
                joined[a << 8 | b] = True
        before, after = np.repeat(np.arange(256), 256), np.tile(np.arange(256), 256)
        plain_before = ((before > 0x20) & (before < 0x7F)) | (before >= 0x80)
        boundary_after = (after < 0x80) | (after >= 0xC0)
        self.cut = ~joined & plain_before & boundary_after & (after != 0x27)
        lengths = np.array([len(t) for t in self.token_bytes], dtype=np.int64)
        self.lengths, self.begins = lengths, np.concatenate([[0], np.cumsum(lengths)[:-1]])
        self.all_bytes = np.frombuffer(b"".join(self.token_bytes), dtype=np.uint8)

    def cuts(self, raw: np.ndarray) -> np.ndarray:
        """Positions in the bytes of a text where no token can span and the pattern cannot look across."""
        if len(raw) < 2:
            return np.zeros(0, dtype=np.int64)
        at = np.flatnonzero(self.cut[raw[:-1].astype(np.uint16) << np.uint16(8) | raw[1:]]) + 1
        high = raw[at - 1] >= 0x80
        if high.any():  # of characters beyond ASCII only two-byte ones from U+00C0 on are certainly no space
            lead = raw[np.maximum(at - 2, 0)]
            at = at[~high | ((lead >= 0xC3) & (lead < 0xE0) & (at >= 2))]
        return at

    def _merge(self, piece: bytes) -> list[int]:
        """The ids of one pre-token: always the merge of lowest rank, the leftmost first."""
        ids = [self.ids[piece[i : i + 1]] for i in range(len(piece))]
        if len(ids) < 2:
            return ids
        n, rank = len(ids), self.rank
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r[0], i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := rank.get((ids[i], ids[i + 1])))]
        heapq.heapify(heap)
        alive = [True] * n
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i] = rank[a, b][1]
            alive[j] = False
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                if r := rank.get((ids[i], ids[k])):
                    heapq.heappush(heap, (r[0], i, ids[i], ids[k]))
            if (h := before[i]) >= 0 and (r := rank.get((ids[h], ids[i]))):
                heapq.heappush(heap, (r[0], h, ids[h], ids[i]))
        return [x for x, live in zip(ids, alive) if live]

    def _fragment(self, fragment: bytes) -> tuple[bytes, bytes]:
        """The ids of a fragment as little-endian uint32 bytes and as decimals, each with a comma."""
        ids = [i for piece in self.pattern.findall(fragment.decode()) for i in self._merge(piece.encode())]
        return np.array(ids, dtype="<u4").tobytes(), b"".join(b"%d," % i for i in ids)

    def _plain(self, raw: np.ndarray, data: bytes) -> Iterator[tuple[bytes, bytes]]:
        cache, last = self.cache, 0
        for at in [*self.cuts(raw).tolist(), len(data)]:
            fragment, last = data[last:at], at
            found = cache.get(fragment)
            if found is None:
                found = self._fragment(fragment)
                if len(fragment) <= CACHE_BYTES:
                    if len(cache) >= CACHE_FRAGMENTS:
                        cache.clear()
                    cache[fragment] = found
            yield found

    def encode_both(self, raw: np.ndarray, data: bytes) -> tuple[np.ndarray, bytes]:
        """The ids of a text, and the same as decimals each followed by a comma."""
        if not data:
            return np.zeros(0, dtype=np.uint32), b""
        if self.special_pattern is None or not any(s.encode() in data for s in self.special):
            found = list(self._plain(raw, data))
            return np.frombuffer(b"".join([f[0] for f in found]), dtype="<u4"), b"".join([f[1] for f in found])
        ids, shown, text, last = [], [], data.decode(), 0
        for m in [*self.special_pattern.finditer(text), None]:
            part = text[last : m.start() if m else len(text)].encode()
            if part:
                for a, b in self._plain(np.frombuffer(part, dtype=np.uint8), part):
                    ids.append(a)
                    shown.append(b)
            if m:
                i, last = self.special[m[0]], m.end()
                ids.append(np.array([i], dtype="<u4").tobytes())
                shown.append(b"%d," % i)
        return np.frombuffer(b"".join(ids), dtype="<u4"), b"".join(shown)

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text."""
        data = (text or "").encode()
        return self.encode_both(np.frombuffer(data, dtype=np.uint8), data)[0]

    def decode(self, ids: np.ndarray) -> bytes:
        """The UTF-8 bytes of the text that ids stand for; broken sequences become U+FFFD."""
        ids = np.asarray(ids, dtype=np.int64)
        if not len(ids):
            return b""
        n = self.lengths[ids]
        ends = np.cumsum(n)
        out = self.all_bytes[np.arange(ends[-1]) + np.repeat(self.begins[ids] - (ends - n), n)].tobytes()
        try:
            out.decode()
        except UnicodeDecodeError:
            out = out.decode(errors="replace").encode()
        return out


_loaded: dict[str, ByteBPE] = {}


def vocabulary(path: str) -> ByteBPE:
    """The vocabulary of a file, read once per worker."""
    if path not in _loaded:
        _loaded[path] = ByteBPE(path)
    return _loaded[path]


SCHEMA = "doc_id long, ids binary, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode_documents(docs: DataFrame, path: str, *, id_column: str = "doc_id", text_column: str = "text", keep_ids: bool = True) -> DataFrame:
    """Encode and decode every text: ``doc_id, ids, n_tokens, ids_sha256, decoded_sha256``.

    One narrow pass without a shuffle; ``ids`` are little-endian unsigned
    32-bit integers (null with ``keep_ids=False``). Rows stay rows: repeated
    ids are encoded each, a null id stays null, an empty table gives no rows,
    other columns are ignored.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = vocabulary(path)
        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            for i, j in slices(offsets, 4 * SLICE_BYTES):
                out: list[tuple] = []
                for a, b in zip(offsets[i:j].tolist(), offsets[i + 1 : j + 1].tolist()):
                    own = raw[a:b]
                    ids, shown = bpe.encode_both(own, own.tobytes())
                    out.append((ids.tobytes() if keep_ids else None, len(ids), hashlib.sha256(shown[:-1]).hexdigest(), hashlib.sha256(bpe.decode(ids)).hexdigest()))
                ids_, n_, h_, d_ = zip(*out)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), pa.array(ids_, pa.binary()), pa.array(n_, pa.int64()), pa.array(h_, pa.string()), pa.array(d_, pa.string())], names=["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"])

    bounded_batches(docs.sparkSession)
    return docs.selectExpr(f"cast(`{id_column}` as long) doc_id", f"cast(`{text_column}` as string) text").mapInArrow(run, SCHEMA)
