"""Whole-text encoding with the tokenizers library at the speed of a word table.

A text is cut where its tokenizer certainly cuts too: at ASCII white space for
a vocabulary that drops white space, at the forced boundaries of ``bpe.py``
for a byte-level one. The library encodes each distinct fragment once per
worker; a bounded table of arrays holds the ids, and a batch of texts is looked
up and put together by a few numpy passes.
"""

from __future__ import annotations

import os
import re

import numpy as np

from .bpe import vocabulary
from .words import _BYTE, span_hashes, word_spans

#: Fragments of a worker's table before it starts anew (memory bound only).
TABLE_FRAGMENTS = 1_000_000
_STOP = re.compile(rb"(?<=[a-z])([.,])(?!\S)")
_PLAIN = re.compile(r" ?[^\s<]+")
#: One run of letters in composed lower case, so one word of the vocabulary.
_LETTERS = re.compile("[a-zà-öø-ÿ]+")


def _printed(b: np.ndarray) -> np.ndarray:
    return (b > 0x20) & (b < 0x7F)


_CASED = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class FragmentTable:
    """Ids of fragments by their 64-bit hash, in arrays: a whole batch is looked up and put together at once.

    A fragment is found by hash and length. Of a table's million fragments an
    unknown one meets some by chance once in 10**13 times.
    """

    def __init__(self):
        self.bits = 21
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(1 << self.bits, dtype=np.uint64)
        self.row = np.zeros(1 << self.bits, dtype=np.int32)
        self.n = 0
        self.start = np.zeros(1024, dtype=np.int64)
        self.size = np.zeros(1024, dtype=np.int32)
        self.bytes_ = np.zeros(1024, dtype=np.int32)
        self.arena = np.zeros(4096, dtype="<u4")
        self.used = 0

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray, length: np.ndarray) -> np.ndarray:
        """The row of each fragment, -1 if unknown."""
        at = self._slot(keys)
        seen = self.keys[at]
        out = np.where(seen == keys, self.row[at], -1)
        todo = np.flatnonzero((seen != keys) & (seen != 0))
        while len(todo):
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)
            seen = self.keys[at[todo]]
            hit = seen == keys[todo]
            out[todo[hit]] = self.row[at[todo[hit]]]
            todo = todo[~hit & (seen != 0)]
        out[(out >= 0) & (self.bytes_[out] != length)] = -1
        return out

    def add(self, keys: np.ndarray, length: np.ndarray, ids: list[bytes]) -> None:
        """Distinct new fragments."""
        k, flat = len(keys), np.frombuffer(b"".join(ids), dtype="<u4")
        sizes = np.array([len(x) // 4 for x in ids], dtype=np.int32)
        for name, need in (("start", self.n + k), ("size", self.n + k), ("bytes_", self.n + k), ("arena", self.used + len(flat))):
            have = getattr(self, name)
            if len(have) < need:
                setattr(self, name, np.concatenate([have, np.zeros(max(need - len(have), len(have) // 2), have.dtype)]))
        rows = np.arange(self.n, self.n + k)
        self.start[rows], self.size[rows], self.bytes_[rows] = self.used + np.cumsum(sizes) - sizes, sizes, length
        self.arena[self.used : self.used + len(flat)] = flat
        self.n, self.used = self.n + k, self.used + len(flat)
        at, todo = self._slot(keys), np.arange(k)
        while len(todo):
            free = todo[self.keys[at[todo]] == 0]
            _, first = np.unique(at[free], return_index=True)  # one a slot; the others go on
            won = free[first]
            self.keys[at[won]], self.row[at[won]] = keys[won], rows[won]
            todo = np.setdiff1d(todo, won, assume_unique=True)
            at[todo] = (at[todo] + 1) & ((1 << self.bits) - 1)

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of fragments in order, and how many each has."""
        n = self.size[rows]
        ends = np.cumsum(n, dtype=np.int64)
        total = int(ends[-1]) if len(ends) else 0
        return self.arena[np.arange(total) + np.repeat(self.start[rows] - (ends - n), n)], n


class FragmentEncoder:
    """Ids of whole texts as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bpe = vocabulary(path) if type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" else None
        if self.bpe is None:
            suffix = self.tokenizer.model.end_of_word_suffix
            vocab = self.tokenizer.get_vocab()
            self.closes = np.zeros(max(vocab.values()) + 1, dtype=bool)
            self.closes[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        else:  # a lone line end between fragments is an id of its own
            self.newline = self.bpe.ids[b"\n"]
        self.table = FragmentTable()
        self.letters = _BYTE if self.bpe is None else _CASED

    def fragments(self, data: bytes) -> list[bytes]:
        """Parts of a text that the library may encode alone, without the white space that it drops."""
        if any(x in data for x in self.special):
            return [data]  # a special token's string: the library sees the text whole
        if self.bpe is None:  # lower case is the vocabulary's own; a stop after a word is a piece of its own
            return _STOP.sub(rb" \1", data.lower() if b"<|" not in data else data).split()
        raw = np.frombuffer(data, dtype=np.uint8)
        at = self.bpe.cuts(raw)
        lone = np.flatnonzero(raw == 10) + 1  # a line end between two printed ASCII characters stands alone
        lone = lone[(lone > 1) & (lone < len(raw))]
        if len(lone):
            lone = lone[_printed(raw[lone]) & _printed(raw[lone - 2])]
            at = np.sort(np.concatenate([at, lone]))
        at = at.tolist()
        return [data[a:b] for a, b in zip([0, *at], [*at, len(data)])]

    def _encode_new(self, parts: list[bytes]) -> dict[bytes, bytes]:
        """Each fragment's ids; ordinary ones in one call, whose ids are told apart by what ends a fragment."""
        out: dict[bytes, bytes] = {}
        ordinary = _LETTERS.fullmatch if self.bpe is None else _PLAIN.fullmatch
        plain, texts, odd = [], [], []
        for p in parts:
            t = p.decode()
            if ordinary(t):
                plain.append(p)
                texts.append(t)
            else:
                odd.append((p, t))
        if plain:
            ids = np.array(self.tokenizer.encode_batch_fast(["\n".join(texts)], add_special_tokens=False)[0].ids, dtype="<u4")
            data, at = ids.tobytes(), 0
            if self.bpe is None:
                step, ends = 0, (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
            else:
                step, ends = 4, [*(4 * np.flatnonzero(ids == self.newline)).tolist(), len(data)]
            for p, e in zip(plain, ends, strict=True):
                out[p] = data[at:e]
                at = e + step
        if odd:
            for (p, _), e in zip(odd, self.tokenizer.encode_batch_fast([t for _, t in odd], add_special_tokens=False)):
                out[p] = np.array(e.ids, dtype="<u4").tobytes()
        return out

    def encode_bytes(self, data: bytes) -> bytes:
        """The ids of a UTF-8 text as little-endian unsigned 32-bit integers."""
        parts = self.fragments(data) if data else []
        found = self._encode_new(list(set(parts))) if parts else {}
        return b"".join([found[p] for p in parts])

    def _spans(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every fragment of some texts."""
        if self.bpe is not None:
            lone = np.flatnonzero(raw == 10) + 1
            lone = lone[(lone > 1) & (lone < len(raw))]
            lone = lone[_printed(raw[lone]) & _printed(raw[lone - 2])]
            edge = np.zeros(len(raw) + 1, dtype=bool)
            edge[self.bpe.cuts(raw)] = edge[lone] = edge[offsets] = True
            edges = np.flatnonzero(edge)
            return edges[:-1], edges[1:]
        starts, ends, _ = word_spans(raw, offsets)
        last = ends - 1
        stop = (raw[last] == 46) | (raw[last] == 44)
        before = raw[np.maximum(last - 1, 0)] | 32
        stop = last[stop & (last > starts) & (before >= 97) & (before <= 122)]
        return np.sort(np.concatenate([starts, stop])), np.sort(np.concatenate([ends, stop]))

    def encode_many(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts one after another, and how many each text has."""
        data = raw.tobytes()
        if any(x in data for x in self.special):  # a special token's string: text by text
            each = [self.encode_bytes(data[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            return np.frombuffer(b"".join(each), "<u4"), np.array([len(x) // 4 for x in each], dtype=np.int64)
        starts, ends = self._spans(raw, offsets)
        keys = span_hashes(raw, starts, ends, self.letters) | np.uint64(1)
        length = (ends - starts).astype(np.int32)
        rows = self.table.find(keys, length)
        missing = np.flatnonzero(rows < 0)
        if len(missing):
            if self.table.n > TABLE_FRAGMENTS:
                self.table.clear()
                missing = np.arange(len(keys))
            _, first = np.unique(keys[missing], return_index=True)
            new = missing[first]
            own = [data[a:b] for a, b in zip(starts[new].tolist(), ends[new].tolist())]
            own = own if self.bpe is not None else [x.lower() for x in own]
            got = self._encode_new(own)
            self.table.add(keys[new], length[new], [got[x] for x in own])
            rows[missing] = self.table.find(keys[missing], length[missing])
        ids, n = self.table.gather(rows)
        ahead = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        return ids, np.diff(ahead[np.searchsorted(starts, offsets)])


_loaded: dict[str, FragmentEncoder] = {}


def encoder(path: str) -> FragmentEncoder:
    """The encoder of a vocabulary file, made once per worker."""
    if path not in _loaded:
        _loaded[path] = FragmentEncoder(path)
    return _loaded[path]
