"""Language-model scoring by the subword lattice of an existing unigram vocabulary.

The pieces are those of a public vocabulary file. Their probabilities start
from the file's scores (in a BPE file these are minus ranks, read as a power
law of the rank) and are fitted by expectation-maximisation to the training
documents. A word (with a mark before it) can be written by many sequences of
pieces; the lattice's probability of it is the sum over all of them, found by
a forward recursion in log space over its bytes. Single bytes are pieces too,
so every text has a probability. One more arc of the lattice is a word of the
training documents as a whole, at its discounted relative frequency; the
pieces share what discounting takes, and are fitted to that. A text's
probability is the product over its words and the end sign; pieces never cross
words, so no segmentation is left out. Given a column of languages, each has
such a model, and a text's probability is their mixture.

How counts reach the documents: each task cuts its documents into chunks of a
bounded size, and writes of every chunk the documents as numbers into the
chunk's own word list, and that list. Lists are summed by word and block of
chunks over the corpus (one shuffle of each chunk's distinct words), blocks by
word where there are several; each word's count and score go back to the
chunks that hold it, where documents are summed up. No vocabulary is ever
broadcast, no text is shuffled, no list is longer than a block.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Tables, bounded_batches
from .words import slices, text_buffer

#: Bytes of text of a chunk.
CHUNK_BYTES = 16_000_000
#: Rounds of expectation-maximisation.
ROUNDS = 3
#: Groups (languages) that get a model of their own.
GROUPS = 6
#: Weight that every piece has beside its expected count.
PRIOR = 0.02
#: Chunks whose places of a word stand in one list.
PLACES = 1024
#: Words of more bytes are walked one at a time.
LONG_WORD = 48
LN10 = math.log(10)
_BASE, _MARK = np.uint64(0x100000001B3), b" "


def held_out(doc_id: int | None, parts: int = 7, part: int = 2) -> bool:
    """Whether a document is kept from training: by the CRC-32 of its id as text (null: empty)."""
    return zlib.crc32(b"" if doc_id is None else b"%d" % doc_id) % parts == part


def read_pieces(model_path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces (as bytes, the word mark as a space) and start probabilities from a sentencepiece file."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    weight: dict[bytes, float] = {}
    known = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i))]
    scores = [model.get_score(i) for i in known if not model.is_byte(i)]
    ranks = all(x == int(x) for x in scores)  # a BPE file's scores; a unigram file's are log-probabilities
    for i in known:
        if model.is_byte(i):
            piece, w = bytes([int(model.id_to_piece(i)[3:5], 16)]), 1e-6
        else:
            piece, score = model.id_to_piece(i).replace("▁", " ").encode(), model.get_score(i)
            w = 1 / (2 - score) if ranks else math.exp(score)
        if b" " not in piece[1:] and piece == piece.lower():
            weight[piece] = weight.get(piece, 0) + w
    for b in range(256):
        weight.setdefault(bytes([b]), 1e-6)
    pieces = sorted(weight)
    p = np.array([weight[x] for x in pieces])
    return pieces, p / p.sum()


def _hash_pieces(pieces: list[bytes]) -> np.ndarray:
    out = np.zeros(len(pieces), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i, x in enumerate(pieces):
            h = np.uint64(len(x))
            for b in x:
                h = (h + np.uint64(b + 1)) * _BASE
            out[i] = h
    return out


class Lattice:
    """Forward (and backward) recursions over words, many words of one length at a time."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        """``log_p`` has a row for each group, or is one group's."""
        self.size = len(pieces)
        self.table = np.vstack([np.atleast_2d(log_p).T, np.full((1, np.atleast_2d(log_p).shape[0]), -np.inf)])  # -1: no piece
        hashes = _hash_pieces(pieces)
        # an open-addressing table: piece number by hash, -1 where there is none
        bits = max(17, (4 * len(pieces)).bit_length())
        self.mask = np.int64((1 << bits) - 1)
        self.shift = np.uint64(64 - bits)
        self.keys = np.zeros(1 << bits, dtype=np.uint64)
        self.number = np.full(1 << bits, -1, dtype=np.int64)
        self.probes = 1
        for n, (h, at) in enumerate(zip(hashes, (hashes * np.uint64(0x9E3779B97F4A7C15) >> self.shift).tolist())):
            step = 1
            while self.number[at] >= 0:
                at, step = (at + 1) & int(self.mask), step + 1
            self.keys[at], self.number[at] = h, n
            self.probes = max(self.probes, step)
        self.by_length = sorted({len(x) for x in pieces})

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The piece of each hash, or -1."""
        at = (hashes * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)
        out = np.where((self.keys[at] == hashes) & (self.number[at] >= 0), self.number[at], -1)
        todo = np.flatnonzero((out < 0) & (self.number[at] >= 0))
        for _ in range(self.probes - 1):
            if not len(todo):
                break
            at[todo] = (at[todo] + 1) & self.mask
            hit = self.keys[at[todo]] == hashes[todo]
            out[todo[hit]] = self.number[at[todo[hit]]]
            todo = todo[~hit & (self.number[at[todo]] >= 0)]
        return out

    def _edges(self, x: np.ndarray) -> list[list[tuple[int, np.ndarray]]]:
        """For each end: (start, piece number or -1 of each word), over words as rows of bytes."""
        n, length = x.shape
        wide = x.astype(np.uint64) + np.uint64(1)
        ends: list[list[tuple[int, np.ndarray]]] = [[] for _ in range(length + 1)]
        for size in self.by_length:
            for a in range(length - size + 1):
                h = np.full(n, size, dtype=np.uint64)
                for i in range(a, a + size):
                    h = (h + wide[:, i]) * _BASE
                found = self.find(h)
                if (found >= 0).any():
                    ends[a + size].append((a, found))
        return ends

    def forward(self, x: np.ndarray, expected: np.ndarray | None = None, weight: np.ndarray | None = None) -> np.ndarray:
        """The natural log-probability of each word in each group; with ``expected`` (one group), adds piece counts to it."""
        n, length = x.shape
        ends = self._edges(x)
        alpha = np.full((length + 1, n, self.table.shape[1]), -np.inf)
        alpha[0] = 0
        for e in range(1, length + 1):
            _log_sum([alpha[a] + self.table[f] for a, f in ends[e]], alpha[e])
        if expected is not None:
            log_p, first = self.table[:, 0], alpha[:, :, 0]
            beta = np.full((length + 1, n), -np.inf)
            beta[length] = 0
            for e in range(length, 0, -1):
                for a, f in ends[e]:
                    beta[a] = np.logaddexp(beta[a], beta[e] + log_p[f])
            for e in range(1, length + 1):
                for a, f in ends[e]:
                    ok = np.flatnonzero(f >= 0)
                    if len(ok):
                        expected += np.bincount(f[ok], np.exp(first[a][ok] + log_p[f[ok]] + beta[e][ok] - first[length][ok]) * weight[ok], minlength=self.size)
        return alpha[length]

    def _long(self, word: bytes, expected: np.ndarray | None, weight: float) -> np.ndarray:
        """One long word: all of a length's substrings are looked up at once, then the recursion walks the bytes."""
        x = np.frombuffer(word, np.uint8).astype(np.uint64) + np.uint64(1)
        n, table = len(x), self.table
        arcs: list[tuple[list[int], list[int]]] = [([], []) for _ in range(n + 1)]
        for size in self.by_length:
            if size > n:
                break
            h = np.full(n - size + 1, size, dtype=np.uint64)
            for i in range(size):
                h = (h + x[i : n - size + 1 + i]) * _BASE
            found = self.find(h)
            for a in np.flatnonzero(found >= 0).tolist():
                arcs[a + size][0].append(a)
                arcs[a + size][1].append(int(found[a]))
        alpha = np.full((n + 1, table.shape[1]), -np.inf)
        alpha[0] = 0
        for e in range(1, n + 1):
            alpha[e] = np.logaddexp.reduce(alpha[arcs[e][0]] + table[arcs[e][1]], axis=0)
        if expected is not None:
            beta = np.full(n + 1, -np.inf)
            beta[n] = 0
            for e in range(n, 0, -1):
                starts, pieces = arcs[e]
                t = beta[e] + table[pieces, 0]
                np.add.at(expected, pieces, weight * np.exp(alpha[starts, 0] + t - alpha[n, 0]))
                beta[starts] = np.logaddexp(beta[starts], t)
        return alpha[n]

    def words(self, words: list[bytes], expected: np.ndarray | None = None, weight: np.ndarray | None = None) -> np.ndarray:
        """The natural log-probability of each word, its mark included, as (words, groups)."""
        out = np.zeros((len(words), self.table.shape[1]))
        if not words:
            return out
        marked = [_MARK + w for w in words]
        lengths = np.array([len(w) for w in marked])
        with np.errstate(over="ignore", divide="ignore", invalid="ignore"):
            for size in np.unique(lengths).tolist():
                at = np.flatnonzero(lengths == size)
                if size > LONG_WORD:
                    for i in at.tolist():
                        out[i] = self._long(marked[i], expected, 0.0 if weight is None else float(weight[i]))
                    continue
                for lo in range(0, len(at), 20_000):
                    some = at[lo : lo + 20_000]
                    x = np.frombuffer(b"".join([marked[i] for i in some.tolist()]), np.uint8).reshape(len(some), size)
                    out[some] = self.forward(x, expected, None if weight is None else weight[some])
        return out


def _log_sum(terms: list[np.ndarray], out: np.ndarray) -> None:
    """log of the sum of exps of some arrays, into ``out``."""
    if len(terms) == 1:
        out[:] = terms[0]
    elif terms:
        top = terms[0].copy()
        for t in terms[1:]:
            np.maximum(top, t, out=top)
        top[~np.isfinite(top)] = 0
        total = np.exp(terms[0] - top)
        for t in terms[1:]:
            total += np.exp(t - top)
        np.log(total, out=total)
        np.add(total, top, out=out)


def _chunk_schema(groups: int) -> str:
    return "chunk long, docs binary, word_ids binary, word string, local int, " + ", ".join(f"n{g} long" for g in range(groups))


def _chunks(parts: int, part: int, groups: int):
    """Rows of two kinds: a chunk's documents as numbers, and the words of its list with training counts by group."""
    names = [x.split()[0] for x in _chunk_schema(groups).split(", ")]
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.string(), pa.int32(), *[pa.int64()] * groups]

    def rows(columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        sizes: list[int] = []
        numbers: list[np.ndarray] = []
        table: defaultdict[bytes, int] = defaultdict()
        table.default_factory = table.__len__  # a new word gets the next number
        train: list[list[np.ndarray]] = [[] for _ in range(groups)]
        taken = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal taken
            chunk = uuid.uuid4().int >> 65
            flat = np.concatenate(numbers)
            counts = [np.bincount(np.concatenate(t), minlength=len(table)) if t else np.zeros(len(table), np.int64) for t in train]
            head = b"".join([np.array([len(ids)], np.int64).tobytes(), np.array([d or 0 for d in ids], np.int64).tobytes(), np.array([d is None for d in ids], np.uint8).tobytes(), np.array(sizes, np.int64).tobytes()])
            yield rows([[chunk], [zlib.compress(head, 1)], [zlib.compress(flat.tobytes(), 1)], [None], [None], *[[None]] * groups])
            words = list(table)
            for lo in range(0, len(words), 20_000):
                some = [x.decode() for x in words[lo : lo + 20_000]]
                k = len(some)
                yield rows([[chunk] * k, [None] * k, [None] * k, some, np.arange(lo, lo + k, dtype=np.int32), *(c[lo : lo + k].astype(np.int64) for c in counts)])
            for x in (ids, sizes, numbers, table, *train):
                x.clear()
            taken = 0

        for batch in batches:
            raw, offsets = text_buffer(batch.column(1))
            docs, group = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for i, j in slices(offsets, CHUNK_BYTES // 4):
                for k in range(i, j):
                    found = raw[offsets[k] : offsets[k + 1]].tobytes().lower().split()
                    own = np.fromiter(map(table.__getitem__, found), np.uint32, len(found))
                    ids.append(docs[k])
                    sizes.append(len(own))
                    numbers.append(own)
                    if not held_out(docs[k], parts, part):
                        train[group[k]].append(own)
                    taken += int(offsets[k + 1] - offsets[k]) + 32
                    if taken >= CHUNK_BYTES:
                        yield from flush()
        if ids:
            yield from flush()

    return run


def _gathered(batches: Iterable[pa.RecordBatch], rows: int = 100_000) -> Iterator[pa.Table]:
    """Batches joined to tables of at least so many rows: words of one length are scored together."""
    held, many = [], 0
    for batch in batches:
        held.append(batch)
        many += batch.num_rows
        if many >= rows:
            yield pa.Table.from_batches(held).combine_chunks()
            held, many = [], 0
    if many:
        yield pa.Table.from_batches(held).combine_chunks()


def _expect(pieces: list[bytes], log_p: np.ndarray, discounts: list[float]):
    """Expected piece counts of each group, of the part of the words' counts that discounting takes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattices = [Lattice(pieces, p) for p in log_p]
        expected = np.zeros((len(lattices), len(pieces)))
        for t in _gathered(batches):
            words = [w.encode() for w in t.column(0).to_pylist()]
            for g, lattice in enumerate(lattices):
                n = t.column(1 + g).to_numpy()
                some = np.flatnonzero(n)
                lattice.words([words[i] for i in some.tolist()], expected[g], np.minimum(n[some], discounts[g]))
        g, piece = np.nonzero(expected)
        yield pa.RecordBatch.from_arrays([pa.array(g, pa.int32()), pa.array(piece, pa.int32()), pa.array(expected[g, piece])], names=["g", "piece", "expected"])

    return run


class Model:
    """Of each group: discount, backoff weight, training words, ends, weight of the group; and its pieces."""

    def __init__(self, pieces: list[bytes], p: np.ndarray, sums: list[tuple[int, int, int, int]], ends: list[int]):
        self.pieces, self.ends = pieces, ends
        self.tokens = [s[0] for s in sums]
        self.log_p = np.repeat(np.log(p)[None], len(sums), axis=0)
        self.discounts = [once / (once + 2 * twice) if once else 0.5 for _, _, once, twice in sums]
        self.backoff = [d * types / n if n else 1.0 for d, (n, types, _, _) in zip(self.discounts, sums)]
        every = sum(ends)
        self.prior = np.array([math.log10(e / every) if e else -math.inf for e in ends]) if every else np.array([0.0] + [-math.inf] * (len(ends) - 1))
        share = [(e + 1) / (e + 1 + n) if n else 0.01 for e, n in zip(ends, self.tokens)]
        self.end = np.array([math.log10(x) for x in share])
        self.go_on = np.array([math.log10(1 - x) for x in share])

    def words(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """log10 of each word's probability in each group, as (words, groups)."""
        out, live = np.zeros((len(words), len(self.ends))), np.flatnonzero(np.isfinite(self.prior))
        spelled = Lattice(self.pieces, self.log_p[live]).words(words) / LN10
        for k, g in enumerate(live.tolist()):
            whole = np.maximum(counts[g] - self.discounts[g], 0) / max(1, self.tokens[g])
            with np.errstate(divide="ignore"):
                known, back = np.log10(whole), spelled[:, k] + math.log10(self.backoff[g])
            top = np.maximum(known, back)
            out[:, g] = top + np.log10(10 ** (known - top) + 10 ** (back - top)) + self.go_on[g]
        return out


def fit_pieces(words: DataFrame, model: Model, rounds: int = ROUNDS) -> None:
    """Fit the pieces' log-probabilities to ``words(word, n0, ...)``.

    Each round sends one number a piece and group to the driver, as many as the vocabulary has.
    """
    groups = len(model.ends)
    for _ in range(rounds):
        run = _expect(model.pieces, model.log_p, model.discounts)
        rows = words.select("word", *(f"n{g}" for g in range(groups))).mapInArrow(run, "g int, piece int, expected double").groupBy("g", "piece").agg(F.sum("expected").alias("expected")).toArrow()
        counts = np.full((groups, len(model.pieces)), PRIOR)
        counts[rows["g"].to_numpy(), rows["piece"].to_numpy()] += rows["expected"].to_numpy()
        model.log_p = np.log(counts / counts.sum(axis=1, keepdims=True))


def _score_words(model: Model):
    """Each word's answer to its chunks: places, training count, log10 probability by group."""
    groups = len(model.ends)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _gathered(batches):
            counts = np.array([t.column(2 + g).to_numpy() for g in range(groups)])
            score = model.words([w.encode() for w in t.column(0).to_pylist()], counts).astype(np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, score.size + 1, groups, dtype=np.int32)), pa.array(score.ravel()))
            yield from pa.table([t.column(1), pa.array(counts.sum(axis=0)), lists], names=["places", "n", "score"]).to_batches(max_chunksize=10_000)

    return run


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score_documents(train_tokens: int, distinct: int, model: Model, parts: int, part: int):
    floor, end_count = math.log10(train_tokens + distinct + 1), sum(model.ends)
    prior, end = model.prior, model.end

    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        out: dict[str, list] = {x.split()[0]: [] for x in SCORES.split(", ")}
        local = right.column("local").to_numpy()
        known, base, score = np.zeros(len(local), np.int64), np.zeros(len(local)), np.zeros((len(local), len(prior)))
        n = right.column("n").to_numpy()
        known[local], base[local] = n > 0, np.log10(n + 1.0)
        if len(local):
            score[local] = right.column("score").combine_chunks().flatten().to_numpy().reshape(len(local), -1)
        for docs, flat in zip(left.column("docs").to_pylist(), left.column("word_ids").to_pylist()):
            head = zlib.decompress(docs)
            many = int(np.frombuffer(head, np.int64, 1)[0])
            ids = np.frombuffer(head, np.int64, many, 8)
            null = np.frombuffer(head, np.uint8, many, 8 + 8 * many)
            sizes = np.frombuffer(head[8 + 9 * many :], np.int64, many)
            words = np.frombuffer(zlib.decompress(flat), np.uint32)
            at = 0
            for d, none, k in zip(ids.tolist(), null.tolist(), sizes.tolist()):
                own = words[at : at + k]
                at += k
                d = None if none else d
                by_group = prior + end + score[own].sum(axis=0)
                top = by_group.max()
                value = float(top + math.log10((10 ** (by_group - top)).sum()))
                plain = math.fsum([float(base[own].sum()), math.log10(end_count + 1), -(k + 1) * floor])
                for name, x in zip(out, (d, held_out(d, parts, part), k + 1, int(known[own].sum()) + (end_count > 0), train_tokens, plain, value)):
                    out[name].append(x)
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table([pa.array(c, t) for c, t in zip(out.values(), kinds)], names=list(out))

    return run


def score_documents(docs: DataFrame, model_path: str, *, parts: int = 7, part: int = 2, rounds: int = ROUNDS, group_column: str | None = None, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Score every text: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the rows whose ``crc32(doc_id as text) % parts`` is not
    ``part`` (a null id counts as empty text). With ``group_column`` (a
    language, say) the ``GROUPS`` most frequent values of training rows get a
    model each, the others one together; scoring does not look at it, a
    text's probability is the sum over the groups. A null or empty text has
    only the end sign. Repeated rows count and are returned each; other
    columns are ignored; an empty table gives no rows; without training rows
    only the vocabulary's own scores speak.
    """
    bounded_batches(docs.sparkSession)
    pieces, p = read_pieces(model_path)
    trains = F.expr(f"crc32(cast(coalesce(cast(cast(`{id_column}` as long) as string), '') as binary)) % {parts} <> {part}")
    names: list[str] = []
    if group_column:
        most = docs.where(trains & F.col(group_column).isNotNull()).groupBy(F.col(group_column).cast("string").alias("g")).count().orderBy(F.desc("count"), "g").limit(GROUPS)
        names = [r["g"] for r in most.collect()]
    groups = len(names) + 1  # the last: other values and null
    group = F.lit(groups - 1)
    for g, name in enumerate(names):
        group = F.when(F.col(group_column).cast("string") == name, g).otherwise(group)
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"), group.alias("g"), trains.alias("trains"))
    counted = {r["g"]: r["count"] for r in rows.where("trains").groupBy("g").count().collect()}
    ends = [counted.get(g, 0) for g in range(groups)]

    columns = [f"n{g}" for g in range(groups)]
    tables = Tables(docs.sparkSession)
    chunks = tables.stored(rows.select("doc_id", "text", "g").mapInArrow(_chunks(parts, part, groups), _chunk_schema(groups)), "chunks")
    # a word's places are listed by blocks of chunks, so no list grows with the corpus
    blocks = 1 + chunks.where("docs is not null").count() // PLACES
    block = F.pmod(F.xxhash64("chunk"), F.lit(blocks)).alias("block")
    placed = chunks.where("word is not null").groupBy("word", block).agg(*(F.sum(c).alias(c) for c in columns), F.collect_list(F.struct("chunk", "local")).alias("places"))
    placed = tables.stored(placed, "places")
    words = placed.drop("block") if blocks == 1 else tables.stored(placed.groupBy("word").agg(*(F.sum(c).alias(c) for c in columns)), "words")
    tables.release()
    every = sum((F.col(c) for c in columns), F.lit(0))
    one = words.agg(F.count_if(every > 0).alias("v"), *(f(c).alias(f"{k}{c}") for c in columns for k, f in (("s", lambda c: F.coalesce(F.sum(c), F.lit(0))), ("t", lambda c: F.count_if(F.col(c) > 0)), ("a", lambda c: F.count_if(F.col(c) == 1)), ("b", lambda c: F.count_if(F.col(c) == 2))))).first()
    model = Model(pieces, p, [tuple(one[f"{k}{c}"] for k in "stab") for c in columns], ends)
    train_tokens, distinct = sum(model.tokens) + sum(ends), one["v"] + (sum(ends) > 0)
    if sum(model.tokens):
        fit_pieces(words.where(every > 0), model, rounds)
    if blocks > 1:
        words = placed.select("word", "places").join(words, "word")
    answers = words.select("word", "places", *columns).mapInArrow(_score_words(model), "places array<struct<chunk:bigint,local:int>>, n long, score array<float>")
    answers = answers.select(F.explode("places").alias("x"), "n", "score").select("x.chunk", "x.local", "n", "score")
    texts = chunks.where("docs is not null").select("chunk", "docs", "word_ids")
    return tables.result(texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_score_documents(train_tokens, distinct, model, parts, part), SCORES), "scores")
