"""Lattice scores against brute force."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

pytest.importorskip("sentencepiece")

from ringside.llm import lattice
from ringside.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def pieces():
    return lattice.read_pieces(tokenizer_path("piece_bpe_32k.model"))


def brute(word, table):
    w = b" " + word
    alpha = [1.0] + [0.0] * len(w)
    for e in range(1, len(w) + 1):
        alpha[e] = sum(alpha[s] * table.get(w[s:e], 0.0) for s in range(e))
    return math.log(alpha[-1])


def test_forward_sums_all_segmentations(pieces):
    names, p = pieces
    own, table = lattice.Lattice(names, np.log(p)), dict(zip(names, p))
    words = [b"the", b"thndhain.", "Äauach".lower().encode(), "日本語".encode(), b"x" * 60, b"ab" * 40, b"\xff\x00q", b"q"]
    assert np.allclose(own.words(words)[:, 0], [brute(w, table) for w in words])


def test_expected_counts(pieces):
    names = [bytes([b]) for b in range(256)] + [b" a", b"ab", b" ab", b"bb"]
    p = np.full(len(names), 1 / len(names))
    own, table = lattice.Lattice(names, np.log(p)), dict(zip(names, p))
    for w in (b"abb", b"abb" * 20):
        got = np.zeros(len(names))
        own.words([w], got, np.array([3.0]))
        h = 1e-6  # a count is the derivative of the log-probability by the piece's log-probability
        for i in (names.index(b"a"), 256, 257, 258, 259):
            up = table | {names[i]: p[i] * math.exp(h)}
            assert abs(got[i] - 3 * (brute(w, up) - brute(w, table)) / h) < 1e-3


def words(text):
    return (text or "").encode().lower().split()


def test_scores_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(lattice, "CHUNK_BYTES", 3000)
    rnd = random.Random(1)
    texts = [None, "", "A a\x0b\tb c É", "z" * 90] + [" ".join(rnd.choice(["the", "The", "on", "é", "qx", f"r{i}"]) for _ in range(rnd.randint(0, 80))) for i in range(80)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "the the"), (3, "on on")]
    df = spark.createDataFrame([(d, t, "x", 1, 2.0) for d, t in rows], "doc_id long, text string, word string, n int, score double").repartition(3)
    got = lattice.score_documents(df, tokenizer_path("piece_bpe_32k.model")).collect()
    assert len(got) == len(rows)
    held = lambda d: zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2
    count, ends = Counter(), 0
    for d, t in rows:
        if not held(d):
            count.update(words(t))
            ends += 1
    total, distinct = sum(count.values()) + ends, len(count) + 1
    want = Counter()
    for d, t in rows:
        c = [count[w] for w in words(t)] + [ends]
        want[d, held(d), len(c), sum(x > 0 for x in c), total, round(sum(math.log10((x + 1) / (total + distinct + 1)) for x in c), 6)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    # the model by brute force: pieces fitted to the discounted part of the counts, words as a whole beside them
    names, p = lattice.read_pieces(tokenizer_path("piece_bpe_32k.model"))
    once, twice = (sum(c == k for c in count.values()) for k in (1, 2))
    d, n = once / (once + 2 * twice), sum(count.values())
    log_p = np.log(p)
    for _ in range(lattice.ROUNDS):
        expected = np.full(len(names), lattice.PRIOR)
        lattice.Lattice(names, log_p).words(list(count), expected, np.minimum(list(count.values()), d))
        log_p = np.log(expected / expected.sum())
    table, end = dict(zip(names, np.exp(log_p))), (ends + 1) / (ends + 1 + n)

    def chance(w):
        return (1 - end) * (max(count[w] - d, 0) / n + d * len(count) / n * math.exp(brute(w, table)))

    scores = sorted(sum(math.log10(chance(w)) for w in words(t)) + math.log10(end) for _, t in rows)
    assert np.allclose(scores, sorted(r.score for r in got), atol=1e-3)


def test_groups_are_a_mixture(spark):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["aa", "bb"] if i % 2 else ["yy", "zz"]) for _ in range(20)), ["x", "y"][i % 2] if i % 9 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one, two = ({r.doc_id: r.score for r in lattice.score_documents(df, tokenizer_path("piece_bpe_32k.model"), group_column=g).collect()} for g in (None, "lang"))
    assert sum(two.values()) > sum(one.values()) + 200 * 20 * 0.15
    swapped = spark.createDataFrame([(d, t, g if not lattice.held_out(d) else "x") for d, t, g in rows], "doc_id long, text string, lang string")
    again = {r.doc_id: r.score for r in lattice.score_documents(swapped, tokenizer_path("piece_bpe_32k.model"), group_column="lang").collect()}
    assert all(abs(again[d] - two[d]) < 1e-3 for d in two)  # scoring doesn't look at the column


def test_empty_and_untrained(spark):
    df = spark.createDataFrame([(d, "a b") for d in range(40) if lattice.held_out(d)], "doc_id long, text string")
    got = lattice.score_documents(df, tokenizer_path("piece_bpe_32k.model")).collect()
    assert got and all(r.held_out and r.n_known == 0 and r.train_tokens == 0 and r.score < 0 for r in got)
    assert lattice.score_documents(df.limit(0), tokenizer_path("piece_bpe_32k.model")).count() == 0


def test_better_than_the_base_on_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    got = [r for r in lattice.score_documents(docs, tokenizer_path("piece_bpe_32k.model"), group_column="lang").collect() if r.held_out]
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_blocks_of_places_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(lattice, "CHUNK_BYTES", 200)
    rnd = random.Random(6)
    rows = [(i, " ".join(rnd.choice(["the", "on", "é", f"r{i % 7}"]) for _ in range(rnd.randint(0, 30)))) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3, "doc_id")
    once = sorted(map(tuple, lattice.score_documents(df, tokenizer_path("piece_bpe_32k.model")).collect()))
    monkeypatch.setattr(lattice, "PLACES", 3)
    again = sorted(map(tuple, lattice.score_documents(df, tokenizer_path("piece_bpe_32k.model")).collect()))
    assert [r[:5] for r in once] == [r[:5] for r in again] and np.allclose([r[5:] for r in once], [r[5:] for r in again], atol=1e-4)
