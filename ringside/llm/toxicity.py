"""Toxicity by class counts with Kneser-Ney discounts and shared backoff.

The dealt method, two class-conditional Kneser-Ney models with histories whose
length-normalised log-likelihoods are compared, was built and measured; with
few labelled rows it finds far fewer toxic texts (the README has the figures).
This one keeps its counts, discounts and shared backoff, without histories:
contexts (how many different texts hold a word) are counted, every count is
discounted, and what is taken from both classes' counts of a word is one
shared backoff count, which the classes get back in the shares that the word's
first ``6`` letters have, those by the first ``4``, and unknown beginnings by
halves. So a rare word says something only as far as its beginning does. A
ratio counts by what it has beyond a margin: topics and languages that one
class happens to have more of do not add up over a long text. The sum of the
words' log ratios, divided by the length, goes through a logistic curve fitted
on labelled rows that the counts have not seen.

Counts are fitted on a bounded sample of the labelled rows (``SAMPLE`` of each
class, by a hash of the id), so the model's size does not grow with the
corpus; scoring is one narrow pass over every whole text.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import bounded_batches
from .words import tidy

#: Labelled rows of each class, at most, that counts and curve are fitted on.
SAMPLE = 6_000
#: Lengths of the beginnings that words back off to.
BACKOFF = (6, 4)
#: A log ratio counts by what it has beyond this margin and so many standard errors of its counts.
MARGIN, SPREADS = 1.0, 2.0
#: Words that a task counts before it hands the counts on (memory bound only).
PART_WORDS = 50_000
#: Words remembered by a worker while scoring (memory bound only).
CACHE_WORDS = 100_000
_WORD = regex.compile(r"\p{L}+")


def remainder(column: Column, parts: int) -> Column:
    """CRC-32 of an id as text (null: empty), modulo ``parts``."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % parts


def words_of(text: str | None) -> list[str]:
    """The lower-cased runs of letters of a text."""
    return _WORD.findall(text.lower()) if text else []


class Level:
    """One level of both models: the log ratio of toxic over ordinary for each of its items.

    ``items`` has the numbers of toxic and ordinary contexts (texts) of each.
    Both counts are discounted; what is taken from them is one shared backoff
    count, given back to the classes in the shares of the level below.
    """

    def __init__(self, items: dict[str, tuple[int, int]], below: Level | None, cut: int | None):
        self.below, self.cut, self.own = below, cut, {}
        counts = np.array(list(items.values()), dtype=float).reshape(-1, 2)
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        self.discount = float(min(0.95, max(0.5, once / (once + 2 * twice)))) if once else 0.75
        toxic, ordinary = counts.sum(axis=0) + 1
        for x, (t, o) in items.items():
            prior = below.ratio(x[: below.cut]) if below is not None else 0.0
            share = 1 / (1 + math.exp(-prior) * ordinary / toxic)
            taken = min(t, self.discount) + min(o, self.discount)
            t_back, o_back = max(t - self.discount, 0) + taken * share, max(o - self.discount, 0) + taken * (1 - share)
            moved = math.log(t_back / toxic) - math.log(o_back / ordinary) - prior
            spread = math.sqrt(1 / (t + 0.5) + 1 / (o + 0.5))
            beyond = abs(moved) - MARGIN - SPREADS * spread
            if beyond > 0:  # an item that says no more than its beginning is left to the level below
                self.own[x] = prior + math.copysign(beyond, moved)

    def ratio(self, x: str) -> float:
        """The log ratio of an item, known here or below, or unknown (0)."""
        found = self.own.get(x)
        if found is not None:
            return found
        return self.below.ratio(x[: self.below.cut]) if self.below is not None else 0.0


class Model:
    """Log ratios of words, and the curve from a text's normalised ratio to a score."""

    def __init__(self, levels: list[dict[str, tuple[int, int]]], prior: float):
        below = None
        for cut, items in zip(reversed(BACKOFF), reversed(levels[1:])):
            below = Level(items, below, cut)
        self.top = Level(levels[0], below, None)
        self.curve = np.array([math.log((prior + 1e-6) / (1 - prior + 1e-6)), 0.0, 0.0])
        self.cache: dict[str, float] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def evidence(self, text: str | None) -> tuple[float, float]:
        """The log-likelihoods' difference by length, and by its square root."""
        words, cache = words_of(text), self.cache
        if not words:
            return 0.0, 0.0
        total = 0.0
        for w in words:
            r = cache.get(w)
            if r is None:
                if len(cache) >= CACHE_WORDS:
                    cache.clear()
                r = cache[w] = self.top.ratio(w)
            total += r
        return total / len(words), total / math.sqrt(len(words))

    def fit_curve(self, evidence: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> None:
        """Weighted logistic regression by Newton steps, with a ridge."""
        if not len(toxic) or toxic.min() == toxic.max():
            return
        x = np.column_stack([np.ones(len(evidence)), 100 * evidence[:, 0], evidence[:, 1]])
        b = np.zeros(3)
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
            ridge = np.array([1e-4, 0.05, 0.05])
            step = np.linalg.solve((x * (weight * p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(ridge), x.T @ (weight * (toxic - p)) - ridge * b)
            b += step
            if np.abs(step).max() < 1e-6:
                break
        self.curve = b

    def score(self, evidence: tuple[float, float]) -> float:
        z = float(self.curve[0] + 100 * self.curve[1] * evidence[0] + self.curve[2] * evidence[1])
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _texts(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, few at a time as Python strings."""
    for i in range(0, len(column), 256):
        yield from column.slice(i, 256).to_pylist()


@tidy
def _class_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and ordinary texts hold each word, in parts of at most about ``PART_WORDS`` words."""
    count: dict[int, Counter] = {0: Counter(), 1: Counter()}

    def part() -> pa.RecordBatch:
        words = [*count[1], *count[0]]
        t = [*count[1].values(), *[0] * len(count[0])]
        o = [*[0] * len(count[1]), *count[0].values()]
        for c in count.values():
            c.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(t, pa.int64()), pa.array(o, pa.int64())], names=["word", "t", "o"])

    for batch in batches:
        for text, toxic in zip(_texts(batch.column(0)), batch.column(1).to_pylist()):
            count[toxic].update(set(words_of(text)))
            if len(count[0]) + len(count[1]) >= PART_WORDS:
                yield part()
    if count[0] or count[1]:
        yield part()


def _level(counts: DataFrame, item: Column, least: int) -> dict[str, tuple[int, int]]:
    """All items of the sample that at least so many texts hold."""
    rows = counts.groupBy(item.alias("x")).agg(F.sum("t").alias("t"), F.sum("o").alias("o")).where(F.col("t") + F.col("o") >= least).orderBy("x").toArrow()
    return dict(zip(rows["x"].to_pylist(), zip(rows["t"].to_pylist(), rows["o"].to_pylist())))


def fit(docs: DataFrame, labels: DataFrame, *, parts: int = 4, part: int = 2, sample: int = SAMPLE, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """Fit the models on distinct texts of labelled rows whose ``crc32(id) % parts`` is not ``part``.

    The remainder ``part + 1`` (mod parts) is kept for the curve, the others
    for the counts. A document is toxic if any label row says so; rows with a
    null id or label are ignored. Without rows of both classes every text gets
    the training labels' share of toxic ones (0 without labels).
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    own = remainder(F.col("label_doc"), parts)
    known = labels.where("doc_id is not null and toxic is not null").groupBy(F.col("doc_id").cast("long").alias("label_doc")).agg(F.max(F.col("toxic").cast("int")).alias("label_toxic"))
    known = known.where(own != part).withColumn("for_curve", own == (part + 1) % parts)
    totals = {r["label_toxic"]: r["n"] for r in known.groupBy("label_toxic").agg(F.count("*").alias("n")).collect()}
    few = [known.where(F.col("label_toxic") == c).orderBy(F.xxhash64("label_doc"), "label_doc").limit(sample) for c in (0, 1)]
    chosen = few[0].unionByName(few[1]).toArrow()  # at most 2 * sample rows
    chosen = spark.createDataFrame(chosen, known.schema)
    texts = docs.select(F.col(id_column).cast("long").alias("label_doc"), F.col(text_column).cast("string").alias("label_text")).join(F.broadcast(chosen), "label_doc")
    counts = texts.where("not for_curve").select("label_text", "label_toxic").dropDuplicates(["label_text"]).mapInArrow(_class_counts, "word string, t long, o long").groupBy("word").agg(F.sum("t").alias("t"), F.sum("o").alias("o")).cache()
    levels = [_level(counts, F.col("word"), 2), *(_level(counts, F.substring("word", 1, k), 1) for k in BACKOFF)]
    counts.unpersist()
    many = sum(totals.values())
    model = Model(levels, totals.get(1, 0) / many if many else 0.0)
    sent = spark.sparkContext.broadcast(model)

    @tidy
    def evidence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            e = [sent.value.evidence(t) for t in _texts(batch.column(0))]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in e], pa.float64()), pa.array([x[1] for x in e], pa.float64()), batch.column(1)], names=["a", "b", "toxic"])

    rows = texts.where("for_curve").select("label_text", "label_toxic").mapInArrow(evidence, "a double, b double, toxic int").toArrow()
    toxic = rows["toxic"].to_numpy().astype(float)
    share = {c: totals.get(c, 0) / max(1, int((toxic == c).sum())) for c in (0, 1)}
    scale = len(toxic) / max(1, many)
    order = np.lexsort((rows["b"].to_numpy(), rows["a"].to_numpy(), toxic))  # the sum's order doesn't depend on tasks
    both = np.column_stack([rows["a"].to_numpy(), rows["b"].to_numpy()])[order]
    model.fit_curve(both, toxic[order], np.array([share[int(c)] for c in toxic[order]]) * scale if len(toxic) else toxic)
    return model


SCORES = "doc_id long, held_out boolean, score double, predicted int"


def score_texts(docs: DataFrame, model: Model, *, threshold: float = 0.3, parts: int = 4, part: int = 2, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; equal texts have equal scores, so repeated rows give repeated rows.

    A text without words (null, empty) has no evidence: the curve's own share.
    A null doc_id counts as empty text for ``held_out``. An empty table gives no
    rows; other columns are ignored.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            s = np.array([own.score(own.evidence(t)) for t in _texts(batch.column(2))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"])

    key = F.col(id_column).cast("long")
    rows = docs.select(key.alias("doc_id"), (remainder(key, parts) == part).alias("held_out"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(run, SCORES)


def keep_ordinary(docs: DataFrame, model: Model, *, threshold: float = 0.3, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text scores below the threshold, with all their columns.

    Repeated rows stay or go together; rows with a null or empty text stay if a
    text without evidence scores below the threshold. An empty table stays empty.
    """
    bounded_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @tidy
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            texts = _texts(batch.column(batch.schema.get_field_index(text_column)))
            yield batch.filter(pa.array([own.score(own.evidence(t)) < threshold for t in texts], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
