"""Quality gates, candidate choice, comparison of computed with published standings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import LEAD_TITLE, name_core
from .assign import by_position

# Agility years whose owners cannot be told.
OWNERLESS_YEARS = (2013, 2015, 2019)


def is_valid(sport: Column, year: Column, dog: Column, owner: Column, score: Column, score2: Column, *, owner_always: bool = False) -> Column:
    """Whether a row of standings is usable (texts as printed)."""
    value, owner, dog = score.try_cast("double"), F.trim(F.coalesce(owner, F.lit(""))), F.coalesce(dog, F.lit(""))
    named = (owner != "") & owner.rlike("^[^a-z]") & owner.rlike("[a-z]")
    exempt = F.lit(False) if owner_always else F.coalesce(year.try_cast("int").isin(*OWNERLESS_YEARS), F.lit(False))
    speed = F.coalesce(score2.try_cast("double"), F.lit(0.0)) <= 12
    agility = (value > 0) & (value <= 100) & ~score.rlike(r"^0\d") & (exempt | named) & ~dog.rlike(r"^[\d.]") & speed
    return F.coalesce(value.isNotNull() & ((sport != "Agility") | agility), F.lit(False))


def gate(df: DataFrame, valid: Column) -> tuple[DataFrame, DataFrame]:
    """(clean, dropped) rows: each row is in one of them."""
    flagged = df.withColumn("__valid", F.coalesce(valid, F.lit(False)))
    return flagged.where("__valid").drop("__valid"), flagged.where("not __valid").drop("__valid")


def without_owners(df: DataFrame) -> DataFrame:
    """Rows of ownerless years with a blank owner and without lone capitals at the dog's end."""
    odd = F.col("year").isin(*OWNERLESS_YEARS) & (F.col("sport") == "Agility")
    return df.withColumns({"owner": F.when(odd, "").otherwise(F.col("owner")), "dog": F.when(odd, F.regexp_replace("dog", r"(?:\s+[A-Z]\b)+$", "")).otherwise(F.col("dog"))})


def name_score(name: Column, owner: Column) -> Column:
    """How clean a parsed row looks: titled names gain, owners in names and missing owners lose."""
    return F.when(name.rlike(LEAD_TITLE), 2).otherwise(0) - F.when(name.contains("/"), 2).otherwise(0) - F.when(F.coalesce(owner, F.lit("")) == "", 1).otherwise(0)


def choose(candidates: DataFrame, keys: Sequence[str], candidate: str, points: Column) -> DataFrame:
    """All rows of each key's candidate of most points, ties to the smaller candidate."""
    sums = candidates.groupBy(*keys, candidate).agg(F.sum(points).alias("__points"))
    best = sums.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__points"), candidate))).where("__n = 1")
    return candidates.join(best.select(*keys, candidate), [*keys, candidate], "left_semi")


def choose_in(candidates: DataFrame, keys: Sequence[str], candidate: str, points: Column) -> DataFrame:
    """As ``choose``, in windows over the candidates themselves: for plans that are too large to stand in twice."""
    summed = candidates.withColumn("__points", F.sum(points).over(Window.partitionBy(*keys, candidate)))
    best = summed.withColumn("__n", F.rank().over(Window.partitionBy(*keys).orderBy(F.desc("__points"), candidate)))
    return best.where("__n = 1").drop("__points", "__n")


def same_dog(a: Column, b: Column) -> Column:
    """Whether two names' cores are equal or one holds the other."""
    x, y = name_core(a), name_core(b)
    return (x == y) | x.contains(y) | y.contains(x)


def status(category: Column, official_dog: Column, official_score: Column, computed_dog: Column, computed_score: Column, has_official: Column, has_computed: Column) -> Column:
    """What an official and a computed position say about each other (the texts are fixed values)."""
    number = F.abs(official_score.try_cast("double") - computed_score.try_cast("double")) < 0.05
    dog = same_dog(official_dog, computed_dog)
    combined = category.contains("High Combined") | category.contains("High Triple") | (category == "Open B/Utility A or B")
    two = F.when(dog & number, "✅ match").when(number, "✅ match (name fmt)").when(dog, F.concat(F.lit("⚠ score "), official_score, F.lit("≠"), computed_score)).otherwise(F.concat(F.lit("↕ ordering ("), official_score, F.lit(" vs "), computed_score, F.lit(")")))
    one = F.when(combined, "▢ combined cat (not computed yet)").otherwise("△ in official, not in raw (snapshot/legs)")
    return F.when(has_official & has_computed, two).when(has_official, one).otherwise("＋ computed, missing from our PDF parse")


def official(sports: DataFrame, sport: str, year: int) -> DataFrame:
    """A sport's published rows of a year: category without its division, in order of rank, dog and score (``seq``)."""
    rows = sports.where((F.col("sport") == sport) & (F.col("year").cast("int") == year)).withColumn("category", F.element_at(F.split("category", ": "), -1))
    return rows.withColumn("seq", F.row_number().over(Window.partitionBy("category").orderBy("rank", "dog", "score")))


def category_order(first: DataFrame, second: DataFrame, order: str) -> DataFrame:
    """All categories of two tables, those of the first by where they begin, then those only the second has: ``category, order_idx``."""
    seen = first.groupBy("category").agg(F.min(order).alias("at")).withColumn("side", F.lit(0)).unionByName(second.groupBy("category").agg(F.min(order).alias("at")).withColumn("side", F.lit(1)))
    return seen.groupBy("category").agg(F.min(F.struct("side", "at")).alias("order_idx"))


def comparison(published: DataFrame, computed: DataFrame) -> DataFrame:
    """Published and computed rows of each category side by side, by position, with what they say about each other.

    ``published`` has ``category, seq, dog, score``, ``computed`` has ``category,
    rank, dog, score``; scores are compared as printed.
    """
    text = lambda c: F.col(c).cast("string").alias("score")
    both = by_position(published.select("category", "seq", "dog", text("score")), computed.select("category", "rank", "dog", text("score")), ["category"], ["seq"], ["rank"])
    said = status(F.col("category"), F.col("l.dog"), F.col("l.score"), F.col("r.dog"), F.col("r.score"), F.col("l").isNotNull(), F.col("r").isNotNull())
    return both.select("category", F.col("position").alias("rank"), F.col("l.dog").alias("official_dog"), F.col("l.score").alias("official_score"), F.col("r.dog").alias("computed_dog"), F.col("r.score").alias("computed_score"), said.alias("status"))


def tally(rows: DataFrame) -> DataFrame:
    """How many rows have each kind of status (its first sign), the most frequent first."""
    return rows.groupBy(F.split("status", " ")[0].alias("kind")).count().orderBy(F.desc("count"), "kind")
