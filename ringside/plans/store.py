"""Canonical tables of standings, their unified view, and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numbers import int_or_null, int_raw, num_or_null, prefix_real
from ..functions.text import inner_initial, squash
from ..functions.titlecase import tc_name, tc_owner
from ..operators.windows import number_rows

# The stat columns of conformation tables, breed and group.
BREED_STATS = ("bob_shows", "bob_spec", "bob_pts", "bos_shows", "bos_spec", "bos_pts", "total")
GROUP_STATS = ("bis_n", "bis_pts", "grp1_n", "grp1_pts", "grp2_n", "grp2_pts", "grp3_n", "grp3_pts", "grp4_n", "grp4_pts", "total")
STATS = (*BREED_STATS[:-1], *GROUP_STATS)
SPORT_FIELDS = ("sport", "year", "quarter", "category", "rank", "tie", "dog", "owner", "score", "score2")


def conformation_table(rows: DataFrame) -> DataFrame:
    """Canonical conformation rows: names and owners repaired and in title case, stats as integers.

    A stat that is not an integer (``8/3``) stays in ``<stat>_raw``. Needs ``src_seq``.
    """
    name, owner = inner_initial(F.col("name"), F.col("owner"))
    fixed = rows.withColumns({"__name": name, "__owner": owner})
    have = [c for c in STATS if c in rows.columns]
    stats = [int_or_null(c).alias(c) for c in have] + [F.lit(None).cast("int").alias(c) for c in STATS if c not in have]
    raw = [int_raw(c).alias(f"{c}_raw") for c in have]
    return fixed.select("src_seq", int_or_null(F.col("year").cast("string")).alias("year"), "quarter", "section", F.col("rank").cast("int").alias("rank"), "tie", tc_name(F.col("__name")).alias("name"), tc_owner(F.col("__owner")).alias("owner"), *stats, *raw)


def sports_table(rows: DataFrame) -> DataFrame:
    """Canonical sports rows: white space tidied, scores as numbers. Needs ``src_seq``."""
    tidy = lambda c: squash(F.coalesce(F.col(c), F.lit("")))
    return rows.select("src_seq", "sport", int_or_null(F.col("year").cast("string")).alias("year"), "quarter", "category", F.col("rank").cast("int").alias("rank"), "tie", tidy("dog").alias("dog"), tidy("owner").alias("owner"), num_or_null("score").alias("score"), num_or_null("score2").alias("score2"))


def with_ids(df: DataFrame, *, bucket: int = 1_000_000) -> DataFrame:
    """``id`` 1..N in order of ``src_seq``, which must be unique; runs of ``bucket`` places are numbered in parallel."""
    return number_rows(df, "id", [F.floor(F.col("src_seq") / bucket)], [F.col("src_seq")]).drop("src_seq")


def rankings(conformation: DataFrame, sports: DataFrame) -> DataFrame:
    """Both tables in one shape; a conformation row's score is its total, read as a number's beginning."""
    total = F.coalesce(F.col("total_raw"), F.col("total").cast("string")) if "total_raw" in conformation.columns else F.col("total").cast("string")
    a = conformation.select(F.lit("Conformation").alias("sport"), "year", "quarter", F.col("section").alias("category"), "rank", "tie", "name", "owner", prefix_real(total).alias("score"))
    return a.unionByName(sports.select("sport", "year", "quarter", "category", "rank", "tie", F.col("dog").alias("name"), "owner", "score"))


def save(df: DataFrame, path: str, partition: Sequence[str] = ("year",)) -> None:
    """Replace a Parquet table, partitioned for the filters that views use."""
    df.write.mode("overwrite").partitionBy(*partition).parquet(path)


def open_store(spark: SparkSession, conformation: str, sports: str) -> DataFrame:
    """Register ``conformation``, ``sports`` and ``rankings`` as views; return the last."""
    a, b = spark.read.parquet(conformation), spark.read.parquet(sports)
    a.createOrReplaceTempView("conformation")
    b.createOrReplaceTempView("sports")
    out = rankings(a, b)
    out.createOrReplaceTempView("rankings")
    return out


def write_csv(df: DataFrame, path: str, columns: Sequence[str]) -> None:
    """CSV with a header, the columns in order; those a row set lacks are empty."""
    have = [F.col(c).cast("string").alias(c) if c in df.columns else F.lit("").alias(c) for c in columns]
    df.select(*have).write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object a line."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def markdown_table(df: DataFrame, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row ``markdown``: a (small) result as a table in a document."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns)), F.lit(" |"))
    lines = F.transform(F.array_sort(F.collect_list(F.struct(*order, line.alias("__line")))), lambda s: s["__line"])
    head = "| " + " | ".join(columns) + " |\n|" + "---|" * len(columns) + "\n"
    return df.agg(F.concat(F.lit(head), F.array_join(lines, "\n")).alias("markdown"))


def counts(df: DataFrame, *by: str) -> DataFrame:
    """How many rows each group has, the largest first (the console reports of a run)."""
    return df.groupBy(*by).agg(F.count("*").alias("n_rows")).orderBy(F.desc("n_rows"), *by)
