"""Connected components of a graph held in a DataFrame.

Alternating large-star and small-star steps: every node links its larger
neighbours to the smallest node it sees, until the edges form stars around the
smallest node of each component. Each step is two aggregates and joins whose
rows are as many as the edges; a node with very many neighbours is aggregated
before the shuffle. Nothing of the graph comes to the driver but two numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import Tables, drop_table, write_table


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v); ``large`` links larger neighbours, else smaller ones and the node itself."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        out = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, tables: Tables | None = None) -> DataFrame:
    """For every node of ``edges(a, b)``: ``node, component``, the smallest node that it reaches.

    Edges with a null end and loops link nothing; a repeated edge counts once.
    The table that is left is one of ``tables``, if given.
    """
    spark = edges.sparkSession
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    path, mark = write_table(now, "edges"), None
    while True:
        now = spark.read.schema("u long, v long").parquet(path)
        stars = _star(_star(now, large=True), large=False)
        next_path = write_table(stars, "edges")
        row = spark.read.schema("u long, v long").parquet(next_path).agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        drop_table(spark, path)
        path = next_path
        if mark == tuple(row):
            break
        mark = tuple(row)
    if tables is not None:
        tables.paths.append(path)
    stars = spark.read.schema("u long, v long").parquet(path)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select(F.col("v"), F.col("v")).distinct())
