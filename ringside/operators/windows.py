"""Order-dependent operators: carry, ranks, keep-first, audits.

Every operator takes the order explicitly (``order`` ends in a unique column),
since a DataFrame's rows have none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def carry(value: Column | str, keys: Sequence[str], order: Sequence[str]) -> Column:
    """The latest value so far that isn't null."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def fill_ties(df: DataFrame, rank: str, keys: Sequence[str], order: Sequence[str], *, first: int = 0, first_is_tie: bool = True) -> DataFrame:
    """A blank rank takes the rank above and the tie flag ``T``; ``first`` where there is none above."""
    above = carry(rank, keys, order)
    tie = F.col(rank).isNull() & (F.lit(True) if first_is_tie else above.isNotNull())
    return df.withColumns({"filled_rank": F.coalesce(above, F.lit(first)), "tie": F.when(tie, "T").otherwise("")})


def continue_ranks(df: DataFrame, rank: str, keys: Sequence[str], order: Sequence[str], *, rebase: bool = True) -> DataFrame:
    """Unprinted ranks count on: from the last printed one, or (``rebase=False``) among themselves."""
    whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    if not rebase:
        own = F.count_if(F.col(rank).isNull()).over(whole)
        return df.withColumn("run_rank", F.coalesce(F.col(rank), own.cast("int")))
    marked = df.withColumn("__island", F.count(rank).over(whole))
    island = Window.partitionBy(*keys, "__island").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    steps = F.count_if(F.col(rank).isNull()).over(island)
    return marked.withColumn("run_rank", (F.coalesce(F.first(rank).over(island), F.lit(0)) + steps).cast("int")).drop("__island")


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of rows of one key the first in order."""
    return df.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__n = 1").drop("__n")


def header_blocks(df: DataFrame, is_header: Column, label: Column, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows below a header get its label and its number as a block; headers themselves go."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    marked = df.withColumns({"__header": is_header, "__label": F.when(is_header, label)})
    out = marked.withColumns({"category": F.last("__label", ignorenulls=True).over(w), "block": F.count_if("__header").over(w)})
    return out.where("not __header").drop("__header", "__label")


def rank_gaps(df: DataFrame, keys: Sequence[str], rank: str) -> DataFrame:
    """First rows of rank groups that don't stand where their rank says: (keys, found, expected)."""
    expected = F.rank().over(Window.partitionBy(*keys).orderBy(rank))
    return df.select(*keys, F.col(rank).alias("found"), expected.alias("expected")).where("found <> expected").distinct()


def rank_audit(df: DataFrame, keys: Sequence[str], rank: str, *, shown: int = 6) -> DataFrame:
    """Of every list its size, largest rank, whether it has gaps, and the first of them."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n_rows"), F.max(rank).alias("max_rank"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("expected", "found"))
    gaps = rank_gaps(df, keys, rank).withColumn("__n", place)
    kept = F.collect_list(F.when(F.col("__n") <= shown, F.struct("expected", "found")))  # null rows are not collected
    gaps = gaps.groupBy(*keys).agg(F.count("*").alias("n_gaps"), F.array_sort(kept).alias("first_gaps"))
    return sizes.join(gaps, list(keys), "left").withColumn("n_gaps", F.coalesce("n_gaps", F.lit(0)))


def number_rows(df: DataFrame, name: str, bucket: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """``name`` 1..N in the order of ``bucket`` columns, then of ``order``, without gathering all rows.

    Rows are numbered within each bucket; only a row a bucket meets in one
    window. Buckets are to be many and small: leading sort columns, coarsened.
    """
    cols = {f"__b{i}": c for i, c in enumerate(bucket)}
    rows = df.withColumns(cols)
    sizes = rows.groupBy(*cols).agg(F.count("*").alias("__size"))
    before = sizes.withColumn("__before", F.sum("__size").over(Window.orderBy(*cols).rowsBetween(Window.unboundedPreceding, 0)) - F.col("__size")).drop("__size")
    own = rows.withColumn("__n", F.row_number().over(Window.partitionBy(*cols).orderBy(*order)))
    return own.join(before, list(cols)).withColumn(name, F.col("__before") + F.col("__n")).drop(*cols, "__n", "__before")


def coverage_note(parsed: Column | str, raw: Column | str, *, least: float = 0.6) -> Column:
    """What a count of parsed rows says beside an independent count of lines."""
    p, r = (F.col(x) if isinstance(x, str) else x for x in (parsed, raw))
    share = F.floor(F.lit(100) * p / r + 0.5).cast("int").cast("string")
    some = F.concat(F.lit("parsed "), p.cast("string"), F.lit("/"), r.cast("string"), F.lit(" ~ "), share, F.lit("%"))
    return F.when((p == 0) & (r > 0), "has data, none parsed").when((r > 0) & (p < least * r), some).otherwise("")


def recon(parsed: DataFrame, raw: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows parsed beside data lines counted of each raw file, 0 where there are none, with a note on what is missing."""
    have = parsed.groupBy(*keys).agg(F.count("*").alias("parsed"))
    out = raw.groupBy(*keys).agg(F.count("*").alias("raw")).join(have, list(keys), "left").withColumn("parsed", F.coalesce("parsed", F.lit(0)))
    return out.withColumn("note", coverage_note("parsed", "raw"))
