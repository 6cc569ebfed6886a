"""The query surface: filtered, searched, sorted, paged and grouped views of standings."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ALL = "All classes"


@dataclass(frozen=True)
class ViewSpec:
    """Which columns a view has, which of them sort as numbers, which hold category and year."""

    columns: tuple[str, ...]
    numeric: tuple[str, ...] = ()
    category: str | None = None
    year: str | None = None
    key: str = "id"


@dataclass(frozen=True)
class ViewState:
    """What is asked of a view."""

    category: str = ALL
    year: str = ""
    search: str = ""
    sort: str | None = None
    descending: bool = False
    page: int = 1
    size: int = 30


def sort_number(x: Column) -> Column:
    """The number that a cell's digits make, for sorting; null for none."""
    return F.regexp_replace(x.cast("string"), r"[^\d.\-]", "").try_cast("double")


def filtered(df: DataFrame, spec: ViewSpec, state: ViewState) -> DataFrame:
    """Rows of the category and year whose any cell holds the search text, whatever its case."""
    if spec.category and state.category not in ("", ALL):
        df = df.where(F.col(spec.category) == state.category)
    if spec.year and state.year:
        df = df.where(F.col(spec.year).cast("string") == state.year)
    if state.search:
        cells = F.array(*(F.lower(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in spec.columns))
        df = df.where(F.exists(cells, lambda c: c.contains(state.search.lower())))
    return df


def ordering(spec: ViewSpec, state: ViewState) -> list[Column]:
    """Sort columns: empty and non-numeric cells last either way, ties by the key."""
    if state.sort is None:
        newest = [F.col(spec.year).desc()] if spec.year else []
        return [*newest, F.col(spec.key)]
    x = sort_number(F.col(state.sort)) if state.sort in spec.numeric else F.collate(F.col(state.sort).cast("string"), "UNICODE")
    return [x.desc_nulls_last() if state.descending else x.asc_nulls_last(), F.col(spec.key)]


def newest_first(year: Column, rank: Column, order: str) -> list[Column]:
    """The order in which a view stands at first: the latest year, then the number of the rank's label, then as stored."""
    digits = lambda c: F.coalesce(F.regexp_replace(c.cast("string"), r"\D", "").try_cast("int"), F.lit(0))
    return [F.when(year.cast("string").rlike(r"^\d+$"), year.cast("int")).otherwise(0).desc(), digits(rank), F.col(order)]


def query(df: DataFrame, spec: ViewSpec, state: ViewState) -> DataFrame:
    """One page of a view, sorted. The page is a limit with an offset, so no row is numbered."""
    out = filtered(df, spec, state).orderBy(*ordering(spec, state)).offset((max(1, state.page) - 1) * state.size).limit(state.size)
    return out.select(*spec.columns)


def clamp_page(df: DataFrame, spec: ViewSpec, state: ViewState) -> tuple[int, int]:
    """(page, rows): the asked page within the pages that there are."""
    n = filtered(df, spec, state).count()
    return max(1, min(state.page, -(-n // state.size))), n


def toggled(state: ViewState, column: str) -> ViewState:
    """The state after a click on a column's head."""
    same = state.sort == column
    return ViewState(state.category, state.year, state.search, column, same and not state.descending, 1, state.size)


def grouped(df: DataFrame, spec: ViewSpec, state: ViewState) -> DataFrame:
    """A report of one section a category, sections in name order: section, place in it, its size, the rest of the columns."""
    if not spec.category:
        raise ValueError("a grouped report needs a category")
    own = filtered(df, spec, state)
    w = Window.partitionBy(spec.category)
    rest = [c for c in spec.columns if c != spec.category]
    return own.select(F.col(spec.category).alias("section"), F.row_number().over(w.orderBy(*ordering(spec, state))).alias("place"), F.count("*").over(w).alias("section_rows"), *rest)


def categories(df: DataFrame, column: str) -> DataFrame:
    """One row: all categories sorted, ``All classes`` first."""
    return df.agg(F.concat(F.array(F.lit(ALL)), F.sort_array(F.collect_set(column))).alias("cats"))


def years(df: DataFrame, column: str) -> DataFrame:
    """One row: all years, the latest first."""
    return df.agg(F.sort_array(F.collect_set(F.col(column).cast("string")), asc=False).alias("years"))


def payload(df: DataFrame, spec: ViewSpec, headers: tuple[str, ...], label: str, kind: str) -> DataFrame:
    """One JSON document of a (small) view: headers, which columns are numbers, categories, years and rows as arrays."""
    rows = F.transform(F.array_sort(F.collect_list(F.struct(F.col(spec.key).alias("k"), F.array(*(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spec.columns)).alias("r")))), lambda s: s["r"])
    cats = F.concat(F.array(F.lit(ALL)), F.sort_array(F.collect_set(spec.category))) if spec.category else F.array(F.lit(ALL))
    ys = F.sort_array(F.collect_set(F.col(spec.year).cast("string")), asc=False) if spec.year else F.array().cast("array<string>")
    body = F.struct(F.lit(label).alias("label"), F.lit(kind).alias("kind"), cats.alias("cats"), ys.alias("years"), F.array(*map(F.lit, headers)).alias("headers"), F.array(*(F.lit(c in spec.numeric) for c in spec.columns)).alias("numeric"), rows.alias("rows"))
    return df.agg(F.to_json(body).alias("payload"))


def missing_years(df: DataFrame, kind: str, year: str) -> DataFrame:
    """Years within the span of all kinds that a kind has no row of (as many rows as kinds have years to miss)."""
    span = df.agg(F.sequence(F.min(year), F.max(year)).alias("__span"))  # one row
    kinds = df.groupBy(kind).agg(F.collect_set(year).alias("__have")).join(F.broadcast(span))
    return kinds.select(kind, F.explode(F.array_except("__span", "__have")).alias(year))


def span(df: DataFrame, year: str) -> DataFrame:
    """One row: the first and last year, how many years there are, and all rows."""
    return df.agg(F.min(year).alias("first_year"), F.max(year).alias("last_year"), F.countDistinct(year).alias("n_years"), F.count("*").alias("n_rows"))


def ownerless(df: DataFrame, kind: str, year: str, owner: str) -> DataFrame:
    """Years of a kind none of whose rows has an owner."""
    some = F.bool_or(F.coalesce(F.trim(owner), F.lit("")) != "")
    return df.groupBy(kind, year).agg(some.alias("__some")).where("not __some").select(kind, year)
