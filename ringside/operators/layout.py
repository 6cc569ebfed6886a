"""From positioned words to lines, columns and rows.

``words`` has ``file, page, word_seq, text, x0, x1, top``. All operators work
within a page, so pages spread over the cluster and none is large.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .assign import nearest_in

PAGE = ("file", "page")


def visual_lines(words: DataFrame, *, tolerance: float = 3.0, keys: Sequence[str] = PAGE) -> DataFrame:
    """Words with ``line_top`` and ``line_no``: each joins the first line whose mean height is within the tolerance.

    A strip of a page is one array, folded in order of height; the state holds
    the lines begun so far as (sum, count) and each word's line. Strips are cut
    where heights step by more than the tolerance and twice what rounding them
    hides: no line's mean reaches over such a step, so a long page costs no more
    than its strips.
    """
    keys, rest = list(keys), [c for c in words.columns if c not in keys]
    order = Window.partitionBy(*keys).orderBy("__r")
    rounded = words.withColumn("__r", F.round("top", 1))
    rounded = rounded.withColumn("__cut", F.coalesce((F.col("__r") - F.lag("__r").over(order) > tolerance + 0.2).cast("int"), F.lit(0)))
    word = F.struct("__r", "x0", "word_seq", F.struct(*rest).alias("__row"))
    pages = rounded.withColumn("__strip", F.sum("__cut").over(order.rangeBetween(Window.unboundedPreceding, 0))).groupBy(*keys, "__strip").agg(F.array_sort(F.collect_list(word)).alias("__words"))
    start = F.struct(F.array().cast("array<struct<s:double,n:int>>").alias("lines"), F.array().cast("array<int>").alias("at"))

    def step(state: Column, w: Column) -> Column:
        top = w["__row"]["top"].cast("double")
        near = F.transform(state["lines"], lambda x: F.abs(x["s"] / x["n"] - top) <= tolerance)

        def joined(found: Column) -> Column:  # from 1; 0: none
            added = F.transform(state["lines"], lambda x, i: F.when(i + 1 == found, F.struct((x["s"] + top).alias("s"), (x["n"] + 1).alias("n"))).otherwise(x))
            begun = F.concat(state["lines"], F.array(F.struct(top.alias("s"), F.lit(1).alias("n"))))
            return F.struct(F.when(found > 0, added).otherwise(begun).alias("lines"), F.concat(state["at"], F.array(F.when(found > 0, found).otherwise(F.size(state["lines"]) + 1))).alias("at"))

        return F.get(F.transform(F.array(F.array_position(near, True).cast("int")), joined), 0)  # names the place once

    pages = pages.withColumn("__fold", F.aggregate("__words", start, step))
    means = F.transform(F.col("__fold.lines"), lambda x: x["s"] / x["n"])
    order = F.array_sort(F.transform(means, lambda m, i: F.struct(m.alias("m"), (i + 1).alias("i"))))
    above = F.sum(F.size("__fold.lines")).over(Window.partitionBy(*keys).orderBy("__strip").rowsBetween(Window.unboundedPreceding, -1))
    pages = pages.withColumns({"__means": means, "__order": F.transform(order, lambda o: o["i"]), "__above": F.coalesce(above, F.lit(0))})
    out = pages.select(*keys, "__means", "__order", "__above", F.explode(F.arrays_zip(F.col("__words"), F.col("__fold.at").alias("at"))).alias("__w"))
    at = F.col("__w.at")
    placed = out.select(*keys, F.col("__w.__words.__row").alias("__row"), F.element_at("__means", at).alias("line_top"), (F.col("__above") + F.array_position("__order", at) - 1).cast("int").alias("line_no"))
    return placed.select(*(F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in words.columns), "line_top", "line_no")


def session_lines(words: DataFrame, *, tolerance: float = 3.0, keys: Sequence[str] = PAGE) -> DataFrame:
    """As ``visual_lines``, natively: a line ends where heights, in order, step by more than the tolerance."""
    order = Window.partitionBy(*keys).orderBy("top", "x0", "word_seq")
    step = F.coalesce((F.col("top") - F.lag("top").over(order) > tolerance).cast("int"), F.lit(0))
    marked = words.withColumn("__step", step)
    return marked.withColumn("line_no", F.sum("__step").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("int")).drop("__step")


def bucket_lines(words: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Lines of words at one rounded height: ``line_key`` and the words in order of x."""
    own = words.groupBy(*keys, F.rint("top").cast("int").alias("line_key")).agg(F.array_sort(F.collect_list(F.struct("x0", "word_seq", "x1", "text"))).alias("words"))
    return own.withColumn("line", F.array_join(F.transform("words", lambda w: w["text"]), " "))


def split_glued(words: DataFrame) -> DataFrame:
    """A word that runs into a decimal number becomes two, parted in proportion to their letters."""
    parts = [F.regexp_extract("text", r"^(.+?)(\d+\.\d+)$", k) for k in (1, 2)]
    glued = (parts[1] != "") & parts[0].rlike("[A-Za-z*)]")
    cut = F.col("x0") + (F.col("x1") - F.col("x0")) * F.length(parts[0]) / F.length("text")
    piece = lambda text, x0, x1, n: F.struct(text.alias("text"), x0.alias("x0"), x1.alias("x1"), F.lit(n).alias("part"))
    whole = F.array(piece(F.col("text"), F.col("x0"), F.col("x1"), 0))
    both = F.array(piece(parts[0], F.col("x0"), cut, 0), piece(parts[1], cut, F.col("x1"), 1))
    rest = [c for c in words.columns if c not in ("text", "x0", "x1")]
    return words.select(*rest, F.explode(F.when(glued, both).otherwise(whole)).alias("__w")).select(*rest, "__w.text", "__w.x0", "__w.x1", F.col("__w.part").alias("part"))


def cluster_rows(df: DataFrame, keys: Sequence[str], x: str, tie: str, k: int | Column) -> DataFrame:
    """Rows with ``cluster``: numbers in order are cut at their k - 1 largest gaps (the first of equals)."""
    order = Window.partitionBy(*keys).orderBy(x, tie)
    gaps = df.withColumns({"__i": F.row_number().over(order), "__gap": F.col(x) - F.lag(x).over(order)})
    ranked = gaps.withColumn("__g", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc_nulls_last("__gap"), "__i")))
    cut = (F.col("__gap").isNotNull() & (F.col("__g") <= k - 1)).cast("int")
    return ranked.withColumn("cluster", F.sum(cut).over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("__i", "__gap", "__g")


def gap_clusters(df: DataFrame, keys: Sequence[str], x: str, tie: str, k: int) -> DataFrame:
    """Centres of at most k clusters of numbers: ``cluster, centre, n``."""
    return cluster_rows(df, keys, x, tie, k).groupBy(*keys, "cluster").agg(F.avg(x).alias("centre"), F.count("*").alias("n"))


def strong_edge(df: DataFrame, keys: Sequence[str], x: Column, *, share: float = 0.8, least: int = 1) -> DataFrame:
    """The smallest value that occurs at least ``share`` times as often as the most frequent: ``edge``."""
    counts = df.groupBy(*keys, x.alias("__x")).agg(F.count("*").alias("__n"))
    return counts.withColumn("__top", F.max("__n").over(Window.partitionBy(*keys))).where((F.col("__n") >= share * F.col("__top")) & (F.col("__n") >= least)).groupBy(*keys).agg(F.min("__x").alias("edge"))


def mode_of(df: DataFrame, keys: Sequence[str], x: Column, seen: str) -> DataFrame:
    """The most frequent value of each key, of equals the one seen first: ``mode``."""
    counts = df.groupBy(*keys, x.alias("__x")).agg(F.count("*").alias("__n"), F.min(seen).alias("__seen"))
    return counts.groupBy(*keys).agg(F.max_by("__x", F.struct("__n", -F.col("__seen"))).alias("mode"))


def header_geometry(lines: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Of each page's first table header: where names start, owners and numbers begin, and its height.

    ``lines`` has ``line_no, line_top`` and ``words`` (structs x0, x1, text).
    """
    texts = F.transform("words", lambda w: w["text"])
    head = F.array_contains(texts, "Rank") & F.array_contains(texts, "Owners") & F.arrays_overlap(texts, F.array(F.lit("Dog"), F.lit("Bitch")))
    word = lambda name: F.element_at(F.filter("words", lambda w: w["text"] == name), 1)
    middle = lambda w: (w["x0"] + w["x1"]) / 2
    dog = F.coalesce(middle(F.try_element_at(F.filter("words", lambda w: w["text"] == "Dog"), F.lit(1))), middle(F.try_element_at(F.filter("words", lambda w: w["text"] == "Bitch"), F.lit(1))))
    found = F.struct(F.col("line_no").alias("head_no"), F.col("line_top").alias("head_top"), (word("Rank")["x1"] + 1).alias("name_left"), ((dog + middle(word("Owners"))) / 2).alias("owner_left"), middle(word("Owners")).alias("owner"))
    marked = lines.withColumn("__head", F.min(F.when(head, found)).over(Window.partitionBy(*keys)))  # the first: by its number
    near = marked.where(F.col("line_no").between(F.col("__head.head_no") - 2, F.col("__head.head_no") + 1))
    labels = F.array(*map(F.lit, ("#BOB", "#BOS", "BOB", "BOS", "Points", "Total", "BIS", "GRP1", "GRP2", "GRP3", "GRP4", "Shows", "#Spec", "#")))
    right = F.filter("words", lambda w: (w["x0"] > F.col("__head.owner") + 20) & (F.array_contains(labels, w["text"]) | w["text"].rlike(r"^\(?-?\d+\)?$")))
    near = near.withColumn("__right", F.when(F.col("line_no") <= F.col("__head.head_no"), F.array_min(F.transform(right, lambda w: w["x0"]))))
    zone = near.groupBy(*keys).agg(F.first("__head").alias("__head"), F.min("__right").alias("__edge"), F.collect_list(F.struct("line_no", "words")).alias("__near"))
    zone = zone.select(*keys, "__head.head_no", "__head.head_top", "__head.name_left", "__head.owner_left", F.coalesce(F.col("__edge") - 6, F.col("__head.owner") + 80).alias("number_left"), "__near")
    columns = lambda words: F.array_sort(F.transform(F.filter(words, lambda w: (w["x0"] >= F.col("number_left") - 4) & F.array_contains(labels, w["text"])), middle))
    sized = F.transform(F.transform("__near", lambda n: F.struct(columns(n["words"]).alias("c"), n["line_no"].alias("l"))), lambda n: F.struct(F.size(n["c"]).alias("n"), (-n["l"]).alias("l"), n["c"].alias("c")))
    return zone.withColumn("centres", F.array_max(sized)["c"]).drop("__near")


def zone_of(x: Column, rank_left: Column, owner_left: Column, number_left: Column) -> Column:
    """The zone of a word's middle: rank, name, owner or stat."""
    return F.when(x < rank_left, "rank").when(x < owner_left, "name").when(x < number_left, "owner").otherwise("stat")


def stat_columns(words: DataFrame, keys: Sequence[str], centres: Column, names: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Numbers of a row to their nearest columns, wide; two on one column are joined by a slash."""
    number = F.trim(F.translate("text", "(),", ""))
    placed = words.withColumns({"__c": nearest_in(centres, (F.col("x0") + F.col("x1")) / 2), "__v": number})
    cells = placed.groupBy(*keys, "__c").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(*order, "__v"))), lambda s: s["__v"]), "/").alias("__v"))
    return cells.groupBy(*keys).agg(*(F.max(F.when(F.col("__c") == i, F.col("__v"))).alias(n) for i, n in enumerate(names, 1)))


def table_rows(cells: DataFrame, names: Sequence[str], keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows of a bordered table's ``cells``: rank (blank: a tie with the one above), name, owner and stats."""
    from ..functions.numbers import clean_num
    from ..functions.text import lead_initials
    from .windows import fill_ties

    clean = F.transform("cells", lambda c: F.trim(F.replace(F.coalesce(c, F.lit("")), F.lit("\n"), F.lit(" "))))
    rows = cells.withColumn("__c", clean).where(F.exists("__c", lambda c: c != "") & (F.element_at("__c", 1) != "Rank"))
    at = lambda k: F.coalesce(F.try_element_at(F.col("__c"), F.lit(k)), F.lit(""))
    rows = rows.withColumn("printed_rank", F.when(at(1).rlike(r"^\d+$"), at(1)).try_cast("int"))
    filled = fill_ties(rows, "printed_rank", keys, order)
    name, owner = lead_initials(at(2), at(3))
    out = filled.select(*dict.fromkeys([*keys, *order]), F.col("filled_rank").alias("rank"), "tie", name.alias("name"), owner.alias("owner"), *(clean_num(at(4 + i)).alias(n) for i, n in enumerate(names)))
    some = F.col("name") != ""
    for n in names:
        some = some | (F.col(n) != "")
    return out.where(some)


def score_second(lines: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Whether scores stand right after ranks on most ranked lines of a file: ``score_second``."""
    w = F.col("words")
    number = lambda c: c.rlike(r"^\d+(\.\d+)?$")
    ranked = (F.size(w) >= 3) & F.element_at(w, 1)["text"].rlike(r"^\(?\d+\)?\.?$")
    last, second = number(F.try_element_at(w, F.lit(-1))["text"]), number(F.try_element_at(w, F.lit(2))["text"])
    counts = lines.groupBy(*keys).agg(F.count_if(ranked & second & ~last).alias("__a"), F.count_if(ranked & last).alias("__b"))
    return counts.select(*keys, ((F.col("__a") > F.col("__b")) & (F.col("__a") >= 3)).alias("score_second"))


def score_columns(words: DataFrame, keys: Sequence[str] = PAGE) -> DataFrame:
    """Left edges of a page's average (12 to 100) and speed (to 12, with a dot) columns, and the band they span."""
    v = F.col("text").try_cast("double")
    number = F.col("text").rlike(r"^\d+(\.\d+)?$")
    kind = F.when(number & (v > 12) & (v <= 100), "average").when(number & (v > 0) & (v <= 12) & F.col("text").contains("."), "speed")
    counts = words.groupBy(*keys, kind.alias("__kind"), F.rint("x0").cast("int").alias("__x")).agg(F.count("*").alias("__n"), F.min("word_seq").alias("__seen")).where("__kind is not null")
    mode = lambda k: F.max_by("__x", F.when(F.col("__kind") == k, F.struct("__n", -F.col("__seen")))).alias(f"{k}_x")
    both = counts.groupBy(*keys).agg(mode("average"), mode("speed"), F.count_distinct("__kind").alias("__kinds")).where("__kinds = 2").drop("__kinds")
    return both.withColumns({"score_left": F.least("average_x", "speed_x") - 6, "score_right": F.greatest("average_x", "speed_x") + 40})


def assign_scores(numbers: Column, *, limit: float = 10) -> tuple[Column, Column]:
    """(score, speed) of a row's trailing numbers: what is at most ``limit`` is the speed; the last of each counts."""
    small = F.filter(numbers, lambda n: n.cast("double") <= limit)
    large = F.filter(numbers, lambda n: n.cast("double") > limit)
    last = lambda a: F.coalesce(F.try_element_at(a, F.lit(-1)), F.lit(""))
    return last(large), last(small)


def wrapped_names(lines: DataFrame, is_data: Column, text: Column, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Data lines with the fragments since the last data line before their own text: ``full_text``."""
    w = Window.partitionBy(*keys).orderBy(*order)
    marked = lines.withColumns({"__data": is_data, "__text": text})
    marked = marked.withColumn("__group", F.count_if("__data").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("__data").cast("int"))
    parts = F.array_sort(F.collect_list(F.struct(*order, "__text")).over(Window.partitionBy(*keys, "__group")))
    return marked.withColumn("full_text", F.array_join(F.transform(parts, lambda p: p["__text"]), " ")).where("__data").drop("__data", "__text", "__group")


def text_standings(lines: DataFrame, sport: str) -> DataFrame:
    """Standings from text lines (``file, line_no, line``): category, rank, tie, dog, owner, scores."""
    from ..functions.text import category_label, is_division, is_header, is_noise, split_row
    from .windows import fill_ties, header_blocks

    x = F.trim("line")
    rows = lines.withColumn("__s", x).where((F.col("__s") != "") & ~is_noise(F.col("__s")))
    rows = rows.withColumn("__row", split_row(F.col("__s")))
    order = Window.partitionBy("file").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("__division", F.last(F.when(is_division(F.col("__s")), F.col("__s")), ignorenulls=True).over(order)).where(~is_division(F.col("__s")))
    head = is_header(F.lit(sport), F.col("__s"))
    blocks = header_blocks(rows.withColumn("__head", head), F.col("__head"), category_label(F.lit(sport), F.col("__s"), F.coalesce("__division", F.lit(""))), ["file"], ["line_no"])
    data = blocks.where("__row is not null and category is not null").withColumn("__rank", F.col("__row.rank"))
    filled = fill_ties(data, "__rank", ["file", "block"], ["line_no"])
    return filled.select("file", "line_no", "category", F.col("filled_rank").alias("rank"), "tie", "__row.dog", "__row.owner", "__row.scores")
