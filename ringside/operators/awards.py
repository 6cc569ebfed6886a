"""Award formulas over raw trial results.

Amounts are summed as whole cents, so a mean does not depend on the order of
rows; every top-k is a rank within its key, which Spark limits before and
after the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import cents, mean_of_cents, round_half_up, speed
from .windows import number_rows

# Placements that qualify, classes and their categories, and the categories' order.
QUALIFYING = ("QLFY", "1", "2", "3", "4")
OBEDIENCE = {
    "BNOVA": "Beginner Novice A", "BNOVB": "Beginner Novice B", "ONOVA": "Novice A", "ONOVB": "Novice B", "OOPENA": "Open A", "OOPENB": "Open B",
    "OUTILA": "Utility A", "OUTILB": "Utility B", "GRADNOVR": "Graduate Novice", "GRADOPNR": "Graduate Open", "POPEN": "Preferred Open",
}
RALLY = {"RNOVA": "Novice A", "RNOVB": "Novice B", "RADVA": "Advanced A", "RADVB": "Advanced B", "REXCA": "Excellent A", "REXCB": "Excellent B", "RINT": "Intermediate", "RMAST": "Master"}
ORDER = {
    "Obedience": [*OBEDIENCE.values()],
    "Rally": [*RALLY.values(), "High Combined", "High Triple"],
    "Agility": ["ESS of the Year", "Novice", "Open", "Excellent A", "Preferred ESS of the Year"],
}


def top_k_mean(df: DataFrame, keys: Sequence[str], score: str, tie_break: str, *, k: int = 3, least: int | None = None) -> DataFrame:
    """Of each key with at least ``least`` (k) scores: the mean of its k best, and how many it has (``legs``)."""
    least = k if least is None else least
    rows = df.where(F.col(score).isNotNull())
    legs = rows.groupBy(*keys).agg(F.count("*").alias("legs")).where(F.col("legs") >= least)
    best = rows.select(*keys, cents(score).alias("__cents"), tie_break).withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__cents"), tie_break))).where(F.col("__n") <= k)
    means = best.groupBy(*keys).agg(F.sum("__cents").alias("__sum"), F.count("*").alias("__k"))
    return means.join(legs, list(keys)).select(*keys, mean_of_cents(F.col("__sum"), F.col("__k")).alias("score"), "legs")


def paired_mean(df: DataFrame, keys: Sequence[str], pair: Sequence[str], side: Column, value: str, order: Sequence[str], *, k: int = 10, least: int = 10) -> DataFrame:
    """Pairs of the first run on either side (0 and 1) of one day: the mean of the k best pair means, from ``least`` pairs.

    ``value`` is in whole units (cents); a pair's mean is kept as its sum.
    """
    first = df.withColumn("__side", side).where(F.col("__side").isNotNull() & F.col(value).isNotNull())
    first = first.withColumn("__n", F.row_number().over(Window.partitionBy(*keys, *pair, "__side").orderBy(*order))).where("__n = 1")
    sums = first.groupBy(*keys, *pair).agg(F.sum(value).alias("__pair"), F.count("*").alias("__both")).where("__both = 2")
    legs = sums.groupBy(*keys).agg(F.count("*").alias("legs")).where(F.col("legs") >= least)
    best = sums.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__pair"), *pair))).where(F.col("__n") <= k)
    means = best.groupBy(*keys).agg(F.sum("__pair").alias("__sum"), F.count("*").alias("__k"))
    return means.join(legs, list(keys)).select(*keys, mean_of_cents(F.col("__sum"), F.col("__k") * 2).alias("score"), "legs")


def all_present_mean(df: DataFrame, keys: Sequence[str], trial: Sequence[str], part: str, parts: Sequence, score: str, *, k: int = 5, least: int = 3) -> DataFrame:
    """Trials that have every part: the best score of each part summed; the mean of the k best sums, from ``least`` trials."""
    best = [F.max(F.when(F.col(part) == p, cents(score))).alias(f"__p{i}") for i, p in enumerate(parts)]
    sums = df.where(F.col(part).isin(*parts)).groupBy(*keys, *trial).agg(*best)
    sums = sums.select(*keys, *trial, sum((F.col(f"__p{i}") for i in range(len(parts))), F.lit(0)).alias("__sum")).where("__sum is not null")
    legs = sums.groupBy(*keys).agg(F.count("*").alias("legs")).where(F.col("legs") >= least)
    top = sums.withColumn("__n", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("__sum"), *trial))).where(F.col("__n") <= k)
    means = top.groupBy(*keys).agg(F.sum("__sum").alias("__all"), F.count("*").alias("__k"))
    return means.join(legs, list(keys)).select(*keys, mean_of_cents(F.col("__all"), F.col("__k")).alias("score"), "legs")


def first_n_mean(df: DataFrame, keys: Sequence[str], side: Column, score: str, order: Sequence[str], *, n: int = 3) -> DataFrame:
    """The first n scores of either side (0 and 1) in order: their mean, if both sides have n."""
    first = df.withColumn("__side", side).where(F.col("__side").isNotNull() & F.col(score).isNotNull())
    first = first.withColumn("__n", F.row_number().over(Window.partitionBy(*keys, "__side").orderBy(*order))).where(F.col("__n") <= n)
    sums = first.groupBy(*keys).agg(F.sum(cents(score)).alias("__sum"), F.count("*").alias("__k")).where(F.col("__k") == 2 * n)
    return sums.select(*keys, mean_of_cents(F.col("__sum"), F.col("__k")).alias("score"), F.col("__k").alias("legs"))


def count_ranked(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """How many rows each key has, and the mean of its values for ties; ranked by both, then the key."""
    micro = F.floor(F.col(value) * 1_000_000 + 0.5)  # the mean is rounded, not what it is of
    out = df.groupBy(*keys).agg(F.count("*").alias("legs"), F.coalesce(F.sum(micro), F.lit(0)).alias("__sum"), F.count(value).alias("__k"))
    n = F.col("__k") * 10_000
    out = out.select(*keys, "legs", F.when(F.col("__k") > 0, F.floor((F.col("__sum") * 2 + n) / (n * 2)) / 100.0).otherwise(0.0).alias("tie_value"))
    return number_rows(out, "rank", [-F.col("legs"), -F.floor("tie_value")], [F.desc("tie_value"), *keys])


def class_table(df: DataFrame, classes: dict[str, str]) -> DataFrame:
    """The dimension of classes and categories (as long as the dictionary), to broadcast."""
    return F.broadcast(df.sparkSession.createDataFrame(list(classes.items()), "primary_class string, category string"))


#: Columns of a result row that its owners are read from.
OWNERS = ("primary_owner", "last_name", "primary_owner_name", "owner_2", "owner_3", "owner_4")


def _named(scores: DataFrame, rows: DataFrame, keys: Sequence[str], sport: str, last: bool) -> DataFrame:
    """Scores with the dog and owners of each key's last (or first) result."""
    from ..functions.text import owners_of

    have = [F.col(c) if c in rows.columns else F.lit(None).cast("string") for c in OWNERS]
    owners = owners_of(F.lit(sport), have[0], have[1], have[2], have[3:])
    pick = F.max_by if last else F.min_by
    named = rows.groupBy(*keys).agg(pick(F.struct(F.col("dog_name").alias("dog"), owners.alias("owners")), "src_seq").alias("__row"), F.max("src_seq").alias("last_seq"), F.min("src_seq").alias("first_seq"))
    return scores.join(named.select(*keys, "__row.dog", "__row.owners", "last_seq", "first_seq"), list(keys))


def standings(results: DataFrame, sport: str, *, variant: str = "calculator") -> DataFrame:
    """The categories of a sport from raw results: ``category, reg_number, dog, owners, score, legs, tie_value, rank``.

    ``results`` has the columns of a results sheet and ``src_seq``, unique over
    all its rows. The variant ``validator`` has best-3 means in the Novice, Open
    and Excellent A classes of agility, and paired speeds in both awards of the
    year. Dog and owners are those of the first result that counts, in the
    calculator's best-3 classes of the last. Equal scores stand in order of
    their first results, with the validator by name, the last first.
    """
    rows = results.where(F.col("placement").isin(*QUALIFYING))
    runs = rows.withColumn("__speed", F.floor(speed("course_distance", "dog_time") * 1_000_000 + 0.5))

    def best(classes: dict[str, str]) -> DataFrame:
        own = rows.join(class_table(rows, classes), "primary_class").where("score is not null")
        keys = ["category", "reg_number"]
        return _named(top_k_mean(own, keys, "score", "src_seq"), own, keys, sport, variant == "calculator")

    def single(scores: DataFrame, own: DataFrame, category: str) -> DataFrame:
        return _named(scores, own, ["reg_number"], sport, False).withColumn("category", F.lit(category))

    def pairs(standard: str, jumpers: str, category: str) -> DataFrame:
        own = runs.where(F.col("primary_class").isin(standard, jumpers) & F.col("__speed").isNotNull())
        side = F.when(F.col("primary_class") == standard, 0).when(F.col("primary_class") == jumpers, 1)
        scores = paired_mean(own.withColumn("__day", F.to_date("event_date")), ["reg_number"], ["__day"], side, "__speed", ["src_seq"])
        return single(scores.withColumn("score", round_half_up(F.col("score") / 10_000)), own, category)

    def combined(classes: Sequence[str], category: str) -> DataFrame:
        own = rows.where(F.col("primary_class").isin(*classes) & F.col("score").isNotNull()).withColumn("__day", F.to_date("event_date"))
        return single(all_present_mean(own, ["reg_number"], ["event_name", "__day"], "primary_class", classes, "score"), own, category)

    def legs(standard: Sequence[str], jumpers: Sequence[str], category: str) -> DataFrame:
        own = rows.where(F.col("primary_class").isin(*standard, *jumpers) & F.col("score").isNotNull()).withColumn("__day", F.to_date("event_date"))
        side = F.when(F.col("primary_class").isin(*standard), 0).otherwise(1)
        return single(first_n_mean(own, ["reg_number"], side, "score", ["__day", "src_seq"]), own, category)

    def preferred(category: str) -> DataFrame:
        own = runs.where(F.col("primary_class").rlike("^(AG|JWW).*P$")).withColumn("__yps", speed("course_distance", "dog_time"))
        return single(count_ranked(own, ["reg_number"], "__yps").drop("rank").withColumn("score", F.col("legs").cast("double")), own, category)

    if sport == "Obedience":
        parts = [best(OBEDIENCE)]
    elif sport == "Rally":
        parts = [best(RALLY)]
        if variant == "calculator":
            parts += [combined(["RADVB", "REXCB"], "High Combined"), combined(["RADVB", "REXCB", "RMAST"], "High Triple")]
    elif variant == "calculator":
        parts = [pairs("AGEXCB", "JWWEXCB", "ESS of the Year"), legs(["AGNOVA", "AGNOVB"], ["JWWNOVA", "JWWNOVB"], "Novice"), legs(["AGOPEN"], ["JWWOPEN"], "Open"), best({"AGEXCA": "Excellent A"}), preferred("Preferred ESS of the Year")]
    else:
        parts = [pairs("AGEXCB", "JWWEXCB", "ESS of the Year"), pairs("AGEXCBP", "JWWEXCBP", "Preferred ESS of the Year"), best({"AGNOVB": "Novice", "AGOPEN": "Open", "AGEXCA": "Excellent A"})]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more, allowMissingColumns=True)
    if "tie_value" not in out.columns:
        out = out.withColumn("tie_value", F.lit(0.0))
    ties = [F.desc("dog"), F.col("first_seq")] if variant == "validator" else [F.col("first_seq")]
    place = Window.partitionBy("category").orderBy(F.desc("score"), F.desc(F.coalesce("tie_value", F.lit(0.0))), *ties)
    return out.select("category", "reg_number", "dog", "owners", "score", "legs", F.coalesce("tie_value", F.lit(0.0)).alias("tie_value"), F.row_number().over(place).alias("rank"), "last_seq")


# What stands beside a category's name.
SUFFIXES = {
    "Preferred ESS of the Year": "  (total qualifying Preferred runs · ties by YPS)", "ESS of the Year": "  (avg YPS, fastest 10 QQs · min 10 QQs)",
    "Novice": "  (avg of first 6: 3 Standard + 3 Jumpers)", "Open": "  (avg of first 6: 3 Standard + 3 Jumpers)", "Excellent A": "  (highest average score)",
}
COMBINED_SUFFIX = "  (combined classes, best 5 trials — DRAFT, pending confirmation)"


def report(spark, sport: str, scores: DataFrame) -> DataFrame:
    """Every category of a sport in its order with its heading's suffix and metric, those without a qualifier with null columns."""
    order = spark.createDataFrame([(i, c, COMBINED_SUFFIX if c.startswith("High ") else SUFFIXES.get(c, "") if sport == "Agility" else "") for i, c in enumerate(ORDER[sport], 1)], "order_idx int, category string, suffix string")
    metric = F.when(F.col("category") == "Preferred ESS of the Year", "# Qual. Runs").when(F.col("category") == "ESS of the Year", "Avg YPS").otherwise("Avg Score")
    return order.join(scores, "category", "left").withColumn("metric", metric).orderBy("order_idx", "rank")


def owner_cell(owners: Column, is_member: Column) -> Column:
    """Owners as last names joined by slashes, members' with a star (``is_member``: an array beside ``owners``)."""
    from ..functions.text import last_name

    return F.array_join(F.zip_with(owners, is_member, lambda o, m: F.concat(last_name(o), F.when(m, "*").otherwise(""))), "/")


def with_owner_cells(scores: DataFrame, members: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``owner``: the cell of each row's ``owners``; a member is known by the whole name, or first and last word (``members``: key)."""
    from ..functions.text import first_last, norm_key
    from .assign import mark_members

    each = scores.select(*keys, F.posexplode("owners").alias("__at", "__owner"))
    marked = mark_members(each.withColumns({"__whole": norm_key("__owner"), "__ends": first_last("__owner")}), ["__whole", "__ends"], members, "key")
    listed = F.array_sort(F.collect_list(F.struct("__at", "__owner", "is_member")))
    cells = marked.groupBy(*keys).agg(listed.alias("__list")).select(*keys, owner_cell(F.transform("__list", lambda x: x["__owner"]), F.transform("__list", lambda x: x["is_member"])).alias("owner"))
    return scores.join(cells, list(keys), "left").withColumn("owner", F.coalesce("owner", F.lit("")))
