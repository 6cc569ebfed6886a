"""The library's operators as queries over the given tables, with equivalent SQL.

Every query runs over whole tables. The tables are a shop's, so each operator
is shown on an analogue: suppliers are groups with scores, events are runs,
documents are lines of reports.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import numbers as N
from .functions import text as T
from .functions.titlecase import tc_name, tc_owner
from .operators import assign, awards, layout, quality, windows
from .plans import store, views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query, with the SQL that gives the same rows."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"


@query(f"""
WITH r AS (SELECT l_suppkey, l_returnflag, {_CENTS} AS c, row_number() OVER (PARTITION BY l_suppkey, l_returnflag ORDER BY {_CENTS} DESC, l_orderkey * 10 + l_linenumber) AS n,
  count(*) OVER (PARTITION BY l_suppkey, l_returnflag) AS legs FROM lineitem)
SELECT l_suppkey, l_returnflag, floor((CAST(sum(c) AS BIGINT) * 2 + 3) / (3 * 2)) / 100 AS score, any_value(legs) AS legs FROM r WHERE n <= 3 AND legs >= 3 GROUP BY ALL
""")
def best3_mean(spark, sf_dir):
    """Mean of the three best prices of each supplier and flag."""
    rows = _t(spark, sf_dir, "lineitem").withColumn("seq", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return awards.top_k_mean(rows, ["l_suppkey", "l_returnflag"], "l_extendedprice", "seq")


@query("""
WITH e AS (SELECT user_id, CAST(ts AS DATE) AS d, event_type, CAST(round(value * 100) AS BIGINT) AS c,
    row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE), event_type ORDER BY ts, event_id) AS n FROM events WHERE event_type IN ('click', 'view') AND value IS NOT NULL),
 p AS (SELECT user_id, d, sum(c) AS s FROM e WHERE n = 1 GROUP BY ALL HAVING count(*) = 2),
 r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY s DESC, d) AS k, count(*) OVER (PARTITION BY user_id) AS legs FROM p)
SELECT user_id, floor((CAST(sum(s) AS BIGINT) * 2 + 2 * count(*)) / (2 * count(*) * 2)) / 100 AS score, any_value(legs) AS legs FROM r WHERE k <= 10 AND legs >= 2 GROUP BY user_id
""")
def paired_day_mean(spark, sf_dir):
    """Days with a first click and a first view of a user: the mean of the ten best pairs."""
    rows = _t(spark, sf_dir, "events").withColumns({"d": F.to_date("ts"), "c": N.cents("value")})
    side = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "view", 1)
    return awards.paired_mean(rows, ["user_id"], ["d"], side, "c", ["ts", "event_id"], k=10, least=2)


@query(f"""
WITH t AS (SELECT l_suppkey, l_orderkey, max(CASE WHEN l_returnflag = 'A' THEN {_CENTS} END) + max(CASE WHEN l_returnflag = 'N' THEN {_CENTS} END) AS s
    FROM lineitem WHERE l_returnflag IN ('A', 'N') GROUP BY ALL),
 r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY s DESC, l_orderkey) AS n, count(*) OVER (PARTITION BY l_suppkey) AS legs FROM t WHERE s IS NOT NULL)
SELECT l_suppkey, floor((CAST(sum(s) AS BIGINT) * 2 + count(*)) / (count(*) * 2)) / 100 AS score, any_value(legs) AS legs FROM r WHERE n <= 5 AND legs >= 1 GROUP BY l_suppkey
""")
def all_present_sum(spark, sf_dir):
    """Orders in which a supplier has both flags: best price of each summed, the mean of the five best sums."""
    return awards.all_present_mean(_t(spark, sf_dir, "lineitem"), ["l_suppkey"], ["l_orderkey"], "l_returnflag", ["A", "N"], "l_extendedprice", k=5, least=1)


@query("""
WITH e AS (SELECT user_id, event_type, CAST(round(value * 100) AS BIGINT) AS c, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS n
    FROM events WHERE event_type IN ('click', 'view') AND value IS NOT NULL)
SELECT user_id, floor((CAST(sum(c) AS BIGINT) * 2 + 6) / 12) / 100 AS score, count(*) AS legs FROM e WHERE n <= 3 GROUP BY user_id HAVING count(*) = 6
""")
def first_n_mean(spark, sf_dir):
    """The first three clicks and views of each user: their mean."""
    side = F.when(F.col("event_type") == "click", 0).when(F.col("event_type") == "view", 1)
    return awards.first_n_mean(_t(spark, sf_dir, "events"), ["user_id"], side, "value", ["ts", "event_id"])


@query("""
WITH c AS (SELECT user_id, count(*) AS legs, CAST(coalesce(sum(CAST(round(value * 100) AS BIGINT)), 0) AS BIGINT) AS s, count(value) AS k FROM events WHERE event_type = 'purchase' GROUP BY user_id),
 m AS (SELECT user_id, legs, CASE WHEN k > 0 THEN floor((s * 2 + k) / (k * 2)) / 100 ELSE 0 END AS tie_value FROM c)
SELECT *, row_number() OVER (ORDER BY legs DESC, tie_value DESC, user_id) AS rank FROM m
""")
def count_tiebreak(spark, sf_dir):
    """Users by their number of purchases, ties by the mean value."""
    return awards.count_ranked(_t(spark, sf_dir, "events").where("event_type = 'purchase'"), ["user_id"], "value")


_RANKED = "SELECT o_custkey, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS rk FROM orders"


@query(f"SELECT DISTINCT o_custkey, rk AS found, expected FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY rk) AS expected FROM ({_RANKED})) WHERE rk <> expected")
def rank_gaps(spark, sf_dir):
    """Ranks that don't stand where they should, per customer's list of orders."""
    rows = _t(spark, sf_dir, "orders").select("o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("rk"))
    return windows.rank_gaps(rows, ["o_custkey"], "rk")


@query(f"""
WITH r AS ({_RANKED}), g AS (SELECT DISTINCT o_custkey, rk, expected FROM (SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY rk) AS expected FROM r) WHERE rk <> expected)
SELECT a.*, coalesce(n, 0) AS n_gaps, b.first_gap FROM (SELECT o_custkey, count(*) AS n_rows, max(rk) AS max_rank FROM r GROUP BY 1) a
LEFT JOIN (SELECT o_custkey, count(*) AS n, min(expected) AS first_gap FROM g GROUP BY 1) b ON a.o_custkey = b.o_custkey
""")
def rank_gap_audit(spark, sf_dir):
    """Each list's size, largest rank and gaps."""
    rows = _t(spark, sf_dir, "orders").select("o_custkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("rk"))
    return windows.rank_audit(rows, ["o_custkey"], "rk").withColumn("first_gap", F.col("first_gaps")[0]["expected"]).drop("first_gaps")


@query("""
SELECT event_id, user_id, coalesce(last_value(p IGNORE NULLS) OVER w, 0) AS filled_rank, CASE WHEN p IS NULL THEN 'T' ELSE '' END AS tie
FROM (SELECT *, CASE WHEN event_type = 'purchase' THEN event_id END AS p FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)
""")
def tie_forward_fill(spark, sf_dir):
    """Each event with its user's latest purchase so far."""
    rows = _t(spark, sf_dir, "events").withColumn("p", F.when(F.col("event_type") == "purchase", F.col("event_id")))
    return windows.fill_ties(rows, "p", ["user_id"], ["ts", "event_id"]).select("event_id", "user_id", "filled_rank", "tie")


@query("""
WITH e AS (SELECT event_id, user_id, ts, CASE WHEN event_type = 'error' THEN event_id % 50 END AS p FROM events),
 i AS (SELECT *, count(p) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS isl FROM e)
SELECT event_id, CAST(coalesce(max(p) OVER (PARTITION BY user_id, isl), 0) + count(*) FILTER (WHERE p IS NULL) OVER (PARTITION BY user_id, isl ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS INTEGER) AS run_rank FROM i
""")
def sequential_rank_rebase(spark, sf_dir):
    """Error events carry a printed rank; the others count on from it."""
    rows = _t(spark, sf_dir, "events").withColumn("p", F.when(F.col("event_type") == "error", F.col("event_id") % 50))
    return windows.continue_ranks(rows, "p", ["user_id"], ["ts", "event_id"]).select("event_id", "run_rank")


@query("""
WITH e AS (SELECT event_id, user_id, ts, event_type FROM events)
SELECT event_id, event_type, last_value(CASE WHEN event_type = 'signup' THEN event_id END IGNORE NULLS) OVER w AS category, CAST(count(*) FILTER (WHERE event_type = 'signup') OVER w AS BIGINT) AS block
FROM e WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) QUALIFY event_type <> 'signup'
""")
def header_carry(spark, sf_dir):
    """Sign-ups as headers of the events that follow them."""
    rows = _t(spark, sf_dir, "events")
    out = windows.header_blocks(rows, F.col("event_type") == "signup", F.col("event_id"), ["user_id"], ["ts", "event_id"])
    return out.select("event_id", "event_type", "category", "block")


def _asof(spark, sf_dir, direction):
    rows = _t(spark, sf_dir, "events")
    clicks = rows.where("event_type = 'click'").select("event_id", "user_id", "ts")
    bought = rows.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("bought_at"), F.col("event_id").alias("purchase_id"))
    return assign.asof(clicks, bought, ["user_id"], "ts", "bought_at", ["purchase_id"], direction=direction).select("event_id", "purchase_id")


@query("""
SELECT c.event_id, (SELECT max(struct_pack(t := p.ts, i := p.event_id)).i FROM events p WHERE p.event_type = 'purchase' AND p.user_id = c.user_id AND p.ts <= c.ts) AS purchase_id FROM events c WHERE c.event_type = 'click'
""")
def asof_backward(spark, sf_dir):
    """Each click with the user's latest purchase at or before it."""
    return _asof(spark, sf_dir, "backward")


@query("""
SELECT c.event_id, (SELECT min(struct_pack(t := p.ts, i := p.event_id)).i FROM events p WHERE p.event_type = 'purchase' AND p.user_id = c.user_id AND p.ts >= c.ts) AS purchase_id FROM events c WHERE c.event_type = 'click'
""")
def asof_forward(spark, sf_dir):
    """Each click with the user's next purchase at or after it."""
    return _asof(spark, sf_dir, "forward")


@query("""
SELECT c_custkey, s_suppkey, abs(c_acctbal - s_acctbal) AS distance FROM customer JOIN supplier ON c_nationkey = s_nationkey
QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY abs(c_acctbal - s_acctbal), s_suppkey) = 1
""")
def nearest_join(spark, sf_dir):
    """Each customer with the supplier of its nation whose balance is nearest."""
    c = _t(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation")
    s = _t(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nation")
    return assign.nearest(c, s, ["nation"], "c_acctbal", "s_acctbal", "s_suppkey").where("s_suppkey is not null").select("c_custkey", "s_suppkey", "distance")


@query("""
WITH a AS (SELECT l_suppkey, l_extendedprice AS x, l_orderkey * 10 + l_linenumber AS q FROM lineitem),
 g AS (SELECT *, row_number() OVER w AS i, x - lag(x) OVER w AS gap FROM a WINDOW w AS (PARTITION BY l_suppkey ORDER BY x, q)),
 r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY gap DESC NULLS LAST, i) AS n FROM g),
 c AS (SELECT *, sum(CASE WHEN gap IS NOT NULL AND n <= 6 THEN 1 ELSE 0 END) OVER (PARTITION BY l_suppkey ORDER BY i) AS cluster FROM r)
SELECT l_suppkey, CAST(cluster AS BIGINT) AS cluster, floor(min(x) * 100 + 0.5) / 100 AS low, floor(max(x) * 100 + 0.5) / 100 AS high, count(*) AS n FROM c GROUP BY ALL
""")
def gap_clusters(spark, sf_dir):
    """Each supplier's prices in seven clusters, cut at the largest gaps."""
    rows = _t(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_extendedprice").alias("x"), (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("q"))
    own = layout.cluster_rows(rows, ["l_suppkey"], "x", "q", 7)
    return own.groupBy("l_suppkey", "cluster").agg(N.round_half_up(F.min("x")).alias("low"), N.round_half_up(F.max("x")).alias("high"), F.count("*").alias("n"))


@query("""
WITH c AS (SELECT l_suppkey, CAST(l_quantity AS INTEGER) AS x, count(*) AS n FROM lineitem GROUP BY ALL)
SELECT l_suppkey, min(x) AS edge FROM (SELECT *, max(n) OVER (PARTITION BY l_suppkey) AS top FROM c) WHERE n >= 0.8 * top GROUP BY l_suppkey
""")
def mode_edge(spark, sf_dir):
    """The smallest of each supplier's quantities that are nearly the most frequent."""
    return layout.strong_edge(_t(spark, sf_dir, "lineitem"), ["l_suppkey"], F.rint("l_quantity").cast("int"))


@query("""
SELECT l_suppkey, x AS mode FROM (SELECT l_suppkey, CAST(l_quantity AS INTEGER) AS x, count(*) AS n, min(l_orderkey * 10 + l_linenumber) AS q FROM lineitem GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY n DESC, q) = 1
""")
def mode_first_seen(spark, sf_dir):
    """Each supplier's most frequent quantity, of equals the one seen first."""
    rows = _t(spark, sf_dir, "lineitem").withColumn("q", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return layout.mode_of(rows, ["l_suppkey"], F.rint("l_quantity").cast("int"), "q")


@query("SELECT doc_id, lang FROM documents QUALIFY row_number() OVER (PARTITION BY text, lang ORDER BY doc_id) = 1")
def dedupe_keep_first(spark, sf_dir):
    """Of documents of equal text and language the first."""
    return windows.keep_first(_t(spark, sf_dir, "documents").select("doc_id", "lang", F.sha2("text", 256).alias("h")), ["h", "lang"], ["doc_id"]).drop("h")


@query("""
WITH l AS (SELECT c_nationkey AS nation, c_name, c_acctbal, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) AS position FROM customer),
 r AS (SELECT s_nationkey AS nation, s_name, s_acctbal, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal DESC, s_suppkey) AS position FROM supplier)
SELECT coalesce(l.nation, r.nation) AS nation, coalesce(l.position, r.position) AS position, c_name, s_name,
  CASE WHEN c_name IS NOT NULL AND s_name IS NOT NULL THEN CASE WHEN abs(c_acctbal - s_acctbal) < 500 THEN 'same' ELSE 'differs' END WHEN c_name IS NOT NULL THEN 'left' ELSE 'right' END AS side
FROM l FULL JOIN r ON l.nation = r.nation AND l.position = r.position
""")
def positional_compare(spark, sf_dir):
    """Customers and suppliers of a nation side by side, by balance."""
    c = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_name", "c_acctbal", "c_custkey")
    s = _t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_name", "s_acctbal", "s_suppkey")
    both = assign.by_position(c, s, ["nation"], [F.desc("c_acctbal"), "c_custkey"], [F.desc("s_acctbal"), "s_suppkey"])
    near = F.when(F.abs(F.col("l.c_acctbal") - F.col("r.s_acctbal")) < 500, "same").otherwise("differs")
    side = F.when(F.col("l").isNotNull() & F.col("r").isNotNull(), near).when(F.col("l").isNotNull(), "left").otherwise("right")
    return both.select("nation", "position", "l.c_name", "r.s_name", side.alias("side"))


@query("""
SELECT 'Conformation' AS sport, c_nationkey AS year, 'Q1' AS quarter, c_mktsegment AS category, 1 AS rank, '' AS tie, c_name AS name, '' AS owner, CAST(c_custkey AS DOUBLE) AS score FROM customer
UNION ALL SELECT 'Rally', s_nationkey, 'Q2', 'Novice A', 2, 'T', s_name, 'x', s_acctbal FROM supplier
""")
def unified_view(spark, sf_dir):
    """Conformation and sports rows in one shape; a total is read as the number it begins with."""
    a = _t(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("year"), F.lit("Q1").alias("quarter"), F.col("c_mktsegment").alias("section"), F.lit(1).alias("rank"), F.lit("").alias("tie"), F.col("c_name").alias("name"), F.lit("").alias("owner"), F.concat(F.col("c_custkey").cast("string"), F.lit("/3")).alias("total"))
    b = _t(spark, sf_dir, "supplier").select(F.lit("Rally").alias("sport"), F.col("s_nationkey").alias("year"), F.lit("Q2").alias("quarter"), F.lit("Novice A").alias("category"), F.lit(2).alias("rank"), F.lit("T").alias("tie"), F.col("s_name").alias("dog"), F.lit("x").alias("owner"), F.col("s_acctbal").alias("score"))
    return store.rankings(a, b)


@query("""
SELECT l_suppkey AS k, NULL::BIGINT AS orders, count(*) AS items FROM lineitem GROUP BY 1 UNION ALL SELECT o_custkey, count(*), NULL FROM orders GROUP BY 1
""")
def hetero_union(spark, sf_dir):
    """Rows of different columns in one table."""
    a = _t(spark, sf_dir, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("items"))
    return a.unionByName(_t(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("orders")), allowMissingColumns=True)


_PART = views.ViewSpec(("p_partkey", "p_name", "p_brand", "p_size"), numeric=("p_size", "p_partkey"), category="p_brand", key="p_partkey")


@query("SELECT p_partkey, p_name, p_brand, p_size FROM part ORDER BY p_size DESC, p_partkey LIMIT 30 OFFSET 30")
def view_page(spark, sf_dir):
    """The second page of parts, the largest first (a page is the feature)."""
    return views.query(_t(spark, sf_dir, "part"), _PART, views.ViewState(sort="p_size", descending=True, page=2))


@query("""
SELECT p_partkey, p_name, p_brand, p_size FROM part WHERE p_brand = 'Brand#11' AND (contains(lower(p_name), '7') OR contains(lower(CAST(p_partkey AS VARCHAR)), '7') OR contains(CAST(p_size AS VARCHAR), '7') OR contains(lower(p_brand), '7'))
ORDER BY p_partkey LIMIT 30
""")
def view_search(spark, sf_dir):
    """The first page of one brand's parts any cell of which holds a 7."""
    return views.query(_t(spark, sf_dir, "part"), _PART, views.ViewState(category="Brand#11", search="7"))


@query("""
SELECT p_brand AS section, row_number() OVER (PARTITION BY p_brand ORDER BY p_size, p_partkey) AS place, count(*) OVER (PARTITION BY p_brand) AS section_rows, p_partkey, p_name, p_size FROM part
""")
def grouped_report(spark, sf_dir):
    """Parts in sections by brand, the smallest first."""
    return views.grouped(_t(spark, sf_dir, "part"), _PART, views.ViewState(sort="p_size"))


@query("""
WITH y AS (SELECT DISTINCT p_brand, p_size FROM part), s AS (SELECT unnest(range(min(p_size), max(p_size) + 1)) AS p_size FROM part)
SELECT b.p_brand, CAST(s.p_size AS INTEGER) AS p_size FROM (SELECT DISTINCT p_brand FROM part) b, s WHERE NOT EXISTS (SELECT 1 FROM y WHERE y.p_brand = b.p_brand AND y.p_size = s.p_size)
""")
def coverage_missing(spark, sf_dir):
    """Sizes within the span of all that a brand has no part of."""
    return views.missing_years(_t(spark, sf_dir, "part"), "p_brand", "p_size")


@query("""
SELECT p.priority, p.order_idx, count(o_orderkey) AS n FROM (VALUES (1, '1-URGENT'), (2, '2-HIGH'), (3, '3-MEDIUM'), (4, '4-NOT SPECIFIED'), (5, '5-LOW'), (6, '6-NONE')) p(order_idx, priority) LEFT JOIN orders ON o_orderpriority = p.priority GROUP BY ALL
""")
def ordered_dimension_left(spark, sf_dir):
    """Every priority of a list in its order, those without orders too."""
    names = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW", "6-NONE"]
    dim = spark.createDataFrame(list(enumerate(names, 1)), "order_idx int, priority string")
    n = _t(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count("*").alias("n"))
    return dim.join(n, "priority", "left").withColumn("n", F.coalesce("n", F.lit(0)))


@query("""
SELECT CASE WHEN o_totalprice > 0 AND o_totalprice <= 100000 AND regexp_matches(o_orderpriority, '^[1-3]') THEN 'clean' ELSE 'dropped' END AS outcome, o_orderstatus, count(*) AS n FROM orders GROUP BY ALL
""")
def quality_gate(spark, sf_dir):
    """Orders that pass a gate and those that don't, counted."""
    rows = _t(spark, sf_dir, "orders")
    clean, dropped = quality.gate(rows, (F.col("o_totalprice") > 0) & (F.col("o_totalprice") <= 100000) & F.col("o_orderpriority").rlike("^[1-3]"))
    return clean.withColumn("outcome", F.lit("clean")).unionByName(dropped.withColumn("outcome", F.lit("dropped"))).groupBy("outcome", "o_orderstatus").agg(F.count("*").alias("n"))


@query("""
WITH s AS (SELECT l_suppkey, l_linestatus, sum(CASE WHEN l_returnflag = 'N' THEN 2 WHEN l_returnflag = 'R' THEN -2 ELSE -1 END) AS p FROM lineitem GROUP BY ALL),
 b AS (SELECT l_suppkey, l_linestatus FROM s QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY p DESC, l_linestatus) = 1)
SELECT l_suppkey, l_linestatus, count(*) AS n FROM lineitem JOIN b USING (l_suppkey, l_linestatus) GROUP BY ALL
""")
def candidate_select(spark, sf_dir):
    """Of two row sets of each supplier the one of more points."""
    points = F.when(F.col("l_returnflag") == "N", 2).when(F.col("l_returnflag") == "R", -2).otherwise(-1)
    return quality.choose(_t(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_linestatus", points).groupBy("l_suppkey", "l_linestatus").agg(F.count("*").alias("n"))


@query("""
SELECT l_suppkey, max(CASE WHEN f = 'A' THEN v END) AS a, max(CASE WHEN f = 'N' THEN v END) AS n, max(CASE WHEN f = 'R' THEN v END) AS r
FROM (SELECT l_suppkey, l_returnflag AS f, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), '/' ORDER BY CAST(l_linenumber AS VARCHAR)) AS v FROM lineitem GROUP BY ALL) GROUP BY l_suppkey
""")
def stat_pivot(spark, sf_dir):
    """Line numbers of each flag in columns, several joined by slashes."""
    rows = _t(spark, sf_dir, "lineitem").select("l_suppkey", F.array_position(F.array(*map(F.lit, "ANR")), F.col("l_returnflag")).alias("c"), F.col("l_linenumber").cast("string").alias("text")).distinct()
    placed = rows.select("l_suppkey", "text", F.col("c").cast("double").alias("x0"), F.col("c").cast("double").alias("x1"), F.col("text").alias("seq"))
    return layout.stat_columns(placed, ["l_suppkey"], F.array(F.lit(1.0), F.lit(2.0), F.lit(3.0)), ["a", "n", "r"], ["seq"])


@query(r"""
SELECT doc_id, array_to_string(list_filter(string_split(regexp_replace(lower(coalesce(text, '')), '[^a-z]+', ' ', 'g'), ' '), lambda w: w <> '' AND w NOT IN ('mr', 'mrs', 'ms', 'dr', 'miss')), ' ') AS key FROM documents
""")
def norm_key(spark, sf_dir):
    """All documents, null texts too, as keys of plain words without honorifics."""
    return _t(spark, sf_dir, "documents").select("doc_id", T.norm_key("text").alias("key"))


@query(r"""
WITH p AS (SELECT doc_id, list_filter(list_transform(string_split_regex(trim(text, ' '), '[.]\s'), lambda c: trim(c, ' ')), lambda c: c <> '') AS parts FROM documents)
SELECT doc_id, len(parts) AS n_parts, parts[1] AS first_part, parts[len(parts)] AS last_part FROM p
""")
def line_split(spark, sf_dir):
    """Texts split at stops, empty parts left out."""
    parts = F.filter(F.transform(F.split(F.trim("text"), r"[.]\s"), lambda c: F.trim(c)), lambda c: c != "")
    rows = _t(spark, sf_dir, "documents").select("doc_id", parts.alias("parts"))
    return rows.select("doc_id", F.size("parts").cast("long").alias("n_parts"), F.try_element_at("parts", F.lit(1)).alias("first_part"), F.try_element_at("parts", F.lit(-1)).alias("last_part"))


@query("""
WITH k AS (SELECT DISTINCT lower(regexp_replace(s_name, '[^0-9]', '', 'g')) AS key FROM supplier)
SELECT c_custkey, lower(regexp_replace(c_name, '[^0-9]', '', 'g')) IN (SELECT key FROM k) AS is_member FROM customer
""")
def member_mark(spark, sf_dir):
    """Customers whose number is a supplier's too."""
    key = lambda c: F.lower(F.regexp_replace(c, "[^0-9]", ""))
    rows = _t(spark, sf_dir, "customer").withColumn("key", key("c_name"))
    return assign.mark_members(rows, ["key"], _t(spark, sf_dir, "supplier").select(key("s_name").alias("k")), "k").select("c_custkey", "is_member")


@query("SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type")
def event_counts(spark, sf_dir):
    """How many events there are of each kind."""
    return store.counts(_t(spark, sf_dir, "events"), "event_type")


@query("""
WITH l AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents), r AS (SELECT source, count(*) FILTER (WHERE length(trim(line)) >= 200) AS parsed, count(*) AS raw FROM l GROUP BY source)
SELECT source, parsed, raw, CASE WHEN parsed = 0 AND raw > 0 THEN 'has data, none parsed' WHEN raw > 0 AND parsed < 0.6 * raw THEN 'parsed ' || parsed || '/' || raw || ' ~ ' || CAST(floor(100 * parsed / raw + 0.5) AS INTEGER) || '%' ELSE '' END AS note FROM r
""")
def raw_vs_parsed(spark, sf_dir):
    """Counts of long lines beside counts of all lines, with a note where few are long."""
    lines = _t(spark, sf_dir, "documents").select("source", F.explode(F.split("text", "\n")).alias("line"))
    counts = lines.groupBy("source").agg(F.count_if(F.length(F.trim("line")) >= 200).alias("parsed"), F.count("*").alias("raw"))
    return counts.withColumn("note", windows.coverage_note("parsed", "raw"))


@query(r"""
SELECT p_partkey, CAST(nullif(regexp_extract(p_name, '^\s*([-+]?\d+)', 1), '') AS DOUBLE) IS NOT NULL AS numeric_name,
  coalesce(TRY_CAST(nullif(regexp_extract(CAST(p_size AS VARCHAR) || '/3', '^\s*([-+]?(?:\d+\.?\d*|\.\d+))', 1), '') AS DOUBLE), 0.0) AS size_real,
  coalesce(TRY_CAST(nullif(regexp_extract(p_brand, '^\s*([-+]?(?:\d+\.?\d*|\.\d+))', 1), '') AS DOUBLE), 0.0) AS brand_real,
  TRY_CAST(regexp_extract(regexp_replace(p_brand, '[^0-9.\-]', '', 'g'), '^-?(?:\d+\.?\d*|\.\d+)') AS DOUBLE) AS brand_num FROM part
""")
def number_casts(spark, sf_dir):
    """Numbers read from texts that begin with, or hold, digits."""
    size = F.concat(F.col("p_size").cast("string"), F.lit("/3"))
    return _t(spark, sf_dir, "part").select("p_partkey", F.regexp_extract("p_name", r"^\s*([-+]?\d+)", 1).try_cast("double").isNotNull().alias("numeric_name"), N.prefix_real(size).alias("size_real"), N.prefix_real("p_brand").alias("brand_real"), N.loose_num("p_brand").alias("brand_num"))


@query("SELECT user_id, floor(min(value) * 100 + 0.5) / 100 AS low, CASE WHEN sum(value) > 0 THEN floor(count(*) / 7 * 100 + 0.5) / 100 END AS rate FROM events WHERE value >= 0 GROUP BY user_id")
def rounding(spark, sf_dir):
    """Rounding of halves upwards, and safe division."""
    own = _t(spark, sf_dir, "events").where("value >= 0").groupBy("user_id").agg(F.min("value").alias("m"), F.count("*").alias("n"), F.sum("value").alias("s"))
    return own.select("user_id", N.round_half_up("m").alias("low"), F.when(F.col("s") > 0, N.round_half_up(N.speed(F.col("n"), F.lit(7)))).alias("rate"))


@query("""
WITH w AS (SELECT o_custkey AS page, o_orderkey AS seq, o_totalprice AS top FROM orders), s AS (SELECT *, CASE WHEN top - lag(top) OVER (PARTITION BY page ORDER BY top, seq) > 3000 THEN 1 ELSE 0 END AS step FROM w)
SELECT page, seq, CAST(sum(step) OVER (PARTITION BY page ORDER BY top, seq ROWS UNBOUNDED PRECEDING) AS INTEGER) AS line_no FROM s
""")
def session_lines(spark, sf_dir):
    """A customer's orders in lines of near totals, natively."""
    words = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("seq"), F.col("o_totalprice").alias("top"), F.lit(0).alias("x0"), F.col("o_orderkey").alias("word_seq"))
    return layout.session_lines(words, tolerance=3000, keys=["page"]).select("page", "seq", "line_no")


@query("""
WITH RECURSIVE w AS (SELECT o_custkey AS page, o_orderkey AS word_seq, o_totalprice AS top, row_number() OVER (PARTITION BY o_custkey ORDER BY round(o_totalprice, 1), o_orderkey) AS i FROM orders),
 f AS (
  SELECT page, CAST(1 AS BIGINT) AS i, word_seq, top, [top] AS s, [1] AS n, 1 AS line FROM w WHERE i = 1
  UNION ALL
  SELECT page, i, word_seq, top, CASE WHEN hit IS NULL THEN list_append(s, top) ELSE list_transform(s, lambda x, k: CASE WHEN k = hit THEN x + top ELSE x END) END,
    CASE WHEN hit IS NULL THEN list_append(n, 1) ELSE list_transform(n, lambda x, k: CASE WHEN k = hit THEN x + 1 ELSE x END) END, coalesce(hit, len(s) + 1)
  FROM (SELECT w.page, w.i, w.word_seq, w.top, f.s, f.n, nullif(list_position(list_transform(f.s, lambda x, k: abs(x / f.n[k] - w.top) <= 3000), true), 0) AS hit FROM f JOIN w ON w.page = f.page AND w.i = f.i + 1)),
 e AS (SELECT page, arg_max(s, i) AS s, arg_max(n, i) AS n FROM f GROUP BY page),
 m AS (SELECT f.page, f.word_seq, f.top, f.line, e.s[f.line] / e.n[f.line] AS line_top FROM f JOIN e ON e.page = f.page)
SELECT page, word_seq, top, floor(line_top * 100 + 0.5) / 100 AS line_top, CAST(dense_rank() OVER (PARTITION BY page ORDER BY line_top, line) - 1 AS INTEGER) AS line_no FROM m
""")
def visual_lines(spark, sf_dir):
    """A customer's orders in lines by running means of totals."""
    words = _t(spark, sf_dir, "orders").select(F.col("o_custkey").alias("page"), F.col("o_orderkey").alias("word_seq"), F.col("o_totalprice").alias("top"), F.lit(0.0).alias("x0"))
    return layout.visual_lines(words, tolerance=3000.0, keys=["page"]).drop("x0").withColumn("line_top", N.round_half_up("line_top"))


@query("""
WITH n AS (SELECT p_partkey, p_size, array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS nm, upper(p_type[1]) || lower(p_type[2:]) AS ty FROM part)
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'CH ' || nm || ' II CD OF' WHEN 1 THEN nm || ' of ' || ty || ' RN RA12' WHEN 2 THEN 'Mc' || nm || ' Sea ' || ty WHEN 3 THEN nm || chr(39) || 's the ' || ty || '-' || ty ELSE nm || ' OA NAJ' END AS name,
  '*J. ' || nm || '/L. O' || chr(39) || ty || ', Jr.' AS owner FROM n
""")
def title_case(spark, sf_dir):
    """Part names with titles, small words and joints around them, in title case; types as owners."""
    name, kind, case = F.upper("p_name"), F.upper("p_type"), F.col("p_size") % 5
    shout = F.when(case == 0, F.concat(F.lit("CH "), name, F.lit(" II CD OF"))).when(case == 1, F.concat(name, F.lit(" OF "), kind, F.lit(" RN RA12"))).when(case == 2, F.concat(F.lit("MC"), name, F.lit(" SEA "), kind))
    shout = shout.when(case == 3, F.concat(name, F.lit("'S THE "), kind, F.lit("-"), kind)).otherwise(F.concat(name, F.lit(" OA NAJ")))
    owner = F.concat(F.lit("*J. "), name, F.lit("/L. O'"), kind, F.lit(", JR."))
    return _t(spark, sf_dir, "part").select("p_partkey", tc_name(shout).alias("name"), tc_owner(owner).alias("owner"))


@query(rf"""
WITH w AS (SELECT doc_id, list_filter(string_split(regexp_replace(replace(replace(coalesce(text, ''), chr(160), ' '), chr(8217), chr(39)), '[^A-Za-z\x27 &-]', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM documents),
 t AS (SELECT doc_id, w, list_transform(w, lambda x: regexp_matches(x, '{T.CORE_TITLES}')) AS t FROM w),
 i AS (SELECT doc_id, w, t, nullif(coalesce(list_position(t, false), 0), 0) AS i FROM t),
 j AS (SELECT doc_id, w, i, nullif(coalesce(list_position(t[i:], true), 0), 0) AS j FROM i)
SELECT doc_id, CASE WHEN i IS NULL THEN '' ELSE regexp_replace(lower(array_to_string(w[i:coalesce(i + j - 2, len(w))], '')), '[^a-z]', '', 'g') END AS core FROM j
""")
def name_cores(spark, sf_dir):
    """Texts reduced to the words before their first title."""
    return _t(spark, sf_dir, "documents").select("doc_id", T.name_core("text").alias("core"))


from . import queries_reports  # noqa: E402, F401  (registers its queries here)
