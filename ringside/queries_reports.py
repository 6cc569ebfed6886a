"""Parsers, awards, comparison, store and views as queries with equivalent SQL.

Rows of the given tables are written out as reports (words at places on a
page, text lines, sheets of cells) which the library reads back, so what a
query must give is plain SQL over the table itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .functions import numbers as N
from .functions import text as T
from .operators import assign, awards, layout, quality, windows
from .plans import parse, store, views
from .queries import _t, query
from .sources import readers


def _text(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _join(*parts) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))


def _suppliers(spark, sf_dir) -> DataFrame:
    """Suppliers with their place among those of their nation (from 1) and a score of two decimals."""
    w = Window.partitionBy("s_nationkey").orderBy("s_suppkey")
    return _t(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.row_number().over(w).alias("k"), (F.lit(50) + F.col("s_suppkey") % 49 + F.col("s_suppkey") % 4 * 0.25).alias("score"))


_SUPPLIERS = "SELECT s_suppkey, s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS k, 50 + s_suppkey % 49 + s_suppkey % 4 * 0.25 AS score FROM supplier"
_SHORT = "rtrim(rtrim(format('{:.2f}', CAST(score AS DOUBLE)), '0'), '.')"


def _files(rows: DataFrame, sport: str, year: str = "2026") -> DataFrame:
    return rows.select("file").distinct().select("file", F.lit(sport).alias("sport"), F.lit(year).alias("year"), F.lit("Q1").alias("quarter"))


def _words(rows: DataFrame, cells: Column) -> DataFrame:
    """Words of pages from arrays of (top, x0, text), a letter 5 wide, numbered by height and place."""
    out = rows.select("file", F.lit(1).alias("page"), F.explode(cells).alias("w")).select("file", "page", F.col("w.text").alias("text"), F.col("w.x0").cast("double").alias("x0"), (F.col("w.x0") + 5 * F.length("w.text")).cast("double").alias("x1"), F.col("w.top").cast("double").alias("top"))
    return out.withColumn("word_seq", F.row_number().over(Window.partitionBy("file", "page").orderBy("top", "x0")))


def _cell(top, x0: float, text) -> Column:
    return F.struct((F.lit(top) if isinstance(top, (int, float)) else top).cast("double").alias("top"), F.lit(float(x0)).alias("x0"), (F.lit(text) if isinstance(text, str) else text).cast("string").alias("text"))


@query(f"""
SELECT 'f' || s_nationkey AS file, 'Regular: Novice A' AS category, CAST(CASE WHEN k % 3 = 0 THEN k - 1 ELSE k END AS INTEGER) AS rank, CASE WHEN k % 3 = 0 THEN 'T' ELSE '' END AS tie,
  'Sunny Day ' || s_suppkey || ' CD' AS dog, 'Ann Core' || s_suppkey AS owner, {_SHORT} AS scores FROM ({_SUPPLIERS})
""")
def text_standings(spark, sf_dir):
    """Suppliers as lines of text standings, every third without a printed rank, read back."""
    s = _suppliers(spark, sf_dir).withColumn("file", _join("f", _text("s_nationkey")))
    rank = F.when(F.col("k") % 3 != 0, _join(_text("k"), ". ")).otherwise("")
    rows = s.select("file", (F.col("k") + 9).alias("line_no"), _join(rank, "Sunny Day ", _text("s_suppkey"), " CD   Ann Core", _text("s_suppkey"), "   ", N.short_decimal("score")).alias("line"))
    heads = s.select("file").distinct().select("file", F.explode(F.array(*(F.struct(F.lit(i).alias("line_no"), F.lit(x).alias("line")) for i, x in enumerate(("Results taken from trials", "REGULAR TITLING CLASSES", "", "novice  a", "Page 3")))) ).alias("l")).select("file", "l.*")
    return layout.text_standings(rows.unionByName(heads), "Obedience").select("file", "category", "rank", "tie", "dog", "owner", F.array_join("scores", " ").alias("scores"))


@query(f"""
SELECT 'f' || s_nationkey AS file, 'Preferred Novice' AS category, CAST(k AS INTEGER) AS rank, 'Very Long Sunny ' || s_suppkey AS dog, 'Ann Core / Bo Kirk' AS owner, {_SHORT} AS score, '4.5' AS score2, 'Agility' AS sport, '2016' AS year FROM ({_SUPPLIERS})
""")
def wrapped_standings(spark, sf_dir):
    """Suppliers as agility lines whose names begin on a line of their own, read back."""
    s = _suppliers(spark, sf_dir).withColumn("file", _join("f", _text("s_nationkey")))
    data = s.select("file", (F.col("k") * 2 + 9).alias("line_no"), _join("Sunny ", _text("s_suppkey"), "   Ann Core   Bo Kirk   4.5   ", N.short_decimal("score")).alias("line"))
    wrap = s.select("file", (F.col("k") * 2 + 8).alias("line_no"), F.lit("Very Long").alias("line"))
    heads = s.select("file").distinct().select("file", F.lit(1).alias("line_no"), F.lit("Preferred Novice Springers").alias("line")).unionByName(s.select("file").distinct().select("file", F.lit(2).alias("line_no"), F.lit("Dog   Owner").alias("line")))
    out = parse.standings(data.unionByName(wrap).unionByName(heads), _files(s, "Agility", "2016"))
    return out.select("file", "category", "rank", "dog", "owner", "score", "score2", "sport", "year")


@query(f"""
SELECT 'f' || s_nationkey AS file, 'Novice A' AS category, CAST(CASE WHEN k > 1 AND k % 4 = 0 THEN k - 1 ELSE k END AS INTEGER) AS rank, CASE WHEN k % 4 = 0 THEN 'T' ELSE '' END AS tie,
  'Sunny Day' || s_suppkey AS dog, 'Ann Core' AS owner, {_SHORT} AS score, '' AS score2, 'Rally' AS sport FROM ({_SUPPLIERS})
""")
def positioned_standings(spark, sf_dir):
    """Suppliers as words at places on a page, every fourth without a rank, scores glued to a word, read back."""
    s = _suppliers(spark, sf_dir).withColumn("file", _join("f", _text("s_nationkey")))
    top = F.col("k") * 20 + 20
    cells = F.array(_cell(top, 50, "Sunny"), _cell(top, 90, _join("Day", _text("s_suppkey"))), _cell(top, 250, "Ann"), _cell(top, 290, "Core"), _cell(top, 400, N.short_decimal("score")))
    cells = F.when(F.col("k") % 4 == 0, cells).otherwise(F.concat(F.array(_cell(top, 10, _text("k"))), cells))
    heads = s.select("file").distinct().select("file", F.array(_cell(5, 50, "Novice"), _cell(5, 90, "A")).alias("cells"))
    rows = s.select("file", cells.alias("cells")).unionByName(heads)
    return parse.positions(_words(rows, F.col("cells")), _files(s, "Rally")).select("file", "category", "rank", "tie", "dog", "owner", "score", "score2", "sport")


def _agility_pages(spark, sf_dir):
    s = _suppliers(spark, sf_dir).withColumn("file", _join("f", _text("s_nationkey")))
    top = F.col("k") * 20 + 30
    cells = F.array(_cell(top, 50, "Sunny"), _cell(top, 80, _join("d", _text("s_suppkey"))), _cell(top, 250, "Ann"), _cell(top, 290, "Core"), _cell(top, 400, F.format_string("%.2f", F.col("score"))), _cell(top, 450, "3.95"))
    heads = s.select("file").distinct().select("file", F.array(_cell(5, 50, "Open"), _cell(5, 90, "B"), _cell(15, 50, "Name"), _cell(15, 250, "Owner"), _cell(15, 400, "Average"), _cell(15, 450, "YPS")).alias("cells"))
    return _words(s.select("file", cells.alias("cells")).unionByName(heads), F.col("cells")), _files(s, "Agility", "2016")


_AGILITY = f"SELECT 'f' || s_nationkey AS file, 'Open B' AS category, CAST(k AS INTEGER) AS rank, 'Sunny d' || s_suppkey AS dog, 'Ann Core' AS owner, {_SHORT} AS score, '3.95' AS score2 FROM ({_SUPPLIERS})"


@query(_AGILITY)
def agility_standings(spark, sf_dir):
    """Suppliers as words on pages of agility standings, columns found by their modes, read back."""
    words, files = _agility_pages(spark, sf_dir)
    return parse.agility(words, files).select("file", "category", "rank", "dog", "owner", "score", "score2")


@query(_AGILITY)
def labelled_standings(spark, sf_dir):
    """The same pages, columns found by the labels over them."""
    words, files = _agility_pages(spark, sf_dir)
    return parse.agility(words, files, parse.labelled_columns(words, parse.lines_of(words))).select("file", "category", "rank", "dog", "owner", "score", "score2")


@query(f"""
SELECT 'f' || s_nationkey AS file, CAST(CASE WHEN k % 3 = 0 THEN k - 1 ELSE k END AS INTEGER) AS rank, CASE WHEN k % 3 = 0 THEN 'T' ELSE '' END AS tie, 'CH Sunny' || s_suppkey || ' of Dream' AS name, 'A. Core B. Kirk' AS owner, 'Breed - Dogs' AS section,
  CAST(k AS VARCHAR) AS bob_shows, CAST(k + 1 AS VARCHAR) AS bob_spec, CAST(k + 2 AS VARCHAR) AS bob_pts, CAST(k + 3 AS VARCHAR) AS bos_shows, CAST(k + 4 AS VARCHAR) AS bos_spec, CAST(k + 5 AS VARCHAR) AS bos_pts, CAST(k + 6 AS VARCHAR) AS total FROM ({_SUPPLIERS})
""")
def conformation_standings(spark, sf_dir):
    """Suppliers as rows of conformation pages, names on two lines, read back by geometry."""
    s = _suppliers(spark, sf_dir).withColumn("file", _join("f", _text("s_nationkey")))
    xs = [400 + 40 * i for i in range(7)]
    # one literal for all rows: "@" is the supplier's number, "#3" the row's plus 3
    cells = [(0, 15, "#0"), (0, 45, "CH"), (0, 65, "Sunny@"), (0, 220, "A."), (0, 240, "Core"), *((0, x + 4, f"#{i}") for i, x in enumerate(xs)), (10, 45, "of"), (10, 65, "Dream"), (10, 220, "B."), (10, 240, "Kirk")]
    placed = s.select("file", "k", "s_suppkey", F.explode(F.array(*(F.struct(F.lit(t).alias("dtop"), F.lit(x).alias("x0"), F.lit(w).alias("text")) for t, x, w in cells))).alias("c")).where("k % 3 <> 0 or c.x0 <> 15")
    number = F.regexp_extract("c.text", r"^#(\d)$", 1)
    text = F.when(number != "", _text(F.col("k") + number.try_cast("int"))).otherwise(F.replace("c.text", F.lit("@"), _text("s_suppkey")))
    marks = ("#BOB", "#Spec", "Points", "#BOS", "#Spec", "Points", "Total")
    heads = s.select("file").distinct().select("file", F.explode(F.array(*(F.struct(F.lit(x).alias("x0"), F.lit(w).alias("text")) for x, w in [(10, "Rank"), (60, "Dog"), (250, "Owners"), *zip(xs, marks)]))).alias("c"))
    words = placed.select("file", (F.col("k") * 60 + 40 + F.col("c.dtop")).alias("top"), "c.x0", text.alias("text")).unionByName(heads.select("file", F.lit(20).cast("bigint").alias("top"), "c.x0", "c.text"))
    words = words.select("file", F.lit(1).alias("page"), "text", F.col("x0").cast("double").alias("x0"), (F.col("x0") + 5 * F.length("text")).cast("double").alias("x1"), F.col("top").cast("double").alias("top"))
    words = words.withColumn("word_seq", F.row_number().over(Window.partitionBy("file", "page").orderBy("top", "x0")))
    pages = s.select("file").distinct().select("file", F.lit(1).alias("page"), F.lit("Breed - Dogs").alias("section"), F.lit(2026).alias("year"), F.lit("Q1").alias("quarter"))
    out = parse.conformation(words, pages)
    return out.select("file", "rank", "tie", "name", "owner", "section", *store.BREED_STATS)


@query(f"""
SELECT 'f' || s_nationkey AS file, CAST(CASE WHEN k % 3 = 0 THEN k - 1 ELSE k END AS INTEGER) AS rank, CASE WHEN k % 3 = 0 THEN 'T' ELSE '' END AS tie, 'CH Sunny ' || s_suppkey AS name, 'J. K. Core' AS owner, CAST(k AS VARCHAR) AS shows, '1277' AS points FROM ({_SUPPLIERS})
""")
def bordered_rows(spark, sf_dir):
    """Suppliers as rows of bordered tables, with owners' initials at the names' start, read back."""
    s = _suppliers(spark, sf_dir).withColumn("file", _join("f", _text("s_nationkey")))
    cells = s.select("file", (F.col("k") + 5).alias("row_no"), F.array(F.when(F.col("k") % 3 != 0, _text("k")).otherwise(""), _join("J. K. CH Sunny\n", _text("s_suppkey")), F.lit("Core"), _join("(", _text("k"), ")"), F.lit("1,277")).alias("cells"))
    extra = s.select("file").distinct().select("file", F.explode(F.array(F.struct(F.lit(1).alias("row_no"), F.array(F.lit("Rank"), F.lit("Dog")).alias("cells")), F.struct(F.lit(2).alias("row_no"), F.array(F.lit(""), F.lit(None)).alias("cells")))).alias("r")).select("file", "r.*")
    return layout.table_rows(cells.unionByName(extra), ["shows", "points"], ["file"], ["row_no"]).drop("row_no")


@query(r"""
SELECT l_orderkey, CAST(rint AS INTEGER) AS line_key, string_agg(CASE WHEN part = 0 THEN 'w' || l_linenumber ELSE CAST(l_quantity AS VARCHAR) END, ' ' ORDER BY l_linenumber, part) AS line FROM
 (SELECT l_orderkey, l_linenumber, CAST(max(l_quantity) AS DOUBLE) AS l_quantity, min(l_suppkey) % 3 AS rint FROM lineitem GROUP BY 1, 2), (VALUES (0), (1)) p(part) GROUP BY ALL
""")
def glued_lines(spark, sf_dir):
    """Line items as words glued to their quantities, parted, in lines of one rounded height."""
    rows = _t(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_quantity").alias("l_quantity"), F.min("l_suppkey").alias("l_suppkey"))
    words = rows.select("l_orderkey", F.col("l_linenumber").alias("word_seq"), _join("w", _text("l_linenumber"), _text(F.col("l_quantity").cast("double"))).alias("text"), (F.col("l_linenumber") * 100.0).alias("x0"), (F.col("l_linenumber") * 100.0 + 50).alias("x1"), (F.col("l_suppkey") % 3 + 0.2).alias("top"))
    parted = layout.split_glued(words.withColumn("text", F.regexp_replace("text", r"^(w\d)(.*)$", "$1:$2"))).withColumn("text", F.regexp_replace("text", ":$", ""))
    return layout.bucket_lines(parted, ["l_orderkey"]).select("l_orderkey", "line_key", "line")


@query("""
WITH r AS (SELECT l_suppkey AS reg, ['ONOVA', 'OOPENA', 'XXX', 'POPEN'][1 + l_linenumber % 4] AS cls, CAST(50 + l_orderkey % 150 / 4.0 AS DOUBLE) AS score, (l_orderkey * 10 + l_linenumber) * 100000 + l_suppkey AS q FROM lineitem WHERE l_returnflag <> 'R'),
 c AS (SELECT *, CASE cls WHEN 'ONOVA' THEN 'Novice A' WHEN 'OOPENA' THEN 'Open A' ELSE 'Preferred Open' END AS category, row_number() OVER (PARTITION BY reg, cls ORDER BY score DESC, q) AS n FROM r WHERE cls <> 'XXX'),
 m AS (SELECT category, reg, floor((CAST(sum(CASE WHEN n <= 3 THEN CAST(round(score * 100) AS BIGINT) END) AS BIGINT) * 2 + 3) / 6) / 100 AS score, count(*) AS legs, min(q) AS first_q, max(q) AS last_q FROM c GROUP BY ALL HAVING count(*) >= 3)
SELECT category, 'R' || reg AS reg_number, 'Dog ' || last_q // 100000 AS dog, 'Ann Core' || last_q // 100000 % 7 AS owner_1, score, legs, CAST(row_number() OVER (PARTITION BY category ORDER BY score DESC, first_q) AS INTEGER) AS rank FROM m
""")
def obedience_standings(spark, sf_dir):
    """Line items as trial results: the best-3 means of the obedience classes, with the last result's dog and owner."""
    return awards.standings(_results(spark, sf_dir), "Obedience").select("category", "reg_number", "dog", F.col("owners")[0].alias("owner_1"), "score", "legs", "rank")


def _results(spark, sf_dir) -> DataFrame:
    rows = _t(spark, sf_dir, "lineitem").withColumn("run", F.col("l_orderkey") * 10 + F.col("l_linenumber")).withColumn("src_seq", F.col("run") * 100_000 + F.col("l_suppkey"))
    cls = F.element_at(F.array(*map(F.lit, ("ONOVA", "OOPENA", "XXX", "POPEN"))), (1 + F.col("l_linenumber") % 4).cast("int"))
    return rows.select("src_seq", _join("R", _text("l_suppkey")).alias("reg_number"), _join("Dog ", _text("run")).alias("dog_name"), cls.alias("primary_class"), F.when(F.col("l_returnflag") == "R", "NQ").when(F.col("l_returnflag") == "A", "1").otherwise("QLFY").alias("placement"), (F.lit(50) + F.col("l_orderkey") % 150 / 4).alias("score"), F.lit(None).cast("double").alias("course_distance"), F.lit(None).cast("double").alias("dog_time"), F.lit("Ann").alias("primary_owner"), _join("Core", _text(F.col("run") % 7)).alias("last_name"))


@query("""
WITH r AS (SELECT l_suppkey AS reg, ['AGNOVB', 'AGOPEN', 'AGEXCA', 'ZZZ'][1 + l_linenumber % 4] AS cls, CAST(50 + l_orderkey % 150 / 4.0 AS DOUBLE) AS score, (l_orderkey * 10 + l_linenumber) * 100000 + l_suppkey AS q FROM lineitem),
 c AS (SELECT *, CASE cls WHEN 'AGNOVB' THEN 'Novice' WHEN 'AGOPEN' THEN 'Open' ELSE 'Excellent A' END AS category, row_number() OVER (PARTITION BY reg, cls ORDER BY score DESC, q) AS n FROM r WHERE cls <> 'ZZZ'),
 m AS (SELECT category, reg, floor((CAST(sum(CASE WHEN n <= 3 THEN CAST(round(score * 100) AS BIGINT) END) AS BIGINT) * 2 + 3) / 6) / 100 AS score, min(q) AS first_q FROM c GROUP BY ALL HAVING count(*) >= 3)
SELECT category, 'R' || reg AS reg_number, 'Dog ' || first_q // 100000 AS dog, score, CAST(row_number() OVER (PARTITION BY category ORDER BY score DESC, 'Dog ' || first_q // 100000 DESC, first_q) AS INTEGER) AS rank FROM m
""")
def validator_standings(spark, sf_dir):
    """Line items as agility results by the validator's formulas: the first result's dog, ties by name, the last first."""
    cls = F.element_at(F.array(*map(F.lit, ("AGNOVB", "AGOPEN", "AGEXCA", "ZZZ"))), (1 + F.substring("dog_name", -1, 1).cast("int") % 4).cast("int"))
    rows = _results(spark, sf_dir).withColumns({"primary_class": cls, "placement": F.lit("2"), "event_date": F.lit(None).cast("date")})
    return awards.standings(rows, "Agility", variant="validator").select("category", "reg_number", "dog", "score", "rank")


@query("""
WITH r AS (SELECT l_suppkey AS reg, 10.0 + l_orderkey % 90 AS dist, CAST(l_linenumber AS DOUBLE) AS t, (l_orderkey * 10 + l_linenumber) * 100000 + l_suppkey AS q FROM lineitem WHERE l_linenumber <= 3),
 m AS (SELECT reg, count(*) AS legs, CAST(sum(CAST(floor(dist / t * 1000000 + 0.5) AS BIGINT)) AS BIGINT) AS s, min(q) AS first_q FROM r GROUP BY reg), n AS (SELECT *, floor((s * 2 + legs * 10000) // (legs * 20000)) / 100 AS tie_value FROM m)
SELECT 'R' || reg AS reg_number, 'Dog ' || first_q // 100000 AS dog, CAST(legs AS DOUBLE) AS score, tie_value, CAST(row_number() OVER (ORDER BY legs DESC, tie_value DESC, first_q) AS INTEGER) AS rank FROM n
""")
def preferred_standings(spark, sf_dir):
    """Line items as preferred agility runs: dogs by their number, ties by the mean speed."""
    seq = F.regexp_extract("dog_name", r"(\d+)$", 1).cast("long")
    rows = _results(spark, sf_dir).withColumns({"primary_class": F.lit("JWWOPENP"), "placement": F.lit("QLFY"), "event_date": F.lit(None).cast("date"), "event_name": F.lit("x"), "course_distance": 10.0 + F.floor(seq / 10) % 90, "dog_time": (seq % 10).cast("double")}).where(seq % 10 <= 3)
    return awards.standings(rows, "Agility").where("category = 'Preferred ESS of the Year'").select("reg_number", "dog", "score", "tie_value", "rank")


@query("""
SELECT i AS order_idx, c AS category, CASE WHEN c = 'High Triple' THEN '  (combined classes, best 5 trials — DRAFT, pending confirmation)' WHEN c = 'High Combined' THEN '  (combined classes, best 5 trials — DRAFT, pending confirmation)' ELSE '' END AS suffix, 'Avg Score' AS metric, n.n FROM
 (VALUES (1, 'Novice A'), (2, 'Novice B'), (3, 'Advanced A'), (4, 'Advanced B'), (5, 'Excellent A'), (6, 'Excellent B'), (7, 'Intermediate'), (8, 'Master'), (9, 'High Combined'), (10, 'High Triple')) o(i, c)
LEFT JOIN (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1) n ON n.o_orderpriority = CASE c WHEN 'Novice A' THEN '1-URGENT' WHEN 'Master' THEN '5-LOW' END
""")
def awards_report(spark, sf_dir):
    """Every category of rally in its order with its heading, those without rows too."""
    scores = _t(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("n"))
    scores = scores.select(F.when(F.col("o_orderpriority") == "1-URGENT", "Novice A").when(F.col("o_orderpriority") == "5-LOW", "Master").alias("category"), "n", F.lit(1).alias("rank")).where("category is not null")
    return awards.report(spark, "Rally", scores).drop("rank")


@query("""
SELECT c_custkey, 'Kirk' || CASE WHEN c_custkey % 3 = 0 THEN '*' ELSE '' END || '/Core' || CASE WHEN c_custkey % 2 = 0 THEN '*' ELSE '' END AS owner FROM customer
""")
def owner_cells(spark, sf_dir):
    """Owners of customers as cells of last names, members with a star (by whole name, or first and last word)."""
    rows = _t(spark, sf_dir, "customer")
    first = F.when(F.col("c_custkey") % 3 == 0, "Mr. Bo Q. Kirk Jr.").otherwise("Zed Kirk")
    second = F.when(F.col("c_custkey") % 2 == 0, "ann core").otherwise("Amy-Lee Y Core II")
    owners = T.owners_of(F.lit("Rally"), F.lit("x"), F.lit(""), first, [second, F.lit(None).cast("string"), F.lit(" ")])
    known = spark.createDataFrame([("Bo Kirk", "Ann Core and Mrs. Di Day")], "nam string, xdn string")
    return awards.with_owner_cells(rows.select("c_custkey", owners.alias("owners")), readers.member_keys(known), ["c_custkey"]).select("c_custkey", "owner")


@query("""
WITH o AS (SELECT c_nationkey % 5 AS g, 'CH Dog q' || chr(CAST(97 + c_custkey % 26 AS INTEGER)) || ' CD' AS dog, CAST(60 + c_custkey % 30 AS VARCHAR) AS score, row_number() OVER (PARTITION BY c_nationkey % 5 ORDER BY c_custkey) AS i FROM customer),
 c AS (SELECT s_nationkey % 6 AS g, 'Dog q' || chr(CAST(97 + s_suppkey % 26 AS INTEGER)) AS dog, CAST(60 + s_suppkey % 31 AS VARCHAR) AS score, row_number() OVER (PARTITION BY s_nationkey % 6 ORDER BY s_suppkey) AS i FROM supplier)
SELECT 'Novice ' || coalesce(o.g, c.g) AS category, CAST(coalesce(o.i, c.i) AS INTEGER) AS rank, o.dog AS official_dog, o.score AS official_score, c.dog AS computed_dog, c.score AS computed_score,
  CASE WHEN o.g IS NULL THEN '＋ computed, missing from our PDF parse' WHEN c.g IS NULL THEN '△ in official, not in raw (snapshot/legs)' WHEN o.score = c.score AND o.dog[4:9] = c.dog[1:6] THEN '✅ match' WHEN o.score = c.score THEN '✅ match (name fmt)'
    WHEN o.dog[4:9] = c.dog[1:6] THEN '⚠ score ' || o.score || '≠' || c.score ELSE '↕ ordering (' || o.score || ' vs ' || c.score || ')' END AS status
FROM o FULL JOIN c ON o.g = c.g AND o.i = c.i
""")
def compare_standings(spark, sf_dir):
    """Customers as published and suppliers as computed standings, side by side, with what they say of each other."""
    return _comparison(spark, sf_dir)


def _comparison(spark, sf_dir) -> DataFrame:
    letter = lambda c: F.expr(f"char(97 + {c} % 26)")
    o = _t(spark, sf_dir, "customer").select(F.lit("Rally").alias("sport"), F.lit(2026).alias("year"), _join("Regular: Novice ", _text(F.col("c_nationkey") % 5)).alias("category"), F.col("c_custkey").alias("rank"), _join("CH Dog q", letter("c_custkey"), " CD").alias("dog"), _text(60 + F.col("c_custkey") % 30).alias("score"))
    c = _t(spark, sf_dir, "supplier").select(_join("Novice ", _text(F.col("s_nationkey") % 6)).alias("category"), F.col("s_suppkey").alias("rank"), _join("Dog q", letter("s_suppkey")).alias("dog"), _text(60 + F.col("s_suppkey") % 31).alias("score"))
    return quality.comparison(quality.official(o, "Rally", 2026), c)


@query("""
WITH o AS (SELECT c_nationkey % 5 AS g, row_number() OVER (PARTITION BY c_nationkey % 5 ORDER BY c_custkey) AS i, c_custkey % 26 AS d, 60 + c_custkey % 30 AS s FROM customer), c AS (SELECT s_nationkey % 6 AS g, row_number() OVER (PARTITION BY s_nationkey % 6 ORDER BY s_suppkey) AS i, s_suppkey % 26 AS d, 60 + s_suppkey % 31 AS s FROM supplier)
SELECT CASE WHEN o.g IS NULL THEN '＋' WHEN c.g IS NULL THEN '△' WHEN o.s = c.s THEN '✅' WHEN o.d = c.d THEN '⚠' ELSE '↕' END AS kind, count(*) AS n FROM o FULL JOIN c ON o.g = c.g AND o.i = c.i GROUP BY 1
""")
def comparison_tally(spark, sf_dir):
    """How many positions of the comparison are of each kind."""
    return quality.tally(_comparison(spark, sf_dir)).withColumnRenamed("count", "n")


@query("""
WITH a AS (SELECT c_mktsegment AS category, min(c_custkey) AS first_at FROM customer GROUP BY 1), b AS (SELECT o_orderpriority AS category, min(o_orderkey) AS first_at FROM orders GROUP BY 1)
SELECT category, CAST(row_number() OVER (ORDER BY side, first_at) AS INTEGER) AS place FROM (SELECT category, min(side) AS side, min(first_at) AS first_at FROM (SELECT category, 0 AS side, first_at FROM a UNION ALL SELECT category, 1, first_at FROM b) GROUP BY 1)
""")
def category_union(spark, sf_dir):
    """The categories of two tables, the first's first (the segments and priorities there are, a short list)."""
    a = _t(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("category"), F.col("c_custkey").alias("at"))
    b = _t(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("category"), F.col("o_orderkey").alias("at"))
    return quality.category_order(a, b, "at").select("category", F.row_number().over(Window.orderBy("order_idx")).alias("place"))


_GATE = """
SELECT event_id, value > 0 AND value <= 100 AND event_id % 7 <> 0 AND (event_id % 3 <> 0 OR event_id % 4 = 0) AND event_id % 5 <> 0 AND event_id % 11 <> 0 AS ok FROM (SELECT event_id, floor(value * 100 + 0.5) / 100 AS value FROM events WHERE value IS NOT NULL)
"""


def _gate_rows(spark, sf_dir) -> DataFrame:
    e = F.col("event_id")
    score = F.format_string("%.2f", N.round_half_up("value"))
    score = F.when(e % 7 == 0, F.concat(F.lit("01"), score)).otherwise(F.concat(F.lit(""), F.regexp_replace(score, r"^0\d*\.", ".")))
    year, owner = F.when(e % 4 == 0, "2013").otherwise("2016"), F.when(e % 3 == 0, "").otherwise("Ann Core")
    dog, speed = F.when(e % 5 == 0, "2 Sunny").otherwise("Sunny"), F.when(e % 11 == 0, "12.5").otherwise("3.1")
    return _t(spark, sf_dir, "events").where("value is not null").select("event_id", F.lit("Agility").alias("sport"), year.alias("year"), dog.alias("dog"), owner.alias("owner"), score.alias("score"), speed.alias("score2"))


@query(_GATE)
def valid_rows(spark, sf_dir):
    """Events as agility rows with every fault that the gate knows: which of them pass."""
    rows = _gate_rows(spark, sf_dir)
    clean, dropped = quality.gate(rows, quality.is_valid(*(F.col(c) for c in ("sport", "year", "dog", "owner", "score", "score2"))))
    return clean.withColumn("ok", F.lit(True)).unionByName(dropped.withColumn("ok", F.lit(False))).select("event_id", "ok")


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'Ann' END AS owner, CASE WHEN c_custkey % 2 = 0 THEN 'Sunny Day' ELSE 'Sunny Day B C' END AS dog FROM customer")
def ownerless_rows(spark, sf_dir):
    """Rows of agility years whose owners cannot be told lose what is left of them."""
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.lit("Agility").alias("sport"), F.when(F.col("c_custkey") % 2 == 0, 2015).otherwise(2016).alias("year"), F.lit("Ann").alias("owner"), F.lit("Sunny Day B C").alias("dog"))
    return quality.without_owners(rows).select("c_custkey", "owner", "dog")


@query("SELECT s_suppkey % 5 AS file, CAST(CASE WHEN count(*) FILTER (WHERE s_suppkey % 3 = 0) > count(*) FILTER (WHERE s_suppkey % 4 <> 0) THEN 1 ELSE 0 END AS INTEGER) AS parser, count(*) AS n FROM supplier GROUP BY 1")
def better_parse(spark, sf_dir):
    """Of two parses of each file the one with more valid rows, ties to the old."""
    rows = _t(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 5).alias("file"), "s_suppkey", F.lit("2016").alias("year"), F.lit("Sunny").alias("dog"), F.lit("98").alias("score"), F.lit("").alias("score2"))
    old, new = rows.withColumn("owner", F.when(F.col("s_suppkey") % 4 != 0, "Ann Core").otherwise("")), rows.withColumn("owner", F.when(F.col("s_suppkey") % 3 == 0, "Ann Core").otherwise(""))
    return parse.better(old, new).groupBy("file", "parser").agg(F.count("*").alias("n"))


@query("""
SELECT p_partkey, p_size AS clean, p_size AS whole, CASE WHEN p_size % 2 = 0 THEN p_size || '/3' END AS raw, CAST(p_size AS DOUBLE) AS num, floor(p_retailprice * 100 + 0.5) / 100 AS price, rtrim(rtrim(format('{:.2f}', CAST(p_size AS DOUBLE)), '0'), '.') AS short,
  p_name || ' ' || CASE WHEN p_size % 3 = 0 THEN 'ti' ELSE 'tt' END AS glyphs, p_size || CASE WHEN p_size % 4 = 0 THEN ' (T)' ELSE '' END AS label, '&lt;' || p_name || ' &amp; co&gt;' AS html, 20 || (10 + p_size % 20) AS year FROM part
""")
def printed_cells(spark, sf_dir):
    """Cells as reports print them, read as numbers, labels and texts."""
    size = _text("p_size")
    rows = _t(spark, sf_dir, "part")
    return rows.select(
        "p_partkey", N.clean_num(_join("(", size, ") ")).cast("int").alias("clean"), N.int_or_null(_join(" ", size)).alias("whole"), N.int_raw(F.when(F.col("p_size") % 2 == 0, _join(size, "/3")).otherwise(size)).alias("raw"), N.num_or_null(_join(size, ".0 ")).alias("num"),
        N.round_half_up("p_retailprice").alias("price"), N.short_decimal("p_size").alias("short"), T.fix_glyphs(_join(F.col("p_name"), " ", F.when(F.col("p_size") % 3 == 0, "(cid:415)").otherwise("(cid:425)"), "(cid:999)")).alias("glyphs"),
        T.rank_label("p_size", F.when(F.col("p_size") % 4 == 0, "T").otherwise("")).alias("label"), T.html_escape(_join("<", F.col("p_name"), " & co>")).alias("html"), _text(T.year_in(_join("Results of ", _text(2010 + F.col("p_size") % 20), " trials"))).alias("year"),
    )


@query("""
SELECT c_custkey, 'de vries ' || c_custkey % 7 AS x, 'ann vries' AS ends, 'Vries' AS last_name, 'CH Sunny' AS moved_name, 'J. K. Core' AS moved_owner, 'Sunny Day' AS inner_name, '*B. Core' AS inner_owner, 2 + CASE WHEN c_custkey % 2 = 0 THEN -2 ELSE 0 END - CASE WHEN c_custkey % 3 = 0 THEN 1 ELSE 0 END AS points FROM customer
""")
def owner_names(spark, sf_dir):
    """Owners' names as keys and last names; initials that leaked into names moved back; how clean a row looks."""
    k = F.col("c_custkey")
    name, owner = T.lead_initials(F.lit("J. K. CH Sunny"), F.lit("Core"))
    inner, inner_owner = T.inner_initial(F.lit("Sunny *B. Day"), F.lit("Core"))
    points = quality.name_score(F.when(k % 2 == 0, "CH Sunny / Ann").otherwise("CH Sunny"), F.when(k % 3 == 0, "").otherwise("Ann"))
    rows = _t(spark, sf_dir, "customer")
    return rows.select("c_custkey", _join("de vries ", _text(k % 7)).alias("x"), T.first_last(_join("Mrs. Ann de\u00a0Vries Jr., III ", F.lit(""))).alias("ends"), T.last_name(F.lit("ann de vries IV")).alias("last_name"), name.alias("moved_name"), owner.alias("moved_owner"), inner.alias("inner_name"), inner_owner.alias("inner_owner"), points.alias("points"))


@query("""
SELECT o_orderkey, ['Breed - Dogs', 'Breed - Bitches', 'Group - Dogs', NULL][1 + o_orderkey % 4] AS section, o_orderkey % 4 = 3 AS heads_table, o_orderkey % 4 >= 2 AS noise, o_orderkey % 4 = 1 AS division, ['Open-B Class', 'Novice', 'Regular: Utility A', 'Overall'][1 + o_orderkey % 4] AS label, ['Master', 'High Combined', 'Novice', 'Overall'][1 + o_orderkey % 4] AS merged, ['Agility', 'Obedience', 'Rally', NULL][1 + o_orderkey % 4] AS sport FROM orders
""")
def line_kinds(spark, sf_dir):
    """What lines of reports are: sections, table heads, noise, divisions, class headers, and the sports of sheets."""
    def pick(*texts) -> Column:
        return F.element_at(F.array(*map(F.lit, texts)), (1 + F.col("o_orderkey") % 4).cast("int"))

    section = T.section_of(pick("2026 Breed Ranking Jan - Dogs", "Breed Competition - Bitches", "Group Competition\u2010Dogs", "Index"))
    label = T.category_label(pick("Rally", "Agility", "Obedience", "Agility"), pick("open-b  class", "Novice Springers   Owner(s)  Avg Score", "utility a", "Springers of the Year"), pick("", "", "REGULAR TITLING CLASSES", ""))
    merged = T.merged_category(pick("Rally", "Rally", "Agility", "Rally"), pick("Masters", "high combined A", "Novice Agility", " "))
    return _t(spark, sf_dir, "orders").select(
        "o_orderkey", section.alias("section"), T.is_table_header(pick("Rank", "Dog Owners", "Rank Owners", "Rank Bitch Owners")).alias("heads_table"), T.is_noise(pick("Sunny", "Ann Core", "Page 3", "98")).alias("noise"),
        T.is_division(pick("Regular Classes", "REGULAR CLASSES", "CLASS", "classes")).alias("division"), label.alias("label"), merged.alias("merged"), T.detect_sport(pick("ESS AGILITY 1Q", "Obedience", " rally", "x")).alias("sport"),
    )


@query("""
SELECT 's' || l_suppkey AS file, 'R' || l_orderkey AS reg_number, 'Dog ' || l_linenumber AS dog_name, floor(l_extendedprice * 100 + 0.5) / 100 AS score, CAST(l_shipdate AS DATE) AS event_date, 'Rally' AS sport FROM lineitem
""")
def sheet_results(spark, sf_dir):
    """Line items as sheets of cells, one a supplier, read as typed results with the sheet's sport."""
    rows = _t(spark, sf_dir, "lineitem").withColumn("file", _join("s", _text("l_suppkey")))
    body = rows.select("file", (9 + F.col("l_orderkey") * 10 + F.col("l_linenumber")).cast("long").alias("row_no"), F.array(_join("R", _text("l_orderkey")), F.lit("old"), _join("Dog ", _text("l_linenumber")), F.lit(None), _join("$", F.format_number(N.round_half_up("l_extendedprice"), 2)), F.date_format("l_shipdate", "yyyy-MM-dd HH:mm")).alias("cells"))
    heads = [["ESS Rally 1Q"], ["", "x"], ["Reg Number", "Score", "Dog Name", "Placement", "Score", "Event Date"]]
    top = rows.select("file").distinct().select("file", F.explode(F.array(*(F.struct(F.lit(i).cast("long").alias("row_no"), F.array(*map(F.lit, h)).alias("cells")) for i, h in enumerate(heads)))).alias("r")).select("file", "r.*")
    cells = body.unionByName(top)
    return readers.results(cells).join(readers.sheet_sport(cells), "file").select("file", "reg_number", "dog_name", "score", "event_date", "sport")


@query("""
SELECT 'y' || n_nationkey AS k, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 2010 + n_nationkey % 9 ELSE 2020 END AS INTEGER) AS year, 'Rally' AS sport, 'Q' || (1 + n_nationkey % 4) AS quarter FROM nation
""")
def file_years(spark, sf_dir):
    """Reports named by year, sport and quarter; the year that one of the first lines names counts."""
    q = _text(1 + F.col("n_nationkey") % 4)
    files = _t(spark, sf_dir, "nation").select(_join("y", _text("n_nationkey")).alias("k"), _join("2020-Rally-Q", q, "-", _text("n_nationkey"), ".pdf").alias("file"), "n_nationkey")
    lines = files.select("file", F.lit(2).alias("line_no"), F.when(F.col("n_nationkey") % 3 == 0, _join("Results ", _text(2010 + F.col("n_nationkey") % 9))).otherwise("Results").alias("line")).unionByName(files.select("file", F.lit(7).alias("line_no"), F.lit("1 Jan 2019").alias("line")))
    return readers.true_years(lines, readers.name_parts(files)).select("k", "year", "sport", "quarter")


@query("SELECT 'f' || s_nationkey AS file, CAST(k AS INTEGER) AS page, CASE WHEN k % 3 = 0 THEN 'Group - Bitches' ELSE 'Breed - Dogs' END AS section, k % 2 = 0 AS bordered FROM (SELECT s_nationkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS k FROM supplier) WHERE k % 3 <> 2")
def page_sections(spark, sf_dir):
    """Pages of tables with the section that they or an earlier page name; others are left out."""
    s = _suppliers(spark, sf_dir)
    own = F.when(F.col("k") % 3 == 1, "Breed Competition - Dogs").when(F.col("k") % 3 == 0, "Group Competition - Bitches").otherwise("Index")
    pages = s.select(_join("f", _text("s_nationkey")).alias("file"), F.col("k").cast("int").alias("page"), own.alias("page_text"), (19 + 2 * (1 - F.col("k") % 2)).alias("n_rules"))
    return readers.bordered(readers.carried_sections(pages)).select("file", "page", "section", "bordered")


@query("""
SELECT s_nationkey AS file, count(*) AS raw, count(*) FILTER (WHERE s_suppkey % 3 = 0) AS parsed, CASE WHEN count(*) FILTER (WHERE s_suppkey % 3 = 0) = 0 THEN 'has data, none parsed' WHEN count(*) FILTER (WHERE s_suppkey % 3 = 0) < 0.6 * count(*) THEN 'parsed ' || count(*) FILTER (WHERE s_suppkey % 3 = 0) || '/' || count(*) || ' ~ ' || CAST(floor(100 * count(*) FILTER (WHERE s_suppkey % 3 = 0) / count(*) + 0.5) AS INTEGER) || '%' ELSE '' END AS note FROM supplier GROUP BY 1
""")
def recon_files(spark, sf_dir):
    """Of each file the data lines that an independent rule counts beside the rows parsed."""
    s = _t(spark, sf_dir, "supplier").withColumn("line", _join("1 Sunny Day   Ann Core   ", _text(F.col("s_suppkey") % 90 + 10)))
    raw = s.unionByName(s.withColumn("line", F.lit("Page 3   12"))).where(T.plausible_data_line("line"))
    return windows.recon(s.where("s_suppkey % 3 = 0").select(F.col("s_nationkey").alias("file")), raw.select(F.col("s_nationkey").alias("file")), ["file"])


@query("""
SELECT p_partkey + 1 AS id, 2000 + p_size AS year, 'Breed - Dogs' AS section, CAST(p_size AS INTEGER) AS rank, 'CH ' || array_to_string(list_transform(string_split(p_name, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') AS name, '*B. Core' AS owner, CAST(CASE WHEN p_size % 2 = 0 THEN p_size END AS INTEGER) AS total, CASE WHEN p_size % 2 <> 0 THEN p_size || '/3' END AS total_raw FROM part
""")
def conformation_rows(spark, sf_dir):
    """Parts as parsed conformation rows, made canonical: leaked initials, title case, integer stats beside raw ones, ids."""
    rows = _t(spark, sf_dir, "part").select(F.col("p_partkey").alias("src_seq"), _text(2000 + F.col("p_size")).alias("year"), F.lit("Q1").alias("quarter"), F.lit("Breed - Dogs").alias("section"), F.col("p_size").alias("rank"), F.lit("").alias("tie"), F.regexp_replace(_join("CH ", F.upper("p_name")), r"(\w+)$", "*B. $1").alias("name"), F.lit("CORE").alias("owner"), F.when(F.col("p_size") % 2 == 0, _text("p_size")).otherwise(_join(_text("p_size"), "/3")).alias("total"))
    return store.with_ids(store.conformation_table(rows), bucket=500).select("id", "year", "section", "rank", "name", "owner", "total", "total_raw")


@query("SELECT o_orderkey AS src_seq, 'Rally' AS sport, CAST(year(o_orderdate) AS INTEGER) AS year, 'Sunny Day' AS dog, floor(o_totalprice * 100 + 0.5) / 100 AS score, NULL::DOUBLE AS score2 FROM orders")
def sports_rows(spark, sf_dir):
    """Orders as parsed sports rows, made canonical: white space tidied, numbers typed."""
    rows = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("src_seq"), F.lit("Rally").alias("sport"), _text(F.year("o_orderdate")).alias("year"), F.lit("Q1").alias("quarter"), F.lit("Novice A").alias("category"), F.lit(1).alias("rank"), F.lit("").alias("tie"), F.lit(" Sunny \u00a0 Day ").alias("dog"), F.lit(None).cast("string").alias("owner"), F.format_string("%.2f ", N.round_half_up("o_totalprice")).alias("score"), F.lit("x").alias("score2"))
    return store.sports_table(rows.withColumn("dog", F.translate("dog", "\u00a0", " "))).select("src_seq", "sport", "year", "dog", "score", "score2")


_VIEW = views.ViewSpec(("c_mktsegment", "year", "label", "c_name"), numeric=("label",), category="c_mktsegment", year="year", key="c_custkey")


def _view_rows(spark, sf_dir) -> DataFrame:
    rank = F.col("c_custkey") % 40 + 1
    return _t(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", (2000 + F.col("c_nationkey")).alias("year"), T.rank_label(rank, F.when(F.col("c_custkey") % 3 == 0, "T").otherwise("")).alias("label"), "c_name", F.when(F.col("c_nationkey") % 4 != 0, "Ann").otherwise(" ").alias("owner"))


@query("""
SELECT c_custkey, CAST(row_number() OVER (ORDER BY c_nationkey DESC, c_custkey % 40, c_custkey) AS INTEGER) AS place FROM customer QUALIFY place <= 100
""")
def newest_first(spark, sf_dir):
    """The first hundred rows of a view as it stands at first, the latest year and best rank first (a top of a list is the feature)."""
    rows = _view_rows(spark, sf_dir).orderBy(*views.newest_first(F.col("year"), F.col("label"), "c_custkey")).limit(100)
    return rows.select("c_custkey", F.row_number().over(Window.orderBy(*views.newest_first(F.col("year"), F.col("label"), "c_custkey"))).alias("place"))


@query("SELECT c_mktsegment, 2000 + c_nationkey AS year, (c_custkey % 40 + 1) || CASE WHEN c_custkey % 3 = 0 THEN ' (T)' ELSE '' END AS label, c_name FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_custkey % 40 DESC, c_custkey LIMIT 30 OFFSET 30")
def toggled_view(spark, sf_dir):
    """The second page of a category after two clicks on the rank's head: by the label's number, the largest first."""
    state = views.toggled(views.toggled(views.ViewState(category="BUILDING"), "label"), "label")
    return views.query(_view_rows(spark, sf_dir), _VIEW, views.ViewState(state.category, state.year, state.search, state.sort, state.descending, 2))


@query("SELECT c_mktsegment, 2000 + c_nationkey AS year, (c_custkey % 40 + 1) || CASE WHEN c_custkey % 3 = 0 THEN ' (T)' ELSE '' END AS label, c_name FROM customer WHERE c_nationkey = 5 ORDER BY c_custkey LIMIT 30")
def year_view(spark, sf_dir):
    """The first page of one year."""
    return views.query(_view_rows(spark, sf_dir), _VIEW, views.ViewState(year="2005"))


@query("SELECT array_to_string(list_concat(['All classes'], list_sort(list(DISTINCT c_mktsegment))), '|') AS cats, array_to_string(list_reverse_sort(list(DISTINCT CAST(2000 + c_nationkey AS VARCHAR))), '|') AS years FROM customer")
def view_choices(spark, sf_dir):
    """What a view can be filtered by: its categories, all first, and its years, the latest first."""
    rows = _view_rows(spark, sf_dir)
    cats, years = views.categories(rows, "c_mktsegment"), views.years(rows, "year")
    return cats.select(F.array_join("cats", "|").alias("cats")).join(F.broadcast(years.select(F.array_join("years", "|").alias("years"))))


@query("SELECT 2000 + min(c_nationkey) AS first_year, 2000 + max(c_nationkey) AS last_year, count(DISTINCT c_nationkey) AS n_years, count(*) AS n_rows FROM customer")
def view_span(spark, sf_dir):
    """The span of years and the rows of a view."""
    return views.span(_view_rows(spark, sf_dir), "year")


@query("SELECT DISTINCT c_mktsegment, 2000 + c_nationkey AS year FROM customer WHERE c_nationkey % 4 = 0")
def ownerless_years(spark, sf_dir):
    """Years of each category none of whose rows has an owner."""
    return views.ownerless(_view_rows(spark, sf_dir), "c_mktsegment", "year", "owner")


@query("""
SELECT '{"label":"Rally","kind":"classes","cats":["All classes","' || string_agg(DISTINCT r_name, '","' ORDER BY r_name) || '"],"years":[],"headers":["Name","Key"],"numeric":[false,true],"rows":[' || string_agg('["' || r_name || '","' || r_regionkey || '"]', ',' ORDER BY r_regionkey) || ']}' AS payload FROM region
""")
def view_payload(spark, sf_dir):
    """The regions as a view's JSON document."""
    spec = views.ViewSpec(("r_name", "r_regionkey"), numeric=("r_regionkey",), category="r_name", key="r_regionkey")
    return views.payload(_t(spark, sf_dir, "region"), spec, ("Name", "Key"), "Rally", "classes")


@query("SELECT '| r_name | r_regionkey |' || chr(10) || '|---|---|' || chr(10) || string_agg('| ' || r_name || ' | ' || r_regionkey || ' |', chr(10) ORDER BY r_regionkey) AS markdown FROM region")
def markdown_table(spark, sf_dir):
    """The regions as a table in a document."""
    return store.markdown_table(_t(spark, sf_dir, "region"), ["r_name", "r_regionkey"], ["r_regionkey"])


@query("""
SELECT s_suppkey, (SELECT min(struct_pack(d := abs(c_acctbal - s_acctbal), i := c_custkey)).i FROM customer c WHERE c.c_nationkey = s.s_nationkey AND abs(c_acctbal - s_acctbal) <= 40) AS c_custkey FROM supplier s
""")
def nearest_within(spark, sf_dir):
    """Each supplier with the customer of its nation whose balance is nearest, if within 40."""
    c, s = _t(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation"), _t(spark, sf_dir, "supplier").withColumnRenamed("s_nationkey", "nation")
    return assign.nearest(s, c, ["nation"], "s_acctbal", "c_acctbal", "c_custkey", within=40).select("s_suppkey", "c_custkey")


@query("""
SELECT c_custkey, CASE WHEN (c_custkey % 2 = 0 AND down IS NOT NULL) OR up IS NULL THEN CASE WHEN down_at - c_acctbal <= 300 THEN down END ELSE CASE WHEN c_acctbal - up_at <= 300 THEN up END END AS s_suppkey FROM (
 SELECT c.*, u.i AS up, u.a AS up_at, d.i AS down, d.a AS down_at FROM customer c
 LEFT JOIN LATERAL (SELECT s_suppkey AS i, s_acctbal AS a FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal <= c_acctbal ORDER BY s_acctbal DESC, s_suppkey DESC LIMIT 1) u ON true
 LEFT JOIN LATERAL (SELECT s_suppkey AS i, s_acctbal AS a FROM supplier WHERE s_nationkey = c_nationkey AND s_acctbal >= c_acctbal ORDER BY s_acctbal, s_suppkey LIMIT 1) d ON true)
""")
def fragment_rows(spark, sf_dir):
    """Customers as wrapped fragments: those that begin a name go to the next supplier, others to the last, if near."""
    c, s = _t(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "nation"), _t(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("c_acctbal"), "s_suppkey")
    return assign.fragment_target(c, s, ["nation"], "c_acctbal", "s_suppkey", F.col("c_custkey") % 2 == 0, within=300).select("c_custkey", "s_suppkey")
