"""Readers of reports, sheets and canonical files; every one gives rows an order."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numbers import loose_num
from ..functions.text import detect_sport, plain, year_in

WORDS = "file string, page int, word_seq int, text string, x0 double, x1 double, top double"
MANIFEST = "year string, sport string, quarter string, url string, file string, bytes long"
SPORT_ROWS = "sport string, year string, quarter string, category string, rank int, tie string, dog string, owner string, score string, score2 string"
# Headers of a results sheet and their columns.
SHEET = {
    "Reg Number": "reg_number", "Dog Name": "dog_name", "Primary Class": "primary_class", "Placement": "placement", "Score": "score",
    "Course Distance": "course_distance", "Dog Time": "dog_time", "Event Name": "event_name", "Event Date": "event_date", "Primary Owner": "primary_owner",
    "Last Name": "last_name", "Primary Owner Name": "primary_owner_name", "2nd Owner": "owner_2", "3rd Owner": "owner_3", "4th Owner": "owner_4",
}


def report_files(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """Files of reports, whose names tell year, sport and quarter: ``file, year, sport, quarter, length``; others are left out."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select(F.element_at(F.split("path", "/"), -1).alias("file"), "length")
    return name_parts(files).where("year is not null")


def name_parts(files: DataFrame) -> DataFrame:
    """Year, sport and quarter from ``YYYY-Sport-Qn`` names."""
    part = lambda k: F.nullif(F.regexp_extract("file", r"^(\d{4})-(\w+)-(Q\d)", k), F.lit(""))
    return files.withColumns({"year": part(1).cast("int"), "sport": part(2), "quarter": part(3)})


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines of text files: ``file, line_no, line``, line numbers from 0."""
    whole = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("file"), "value")
    return whole.select("file", F.posexplode(F.split("value", "\n"))).select("file", F.col("pos").alias("line_no"), F.col("col").alias("line"))


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON array's rows with ``src_seq``, their place in it."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.posexplode(F.from_json("value", f"array<struct<{', '.join(f.replace(' ', ':', 1) for f in schema.split(', '))}>>"))).select(F.col("pos").cast("long").alias("src_seq"), "col.*")


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The list of sources (small) with ``src_seq``."""
    return json_rows(spark, path, MANIFEST)


def true_years(lines: DataFrame, files: DataFrame) -> DataFrame:
    """Files with the year that one of their first six lines names, else the year given."""
    named = lines.where("line_no < 6").select("file", "line_no", year_in("line").alias("__year")).where("__year is not null").groupBy("file").agg(F.min_by("__year", "line_no").alias("__year"))
    return files.join(named, "file", "left").withColumn("year", F.coalesce("__year", F.col("year").cast("int"))).drop("__year")


def sheet_sport(cells: DataFrame) -> DataFrame:
    """The sport that each sheet's first cell names: ``file, sport``; unknown sheets are left out."""
    return cells.where("row_no = 0").select("file", detect_sport(F.element_at("cells", 1)).alias("sport")).where("sport is not null")


def results(cells: DataFrame) -> DataFrame:
    """Typed results from sheets' ``file, row_no, cells``: the first row with a cell ``Reg Number`` names the columns.

    Later rows without a first cell are left out; of repeated headers the last
    counts; ``src_seq`` is unique over all sheets and ascends within each.
    """
    clean = F.transform("cells", plain)
    rows = cells.select("file", "row_no", clean.alias("c"))
    head = rows.where(F.array_contains("c", "Reg Number")).groupBy("file").agg(F.min("row_no").alias("head_no"), F.min_by("c", "row_no").alias("head"))
    body = rows.join(head, "file").where((F.col("row_no") > F.col("head_no")) & (F.coalesce(F.try_element_at("c", F.lit(1)), F.lit("")) != ""))
    last = lambda name: F.size("head") - F.array_position(F.reverse("head"), name) + 1
    cell = lambda name: F.when(F.array_contains("head", name), F.nullif(F.try_element_at("c", last(name).cast("int")), F.lit("")))
    typed = {"score": loose_num, "course_distance": loose_num, "dog_time": loose_num, "event_date": lambda x: F.substring(x, 1, 10).try_cast("date")}
    place = F.shiftleft(F.xxhash64("file").bitwiseAND(F.lit((1 << 31) - 1)), 32) + F.col("row_no")
    return body.select("file", place.alias("src_seq"), *(typed.get(c, lambda x: x)(cell(h)).alias(c) for h, c in SHEET.items()))


def members(spark: SparkSession, path: str | None) -> DataFrame:
    """The private list of members (``nam, xdn``); empty without a file."""
    schema = "nam string, xdn string"
    return spark.read.schema(schema).json(path, multiLine=True) if path else spark.createDataFrame([], schema)


def member_keys(rows: DataFrame) -> DataFrame:
    """Keys under which members are known: whole names of two words or more, and first and last words."""
    from ..functions.text import first_last, norm_key

    people = rows.select(F.explode(F.concat(F.array("nam"), F.split(F.coalesce("xdn", F.lit("")), r"(?i)\band\b"))).alias("p"))
    whole = norm_key("p")
    keys = people.select(F.explode(F.array(F.when(whole.contains(" "), whole).otherwise(""), first_last("p"))).alias("key"))
    return keys.where("key <> ''").distinct()


def carried_sections(pages: DataFrame) -> DataFrame:
    """Pages (``file, page, page_text``) of conformation tables with the section that they or the page before name."""
    from ..functions.text import is_table_header, section_of

    continued = F.exists(F.split("page_text", "\n"), is_table_header)
    w = Window.partitionBy("file").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    own = pages.withColumn("__own", section_of("page_text"))
    return own.withColumn("section", F.last("__own", ignorenulls=True).over(w)).where(F.col("__own").isNotNull() | (continued & F.col("section").isNotNull())).drop("__own")


def bordered(pages: DataFrame, *, rules: int = 20) -> DataFrame:
    """Pages (with ``n_rules``, the drawn lines) whose table has borders; the others are read by positions."""
    return pages.withColumn("bordered", F.col("n_rules") > rules)
