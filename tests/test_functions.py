"""Scalar functions on worked cases."""

import pytest
from pyspark.sql import functions as F

from ringside.functions import numbers as N
from ringside.functions import text as T
from ringside.functions import titlecase as C


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} {'double' if isinstance(v, float) else 'int' if isinstance(v, int) else 'string'}" for k, v in values.items()))
    return df.select(column.alias("x")).first().x


@pytest.mark.parametrize("text, want", [("(8)", "8"), ("()", ""), ("1,277", "1277")])
def test_clean_num(spark, text, want):
    assert one(spark, N.clean_num("t"), t=text) == want


@pytest.mark.parametrize("text, want", [("8/3", 8.0), ("abc", 0.0), (None, None), (" -2.5x", -2.5), (".5", 0.5), ("", 0.0)])
def test_prefix_real(spark, text, want):
    assert one(spark, N.prefix_real("t"), t=text) == want


def test_other_numbers(spark):
    assert one(spark, N.int_or_null("t"), t=" 12 ") == 12 and one(spark, N.int_or_null("t"), t="8/3") is None and one(spark, N.int_raw("t"), t="8/3") == "8/3"
    assert one(spark, N.loose_num("t"), t="$1,234.50 x") == 1234.5 and one(spark, N.loose_num("t"), t="none") is None
    assert one(spark, N.round_half_up("v"), v=2.675) == 2.68 and one(spark, N.short_decimal("v"), v=98.5) == "98.5" and one(spark, N.short_decimal("v"), v=100.0) == "100"
    assert one(spark, N.speed("a", "b"), a=10.0, b=0.0) is None and one(spark, N.speed("a", "b"), a=10.0, b=4.0) == 2.5


@pytest.mark.parametrize(
    "name, want",
    [
        ("CH SEA DOG", "CH Sea Dog"), ("GOLDEN MIRACLE NA NAJ", "Golden Miracle NA NAJ"), ("SEEMORE OF ME MXF OF", "Seemore of Me MXF OF"),
        ("BEAR'S MACHINE", "Bear's MacHine"), ("MCGRADY II UDX9", "McGrady II UDX9"), ("", ""), (None, None),
    ],
)
def test_title_name(spark, name, want):
    assert one(spark, C.tc_name(F.col("t")), t=name) == want


def test_title_columns(spark):
    assert one(spark, C.tc_owner(F.col("t")), t="*K. R. MCLOREN/L. O'KIRK, JR.") == "*K. R. McLoren/L. O'Kirk, Jr."
    assert one(spark, C.tc_name(F.col("t")), t="A SEA DOG") == "A SEA Dog" and one(spark, C.tc_name(F.col("t")), t="  ") == ""
    assert one(spark, C.tc_owner(F.col("t")), t="MACDUFF-MCKAY III/.") == "MacDuff-McKay III/."
    assert one(spark, C.tc_name(F.col("t")), t="CH SEA DOG") == "CH Sea Dog" and one(spark, C.tc_owner(F.col("t")), t=None) is None


def test_sections_headers_and_divisions(spark):
    assert one(spark, T.section_of("t"), t="2026 Breed Ranking Jan to Mar - Dogs") == "Breed - Dogs"
    assert one(spark, T.section_of("t"), t="Group Competition ‐ Bitches") == "Group - Bitches" and one(spark, T.section_of("t"), t="x") is None
    assert one(spark, T.is_division("t"), t="REGULAR TITLING CLASSES") and not one(spark, T.is_division("t"), t="Regular Classes")
    assert one(spark, T.is_header(F.lit("Rally"), F.col("t")), t="Advanced B") and not one(spark, T.is_header(F.lit("Rally"), F.col("t")), t="Novice A   98")
    assert one(spark, T.is_header(F.lit("Agility"), F.col("t")), t="Preferred Open Springers")
    assert one(spark, T.category_label(F.lit("Agility"), F.col("t"), F.lit("")), t="Novice Springers     Owner(s)  Avg Score  YPS") == "Novice"
    assert one(spark, T.category_label(F.lit("Obedience"), F.col("t"), F.lit("REGULAR TITLING CLASSES")), t="open-b  class") == "Regular: Open-B Class"
    assert one(spark, T.merged_category(F.lit("Rally"), F.col("t")), t="Masters") == "Master" and one(spark, T.merged_category(F.lit("Rally"), F.col("t")), t=" ") == "Overall"


def test_names(spark):
    assert one(spark, T.norm_key("t"), t="Mrs. Ann  O'Kirk") == "ann o kirk" and one(spark, T.norm_key("t"), t=None) == ""
    assert one(spark, T.first_last("t"), t="Al Bo Core Jr") == "al core" and one(spark, T.first_last("t"), t="Dr. Core") == "" and one(spark, T.last_name("t"), t="Al Core III") == "Core"
    assert one(spark, T.name_core("t"), t="GCH CH Sunny’s Day-Dream CD RN") == "sunnysdaydream" and one(spark, T.name_core("t"), t=None) == ""
    assert one(spark, T.fix_glyphs("t"), t="na(cid:415)ve(cid:9)") == "native" and one(spark, T.squash("t"), t=" a   b\n") == "a b"
    assert one(spark, T.html_escape("t"), t="a<b&c") == "a&lt;b&amp;c" and one(spark, T.rank_label("r", "t"), r=3, t="T") == "3 (T)"
    assert [one(spark, c, n="K. R. Sunny Day Dream", o="Core") for c in T.lead_initials("n", "o")] == ["Sunny Day Dream", "K. R. Core"]
    assert [one(spark, c, n="Sunny *B. Day", o="Core") for c in T.inner_initial("n", "o")] == ["Sunny Day", "*B. Core"]
    owners = T.owners_of(F.lit("Obedience"), F.col("a"), F.col("b"), F.col("c"), [F.col("d")])
    assert one(spark, owners, a="Ann", b="Core", c="", d=" Bo Kirk ") == ["Ann Core", "Bo Kirk"]


@pytest.mark.parametrize(
    "line, want",
    [
        ("1 Sunny CD   Ann Core   98.5", (1, "", "Sunny CD", "Ann Core", ["98.5"])),
        ("Sunny CD   Ann Core   98.5   4.2", (None, "T", "Sunny CD", "Ann Core", ["98.5", "4.2"])),
        ("2. 89.8   Sunny   Ann   Bo", (2, "", "Sunny", "Ann / Bo", ["89.8"])),
        ("just text", None),
        ("3 Sunny   0.5 Core   1 Kirk   98.5   4.2", (3, "", "Sunny 0.5 Core", "1 Kirk", ["98.5", "4.2"])),
        ("a   b", None),
        ("", None),
    ],
)
def test_split_row(spark, line, want):
    got = one(spark, T.split_row("t"), t=line)
    assert (tuple(got) if got else None) == want


def test_counting_lines(spark):
    assert one(spark, T.plausible_data_line("t"), t="3 Sunny Day 98.5") and one(spark, T.plausible_data_line("t"), t="Sunny   98") and not one(spark, T.plausible_data_line("t"), t="Page 3 of 98.5")
    assert one(spark, T.detect_sport("t"), t="ESS Rally 1Q") == "Rally" and one(spark, T.detect_sport("t"), t="x") is None and one(spark, T.year_in("t"), t="Q1 2026 results") == 2026
