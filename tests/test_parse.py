"""Whole parsers on synthetic pages."""

import random

import pytest
from pyspark.sql import functions as F

from ringside.operators import assign, layout, quality
from ringside.plans import parse
from ringside.plans.store import BREED_STATS, GROUP_STATS
from ringside.sources.readers import WORDS


def page(rows, file="f", number=1):
    """Words of a page from (top, [(x0, text), ...]) rows; a letter is 5 wide."""
    out = []
    for top, cells in rows:
        for x, text in cells:
            for word in text.split(" "):
                out.append((file, number, len(out), word, float(x), float(x + 5 * len(word)), float(top)))
                x += 5 * len(word) + 4
    return out


@pytest.fixture(scope="module")
def files(spark):
    return spark.createDataFrame([("f", "Rally", "2026", "Q1"), ("a", "Agility", "2016", "Q1")], "file string, sport string, year string, quarter string")


BREED = ["bob_shows", "bob_spec", "bob_pts", "bos_shows", "bos_spec", "bos_pts", "total"]


@pytest.mark.parametrize("centred", [False, True])
def test_conformation(spark, centred):
    marks = ["#BOB", "#Spec", "Points", "#BOS", "#Spec", "Points", "Total"]
    xs = [400 + 40 * i for i in range(7)]
    rows = [(5, [(0, "Breed Competition - Dogs")]), (20, [(10, "Rank"), (60, "Dog"), (250, "Owners"), *zip(xs, marks)])]
    numbers = lambda k: [(x + 4, str(k + i)) for i, x in enumerate(xs)]
    up = -10 if centred else 10
    rows += [(50, [(15, "1"), (45, "CH Sunny Day"), (220, "A. Core"), *numbers(1)]), (50 + up, [(45, "GCH Dream"), (220, "B. Kirk")])] if not centred else [(40, [(45, "CH Sunny Day"), (220, "A. Core")]), (50, [(15, "1"), *numbers(1)]), (60, [(45, "of Dream"), (220, "B. Kirk")])]
    rows += [(90, [(45, "CH Rainy Day"), (220, "C. Core"), *numbers(11)]), (120, [(15, "3"), (45, "CH Windy Day"), (220, "D. Core"), *numbers(21)])]
    words = spark.createDataFrame(page(rows), WORDS)
    pages = spark.createDataFrame([("f", 1, "Breed - Dogs", 2026, "Q1")], "file string, page int, section string, year int, quarter string")
    got = parse.conformation(words, pages).orderBy("line_no").collect()
    assert [(r["rank"], r.tie) for r in got] == [(1, ""), (1, "T"), (3, "")]
    assert [r.name for r in got][1:] == ["CH Rainy Day", "CH Windy Day"] and got[0].name.startswith("CH Sunny Day")
    assert got[0].owner == "A. Core B. Kirk" and got[2].owner == "D. Core"
    assert [got[2][c] for c in BREED] == [str(21 + i) for i in range(7)] and got[0].section == "Breed - Dogs" and got[0].year == 2026


def test_positions(spark, files):
    rows = [
        (10, [(50, "Novice A")]),
        (30, [(50, "Sunny Day CD"), (250, "Ann Core"), (400, "98.5")]),
        (50, [(10, "2"), (50, "Very Long Name")]),
        (60, [(50, "of Dream RN"), (250, "Bo Kirk"), (400, "97.25")]),
        (80, [(50, "Rainy CD"), (250, "Cy Kirk"), (400, "97.25")]),
        (90, [(50, "RN RA")]),
        (110, [(50, "NOTES about this")]),
        (120, [(50, "some words"), (250, "more words"), (400, "11")]),
        (140, [(50, "Advanced B")]),
        (160, [(10, "1"), (50, "Windy Day"), (361, "Di Core*96.5")]),
    ]
    words = spark.createDataFrame(page(rows), WORDS)
    got = parse.positions(words, files).orderBy("line_no").collect()
    assert [(r.category, r["rank"], r.tie, r.dog, r.owner, r.score) for r in got] == [
        ("Novice A", 1, "", "Sunny Day CD", "Ann Core", "98.5"),
        ("Novice A", 2, "", "Very Long Name of Dream RN", "Bo Kirk", "97.25"),
        ("Novice A", 2, "T", "Rainy CD RN RA", "Cy Kirk", "97.25"),
        ("Advanced B", 1, "", "Windy Day", "Di Core*", "96.5"),
    ]


@pytest.mark.parametrize("owner_last", [False, True])
def test_agility(spark, files, owner_last):
    a, s, o = (250, 300, 400) if owner_last else (400, 450, 250)
    row = lambda top, dog, owner, avg, yps, rank=None: (top, [*([(10, rank)] if rank else []), (50, dog), (o, owner), (a, avg), (s, yps)])
    rows = [(10, [(50, "Preferred Novice Springers")]), (20, [(50, "Name of Dog"), (a, "Average"), (s, "YPS"), (o, "Owner")])]
    rows += [row(40, "Sunny", "Ann Core", "98.50", "4.2"), row(60, "Rainy", "Bo Kirk", "97", "3.95", "4"), (70, [(50, "of Dream")]), row(90, "Windy", "Cy Core", "96", "3.1"), (110, [(50, "Open A")]), row(130, "Foggy", "Di Kirk", "100", "2.5")]
    words = spark.createDataFrame(page(rows, "a"), WORDS)
    for columns in (None, parse.labelled_columns(words, parse.lines_of(words))):
        got = parse.agility(words, files, columns).orderBy("line_no").collect()
        assert [(r.category, r["rank"], r.dog, r.owner, r.score, r.score2) for r in got] == [
            ("Preferred Novice", 1, "Sunny", "Ann Core", "98.5", "4.2"),
            ("Preferred Novice", 4, "Rainy of Dream", "Bo Kirk", "97", "3.95"),
            ("Preferred Novice", 5, "Windy", "Cy Core", "96", "3.1"),
            ("Open A", 1, "Foggy", "Di Kirk", "100", "2.5"),
        ]


def test_standings(spark, files):
    text = ["Agility Standings", "Preferred Novice Springers", "Dog   Owner", "Very Long", "Sunny Day   Ann Core   98.5   4.2", "2 Rainy   Bo Kirk   Cy Kirk   3.9   97", "Open", "Windy   95"]
    lines = spark.createDataFrame([("a", i, x) for i, x in enumerate(text)], "file string, line_no int, line string")
    got = parse.standings(lines, files).orderBy("line_no").collect()
    assert [(r.category, r["rank"], r.dog, r.owner, r.score, r.score2) for r in got] == [
        ("Preferred Novice", 1, "Very Long Sunny Day", "Ann Core", "98.5", "4.2"),
        ("Preferred Novice", 2, "Rainy", "Bo Kirk / Cy Kirk", "97", "3.9"),
        ("Open", 1, "Windy", "", "95", ""),
    ]


def test_route_and_choice(spark, files):
    more = files.unionByName(spark.createDataFrame([("y", "Rally", "2020", "Q1"), ("s", "Rally", "2024", "Q1"), ("o", "Agility", "2013", "Q1")], files.schema))
    lines = spark.createDataFrame([("y", 0, "Dog of the Year"), ("f", 9, "of the Year")], "file string, line_no int, line string")
    line = lambda *t: [(float(i), float(i + 1), x) for i, x in enumerate(t)]
    ranked = spark.createDataFrame([("s", line(f"{k}.", "98", "Sunny")) for k in range(3)], "file string, words array<struct<x0:double,x1:double,text:string>>")
    assert {r.file: r.route for r in parse.route(more, lines, ranked).collect()} == {"f": "positions", "a": "agility", "y": "text", "s": "text", "o": "geometry"}
    schema = "file string, year string, dog string, owner string, score string, score2 string"
    old = spark.createDataFrame([("a", "2016", "Sunny", "", "98", ""), ("b", "2016", "Sunny", "P Core", "98", "")], schema)
    new = spark.createDataFrame([("a", "2016", "Sunny", "P Core", "98", ""), ("b", "2016", "Sunny", "P Core", "98", "")], schema)
    assert {(r.file, r.parser) for r in parse.better(old, new).collect()} == {("a", 1), ("b", 0)}


def test_lines_keep_their_words(spark):
    words = spark.createDataFrame(page([(10, [(50, "b"), (10, "a")]), (11, [(90, "c")])]), WORDS)
    assert [r.line for r in parse.lines_of(words).collect()] == ["a b c"]
    assert layout.session_lines(words).select(F.max("line_no")).first()[0] == 0


def leaves(df):
    return df._jdf.queryExecution().analyzed().collectLeaves().size()


def test_agility_plan_is_small(spark, files):
    words = spark.createDataFrame([], WORDS)
    assert leaves(parse.agility(words, files)) < 20


def folded(tops, tolerance):
    """Lines by their definition: the first line begun whose mean is near, numbered by their means."""
    lines, at = [], []
    for _, i in sorted((round(t, 1), i) for i, t in enumerate(tops)):
        near = next((k for k, ls in enumerate(lines) if abs(sum(ls) / len(ls) - tops[i]) <= tolerance), None)
        if near is None:
            lines.append([])
            near = len(lines) - 1
        lines[near].append(tops[i])
        at.append((i, near))
    order = sorted(range(len(lines)), key=lambda k: (sum(lines[k]) / len(lines[k]), k))
    return {i: order.index(k) for i, k in at}


@pytest.mark.parametrize("tolerance", [3.0, 0.5])
def test_strips_give_the_lines_of_the_whole_page(spark, tolerance):
    rng = random.Random(7)
    pages = [[rng.randrange(8 * n) / 8 for _ in range(n)] for n in (30, 200)] + [[k * 3.25 + 1 for k in range(60)], [k * 3.0 for k in range(60)], [0.0, 3.125, 6.375, 3.25]]
    rows = [("f", p, i, "w", float(i), float(i + 1), t) for p, tops in enumerate(pages) for i, t in enumerate(tops)]
    got = {(r.page, r.word_seq): r.line_no for r in layout.visual_lines(spark.createDataFrame(rows, WORDS), tolerance=tolerance).collect()}
    assert got == {(p, i): k for p, tops in enumerate(pages) for i, k in folded(tops, tolerance).items()}


def test_strips_keep_words_without_a_height(spark):
    tops = [None, 5.0, float("nan"), 50.0, None, float("inf")]
    words = spark.createDataFrame([("f", 1, i, "w", 0.0, 1.0, t) for i, t in enumerate(tops)], WORDS)
    assert [r.line_no for r in layout.visual_lines(words).orderBy("word_seq").collect()] == [0, 2, 5, 3, 1, 4]


def test_nearest_among_equals_nearest(spark):
    rng = random.Random(3)
    rows = [(p, i, rng.choice([None, *range(60)]) if i % 9 == 0 else rng.randrange(60) * 1.0, rng.random() < 0.4) for p in range(12) for i in range(25)]
    df = spark.createDataFrame([(p, i, None if t is None else float(t), d) for p, i, t, d in rows], "p int, i int, t double, d boolean")
    right = df.where("d").select("p", F.col("t").alias("at"), F.col("i").alias("id"))
    want = {(r.p, r.i): r.id for r in assign.nearest(df.where("not d"), right, ["p"], "t", "at", "id", within=4).collect()}
    got = df.withColumn("id", assign.nearest_among(["p"], "t", "i", F.col("d"), within=4)).where("not d")
    assert {(r.p, r.i): r.id for r in got.collect()} == want and {None} < set(want.values())


def test_conformation_plan_is_small(spark):
    pages = spark.createDataFrame([], "file string, page int, section string, year int, quarter string")
    assert leaves(parse.conformation(spark.createDataFrame([], WORDS), pages)) < 30


def test_conformation_without_labels_goes_by_clusters(spark):
    def sheet(number, k):
        xs = [400 + 40 * i for i in range(k)]
        rows = [(20, [(10, "Rank"), (60, "Dog"), (250, "Owners"), (400, "Points")])]
        rows += [(50 + 30 * r, [(15, str(r + 1)), (45, "CH Sun"), (220, "A. Core"), *[(x + (i + r) % 3, str(10 * r + i)) for i, x in enumerate(xs)]]) for r in range(3)]
        rows[-1][1].append((xs[0] + 12, "(9)"))  # a second number on a column
        return page(rows, "f", number)

    pages = spark.createDataFrame([("f", 1, "Breed - Dogs", 2026, "Q1"), ("f", 2, "Group - Dogs", 2026, "Q1"), ("f", 3, "Breed - Dogs", 2026, "Q1")], "file string, page int, section string, year int, quarter string")
    got = parse.conformation(spark.createDataFrame(sheet(1, 7) + sheet(2, 11), WORDS), pages).orderBy("page", "line_no").collect()
    assert [(r.page, r["rank"], r.name, r.owner) for r in got] == [(p, r + 1, "CH Sun", "A. Core") for p in (1, 2) for r in range(3)]
    for r, names, others in [(r, *((BREED_STATS, GROUP_STATS), (GROUP_STATS, BREED_STATS))[r.page - 1]) for r in got]:
        k = 10 * (r["rank"] - 1)
        assert [r[n] for n in names] == [str(k) + ("/9" if k == 20 else ""), *(str(k + i) for i in range(1, len(names)))]
        assert all(r[n] is None for n in others if n not in names)


def test_choose_in_equals_choose(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(k, rng.randrange(3), rng.choice([None, 0, 1, 2])) for k in range(40) for _ in range(rng.randrange(1, 6))], "k int, c int, n int")
    assert sorted(quality.choose_in(df, ["k"], "c", F.col("n")).collect(), key=str) == sorted(quality.choose(df, ["k"], "c", F.col("n")).collect(), key=str)


def test_labelled_plan_is_small(spark, files):
    words = spark.createDataFrame([], WORDS)
    assert leaves(parse.agility(words, files, parse.labelled_columns(words, parse.lines_of(words)))) < 20
