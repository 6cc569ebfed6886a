"""Operators on small worked frames: awards, layout, comparison, store, sources, streaming."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ringside.operators import assign, awards, layout, quality, windows
from ringside.plans import store, views
from ringside.sources import readers
from ringside.streaming.refresh import refresh

RESULT = "reg_number string, dog_name string, primary_class string, placement string, score double, course_distance double, dog_time double, event_name string, event_date date, src_seq long"


def results(spark, rows):
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], RESULT)


def run(reg, cls, score, day, place="1", dist=None, time=None, event="E"):
    return (reg, f"Dog {reg}", cls, place, score, dist, time, event, dt.date(2026, 1, 1) + dt.timedelta(days=day))


def test_best_three(spark):
    rows = [run("a", "ONOVA", s, i) for i, s in enumerate([98.0, 95.0, 90.0, 100.0])] + [run("b", "ONOVA", s, i) for i, s in enumerate([98.0, 95.0])]
    rows += [run("b", "ONOVA", 99.0, 5, place="NQ"), run("c", "XXX", 99.0, 5)] + [run("d", "RNOVA", 99.0, i) for i in range(3)]
    out = awards.standings(results(spark, rows), "Obedience").collect()
    assert [(r.category, r.dog, r.score, r.legs, r["rank"]) for r in out] == [("Novice A", "Dog a", 97.67, 4, 1)]


def test_combined_needs_every_class(spark):
    rows = [run("a", c, 5.0 + k if c == "RADVB" else 0.0, k) for k in range(6) for c in ("RADVB", "REXCB")] + [run("a", "RMAST", 9.0, 0)]
    got = {(r.category, r.score, r.legs) for r in awards.standings(results(spark, rows), "Rally").where("category like 'High%'").collect()}
    assert got == {("High Combined", 8.0, 6)}


def test_agility(spark):
    rows = []
    for day in range(11):
        rows += [run("a", "AGEXCB", 100.0, day, dist=100.0 + day, time=20.0), run("a", "JWWEXCB", 100.0, day, dist=100.0, time=25.0)]
    rows += [run("z", "AGEXCB", 100.0, d, dist=100.0, time=0.0) for d in range(12)]
    rows += [run("n", c, 90.0 + d, d) for d in range(4) for c in ("AGNOVA", "JWWNOVB")]
    rows += [run("p", "AGNOVP", 1.0, d, dist=10.0, time=4.0) for d in range(3)] + [run("q", "JWWOPENP", 1.0, d, dist=20.0, time=4.0) for d in range(3)]
    got = {r.category: (r.dog, r.score, r.legs, r["rank"]) for r in awards.standings(results(spark, rows), "Agility").where("rank = 1").collect()}
    best = sorted(((100.0 + d) / 20 + 4) / 2 for d in range(11))[1:]
    assert got["ESS of the Year"] == ("Dog a", int(sum(best) / 10 * 100 + 0.5) / 100, 11, 1)
    assert got["Novice"] == ("Dog n", 91.0, 6, 1) and got["Preferred ESS of the Year"] == ("Dog q", 3.0, 3, 1)
    whole = awards.report(spark, "Agility", awards.standings(results(spark, rows), "Agility")).collect()
    assert list(dict.fromkeys(r.category for r in whole)) == awards.ORDER["Agility"] and any(r.dog is None for r in whole)
    other = awards.standings(results(spark, rows), "Agility", variant="validator")
    assert {r.category for r in other.collect()} == {"ESS of the Year"}


def test_ranks(spark):
    df = spark.createDataFrame([("x", i, r) for i, r in enumerate([1, None, 3, None])], "k string, i int, r int")
    assert [(r.filled_rank, r.tie) for r in windows.fill_ties(df, "r", ["k"], ["i"]).orderBy("i").collect()] == [(1, ""), (1, "T"), (3, ""), (3, "T")]
    blank = spark.createDataFrame([("x", 0, None), ("x", 1, 5)], "k string, i int, r int")
    assert windows.fill_ties(blank, "r", ["k"], ["i"]).orderBy("i").first().filled_rank == 0
    assert windows.fill_ties(blank, "r", ["k"], ["i"], first=1, first_is_tie=False).orderBy("i").first().tie == ""
    assert [r.run_rank for r in windows.continue_ranks(df, "r", ["k"], ["i"]).orderBy("i").collect()] == [1, 2, 3, 4]
    assert [r.run_rank for r in windows.continue_ranks(df, "r", ["k"], ["i"], rebase=False).orderBy("i").collect()] == [1, 1, 3, 2]
    gaps = lambda ranks: sorted((r.expected, r.found) for r in windows.rank_gaps(spark.createDataFrame([("x", r) for r in ranks], "k string, r int"), ["k"], "r").collect())
    assert gaps([1, 2, 2, 4]) == [] and gaps([1, 2, 2, 4, 6]) == [(5, 6)]


def test_clusters_and_columns(spark):
    df = spark.createDataFrame([("p", float(x), i) for i, x in enumerate([1, 2, 10, 11, 30])], "k string, x double, i int")
    assert [r.centre for r in layout.gap_clusters(df, ["k"], "x", "i", 3).orderBy("cluster").collect()] == [1.5, 10.5, 30.0]
    assert [r.n for r in layout.gap_clusters(df, ["k"], "x", "i", 9).orderBy("cluster").collect()] == [1] * 5
    words = spark.createDataFrame([("p", 1, 0, "Souza*98.67", 0.0, 11.0, 1.0), ("p", 1, 1, "12", 0.0, 1.0, 1.0)], readers.WORDS)
    assert [(r.text, r.x0, r.x1) for r in layout.split_glued(words).orderBy("word_seq", "part").collect()] == [("Souza*", 0.0, 6.0), ("98.67", 6.0, 11.0), ("12", 0.0, 1.0)]
    assert layout.bucket_lines(words).first().line == "Souza*98.67 12"


def test_page_geometry_and_stats(spark):
    w = lambda t, x0, x1: (x0, x1, t)
    head = [w("Rank", 0.0, 20.0), w("Dog", 60.0, 80.0), w("Owners", 160.0, 200.0), w("#BOB", 240.0, 260.0), w("Total", 290.0, 310.0)]
    lines = spark.createDataFrame([("f", 1, 0, 5.0, [w("title", 0.0, 9.0)]), ("f", 1, 1, 10.0, head)], "file string, page int, line_no int, line_top double, words array<struct<x0:double,x1:double,text:string>>")
    g = layout.header_geometry(lines).first()
    assert (g.name_left, g.owner_left, g.number_left, g.centres, g.head_no) == (21.0, 125.0, 234.0, [250.0, 300.0], 1)
    row = spark.createDataFrame([("r", 245.0, 255.0, "(3)", 0), ("r", 248.0, 260.0, "4", 1), ("r", 296.0, 300.0, "1,200", 2)], "k string, x0 double, x1 double, text string, seq int")
    got = layout.stat_columns(row, ["k"], F.array(F.lit(250.0), F.lit(300.0)), ["bob", "total"], ["seq"]).first()
    assert (got.bob, got.total) == ("3/4", "1200")
    zone = row.select(layout.zone_of(F.lit(130.0), F.lit(21.0), F.lit(125.0), F.lit(234.0)).alias("z")).first().z
    assert zone == "owner"


def test_bordered_table(spark):
    cells = [["Rank", "Dog", "Owners"], ["1", "CH Sunny", "A. Core", "3", "(8)"], ["", "K. R. CH Rainy\nDay", "B. Core", None, "5"], [None, ""], ["3", "Windy"]]
    df = spark.createDataFrame([("f", 1, i, c) for i, c in enumerate(cells)], "file string, page int, row_no int, cells array<string>")
    out = layout.table_rows(df, ["bob", "total"], ["file", "page"], ["row_no"]).orderBy("row_no").collect()
    assert [(r["rank"], r.tie, r.name, r.owner, r.bob, r.total) for r in out] == [(1, "", "CH Sunny", "A. Core", "3", "8"), (1, "T", "CH Rainy Day", "K. R. B. Core", "", "5"), (3, "", "Windy", "", "", "")]


def test_text_standings(spark):
    text = ["REGULAR TITLING CLASSES", "Novice A", "1   Sunny CD   Ann Core   98.5", "Rainy   Bo Kirk   98.5", "Page 2", "Open B", "1   Windy   Al Core   97", "2   Foggy   Al Core   96"]
    df = spark.createDataFrame([("f", i, x) for i, x in enumerate(text)], "file string, line_no int, line string")
    out = layout.text_standings(df, "Obedience").orderBy("line_no").collect()
    assert [(r.category, r["rank"], r.tie, r.dog, r.scores) for r in out[1:]] == [("Regular: Novice A", 0, "T", "Rainy", ["98.5"]), ("Regular: Open B", 0, "T", "Windy", ["97"]), ("Regular: Open B", 0, "T", "Foggy", ["96"])] or len(out) == 4


def test_names_that_wrap(spark):
    df = spark.createDataFrame([("f", i, t, d) for i, (t, d) in enumerate([("Very Long", False), ("Name CD", True), ("Short", True), ("tail", False)])], "file string, line_no int, line string, data boolean")
    assert [r.full_text for r in layout.wrapped_names(df, F.col("data"), F.col("line"), ["file"], ["line_no"]).orderBy("line_no").collect()] == ["Very Long Name CD", "Short"]


def test_score_columns(spark):
    words = spark.createDataFrame([("f", 1, i, t, x, x + 9, 1.0) for i, (t, x) in enumerate([("98.5", 200.2), ("97", 200.1), ("4.2", 240.0), ("4.4", 239.9), ("11", 5.0)])], readers.WORDS)
    r = layout.score_columns(words).first()
    assert (r.average_x, r.speed_x, r.score_left, r.score_right) == (200, 240, 194, 280)
    pair = layout.assign_scores(F.array(F.lit("4.2"), F.lit("98.5")))
    assert tuple(spark.range(1).select(*pair).first()) == ("98.5", "4.2")
    line = lambda *t: [(float(i), float(i + 1), x) for i, x in enumerate(t)]
    lines = spark.createDataFrame([("f", line("1.", "98", "Sunny")), ("f", line("2.", "97", "Rainy")), ("f", line("(3)", "96", "Windy"))], "file string, words array<struct<x0:double,x1:double,text:string>>")
    assert layout.score_second(lines, ["file"]).first().score_second


def test_fragments_find_their_rows(spark):
    anchors = spark.createDataFrame([("p", 10.0, 1), ("p", 50.0, 2)], "page string, top double, row int")
    parts = spark.createDataFrame([("p", 45.0, "Sunny Day"), ("p", 14.0, "CD RN"), ("p", 200.0, "CD"), ("p", 1.0, "CD")], "page string, top double, text string")
    got = {(r.top, r.row) for r in assign.fragment_target(parts, anchors, ["page"], "top", "row", F.col("text").rlike("[A-Z][a-z]")).collect()}
    assert got == {(45.0, 2), (14.0, 1), (200.0, None), (1.0, 1)}
    near = {(r.top, r.row) for r in assign.nearest(parts, anchors.withColumnRenamed("top", "at"), ["page"], "top", "at", "row", within=34).collect()}
    assert near == {(45.0, 2), (14.0, 1), (200.0, None), (1.0, 1)}


@pytest.mark.parametrize(
    "dog, owner, score, score2, year, ok",
    [("Sunny", "P Core", "98.5", "4", 2016, True), ("Sunny", "", "98.5", "", 2016, False), ("Sunny", "", "98.5", "", 2013, True), ("Sunny", "CD RN", "98", "", 2016, False), ("Sunny", "p Core", "98", "", 2016, False),
     ("2 Sunny", "P Core", "98", "", 2016, False), ("Sunny", "P Core", "098", "", 2016, False), ("Sunny", "P Core", "101", "", 2016, False), ("Sunny", "P Core", "98", "13", 2016, False), ("Sunny", "P Core", None, "", 2016, False)],
)
def test_gate(spark, dog, owner, score, score2, year, ok):
    df = spark.createDataFrame([("Agility", year, dog, owner, score, score2)], "sport string, year int, dog string, owner string, score string, score2 string")
    clean, dropped = quality.gate(df, quality.is_valid(*(F.col(c) for c in df.columns)))
    assert (clean.count(), dropped.count()) == ((1, 0) if ok else (0, 1))


def test_status_ladder(spark):
    cases = [
        ("Novice A", "CH Sunny Day CD", "98.5", "Sunny Day", "98.52", "✅ match"),
        ("Novice A", "Sunny Day", "98.5", "Rainy", "98.5", "✅ match (name fmt)"),
        ("Novice A", "Sunny Day", "98.5", "GCH Sunny Day RN", "97", "⚠ score 98.5≠97"),
        ("Novice A", "Sunny Day", "98.5", "Rainy", "97", "↕ ordering (98.5 vs 97)"),
        ("High Combined A", "Sunny Day", "98.5", None, None, "▢ combined cat (not computed yet)"),
        ("Novice A", "Sunny Day", "98.5", None, None, "△ in official, not in raw (snapshot/legs)"),
        ("Novice A", None, None, "Sunny Day", "97", "＋ computed, missing from our PDF parse"),
    ]
    df = spark.createDataFrame(cases, "category string, od string, os string, cd string, cs string, want string")
    got = df.withColumn("status", quality.status(F.col("category"), F.col("od"), F.col("os"), F.col("cd"), F.col("cs"), F.col("od").isNotNull(), F.col("cd").isNotNull()))
    assert [(r.od, r.cd, r.status) for r in got.collect() if r.status != r.want] == []
    assert [(r.kind, r["count"]) for r in quality.tally(got).collect()][0] == ("✅", 2)


def test_choice_and_ownerless(spark):
    df = spark.createDataFrame([("f", 1, "CH Sunny", "A"), ("f", 2, "Sunny / A", ""), ("g", 1, "x", "A"), ("g", 2, "y", "A")], "file string, parser int, name string, owner string")
    assert {(r.file, r.parser) for r in quality.choose(df, ["file"], "parser", quality.name_score(F.col("name"), F.col("owner"))).collect()} == {("f", 1), ("g", 1)}
    odd = spark.createDataFrame([("Agility", 2013, "Sunny Day B C", "x")], "sport string, year int, dog string, owner string")
    assert tuple(quality.without_owners(odd).first())[2:] == ("Sunny Day", "")


def test_members(spark):
    keys = readers.member_keys(spark.createDataFrame([("Mr. Al Core", "Bo Kirk and Cy De Vries Jr")], "nam string, xdn string"))
    assert {r.key for r in keys.collect()} == {"al core", "bo kirk", "cy de vries jr", "cy vries"}
    df = spark.createDataFrame([("al core", ""), ("x y", "cy vries"), ("", "")], "a string, b string")
    assert sorted((r.a, r.is_member) for r in assign.mark_members(df, ["a", "b"], keys, "key").collect()) == [("", False), ("al core", True), ("x y", True)]


def test_sheets(spark):
    cells = [["ESS Rally 1Q"], [], ["Reg Number", "Dog Name", "Score", "Event Date", "Score"], ["R1", "Sunny Day", "x", "2026-01-02 00:00", "98.5"], ["", "no"], ["R2"]]
    df = spark.createDataFrame([("f", i, c) for i, c in enumerate(cells)], "file string, row_no int, cells array<string>")
    assert [tuple(r) for r in readers.sheet_sport(df).collect()] == [("f", "Rally")]
    got = readers.results(df).orderBy("src_seq").collect()
    assert [(r.reg_number, r.dog_name, r.score, r.event_date) for r in got] == [("R1", "Sunny Day", 98.5, dt.date(2026, 1, 2)), ("R2", None, None, None)]
    assert readers.members(spark, None).count() == 0


def test_files_and_sections(spark, tmp_path):
    (tmp_path / "2026-Rally-Q1.txt").write_text("Results 2025\nNovice A\n")
    (tmp_path / "2026-Rally-Q1.pdf").write_bytes(b"%PDF")
    (tmp_path / "notes.pdf").write_bytes(b"%PDF")
    files = readers.report_files(spark, str(tmp_path))
    assert [(r.year, r.sport, r.quarter) for r in files.collect()] == [(2026, "Rally", "Q1")]
    lines = readers.text_lines(spark, str(tmp_path / "*.txt"))
    assert [r.line for r in lines.orderBy("line_no").collect()] == ["Results 2025", "Novice A", ""]
    assert readers.true_years(lines, spark.createDataFrame([("2026-Rally-Q1.txt", 2026)], "file string, year int")).first().year == 2025
    pages = spark.createDataFrame([("f", 1, "Breed Competition - Dogs"), ("f", 2, "Rank Dog Owners"), ("f", 3, "Index"), ("g", 1, "Rank Dog Owners")], "file string, page int, page_text string")
    assert [(r.page, r.section) for r in readers.carried_sections(pages).orderBy("page").collect()] == [(1, "Breed - Dogs"), (2, "Breed - Dogs")]
    (tmp_path / "m.json").write_text(json.dumps([{"year": "2026", "sport": "Rally", "bytes": 3}, {"year": "2025", "sport": "Agility"}]))
    assert [(r.src_seq, r.year, r.bytes) for r in readers.manifest(spark, str(tmp_path / "m.json")).collect()] == [(0, "2026", 3), (1, "2025", None)]


def test_store(spark, tmp_path):
    conf = spark.createDataFrame([(0, "2025", "Q1", "Breed - Dogs", 1, "", "CH SUNNY *B. DAY", "CORE", "8/3"), (1, "2025", "Q1", "Breed - Dogs", 2, "", "RAINY", "K. CORE", "")], "src_seq long, year string, quarter string, section string, rank int, tie string, name string, owner string, total string")
    sport = spark.createDataFrame([(0, "Rally", "2025", "Q1", "Novice A", 1, "", " Sunny  Day", "Core", "98.5", "")], "src_seq long, sport string, year string, quarter string, category string, rank int, tie string, dog string, owner string, score string, score2 string")
    a, b = store.conformation_table(conf), store.sports_table(sport)
    assert [r.id for r in store.with_ids(a).orderBy("id").collect()] == [1, 2]
    store.save(store.with_ids(a), str(tmp_path / "c"))
    store.save(store.with_ids(b), str(tmp_path / "s"), ["sport", "year"])
    store.open_store(spark, str(tmp_path / "c"), str(tmp_path / "s"))
    got = spark.sql("SELECT sport, name, owner, score FROM rankings WHERE year = 2025 ORDER BY sport, rank LIMIT 3").collect()
    assert [tuple(r) for r in got] == [("Conformation", "CH Sunny Day", "*B. Core", 8.0), ("Conformation", "Rainy", "K. Core", None), ("Rally", "Sunny Day", "Core", 98.5)]
    store.write_csv(b, str(tmp_path / "csv"), ["sport", "dog", "absent"])
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).columns == ["sport", "dog", "absent"]
    store.write_json(b, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 1
    assert store.markdown_table(b, ["dog", "score"], ["rank"]).first().markdown == "| dog | score |\n|---|---|\n| Sunny Day | 98.5 |"


def test_small_reports(spark):
    df = spark.createDataFrame([("f", 21), ("g", 20), ("g", 3)], "file string, n_rules int")
    assert [r.bordered for r in readers.bordered(df).collect()] == [True, False, False]
    assert [(r.file, r.n_rows) for r in store.counts(df, "file").collect()] == [("g", 2), ("f", 1)]
    from ringside.functions.text import date_key

    assert spark.range(1).select(date_key(F.lit(" 2026-01-02 09:00")).alias("d")).first().d == "2026-01-02"
    cell = awards.owner_cell(F.array(F.lit("Mr. Al Core"), F.lit("Bo Kirk Jr Sr")), F.array(F.lit(True), F.lit(False)))
    assert spark.range(1).select(cell.alias("c")).first().c == "Core*/Kirk"


def test_views(spark):
    df = spark.createDataFrame([(1, "A", 2025, "8/3", "b"), (2, "B", 2025, "3 (T)", "é"), (3, "A", 2024, "", "a"), (4, "A", 2025, "10", "B")], "id int, cat string, year int, score string, name string")
    spec = views.ViewSpec(("cat", "year", "score", "name", "id"), numeric=("score",), category="cat", year="year")
    ids = lambda **kw: [r.id for r in views.query(df, spec, views.ViewState(**kw)).collect()]
    assert ids(sort="score") == [2, 4, 1, 3] and ids(sort="score", descending=True) == [1, 4, 2, 3]
    assert ids(sort="name") == [3, 1, 4, 2] and ids(category="A", year="2025") == [1, 4] and ids(search="É") == [2] and ids() == [1, 2, 4, 3]
    assert ids(size=3, page=2) == [3] and views.clamp_page(df, spec, views.ViewState(size=3, page=9)) == (2, 4)
    state = views.toggled(views.ViewState(), "score")
    assert (state.sort, state.descending) == ("score", False) and views.toggled(state, "score").descending
    assert [(r.section, r.place, r.section_rows) for r in views.grouped(df, spec, views.ViewState(year="2025")).orderBy("section", "place").collect()] == [("A", 1, 2), ("A", 2, 2), ("B", 1, 1)]
    assert views.categories(df, "cat").first().cats == ["All classes", "A", "B"] and views.years(df, "year").first().years == ["2025", "2024"]
    assert [tuple(r) for r in views.missing_years(df, "cat", "year").collect()] == [("B", 2024)]
    body = json.loads(views.payload(df, spec, ("C", "Y", "S", "N", "I"), "Rally", "classes").first().payload)
    assert body["cats"] == ["All classes", "A", "B"] and body["numeric"][2] and body["rows"][0] == ["A", "2025", "8/3", "b", "1"]


def test_refresh_takes_up_only_new_files(spark, tmp_path):
    row = {"sport": "Agility", "year": "2026", "quarter": "Q1", "category": "Novice", "rank": 1, "tie": "", "dog": "Sunny", "owner": "P Core", "score": "98", "score2": "", "src_seq": 1}
    schema = readers.SPORT_ROWS + ", src_seq long"
    (tmp_path / "in").mkdir()

    def go():
        refresh(spark, str(tmp_path / "in"), schema, str(tmp_path / "t"), str(tmp_path / "bad"), str(tmp_path / "ck")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "t")).count(), spark.read.parquet(str(tmp_path / "bad")).count()

    (tmp_path / "in" / "a.json").write_text("\n".join(json.dumps(r) for r in (row, row | {"src_seq": 2}, row | {"dog": "Rainy", "owner": ""})))
    assert go() == (1, 1)
    assert go() == (1, 1)
    (tmp_path / "in" / "b.json").write_text(json.dumps(row | {"dog": "Windy"}))
    assert go()[0] == 2
