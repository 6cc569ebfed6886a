"""Whole parsers, composed of the layout operators: pages of words or lines to rows of standings.

Each is one lazy plan. Work is keyed by (file, page), so reports of any number
spread over the cluster; what crosses pages (a class that goes on) is carried
by a window over a file.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numbers import clean_num, short_decimal
from ..functions.text import category_label, fix_glyphs, is_division, is_header, is_noise, lead_initials, squash
from ..operators import assign, layout, quality, windows
from .store import BREED_STATS, GROUP_STATS

PAGE = ["file", "page"]
# Patterns of numbers, printed ranks, agility classes and labels.
NUMBER, STAT, RANK = r"^\d+(\.\d+)?$", r"^\(?-?\d+\)?$", r"^\(?(\d+)\)?\.?$"
AGILITY_CLASS = r"(?i)^(Preferred\s+)?(Novice|Open|Excellent|Master|Veteran)\b"
AGILITY_CATEGORY = r"(?i)^(Preferred\s+|Time\s*2\s*Beat\s+|Premier\s+)?(Novice|Open|Excellent|Master|Veteran)(\s+[AB])?\b"
AGILITY_LABELS = r"(?i)Owner|Dog|Name|Average|Avg|YPS|Score|Co[\s/-]?Owner"
FOOTNOTE = r"(?i)AVERAGE|Owner|Name of Dog|qualifying|based on|YPS|Score"


def lines_of(words: DataFrame, *, tolerance: float = 3.0) -> DataFrame:
    """``file, page, line_no, line_top, words`` (in order of x) and ``line``, their text."""
    own = layout.visual_lines(words.select("file", "page", "word_seq", "text", "x0", "x1", "top"), tolerance=tolerance)
    out = own.groupBy(*PAGE, "line_no").agg(F.first("line_top").alias("line_top"), F.array_sort(F.collect_list(F.struct("x0", "word_seq", "x1", "text"))).alias("words"))
    return out.withColumn("line", F.array_join(F.transform("words", lambda w: w["text"]), " "))


def _said(pieces: DataFrame, keys: Sequence[str], keep: dict[str, Column]) -> DataFrame:
    """Texts of some words of each key, from top to bottom and left to right."""
    def text(c: Column) -> Column:
        some = F.collect_list(F.when(c, F.struct("line_top", F.col("w.x0").alias("x0"), F.col("w.word_seq").alias("q"), F.col("w.text").alias("text"))))
        return squash(F.array_join(F.transform(F.array_sort(some), lambda s: s["text"]), " "))

    return pieces.groupBy(*keys).agg(*(text(c).alias(n) for n, c in keep.items()))


def _said_in(pieces: str, keep: Callable[[Column], Column]) -> Column:
    """As ``_said``, of an array of lines (structs ``line_top, words``)."""
    words = F.flatten(F.transform(pieces, lambda p: F.transform(p["words"], lambda w: F.struct(p["line_top"].alias("line_top"), w["x0"].alias("x0"), w["word_seq"].alias("word_seq"), w["text"].alias("text"), w["x1"].alias("x1")))))
    return squash(F.array_join(F.transform(F.array_sort(F.filter(words, keep)), lambda w: w["text"]), " "))


def conformation(words: DataFrame, pages: DataFrame) -> DataFrame:
    """Rows of conformation pages without borders. ``pages`` gives ``file, page, section, year, quarter``.

    Names that wrap belong to the rank line above them, or to the nearest: both
    are tried, and each page keeps the one whose names look cleaner.
    """
    lines = lines_of(words).join(pages.select(*PAGE, "section", "year", "quarter"), PAGE)
    geometry = layout.header_geometry(lines)
    body = lines.join(geometry, PAGE).where(F.col("line_top") > F.col("head_top") + 1)
    loose = body.select(*PAGE, "line_no", "name_left", "number_left", F.explode("words").alias("w"))
    edge = layout.strong_edge(loose.where(~F.col("w.text").rlike(STAT) & (F.col("w.x0") > F.col("name_left") + 40) & (F.col("w.x0") < F.col("number_left"))), PAGE, F.rint("w.x0"))
    body = body.join(edge, PAGE, "left").withColumn("owner_left", F.coalesce(F.col("edge") - 5, F.col("owner_left"))).drop("edge")
    numbers = F.filter("words", lambda w: (w["x0"] >= F.col("number_left")) & w["text"].rlike(STAT))
    printed = F.filter("words", lambda w: (w["x0"] < F.col("name_left")) & w["text"].rlike(r"^\d+$"))
    body = body.withColumns({"numbers": numbers, "printed": F.try_element_at(printed, F.lit(1))["text"].try_cast("int")})
    body = body.withColumn("own", F.size("numbers") >= 2)
    body = body.where(F.col("own") | F.exists("words", lambda w: (w["x0"] >= F.col("name_left") - 6) & (w["x0"] < F.col("number_left"))))
    # each other line with the last rank line at its height or above (else the page's first), and with the nearest
    rank_line = F.when(F.col("own"), F.struct("line_no", F.col("line_top").alias("at")))
    body = body.withColumn("reach", F.when(F.col("own"), F.col("line_top")).otherwise(F.col("line_top") + 1))
    last = F.last(rank_line, ignorenulls=True).over(Window.partitionBy(*PAGE).orderBy("reach", F.desc("own"), "line_no").rowsBetween(Window.unboundedPreceding, 0))
    body = body.withColumn("above", F.coalesce(last, F.min(rank_line).over(Window.partitionBy(*PAGE))))
    below = F.when(F.abs(F.col("above.at") - F.col("line_top")) <= 34, F.col("above.line_no"))
    body = body.withColumns({"below": below, "centred": assign.nearest_among(PAGE, "line_top", "line_no", F.col("own"), within=34)})
    models = F.array(*(F.struct(F.lit(i).alias("model"), F.when(F.col("own"), F.col("line_no")).otherwise(F.col(c)).alias("anchor")) for i, c in enumerate(("below", "centred"))))
    pieces = body.withColumn("m", F.explode(models)).withColumns({"model": F.col("m.model"), "anchor": F.col("m.anchor")}).where("anchor is not null")
    same = ("name_left", "owner_left", "number_left", "centres", "section", "year", "quarter")  # on all lines of a page
    mine = lambda c: F.any_value(F.when(F.col("own"), F.col(c)), True).alias(c)
    rows = pieces.groupBy(*PAGE, "model", "anchor").agg(*(F.first(c).alias(c) for c in same), mine("printed"), mine("numbers"), F.collect_list(F.struct("line_top", "words")).alias("pieces"))
    middle = lambda w: (w["x0"] + w["x1"]) / 2
    rank_word = lambda w: (w["x0"] < F.col("name_left")) & w["text"].rlike(r"^\d+$")
    said = {
        "name": _said_in("pieces", lambda w: (middle(w) >= F.col("name_left") - 6) & (middle(w) < F.col("owner_left")) & ~rank_word(w)),
        "owner": _said_in("pieces", lambda w: (middle(w) >= F.col("owner_left")) & (middle(w) < F.col("number_left"))),
    }
    rows = rows.withColumns(said).drop("pieces")
    name, owner = lead_initials("name", "owner")
    chosen = quality.choose_in(rows.withColumns({"name": name, "owner": owner}), PAGE, "model", quality.name_score(F.col("name"), F.col("owner")))
    ranked = windows.fill_ties(chosen.withColumnRenamed("anchor", "line_no"), "printed", PAGE, ["line_no"])

    # numbers to the columns of the header, or else to the clusters of the page's numbers
    group = F.col("section").startswith("Group")
    size = F.when(group, len(GROUP_STATS)).otherwise(len(BREED_STATS))
    kept = ["section", "filled_rank", "tie", "name", "owner", "year", "quarter"]
    cells = ranked.select(*PAGE, "line_no", *kept, "centres", group.alias("group"), F.explode("numbers").alias("w")).select(*PAGE, "line_no", *kept, "centres", "group", "w.*").withColumn("mid", (F.col("x0") + F.col("x1")) / 2)
    keys = [*PAGE, "group"]
    clusters = layout.cluster_rows(cells, keys, "mid", "word_seq", size)
    own = Window.partitionBy(*keys, "cluster")
    clusters = clusters.withColumn("centre", F.when(F.row_number().over(own.orderBy("mid", "word_seq")) == 1, F.avg("mid").over(own)))
    clusters = clusters.withColumn("clustered", F.array_sort(F.collect_list("centre").over(Window.partitionBy(*keys))))
    centres = F.when(F.size("centres") == size, F.col("centres")).otherwise(F.col("clustered"))
    placed = clusters.withColumns({"c": assign.nearest_in(centres, F.col("mid")), "v": clean_num("text")})
    wide = placed.groupBy(*keys, "line_no").agg(*(F.first(c).alias(c) for c in kept), F.array_sort(F.collect_list(F.struct("x0", "word_seq", "v", "c"))).alias("cells"))

    def stat(n: str) -> Column:
        place = F.coalesce(*(F.when(F.col("group") == g, names.index(n) + 1) for g, names in ((False, BREED_STATS), (True, GROUP_STATS)) if n in names))
        here = F.filter("cells", lambda x: x["c"] == place)
        return F.when(F.size(here) > 0, F.array_join(F.transform(here, lambda x: x["v"]), "/")).alias(n)

    stats = [stat(n) for n in dict.fromkeys((*BREED_STATS, *GROUP_STATS))]
    return wide.select(*PAGE, "line_no", "section", F.col("filled_rank").alias("rank"), "tie", *stats, "name", "owner", "year", "quarter")


def without_notes(lines: DataFrame, sport: Column) -> DataFrame:
    """Lines but for blocks of notes: from a line that begins with NOTES to the next header."""
    head = is_header(sport, F.col("line"))
    mark = F.when(F.col("line").rlike(r"(?i)^\s*NOTES\b"), 1).when(head, 0)
    w = Window.partitionBy(*PAGE).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("__notes", F.coalesce(F.last(mark, ignorenulls=True).over(w), F.lit(0))).where("__notes = 0").drop("__notes")


def trailing_columns(lines: DataFrame) -> DataFrame:
    """Left edges of the owner and score columns of each page, by its lines that end in a number."""
    w = F.col("words")
    data = lines.where((F.size(w) >= 3) & F.element_at(w, -1)["text"].rlike(NUMBER))
    gaps = F.transform(F.sequence(F.lit(2), F.size(w) - 1), lambda i: F.struct((F.element_at(w, i)["x0"] - F.element_at(w, i - 1)["x1"]).alias("gap"), F.rint(F.element_at(w, i)["x0"]).alias("x")))
    seen = data.withColumns({"__owner": F.array_max(gaps)["x"], "__score": F.rint(F.element_at(w, -1)["x0"])})
    owner = layout.mode_of(seen, PAGE, F.col("__owner"), "line_no").withColumnRenamed("mode", "owner_x")
    return owner.join(layout.mode_of(seen, PAGE, F.col("__score"), "line_no").withColumnRenamed("mode", "score_x"), PAGE)


def positions(words: DataFrame, files: DataFrame, *, score_columns: int = 1, limit: float = 10) -> DataFrame:
    """Rows of reports whose scores trail. ``files`` gives ``file, sport, year, quarter``.

    A class goes on over pages of a file; its fragments belong to rows of the
    same page. A class's first row without a printed rank is first, later ones tie.
    """
    glued = layout.split_glued(words)
    lines = lines_of(glued).join(files.select("file", "sport"), "file")
    lines = lines.join(trailing_columns(lines), PAGE).where((F.trim("line") != "") & ~is_noise("line"))
    lines = without_notes(lines, F.col("sport"))
    scores = F.filter("words", lambda w: w["text"].rlike(NUMBER) & (w["x0"] >= F.col("score_x") - 40))
    lines = lines.withColumn("scores", scores).withColumn("data", (F.size("scores") > 0) & (F.size("words") >= 2))
    division, head = ~F.col("data") & is_division("line"), ~F.col("data") & is_header(F.col("sport"), F.col("line"))
    over = Window.partitionBy("file").orderBy("page", "line_no").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.withColumns({"division": F.last(F.when(division, F.col("line")), ignorenulls=True).over(over), "head": head & ~division, "super": division})
    label = category_label(F.col("sport"), F.col("line"), F.coalesce("division", F.lit("")))
    blocks = windows.header_blocks(lines.where("not super"), F.col("head"), label, ["file"], ["page", "line_no"]).where("category is not null")
    keys = [*PAGE, "block"]
    owner_left = F.col("owner_x") - 6
    anchors = blocks.where("data").withColumn("anchor", F.col("line_no"))
    heads = F.exists("words", lambda w: (w["x0"] < owner_left) & w["text"].rlike("^[A-Z][a-z]"))
    orphans = assign.fragment_target(blocks.where("not data").withColumn("__heads_name", heads), anchors, keys, "line_top", "anchor", F.col("__heads_name")).where("anchor is not null")
    columns = [*keys, "anchor", "line_no", "line_top", "words", "scores", "owner_x", "score_x", "data"]
    pieces = anchors.select(*columns).unionByName(orphans.select(*columns))
    first = pieces.groupBy(*keys, "anchor").agg(F.min_by(F.element_at("words", 1), F.struct("line_top", "line_no")).alias("lead"), F.first("owner_x").alias("owner_x"))
    ranked = F.when(F.col("lead.text").rlike(RANK) & (F.col("lead.x0") < F.col("owner_x") - 80), F.regexp_extract("lead.text", RANK, 1)).try_cast("int")
    ranks = windows.fill_ties(first.withColumn("printed", ranked), "printed", ["file", "block"], ["page", "anchor"], first=1, first_is_tie=False)
    exploded = pieces.join(ranks.select(*keys, "anchor", F.when(F.col("printed").isNotNull(), F.col("lead.word_seq")).alias("rank_word")), [*keys, "anchor"]).withColumn("w", F.explode("words"))
    is_score = F.exists("scores", lambda s: (s["word_seq"] == F.col("w.word_seq")) & (s["x0"] == F.col("w.x0")))
    text = ~is_score & ~F.coalesce(F.col("w.word_seq") == F.col("rank_word"), F.lit(False))
    in_owner = (F.col("w.x0") >= F.col("owner_x") - 6) & (F.col("w.x0") < F.col("score_x") - 6)
    said = _said(exploded, [*keys, "anchor"], {"dog": text & (F.col("w.x0") < F.col("owner_x") - 6), "own": text & in_owner & F.col("data"), "near": text & in_owner & ~F.col("data")})
    values = F.transform("scores", lambda s: s["text"])
    score, speed = layout.assign_scores(values, limit=limit) if score_columns == 2 else (F.element_at(values, -1), F.lit(""))
    rows = anchors.select(*keys, "anchor", "category", score.alias("score"), speed.alias("score2")).join(said, [*keys, "anchor"]).join(ranks.select(*keys, "anchor", F.col("filled_rank").alias("rank"), "tie"), [*keys, "anchor"])
    owner = F.when(F.col("own") != "", F.col("own")).otherwise(F.col("near"))
    return rows.where("dog <> ''").select(*PAGE, F.col("anchor").alias("line_no"), "category", "rank", "tie", fix_glyphs("dog").alias("dog"), fix_glyphs(owner).alias("owner"), "score", "score2").join(files.select("file", "sport", "year", "quarter"), "file")


def agility_category(line: Column | str) -> Column:
    """An agility class out of a header with labels, ``Preferred`` first."""
    from ..functions.text import title_words

    x = F.col(line) if isinstance(line, str) else line
    x = F.regexp_replace(F.regexp_replace(x, r"(?i)\(Highest Average Score\)", " "), r"(?i)Owner\(?s?\)?.*$", " ")
    x = F.regexp_replace(x, r"(?i)English Springer Spaniel|English Spaniel|\bES+\b|\bSpringers?\b|\bAgility\b|of the Year|Name of Dog|2nd|\bAve?\b|Average|Score|\bYPS\b", " ")
    x = title_words(F.regexp_replace(F.regexp_replace(x, r"\s+", " "), r"^[ \-–·,]+|[ \-–·,]+$", ""))
    bare = F.trim(F.regexp_replace(F.regexp_replace(x, r"(?i)\bPreferred\b", " "), r"\s+", " "))
    x = F.when(x.rlike(r"(?i)\bPreferred\b"), F.trim(F.concat(F.lit("Preferred "), bare))).otherwise(F.trim(F.regexp_replace(x, r"\s+", " ")))
    return F.when(x == "", "Overall").otherwise(x)


def agility_columns(words: DataFrame, lines: DataFrame) -> DataFrame:
    """Of each page: the score band, where names begin, the owner column and whether it follows the scores."""
    band = layout.score_columns(words).join(_letters(words), PAGE)
    kept = [c for c in band.columns if c not in PAGE]
    base = band.join(lines.select(*PAGE, "words"), PAGE, "left").withColumn("data", _has(12, 100, False) & _has(0, 12, True))
    base = base.groupBy(*PAGE).agg(*(F.first(c).alias(c) for c in kept), F.count_if("data").alias("n_data"))
    after = F.filter("modes", lambda m: m["x"] > F.col("score_right") - 30)
    least = F.greatest(F.lit(3.0), 0.3 * F.col("n_data"))
    before = F.filter("modes", lambda m: (m["x"] > F.col("name_left") + 60) & (m["x"] < F.col("score_left")))
    places = lambda modes: F.transform(modes, lambda m: m["x"])
    out = base.withColumns({"after": after, "before_x": F.array_max(F.transform(before, lambda m: F.struct(m["n"].alias("n"), (-m["seen"]).alias("seen"), m["x"].alias("x"))))["x"]})
    out = out.withColumns({"after_x": F.coalesce(F.array_min(places(F.filter("after", lambda m: m["n"] >= least))), F.array_min(places(F.col("after")))), "after_n": F.aggregate("after", F.lit(0).cast("long"), lambda n, m: n + m["n"])})
    follows = F.col("after_n") >= 0.5 * F.greatest(F.lit(1), F.col("n_data"))
    return out.withColumns({"owner_after": follows, "owner_x": F.when(follows, F.col("after_x")).otherwise(F.col("before_x"))}).where("owner_x is not null").drop("modes", "after")


def _letters(words: DataFrame) -> DataFrame:
    """Of each page where words with letters begin: ``name_left``, the first place, and ``modes``, every rounded place with its count and first word."""
    letters = words.where(~F.col("text").rlike(NUMBER) & F.col("text").rlike("[A-Za-z]"))
    counts = letters.groupBy(*PAGE, F.rint("x0").alias("x")).agg(F.count("*").alias("n"), F.min("word_seq").alias("seen"), F.min("x0").alias("left"))
    return counts.groupBy(*PAGE).agg(F.min("left").alias("name_left"), F.collect_list(F.struct("x", "n", "seen")).alias("modes"))


def _has(low: float, high: float, dot: bool) -> Column:
    """Whether a line has a number of a size within the score band."""
    def fits(w: Column) -> Column:
        v = F.when(w["text"].rlike(NUMBER), w["text"]).try_cast("double")
        ok = (v > low) & (v <= high) & w["x0"].between(F.col("score_left"), F.col("score_right"))
        return F.coalesce(ok & w["text"].contains(".") if dot else ok, F.lit(False))

    return F.exists("words", fits)


def agility(words: DataFrame, files: DataFrame, columns: DataFrame | None = None) -> DataFrame:
    """Rows of agility pages with an average and a speed, told apart by size, and owners on either side.

    Classes begin anew on each page; unprinted ranks count on. ``columns``
    replaces what ``agility_columns`` finds.
    """
    glued = layout.split_glued(words)
    lines = lines_of(glued)
    lines = lines.join(agility_columns(glued, lines) if columns is None else columns, PAGE).where((F.trim("line") != "") & ~is_noise("line"))
    lines = lines.withColumns({"average_here": _has(12, 100, False), "speed_here": _has(0, 12, True)})
    data = F.col("average_here") & F.col("speed_here")
    head = ~(F.col("average_here") | F.col("speed_here")) & ((F.col("line").rlike(AGILITY_CATEGORY) & (F.length("line") < 90)) | F.col("line").contains("of the Year"))
    lines = lines.withColumns({"data": data, "head": head})
    blocks = windows.header_blocks(lines, F.col("head"), agility_category("line"), PAGE, ["line_no"]).where("category is not null")
    blocks = blocks.where(F.col("data") | ~F.col("line").rlike(FOOTNOTE))
    keys = [*PAGE, "block"]
    numbers = F.filter(F.transform("words", lambda w: w["text"]), lambda t: t.rlike(NUMBER))
    average = F.try_element_at(F.filter(numbers, lambda t: (t.cast("double") > 12) & (t.cast("double") <= 100)), F.lit(1))
    speed = F.try_element_at(F.filter(numbers, lambda t: (t.cast("double") > 0) & (t.cast("double") <= 12) & t.contains(".")), F.lit(1))
    own = lambda x: F.any_value(F.when(F.col("data"), x), True)
    nearest = assign.nearest_among(keys, "line_top", "line_no", F.col("data"), within=40)
    pieces = blocks.withColumn("anchor", F.when(F.col("data"), F.col("line_no")).otherwise(nearest)).where("anchor is not null")
    places = ("category", "name_left", "owner_x", "owner_after", "score_left")  # the same on all lines of a block
    rows = pieces.groupBy(*keys, "anchor").agg(
        *(F.first(c).alias(c) for c in places), F.collect_list(F.struct("line_top", "words")).alias("pieces"), F.min_by(F.element_at("words", 1), F.struct("line_top", "line_no")).alias("lead"),
        own(short_decimal(average)).alias("score"), F.coalesce(own(short_decimal(speed)), F.lit("")).alias("score2"),
    )
    printed = F.when(F.col("lead.text").rlike(RANK) & (F.col("lead.x0") < F.col("name_left") + 30), F.regexp_extract("lead.text", RANK, 1)).try_cast("int")
    ranked = windows.continue_ranks(rows.withColumn("printed", printed), "printed", keys, ["anchor"])
    rank_word = F.when(F.col("printed").isNotNull(), F.col("lead.word_seq"))
    is_name = lambda w: (w["x0"] >= F.col("name_left") - 6) & (w["x0"] < F.when(F.col("owner_after"), F.col("score_left")).otherwise(F.col("owner_x") - 6))
    is_owner = lambda w: F.when(F.col("owner_after"), w["x0"] >= F.col("owner_x") - 6).otherwise((w["x0"] >= F.col("owner_x") - 6) & (w["x0"] < F.col("score_left")))
    said = ranked.withColumns({"dog": _said_in("pieces", lambda w: is_name(w) & ~F.coalesce(w["word_seq"] == rank_word, F.lit(False))), "owner": _said_in("pieces", is_owner)})
    return said.where("dog <> '' and score is not null").select(*PAGE, F.col("anchor").alias("line_no"), "category", F.col("run_rank").alias("rank"), F.lit("").alias("tie"), fix_glyphs("dog").alias("dog"), fix_glyphs("owner").alias("owner"), "score", "score2").join(files.select("file", "sport", "year", "quarter"), "file")


def labelled_columns(words: DataFrame, lines: DataFrame) -> DataFrame:
    """As ``agility_columns``, from the labels over the columns (the first 30 lines) and the owners' nearest strong edge."""
    heads = lines.where((F.col("line_no") < 30) & (F.size("words") <= 6)).select(*PAGE, F.explode("words").alias("w"))
    at = lambda pattern: F.min(F.when(F.col("w.text").rlike(pattern), F.col("w.x0")))
    labels = heads.groupBy(*PAGE).agg(at("(?i)^Owner").alias("owner_label"), F.least(at("(?i)^(Av|Score)"), at("(?i)^YPS")).alias("score_label"))
    band = layout.score_columns(words).join(labels, PAGE).where("owner_label is not null and score_label is not null").join(_letters(words), PAGE)
    band = band.withColumn("score_left", F.least(F.col("score_label") - 18, F.col("score_left")))
    band = band.withColumn("near", F.filter("modes", lambda m: m["x"].between(F.col("owner_label") - 55, F.col("owner_label") + 12)))
    top = F.array_max(F.transform("near", lambda m: m["n"]))
    strong = F.array_min(F.transform(F.filter("near", lambda m: m["n"] >= 0.4 * top), lambda m: m["x"]))
    nearest = F.array_min(F.transform("modes", lambda m: F.struct(F.abs(m["x"] - F.col("owner_label")).alias("d"), m["x"].alias("x"))))["x"]
    return band.withColumns({"owner_x": F.coalesce(strong, nearest), "owner_after": F.col("owner_label") > F.col("score_label")}).drop("modes", "near")


def standings(lines: DataFrame, files: DataFrame, *, limit: float = 10) -> DataFrame:
    """Rows of agility text lines (``file, line_no, line``) whose names may wrap over lines before the data.

    Ranks are printed, or counted among the unprinted of a class.
    """
    s = F.trim("line")
    rows = lines.withColumn("s", s).where((F.col("s") != "") & ~is_noise("s"))
    parts = F.filter(F.transform(F.split("s", r"\s{2,}"), lambda c: F.trim(c)), lambda c: c != "")
    rows = rows.withColumns({"parts": parts, "data": (F.size(parts) >= 2) & F.element_at(parts, -1).rlike(NUMBER)})
    head = ~F.col("data") & F.col("s").rlike(AGILITY_CLASS) & (F.length("s") < 170)
    lead = lambda k: F.regexp_extract("s", AGILITY_CLASS, k)
    label = F.concat(F.when(lead(1) != "", "Preferred ").otherwise(""), F.initcap(lead(2)))
    blocks = windows.header_blocks(rows.withColumn("head", head), F.col("head"), label, ["file"], ["line_no"]).where("category is not null")
    ends = F.col("data") | (F.col("s").rlike(AGILITY_LABELS) & ~F.col("s").rlike(AGILITY_CLASS))
    w = Window.partitionBy("file", "block").orderBy("line_no")
    blocks = blocks.withColumn("ends", ends)
    blocks = blocks.withColumn("entry", F.count_if("ends").over(w.rowsBetween(Window.unboundedPreceding, 0)) - F.col("ends").cast("int"))
    number = lambda c: c.rlike(NUMBER)
    tail = F.aggregate(F.reverse("parts"), F.struct(F.lit(0).alias("k"), F.lit(True).alias("on")), lambda a, c: F.struct((a["k"] + (a["on"] & number(c)).cast("int")).alias("k"), (a["on"] & number(c)).alias("on")), lambda a: a["k"])
    blocks = blocks.withColumn("k", tail)
    pending = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(~F.col("ends"), F.struct("line_no", "s"))).over(Window.partitionBy("file", "block", "entry"))), lambda p: p["s"]), " ")
    data = blocks.withColumn("pending", pending).where(F.col("data") & (F.size("parts") > F.col("k")))
    first = F.element_at("parts", 1)
    printed, after = F.regexp_extract(first, r"^(\d+)\.?\s+(.*)$", 1), F.regexp_extract(first, r"^(\d+)\.?\s+(.*)$", 2)
    data = data.withColumns({"printed": F.nullif(printed, F.lit("")).try_cast("int"), "own": F.when(printed != "", F.trim(after)).otherwise(first)})
    ranked = windows.continue_ranks(data, "printed", ["file", "block"], ["line_no"], rebase=False)
    score, speed = layout.assign_scores(F.slice("parts", F.size("parts") - F.col("k") + 1, F.col("k")), limit=limit)
    owners = F.array_join(F.slice("parts", 2, F.greatest(F.size("parts") - F.col("k") - 1, F.lit(0))), " / ")
    return ranked.select("file", "line_no", "category", F.col("run_rank").alias("rank"), F.lit("").alias("tie"), F.trim(F.concat_ws(" ", F.nullif("pending", F.lit("")), "own")).alias("dog"), owners.alias("owner"), score.alias("score"), speed.alias("score2")).join(files.select("file", "sport", "year", "quarter"), "file")


def route(files: DataFrame, lines: DataFrame, ranked_lines: DataFrame) -> DataFrame:
    """Which parser each file goes to: ``geometry``, ``agility`` (two candidates to choose from), ``text`` or ``positions``.

    Agility of ownerless years goes by labels; reports with "of the Year" in
    their first four lines, or scores before names, go by text.
    """
    yearly = lines.where("line_no < 4").groupBy("file").agg(F.bool_or(F.col("line").contains("of the Year")).alias("yearly"))
    second = layout.score_second(ranked_lines, ["file"])
    out = files.join(yearly, "file", "left").join(second, "file", "left")
    text = F.coalesce("yearly", F.lit(False)) | F.coalesce("score_second", F.lit(False))
    by = F.when((F.col("sport") == "Agility") & F.col("year").try_cast("int").isin(*quality.OWNERLESS_YEARS), "geometry").when(F.col("sport") == "Agility", "agility").when(text, "text").otherwise("positions")
    return out.withColumn("route", by).drop("yearly", "score_second")


def better(old: DataFrame, new: DataFrame) -> DataFrame:
    """Of two parses of each file the one with more valid agility rows, ties to the old."""
    both = old.withColumn("parser", F.lit(0)).unionByName(new.withColumn("parser", F.lit(1)), allowMissingColumns=True)
    valid = quality.is_valid(F.lit("Agility"), F.col("year").cast("string"), F.col("dog"), F.col("owner"), F.col("score"), F.col("score2"), owner_always=True)
    return quality.choose(both, ["file"], "parser", valid.cast("int"))
