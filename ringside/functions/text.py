"""Names, owners, headers and keys out of report text."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col

# Words, patterns and names that the reports use.
NOISE = (
    r"(?i)SCORECARD|Trials |Results taken|Average of|January|No Dogs Eligible|^Page|^\d+\s*$|rankings based|based on the|"
    r"Springer Showcase|Springer of the Year|Rankings \d{4}|highest combined|Combined Open B/Utility"
)
COUNT_NOISE = r"(?i)SCORECARD|Results|compiled|Average|Springer|Rankings|Page|Owner|^\s*$|Trials|Combined Open|No Dogs"
HEADER_WORDS = (
    r"(?i)Novice|Open|Utility|Excellent|Master|Advanced|Beginner|Graduate|Versatility|Preferred|Combined|Optional|Wild Card|"
    r"Regular|Veteran|Brace|Team|Champion|Intermediate|High Triple|Triple|High Combined|Choice"
)
AGILITY_HEADER = r"(?i)^(Preferred\s+|Time\s*2\s*Beat|Premier\s+)?(Novice|Open|Excellent|Master|Veteran)\b"
SECTIONS = ("Breed - Dogs", "Breed - Bitches", "Group - Dogs", "Group - Bitches")
GLYPHS = {"(cid:415)": "ti", "(cid:425)": "tt", "(cid:431)": "ff"}
HONORIFICS = ("mr", "mrs", "ms", "dr", "miss")
SUFFIXES = ("jr", "sr", "ii", "iii", "iv", "v")
LEAD_TITLE = r"^(GCH[A-Z]?\d?|CH|DC|NOHS|FC|AFC)\b"
CORE_TITLES = (
    r"(?i)^(GCH[A-Z]?\d?|CH|DC|NAFC|FC|AFC|OTCH\d*|MACH\d*|PACH\d*|AGCH|RACH\d*|VCCH|"
    r"CD|CDX|UD|UDX\d*|OM\d*|OGM|GO|GN|VER|BN|PCD|PUD|RN|RA|RE|RAE\d*|RM\d*|RI|"
    r"NA|NAJ|OA|OAJ|AX|AXJ|MX[A-Z]?\d*|MJ[A-Z]?\d*|MF[A-Z]?\d*|XF|NF|OF|T2B\d*|"
    r"PAD|PJD|PDS|PJS|TQX|NAP|NJP|OAP|OJP|AXP|AJP|MXP\d*|MJP\d*|PAX\d*|MFP[A-Z]?|"
    r"JH|SH|MH|TD|TDX|FDC|CGC|CGCA|CGCU|TKN|TKI|TKA|TKE|TKP|ATT|BCAT|DCAT|FCAT|"
    r"VHMP|ACT\d?J?|FITB?|FITS?|FTN?|FTR?|SWN|SWA|SWE|SCN|SEN|SIN|SEE|SIA|SHDN|SBN|"
    r"DS|DJ|DJA|DN|RATN|RATO|RATCH|VCD\d|SEM|SBM|BM|STR|PJDP|PADP|MFPB|MFPS|TQXP|"
    r"T2BP\d*|MXPB\d*|MJPB\d*|MXPC|MJPC|II|III|IV|V)$"
)


def squash(x: Column | str) -> Column:
    """White space of any kind as one space, none at the ends."""
    return F.trim(F.regexp_replace(col(x), r"(?U)\s+", " "))


def plain(x: Column | str) -> Column:
    """No-break spaces as spaces, none at the ends; null as empty."""
    return F.trim(F.translate(F.coalesce(col(x).cast("string"), F.lit("")), " ", " "))


def fix_glyphs(x: Column | str) -> Column:
    """Ligature codes as letters; other codes go."""
    known = reduce(lambda c, kv: F.replace(c, F.lit(kv[0]), F.lit(kv[1])), GLYPHS.items(), col(x))
    return F.regexp_replace(known, r"\(cid:\d+\)", "")


def title_words(x: Column | str) -> Column:
    """Every run of letters capitalised, after hyphens and slashes too."""
    runs = F.regexp_extract_all(F.lower(col(x)), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda r: F.concat(F.upper(F.substring(r, 1, 1)), F.substring(r, 2, 1_000_000))), "")


def section_of(page_text: Column | str) -> Column:
    """The section that a page's text names, else null: the first of the four that fits."""
    out = F.lit(None).cast("string")
    for name in reversed(SECTIONS):
        kind, sex = name.split(" - ")
        out = F.when(col(page_text).rlike(rf"{kind} (?:Competition|Ranking[^\n]*?)\s*[-‐]\s*{sex}"), name).otherwise(out)
    return out


def is_table_header(line: Column | str) -> Column:
    """Whether a line heads a conformation table."""
    x = col(line)
    return x.contains("Rank") & x.contains("Owners") & (x.contains("Dog") | x.contains("Bitch"))


def is_noise(line: Column | str) -> Column:
    return col(line).rlike(NOISE)


def is_division(line: Column | str) -> Column:
    """Whether a line heads a division: capitals, with the word CLASSES."""
    x = col(line)
    return x.rlike(r"\bCLASSES\b") & (F.upper(x) == x)


def is_header(sport: Column | str, line: Column | str) -> Column:
    """Whether a (trimmed) line heads a class of its sport."""
    x = col(line)
    agility = x.contains("of the Year") | (x.rlike(AGILITY_HEADER) & (F.length(x) < 80))
    last = F.element_at(F.split(x, r"\s{2,}"), -1)
    other = (F.length(x) <= 70) & ~last.rlike(r"^\d+(\.\d+)?$") & x.rlike(HEADER_WORDS)
    return ~is_noise(x) & F.when(col(sport) == "Agility", agility).otherwise(other)


def category_label(sport: Column | str, line: Column | str, division: Column | str) -> Column:
    """The category that a header line names."""
    x = F.trim(col(line))
    agility = F.regexp_replace(x, r"(?i)\(Highest Average Score\)", " ")
    agility = F.regexp_replace(agility, r"(?i)Owner\(?s?\)?.*$", " ")
    agility = F.regexp_replace(agility, r"(?i)English Springer Spaniel", " ")
    agility = F.regexp_replace(agility, r"(?i)\bSpringers?\b|\bAgility\b|of the Year|Total\s+Score|Avg(?:erage)?\.?\s+Score|\bYPS\b", " ")
    agility = F.regexp_replace(F.regexp_replace(agility, r"\s+", " "), r"^[ \-–·]+|[ \-–·]+$", "")
    named = title_words(squash(x))
    super_ = F.trim(F.replace(F.replace(title_words(col(division)), F.lit(" Classes"), F.lit("")), F.lit(" Titling"), F.lit("")))
    obedience = F.when(F.coalesce(col(division), F.lit("")) != "", F.concat(super_, F.lit(": "), named)).otherwise(named)
    return F.when(col(sport) == "Agility", F.when(agility == "", "Overall").otherwise(agility)).when(col(sport) == "Obedience", obedience).otherwise(named)


def merged_category(sport: Column | str, category: Column | str) -> Column:
    """Categories that go by several names, under one."""
    c = squash(category)
    c = F.when(c.rlike("(?i)^High Combined"), "High Combined").when(c.rlike("(?i)^High Triple"), "High Triple").otherwise(c)
    c = F.when(col(sport) == "Rally", F.regexp_replace(c, "^Masters$", "Master")).when(col(sport) == "Agility", F.regexp_replace(c, " Agility$", "")).otherwise(c)
    return F.when(F.coalesce(c, F.lit("")) == "", "Overall").otherwise(c)


def name_words(x: Column | str) -> Column:
    """A key's words: lower case, letters a-z only, honorifics left out."""
    bare = F.regexp_replace(F.lower(plain(x)), r"[^a-z]+", " ")
    return F.filter(F.split(F.trim(bare), " "), lambda w: (w != "") & ~w.isin(*HONORIFICS))


def norm_key(x: Column | str) -> Column:
    """``name_words`` joined."""
    return F.array_join(name_words(x), " ")


def drop_suffixes(words: Column) -> Column:
    """Words without generation suffixes at the end, as long as two words stay."""
    last = F.aggregate(
        F.sequence(F.lit(1), F.greatest(F.size(words), F.lit(1))),
        F.size(words),
        lambda n, _: F.when((n > 2) & F.coalesce(F.try_element_at(words, n), F.lit("")).isin(*SUFFIXES), n - 1).otherwise(n),
    )
    return F.slice(words, 1, F.greatest(last, F.lit(0)))


def first_last(x: Column | str) -> Column:
    """First and last word of a name, empty for fewer than two words."""
    w = drop_suffixes(name_words(x))
    return F.when(F.size(w) >= 2, F.concat(F.element_at(w, 1), F.lit(" "), F.element_at(w, -1))).otherwise("")


def last_name(x: Column | str) -> Column:
    """The last name, capitalised."""
    w = drop_suffixes(name_words(x))
    last = F.when(F.size(w) > 0, F.element_at(w, -1)).otherwise("")
    return F.concat(F.upper(F.substring(last, 1, 1)), F.substring(last, 2, 1_000_000))


def owners_of(sport: Column | str, primary: Column, last: Column, primary_name: Column, others: list[Column]) -> Column:
    """The owners of a result row: in obedience the first is printed in two columns."""
    named = F.coalesce(F.when(plain(primary_name) != "", primary_name), primary)
    first = F.when(col(sport) == "Obedience", F.concat(plain(primary), F.lit(" "), plain(last))).otherwise(plain(named))
    return F.filter(F.transform(F.array(first, *map(plain, others)), lambda c: F.trim(c)), lambda o: o != "")


def name_core(x: Column | str) -> Column:
    """A dog's name without its titles before and after, as lower-case letters only; empty for titles alone."""
    bare = F.translate(F.translate(F.coalesce(col(x), F.lit("")), " ", " "), "’", "'")
    words = F.filter(F.split(F.trim(F.regexp_replace(bare, r"[^A-Za-z' &\-]", " ")), " +"), lambda w: w != "")
    start = F.struct(F.lit(0).alias("phase"), F.lit("").alias("core"))

    def step(state: Column, w: Column) -> Column:
        title = w.rlike(CORE_TITLES)
        phase = F.when((state["phase"] == 0) & title, 0).when((state["phase"] <= 1) & ~title, 1).otherwise(2)
        return F.struct(phase.alias("phase"), F.when(phase == 1, F.concat(state["core"], w)).otherwise(state["core"]).alias("core"))

    core = F.aggregate(words, start, step, lambda s: s["core"])
    return F.regexp_replace(F.lower(core), "[^a-z]", "")


def html_escape(x: Column | str) -> Column:
    """A text with ``&``, ``<`` and ``>`` written for HTML."""
    out = col(x).cast("string")
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(sign), F.lit(entity))
    return out


def rank_label(rank: Column | str, tie: Column | str) -> Column:
    """A rank as shown: ``3 (T)`` for a tie."""
    return F.concat(col(rank).cast("string"), F.when(F.coalesce(col(tie), F.lit("")) != "", " (T)").otherwise(""))


def lead_initials(name: Column | str, owner: Column | str) -> tuple[Column, Column]:
    """(name, owner) with owner initials at a name's start moved to the owner, if a real name follows."""
    n, o = col(name), F.coalesce(col(owner), F.lit(""))
    lead, rest = (F.regexp_extract(n, r"^((?:[A-Z]\.\s+)+)(\S.*)$", k) for k in (1, 2))
    moves = (lead != "") & (rest.rlike(LEAD_TITLE) | (F.length(rest) > 6))
    return F.when(moves, rest).otherwise(n), F.when(moves, F.trim(F.concat(F.trim(lead), F.lit(" "), o))).otherwise(o)


def inner_initial(name: Column | str, owner: Column | str) -> tuple[Column, Column]:
    """(name, owner) with the first starred initial inside a name moved to the owner's front."""
    n, o = col(name), F.coalesce(col(owner), F.lit(""))
    found = F.regexp_extract(n, r"\s*(\*[A-Z]\.)\s*", 1)
    where = F.regexp_extract(n, r"^(.*?)\s*\*[A-Z]\.", 1)
    tail = F.regexp_extract(n, r"^.*?\*[A-Z]\.\s*(.*)$", 1)
    return F.when(found != "", squash(F.concat(where, F.lit(" "), tail))).otherwise(n), F.when(found != "", F.trim(F.concat(found, F.lit(" "), o))).otherwise(o)


def year_in(line: Column | str) -> Column:
    """The year 2000-2029 (or ending in 2) that a line names, else null."""
    return F.nullif(F.regexp_extract(col(line), r"\b(20\d2|20[12]\d)\b", 1), F.lit("")).cast("int")


def split_row(line: Column | str) -> Column:
    """A data line as struct(rank, tie, dog, owner, scores), or null.

    Columns stand two or more spaces apart, either rank, dog, owner, scores or
    rank and score, dog, owners.
    """
    parts = F.filter(F.transform(F.split(F.trim(col(line)), r"\s{2,}"), lambda c: F.trim(c)), lambda c: c != "")
    n = F.size(parts)
    number = lambda c: F.coalesce(c, F.lit("")).rlike(r"^\d+(\.\d+)?$")
    at = lambda k: F.try_element_at(parts, k)
    trailing = F.aggregate(F.reverse(parts), F.struct(F.lit(0).alias("k"), F.lit(True).alias("on")), lambda s, c: F.struct((s["k"] + (s["on"] & number(c)).cast("int")).alias("k"), (s["on"] & number(c)).alias("on")), lambda s: s["k"])
    rest = n - trailing
    scores = F.slice(parts, rest + 1, F.greatest(trailing, F.lit(0)))
    head = F.array_join(F.slice(parts, 1, F.greatest(rest - 1, F.lit(0))), " ")
    lead, after = F.regexp_extract(head, r"^(\d+)\.?\s+(.*)$", 1), F.regexp_extract(head, r"^(\d+)\.?\s+(.*)$", 2)
    ranked = lead != ""
    dog = F.when(ranked, F.trim(after)).otherwise(F.trim(head))
    fields = lambda rank, tie, dog, owner, scores: F.struct(rank.cast("int").alias("rank"), tie.alias("tie"), dog.alias("dog"), owner.alias("owner"), scores.alias("scores"))
    first_rank, first_score = (F.regexp_extract(F.coalesce(at(F.lit(1)), F.lit("")), r"^(\d+)\.?\s+(\d+(?:\.\d+)?)$", k) for k in (1, 2))
    second = fields(F.nullif(first_rank, F.lit("")), F.lit(""), at(F.lit(2)), F.array_join(F.slice(parts, 3, 1_000_000), " / "), F.array(first_score))
    third = fields(F.nullif(lead, F.lit("")), F.when(ranked, "").otherwise("T"), dog, at(F.greatest(rest, F.lit(1))), scores)
    return F.when((n >= 3) & (first_rank != ""), second).when((n >= 2) & (trailing > 0) & (rest > 0) & (dog != ""), third)


def plausible_data_line(line: Column | str) -> Column:
    """Whether a line looks like a row of standings, by no parser's rules."""
    x = F.trim(col(line))
    parts = F.filter(F.split(x, r"\s{2,}"), lambda c: F.trim(c) != "")
    tail = F.coalesce(F.trim(F.try_element_at(parts, F.lit(-1))), F.lit(""))
    return ~x.rlike(COUNT_NOISE) & x.rlike("[A-Za-z]{3,}") & (((F.size(parts) >= 2) & tail.rlike(r"^\d+(\.\d+)?$")) | (x.rlike(r"^\d+\.?\s+\S") & x.rlike(r"\d+\.\d+|\b\d{2,4}\b")))


def detect_sport(cell: Column | str) -> Column:
    """The sport that a sheet's first cell names, the first of three that fits, else null."""
    x = plain(cell)
    return F.when(x.rlike("(?i)agility"), "Agility").when(x.rlike("(?i)obedience"), "Obedience").when(x.rlike("(?i)rally"), "Rally")


def date_key(x: Column | str) -> Column:
    """The day of a date or of a text that begins with one, as ``YYYY-MM-DD``."""
    return F.substring(F.trim(col(x).cast("string")), 1, 10)
