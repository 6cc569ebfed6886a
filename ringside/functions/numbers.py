"""Numbers out of report text, with the rounding and casting rules of the standings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean_num(x: Column | str) -> Column:
    """A printed number without brackets and thousands separators: ``(1,277)`` gives ``1277``."""
    return F.trim(F.translate(col(x), "(),", ""))


def int_or_null(x: Column | str) -> Column:
    """The integer that a text is, else null."""
    return F.trim(col(x)).try_cast("int")


def int_raw(x: Column | str) -> Column:
    """The text of a value that is neither empty nor an integer (``8/3``), else null."""
    t = F.trim(col(x))
    return F.when((t != "") & t.try_cast("int").isNull(), t)


def num_or_null(x: Column | str) -> Column:
    """The number that a text is, else null."""
    return F.trim(col(x)).try_cast("double")


def prefix_real(x: Column | str) -> Column:
    """The number that a text begins with, 0.0 if it begins with none; null stays null."""
    head = F.regexp_extract(col(x).cast("string"), r"^\s*([-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d+)?)", 1)
    return F.when(col(x).isNotNull(), F.coalesce(head.try_cast("double"), F.lit(0.0)))


def loose_num(x: Column | str) -> Column:
    """The number that the digits, dots and minus signs of a text begin with, else null."""
    kept = F.regexp_replace(col(x).cast("string"), r"[^0-9.\-]", "")
    return F.regexp_extract(kept, r"^-?(?:\d+\.?\d*|\.\d+)", 0).try_cast("double")


def round_half_up(x: Column | str, places: int = 2) -> Column:
    """Rounded so that halves go up, alike in every engine."""
    scale = float(10**places)
    return F.floor(col(x) * scale + 0.5) / scale


def mean_of_cents(cents: Column, n: Column | int) -> Column:
    """The mean of n amounts whose sum is in whole cents, rounded half up from integers only."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.floor((cents * 2 + n) / (n * 2)) / 100.0


def cents(x: Column | str) -> Column:
    """An amount as whole cents."""
    return F.round(col(x) * 100).cast("long")


def speed(distance: Column | str, time: Column | str) -> Column:
    """Distance by time; null without either, or for a time of zero."""
    t = col(time)
    return F.when(t != 0, F.try_divide(col(distance), t))


def short_decimal(x: Column | str) -> Column:
    """At most two decimals, without trailing zeros: ``98.50`` gives ``98.5``, ``98.00`` gives ``98``."""
    text = F.format_string("%.2f", col(x).cast("double"))
    return F.when(col(x).isNotNull(), F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", ""))
