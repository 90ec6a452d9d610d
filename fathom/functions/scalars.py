"""Scalar functions as columns: text, dates, numbers, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def snake_case(text: Column) -> Column:
    """CamelCase, spaces and signs to lower-case words joined by underscores."""
    split = F.regexp_replace(F.regexp_replace(text, r"([a-z0-9])([A-Z])", "$1_$2"), r"([A-Z]+)([A-Z][a-z])", "$1_$2")
    return F.lower(F.trim(F.regexp_replace(split, r"[^0-9a-zA-Z]+", "_"), F.lit("_")))


def magnitude(text: Column) -> Column:
    """``1.2B`` as 1.2e9, ``5%`` as 0.05; null for another text."""
    number = F.regexp_extract(text, r"^(-?[0-9]+(?:\.[0-9]+)?)([KMBT%]?)$", 1).try_cast("double")
    unit = F.regexp_extract(text, r"^(-?[0-9]+(?:\.[0-9]+)?)([KMBT%]?)$", 2)
    return number * F.when(unit == "K", 1e3).when(unit == "M", 1e6).when(unit == "B", 1e9).when(unit == "T", 1e12).when(unit == "%", 0.01).otherwise(1.0)


def finite(x: Column) -> Column:
    """The number, or null if it is NaN or infinite."""
    return F.when(~F.isnan(x) & (F.abs(x) < float("inf")), x)


def zero_as_null(x: Column) -> Column:
    return F.nullif(F.nanvl(x, F.lit(None).cast("double")), F.lit(0.0))


def ln(value: Column) -> Column:
    """The natural logarithm: minus infinity of zero, NaN of what is below."""
    return F.when(value == 0, F.lit(float("-inf"))).when(value < 0, F.lit(float("nan"))).otherwise(F.ln(value))


def _scaled(x: Column, places: int, whole) -> Column:
    """Rounds the product with the power of ten, as SQL does with doubles; ``round`` and ``bround`` take the shortest decimal text, which has other ties."""
    power = F.lit(10.0**places)
    moved = x * power
    return F.when(F.isnan(moved) | (F.abs(moved) == float("inf")), x).otherwise(whole(moved) / power)


def half_up(x: Column, places: int) -> Column:
    """A double rounded half away from zero."""
    return _scaled(x, places, F.round)


def half_even(x: Column, places: int) -> Column:
    """A double rounded half to even."""
    return _scaled(x, places, F.rint)


def three_halves(x: Column) -> Column:
    """``x`` to the power of 1.5, as x times its root with the errors of both added (Dekker's products); Java's ``pow`` is off in the last bit of one result in ten."""

    def halves(a: Column) -> tuple[Column, Column]:
        high = a * F.lit(134217729.0)
        high = high - (high - a)
        return high, a - high

    def error(a: Column, b: Column, product: Column) -> Column:
        (ah, al), (bh, bl) = halves(a), halves(b)
        return ah * bh - product + ah * bl + al * bh + al * bl

    root = F.sqrt(x)
    square, product = root * root, x * root
    missing = (x - square - error(root, root, square)) / (root * 2)
    return F.when((x > 1e-100) & (x < 1e150), product + (error(x, root, product) + x * missing)).otherwise(F.pow(x, F.lit(1.5)))


def sign(x: Column) -> Column:
    """-1, 0 or 1 as a double; 0 of NaN, as SQL has it."""
    return F.when(F.isnan(x), F.lit(0.0)).otherwise(F.signum(x))


def quarter_end(day: Column) -> Column:
    return F.last_day(F.add_months(F.trunc(day, "quarter"), 2))


def slot_of(ts: Column, start: Column, seconds: int) -> Column:
    """Number of the tumbling slot since a start."""
    return F.floor((F.unix_timestamp(ts) - F.unix_timestamp(start)) / seconds)


def iso_week(day: Column) -> Column:
    """``2024-W05`` by ISO weeks: the year is that of the week's Thursday."""
    thursday = F.date_add(F.trunc(day, "week"), 3)
    return F.concat(F.year(thursday), F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def local_to_utc(ts: Column, zone: str) -> Column:
    """UTC of a local wall time, null where the clock skipped it (the way back doesn't return to it)."""
    utc = F.to_utc_timestamp(ts, zone)
    return F.when(F.from_utc_timestamp(utc, zone) == ts.cast("timestamp"), utc)


def similar(a: Column, b: Column) -> Column:
    """1 for equal texts down to 0: one less the edit distance over the longer length."""
    return 1 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))


def strip_tags(html: Column) -> Column:
    """The text of a page: scripts, styles and tags out, white space collapsed."""
    plain = F.regexp_replace(F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " "), r"(?s)<[^>]*>", " ")
    return F.trim(F.regexp_replace(plain, r"[ \t\r\n]+", " "))


def canonical_json(*columns: str) -> Column:
    """An object of the columns in the order given, nulls kept, as one pinned text."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
