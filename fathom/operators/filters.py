"""Filters, guards and projections. Predicates are plain columns, so that they reach the scan."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class TooManyRows(ValueError):
    """A bounded read would have to truncate."""


def symbol_dates(df: DataFrame, symbols: Sequence[str], start, end, symbol: str = "symbol", date: str = "date") -> DataFrame:
    """Rows of the symbols, compared in upper case, between two dates inclusive; rows without a date go."""
    wanted = [s.upper() for s in symbols]
    return df.where(F.upper(F.col(symbol).cast("string")).isin(wanted) & F.col(date).between(start, end))


def guarded(df: DataFrame, limit: int, order: Sequence[str]) -> DataFrame:
    """``df`` in order if it has 1 to ``limit`` rows, else an error: never a silent cut. Reads at most limit + 1 rows."""
    n = df.limit(limit + 1).count()
    if n > limit:
        raise TooManyRows(f"more than {limit} rows")
    if not n:
        raise ValueError("no rows")
    return df.orderBy(*order)


def missing_symbols(df: DataFrame, symbols: Sequence[str], symbol: str = "symbol") -> DataFrame:
    """The wanted symbols that ``df`` has no row of."""
    wanted = df.sparkSession.createDataFrame([(s.upper(),) for s in symbols], "symbol string")
    return wanted.join(df.select(F.upper(symbol).alias("symbol")).distinct(), "symbol", "left_anti")


def latest_snapshot(df: DataFrame, by: Sequence[str], day: str) -> DataFrame:
    """Rows of each key's latest day, chosen before any other filter. The maxima are one small aggregation."""
    last = df.groupBy(*by).agg(F.max(day).alias(day))
    return df.join(last, [*by, day], "left_semi")


def side(col: str) -> Column:
    """c and p, in any case and padding, as call and put; anything else in lower case and trimmed as it is."""
    v = F.lower(F.trim(F.col(col)))
    return F.when(v == "c", "call").when(v == "p", "put").otherwise(v)


OPERATORS = {"=": lambda a, b: a == b, ">=": lambda a, b: a >= b, "<=": lambda a, b: a <= b}


def compare(col: str, op: str, value) -> Column:
    """One of the allowed comparisons; any other operator is an error."""
    if op not in OPERATORS:
        raise ValueError(f"operator {op!r} is not one of {', '.join(OPERATORS)}")
    return OPERATORS[op](F.col(col), F.lit(value))


def quoted(name: str) -> str:
    """A dotted name with each part in backticks."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The named columns; a missing one is an error that lists the choices."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"{', '.join(missing)} not among {', '.join(df.columns)}")
    return df.select(*(F.col(quoted(c)) for c in columns))


def standard_names(df: DataFrame) -> DataFrame:
    """Columns in snake case: whatever is no letter or digit becomes one underscore."""
    return df.toDF(*(re.sub(r"[^0-9a-zA-Z]+", "_", c).strip("_").lower() for c in df.columns))


def moneyness(df: DataFrame, kind: str, price: str = "price", strike: str = "strike", option: str = "option_type") -> DataFrame:
    """Options out of (``otm``) or in (``itm``) the money, strictly; calls and puts each by their own rule."""
    call, p, k = F.col(option) == "call", F.col(price), F.col(strike)
    otm, itm = (call & (k > p)) | (~call & (k < p)), (call & (k < p)) | (~call & (k > p))
    return df.where({"otm": otm, "itm": itm}[kind])


def surface(df: DataFrame, target: str, dte: tuple[int, int] = (0, 10_000), within: float | None = None, strikes: tuple[float, float] | None = None, volume: bool = False, oi: bool = False, kind: str | None = None) -> DataFrame:
    """Chain rows for a surface: positive target, expiry and strike bounds, distance of the strike from the price in parts, traded or held."""
    out = df.where(F.col("dte").between(*dte) & (F.col(target) > 0))
    if within is not None:
        out = out.where(F.abs(F.col("strike") / F.col("price") - 1) <= within)
    if strikes:
        out = out.where(F.col("strike").between(*strikes))
    if volume:
        out = out.where(F.col("volume") > 0)
    if oi:
        out = out.where(F.col("open_interest") > 0)
    return moneyness(out, kind) if kind else out


def screen(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Rows whose columns are within their bounds; a null passes."""
    for col, (lo, hi) in bounds.items():
        v = F.col(col)
        df = df.where(v.isNull() | ((v >= lo) if lo is not None else F.lit(True)) & ((v <= hi) if hi is not None else F.lit(True)))
    return df


def text_search(df: DataFrame, text: str, columns: Sequence[str]) -> DataFrame:
    """Rows with the text in any of the columns, whatever the case."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.lower(c), F.lit(text.lower())), F.lit(False))
    return df.where(hit)


BASES = ("unadjusted", "split", "total")


def adjusted(df: DataFrame, basis: str, factors: dict[str, str]) -> DataFrame:
    """Prices on a basis: OHLC times the basis' factor column, no volume-weighted price on an adjusted basis.

    ``factors`` names the factor column of each adjusted basis. See :func:`adjustment_faults` for what to refuse.
    """
    if basis not in BASES:
        raise ValueError(f"basis {basis!r} is not one of {', '.join(BASES)}")
    if basis == "unadjusted":
        return df
    k = F.col(factors[basis])
    return df.withColumns({c: F.col(c) * k for c in ("open", "high", "low", "close")} | ({"vwap": F.lit(None).cast("double")} if "vwap" in df.columns else {}))


def adjustment_faults(df: DataFrame, keys: Sequence[str], factor: str) -> DataFrame:
    """(keys, ``fault``) of what an adjustment refuses: a factor that is missing or not positive, a key twice."""
    n = F.count("*").over(Window.partitionBy(*keys))
    fault = F.when(F.col(factor).isNull(), "missing_factor").when(F.col(factor) <= 0, "factor_not_positive").when(n > 1, "duplicate_key")
    return df.select(*keys, fault.alias("fault")).where("fault IS NOT NULL").distinct()


def numeric_only(df: DataFrame) -> DataFrame:
    kinds = ("int", "bigint", "smallint", "tinyint", "float", "double")
    return df.select(*(c for c, t in df.dtypes if t in kinds or t.startswith("decimal")))


def present_rows(df: DataFrame, columns: Sequence[str], how: str = "all") -> DataFrame:
    """Rows that are not null in ``all`` (or ``any``) of the columns; columns never go."""
    return df.na.drop(how="any" if how == "all" else "all", subset=list(columns))


def quality(quarantine: Sequence[Column], conditional: Sequence[Column]) -> Column:
    """quarantine before conditional before clean; a null flag counts as set."""

    def any_of(flags: Sequence[Column]) -> Column:
        out = F.lit(False)
        for f in flags:
            out = out | F.coalesce(f, F.lit(True))
        return out

    return F.when(any_of(quarantine), "quarantine").when(any_of(conditional), "conditional").otherwise("clean")


def lexical_decimal(col: str, scale: int = 18) -> Column:
    """A decimal written plainly (sign, digits, at most ``scale`` decimals), or null."""
    text = F.col(col)
    return F.when(text.rlike(rf"^-?[0-9]{{1,20}}(\.[0-9]{{1,{scale}}})?$"), F.expr(f"try_cast(`{col}` AS decimal(38, {scale}))"))


def ohlc_ordered(o="open", h="high", low="low", c="close") -> Column:
    """Whether the low is least and the high greatest."""
    return (F.col(low) <= F.least(o, c)) & (F.col(h) >= F.greatest(o, c))


def percent_to_ratio(col: str) -> Column:
    """An exact hundredth: narrowed to 16 decimals first, so that the product keeps all 18."""
    return F.col(col).cast("decimal(34,16)") * F.lit("0.01").cast("decimal(3,2)")
