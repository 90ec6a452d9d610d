"""Window frames over ordered series, with pandas' ``min_periods`` rule."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

By = Sequence[str]


def ordered(by: By, order: Sequence[str]) -> WindowSpec:
    """One series a key, in order. ``order`` should end in a unique column, so that ties have one order."""
    return Window.partitionBy(*by).orderBy(*order)


def last_n(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def so_far(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, 0)


def full(value: Column, seen: Column | str, w: WindowSpec, n: int) -> Column:
    """``value`` over the last ``n`` rows, null until ``n`` non-null values of ``seen`` are in the frame."""
    frame = last_n(w, n)
    return F.when(F.count(seen).over(frame) == n, value.over(frame))


def shifted(value: Column, w: WindowSpec, offset: int) -> Column:
    return F.lag(value, offset).over(w) if offset else value


def linear_weighted(x: Column, w: WindowSpec, n: int) -> Column:
    """Mean of the last ``n`` values weighted 1 (oldest) to n (newest)."""
    values = F.collect_list(x).over(last_n(w, n))
    weighted = F.aggregate(F.transform(values, lambda v, i: v * (i + 1)), F.lit(0.0), lambda a, v: a + v)
    return F.when(F.size(values) == n, weighted / (n * (n + 1) / 2))


def returns(x: Column, w: WindowSpec) -> Column:
    """Simple return on the row before; null on the first row or where that value is zero."""
    before = F.lag(x).over(w)
    return F.try_divide(x, before) - 1


def log_return(x: Column, w: WindowSpec) -> Column:
    return F.ln(x / F.lag(x).over(w))
