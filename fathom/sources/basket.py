"""Latest row of each instrument of a basket, within an age."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def basket(df: DataFrame, by: Sequence[str], time: str, order: Sequence[str], at: Column, max_age: Column) -> DataFrame:
    """Each key's latest row at or before ``at`` and no older than ``max_age``: one partial aggregation."""
    rows = df.where((F.col(time) <= at) & (F.col(time) >= at - max_age))
    best = F.max_by(F.struct(*(c for c in df.columns if c not in by)), F.struct(*order)).alias("_r")
    return rows.groupBy(*by).agg(best).select(*by, "_r.*")


def skew_exceeded(rows: DataFrame, time: str, most_seconds: float) -> DataFrame:
    """One row if the basket's times spread over more than the bound, else none."""
    spread = F.unix_timestamp(F.max(time)) - F.unix_timestamp(F.min(time))
    return rows.agg(spread.alias("spread_seconds")).where(F.col("spread_seconds") > most_seconds)
