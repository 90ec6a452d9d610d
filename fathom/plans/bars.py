"""OHLCV bars and daily series from event and order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def ohlcv(df: DataFrame, by: str, ts: str, value: str, tie: str, unit: str = "hour") -> DataFrame:
    """One bar per key and time bucket: first, highest, lowest and last value, and the number of values.

    First and last go by time, ties by ``tie``. One partial aggregation before the shuffle.
    """
    at = F.struct(F.col(ts), F.col(tie))
    return df.groupBy(F.col(by).alias("symbol"), F.date_trunc(unit, ts).cast("timestamp_ntz").alias("ts")).agg(
        F.min_by(value, at).alias("open"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.max_by(value, at).alias("close"),
        F.count("*").alias("volume"),
    )


def resample(bars: DataFrame, bucket, extra: dict | None = None) -> DataFrame:
    """Coarser bars: open first, high max, low min, close last, volume summed, and the aggregates of ``extra``."""
    return bars.groupBy("symbol", bucket.alias("bucket")).agg(
        F.min_by("open", "ts").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "ts").alias("close"),
        F.sum("volume").alias("volume"),
        *(v.alias(k) for k, v in (extra or {}).items()),
    )


def friday_week(day):
    """The Friday that ends the week of a day."""
    return F.next_day(F.date_sub(day, 1), "FRI")


def daily_totals(df: DataFrame, by: str, ts: str, value: str) -> DataFrame:
    """(symbol, date, value): sums a day."""
    return df.groupBy(F.col(by).alias("symbol"), F.to_date(ts).alias("date")).agg(F.sum(value).alias("value"))
