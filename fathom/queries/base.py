"""What query modules share: registration, base tables and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathom.plans.bars import daily_totals, ohlcv
from fathom.session import table

Query = Callable[[SparkSession, str], DataFrame]
PLACES = 6


class Registry:
    """Collects a module's queries and SQL by the function's name."""

    def __init__(self):
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def __call__(self, sql: str | None = None, name: str | None = None):
        def add(fn: Query) -> Query:
            key = name or fn.__name__
            self.queries[key] = fn
            if sql:
                self.sql[key] = sql
            return fn

        return add


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars per event type."""
    return ohlcv(table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value"), "event_type", "ts", "value", "event_id")


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order totals a day and priority."""
    return daily_totals(table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate", "o_totalprice")


def rounded(df: DataFrame, places: int = PLACES) -> DataFrame:
    """Doubles rounded alike in both engines, and -0.0 made 0.0."""
    return df.select(*((F.round(f"`{c}`", places) + F.lit(0.0)).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes))


BARS = """bars AS (
    SELECT event_type AS symbol, date_trunc('hour', ts) AS ts, first(value ORDER BY ts, event_id) AS open, max(value) AS high,
           min(value) AS low, last(value ORDER BY ts, event_id) AS close, count(*) AS volume
    FROM events GROUP BY 1, 2)"""
DAILY = """daily AS (
    SELECT o_orderpriority AS symbol, CAST(o_orderdate AS DATE) AS date, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2)"""


def r(expr: str, name: str | None = None, places: int = PLACES) -> str:
    """A rounded SQL column."""
    return f"round({expr}, {places}) + 0.0 AS {name or expr}"
