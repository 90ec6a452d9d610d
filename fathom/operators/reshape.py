"""Sorting, top-k, set operations and reshaping."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, by: Sequence[str], score: str, ident: str, k: int) -> DataFrame:
    """The ``k`` best of each group, ties by the smaller id. Spark keeps k rows a group and task before the shuffle."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(ident)))
    return df.withColumn("rank", rank).where(F.col("rank") <= k)


def first_of(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row of each group, the first in order: an aggregation that combines before the shuffle."""
    rest = [c for c in df.columns if c not in by]
    return df.groupBy(*by).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_r")).select(*by, "_r.*")


def category_key(column: str, order: Sequence[str]) -> Column:
    """Place of a value in a fixed order, after all of it for others."""
    table = F.create_map(*(F.lit(x) for x in chain.from_iterable((v, i) for i, v in enumerate(order))))
    return F.coalesce(F.try_element_at(table, F.col(column)), F.lit(len(order)))


def world_last(column: str, world: str = "World") -> Column:
    """Sort key that puts the total after everything."""
    return F.when(F.col(column) == world, F.lit(float("inf"))).otherwise(F.lit(0.0))


UNITS = {"day": 1 / 30, "week": 7 / 30, "month": 1, "year": 12}


def duration_months(label: Column) -> Column:
    """Months of a label such as ``year_5`` or ``month_3``; null for another text."""
    n, out = F.regexp_extract(label, r"_([0-9]+)$", 1).try_cast("double"), F.lit(None).cast("double")
    for unit, months in UNITS.items():
        out = F.when(F.regexp_extract(label, r"^([a-z]+)_", 1) == unit, n * months).otherwise(out)
    return out


def page_after(df: DataFrame, key: str, last, size: int) -> DataFrame:
    """The page of ``size`` rows after a key: a filter and a bounded sort, never an offset."""
    return (df if last is None else df.where(F.col(key) > last)).orderBy(key).limit(size)


def same_members(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one side has, with the side; empty for equal sets."""
    left, right = a.exceptAll(b).withColumn("side", F.lit("left")), b.exceptAll(a).withColumn("side", F.lit("right"))
    return left.unionByName(right)


def lost(previous: DataFrame, now: DataFrame, key: str) -> DataFrame:
    """Keys that were there and are no longer: a shrinking universe."""
    return previous.select(key).distinct().join(now.select(key).distinct(), key, "left_anti")


def missing_times(df: DataFrame, by: str, time: str, step: str) -> DataFrame:
    """Expected times between each key's first and last that have no row."""
    ends = df.groupBy(by).agg(F.min(time).alias("a"), F.max(time).alias("z"))
    expected = ends.select(by, F.explode(F.expr(f"sequence(a, z, interval {step})")).alias(time))
    return expected.join(df.select(by, time), [by, time], "left_anti")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value") -> DataFrame:
    return df.unpivot(list(ids), list(values), name, value)


def pivot(df: DataFrame, ids: Sequence[str], name: str, names: Sequence[str], value: str) -> DataFrame:
    """Long to wide with the columns given, so that no job has to look for them."""
    return df.groupBy(*ids).pivot(name, list(names)).agg(F.first(value, ignorenulls=True))


def transposed(df: DataFrame, name: str, names: Sequence[str]) -> DataFrame:
    """Rows become columns: one row for each other column of ``df``."""
    others = [c for c in df.columns if c != name]
    return pivot(melt(df, [name], others, "field", "value"), ["field"], name, names, "value")


def upsert(current: DataFrame, changes: DataFrame, key: Sequence[str], replace: bool = True) -> DataFrame:
    """Changes applied to a table by key: replacing rows, or only adding those it lacks."""
    if replace:
        return current.join(changes, list(key), "left_anti").select(*current.columns).unionByName(changes)
    return current.unionByName(changes.join(current, list(key), "left_anti").select(*current.columns))
