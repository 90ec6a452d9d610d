"""Joins: as-of, nearest, bitemporal, validated, aligned. Equi-joins are left to the optimizer."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SMALL = 10_000_000  # bytes by the optimizer's own estimate; anything above it is shuffled


def asof(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, values: Sequence[str], tie: str | None = None) -> DataFrame:
    """Left rows with ``values`` of the latest right row at or before them, null if there is none.

    Both sides are stacked and sorted by key and time once, right rows first on ties, and the last right
    row is carried on. No range join: the cost is one shuffle and sort of both sides. Of right rows at one
    time that with the greatest ``tie`` counts.
    """
    carried = F.struct(*values)
    l = left.withColumns({"_t": F.col(left_on), "_side": F.lit(1), "_row": F.struct(*left.columns), "_v": F.lit(None), "_tie": F.lit(None).cast("long")})
    r = right.select(*by, F.col(right_on).alias("_t"), F.lit(0).alias("_side"), carried.alias("_v"), (F.col(tie).cast("long") if tie else F.lit(0).cast("long")).alias("_tie"))
    l = l.select(*by, "_t", "_side", F.lit(None).cast(r.schema["_v"].dataType).alias("_v"), "_tie", "_row")
    r = r.withColumn("_row", F.lit(None).cast(l.schema["_row"].dataType))
    w = Window.partitionBy(*by).orderBy("_t", "_side", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    out = l.unionByName(r).withColumn("_v", F.last("_v", ignorenulls=True).over(w)).where("_side = 1")
    return out.select("_row.*", *(F.col(f"_v.{v}").alias(v) for v in values))


def asof_bucketed(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, values: Sequence[str], bucket: str = "day") -> DataFrame:
    """As :func:`asof`, for keys whose rows are too many for one task: work is cut by (key, time bucket).

    Each bucket's last right row is carried over whole buckets on a small table; inside a bucket the stacked
    window runs over that bucket's rows alone. Whole rows are carried, so a null value of the latest row stays null. Right rows
    of one time should be unique.
    """
    at = lambda c: F.date_trunc(bucket, F.col(c))
    latest = right.groupBy(*by, at(right_on).alias("_b")).agg(F.max_by(F.struct(*values), right_on).alias("_last"))
    buckets = left.select(*by, at(left_on).alias("_b")).distinct().withColumn("_last", F.lit(None).cast(latest.schema["_last"].dataType)).withColumn("_need", F.lit(1))
    w = Window.partitionBy(*by).orderBy("_b", F.col("_need").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = buckets.unionByName(latest.withColumn("_need", F.lit(0))).withColumn("_carry", F.last("_last", ignorenulls=True).over(w)).where("_need = 1").select(*by, "_b", "_carry")
    rows = right.withColumns({"_b": at(right_on), "_met": F.struct(*values)})
    inner = asof(left.withColumn("_b", at(left_on)), rows, [*by, "_b"], left_on, right_on, ["_met"])
    out = inner.join(carry, [*by, "_b"], "left").withColumn("_met", F.coalesce("_met", "_carry"))
    return out.select(*left.columns, *(F.col(f"_met.{v}").alias(v) for v in values))


def asof_or_nearest(left: DataFrame, right: DataFrame, by: Sequence[str], left_on: str, right_on: str, value: str) -> DataFrame:
    """The latest value at or before, else the first one after."""
    before = asof(left, right, by, left_on, right_on, [value])
    first = right.groupBy(*by).agg(F.min_by(value, right_on).alias("_first"))
    return before.join(first, list(by), "left").withColumn(value, F.coalesce(value, "_first")).drop("_first")


def known_at(df: DataFrame, by: Sequence[str], known: str, clock, order: Sequence[str]) -> DataFrame:
    """Each key's latest row among those known by ``clock``; ``order`` decides, greatest first."""
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*(F.col(c).desc() for c in order)))
    return df.where(F.col(known) <= clock).withColumn("_n", rank).where("_n = 1").drop("_n")


def bitemporal(left: DataFrame, right: DataFrame, on: Sequence[str], left_valid: str, right_valid: str, right_known: str, decided: str, value: str) -> DataFrame:
    """The right row of the key that is latest by valid time, valid and known by the left row's decision time.

    Equal left rows are met once and come back as often as they are there.
    """
    keys = [F.col(f"l.{k}") == F.col(f"r.{k}") for k in on]
    l, r = left.groupBy(*left.columns).agg(F.count("*").cast("int").alias("_times")).alias("l"), right.alias("r")
    met = l.join(r, [*keys, F.col(f"r.{right_valid}") <= F.col(f"l.{left_valid}"), F.col(f"r.{right_known}") <= F.col(f"l.{decided}")], "left")
    latest = F.max_by(F.col(f"r.{value}"), F.struct(f"r.{right_valid}", f"r.{right_known}", f"r.{value}"))
    one = met.groupBy(*(F.col(f"l.{c}").alias(c) for c in [*left.columns, "_times"])).agg(latest.alias(value))
    return one.select(*left.columns, value, F.explode(F.array_repeat(F.lit(0), F.col("_times"))).alias("_n")).drop("_n")


def validated_left(left: DataFrame, right: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(left join with ``matched``, keys that the right side has more than once): the second must be empty."""
    twice = right.groupBy(*on).agg(F.count("*").alias("n")).where("n > 1")
    flagged = left.join(right.withColumn("matched", F.lit(True)), list(on), "left").withColumn("matched", F.coalesce("matched", F.lit(False)))
    return flagged, twice


def first_of_group(df: DataFrame, by: Sequence[str], value: str, order: Sequence[str], name: str) -> DataFrame:
    """Each row with its group's first value: a window, where a group table and a join would do the same twice."""
    return df.withColumn(name, F.first(value).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def complete_grid(calendar: DataFrame, instruments: DataFrame, bars: DataFrame, on: Sequence[str]) -> DataFrame:
    """Every (instrument, session) with its bar and ``present``; the grid is the product by definition, and its size is the result's."""
    grid = instruments.crossJoin(calendar)
    return grid.join(bars.withColumn("present", F.lit(True)), list(on), "left").withColumn("present", F.coalesce("present", F.lit(False)))


def name_pairs(df: DataFrame, name: str) -> DataFrame:
    """Every two different names, smaller first. Names are few: columns or instruments of a study."""
    names = df.select(name).distinct()
    return names.select(F.col(name).alias("a")).join(names.select(F.col(name).alias("b")), F.col("a") < F.col("b"))


def forward_filled(wide_keys: DataFrame, long: DataFrame, by: str, time: str, value: str) -> DataFrame:
    """Long rows at every common time with the last known value; times before a key's first value go."""
    times = long.select(time).distinct()
    grid = wide_keys.crossJoin(times).join(long, [by, time], "left")
    w = Window.partitionBy(by).orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    return grid.withColumn(value, F.last(value, ignorenulls=True).over(w)).where(F.col(value).isNotNull())


def interpolated(df: DataFrame, by: Sequence[str], time: str, value: str) -> DataFrame:
    """Gaps filled on the straight line between the known rows around them, by row; ends stay null."""
    w = Window.partitionBy(*by).orderBy(time)
    df = df.withColumn("_i", F.row_number().over(w)).withColumn("_k", F.when(F.col(value).isNotNull(), F.struct("_i", F.col(value).alias("v"))))
    df = df.withColumns({"_a": F.last("_k", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "_z": F.first("_k", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    line = F.col("_a.v") + (F.col("_z.v") - F.col("_a.v")) * (F.col("_i") - F.col("_a._i")) / (F.col("_z._i") - F.col("_a._i"))
    return df.withColumn(value, F.coalesce(value, line)).drop("_i", "_k", "_a", "_z")
