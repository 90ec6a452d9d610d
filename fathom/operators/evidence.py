"""Evidence pipelines: revisions, classification with reasons, conservation checks, planning of chunks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.operators.aggregates import row_hash


def revisions(df: DataFrame, key: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Adds ``values_hash``, ``revision`` (from 1) and ``duplicate``: a row whose hash is that of the one before is no new revision."""
    w = Window.partitionBy(*key).orderBy(*order)
    df = df.withColumn("values_hash", row_hash(values))
    changed = ~F.col("values_hash").eqNullSafe(F.lag("values_hash").over(w))
    df = df.withColumn("duplicate", ~changed)
    return df.withColumn("revision", F.sum((~F.col("duplicate")).cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)))


def clock_faults(df: DataFrame, key: Sequence[str], order: Sequence[str], clock: str) -> DataFrame:
    """Rows whose clock is behind that of the row before them: must be empty."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_before", F.lag(clock).over(w)).where(F.col(clock) < F.col("_before")).drop("_before")


def pointer(events: DataFrame, by: Sequence[str], at, clock: str = "known_at", order: str = "event_id", value: str = "snapshot_id") -> DataFrame:
    """What each key's latest event known by ``at`` points to; a withdrawal points to null."""
    return events.where(F.col(clock) <= at).groupBy(*by).agg(F.max_by(value, F.struct(clock, order)).alias(value))


def classified(df: DataFrame, rules: Sequence[tuple[str, Column]], outside: Column | None = None) -> DataFrame:
    """Adds ``reason`` (the first rule that fails, null if none) and ``disposition``: accepted, rejected or outside."""
    reason = F.lit(None).cast("string")
    for name, failed in reversed(rules):
        reason = F.when(F.coalesce(failed, F.lit(True)), name).otherwise(reason)
    state = F.when(F.col("reason").isNull(), "accepted").otherwise("rejected")
    return df.withColumn("reason", reason).withColumn("disposition", F.when(outside, "outside").otherwise(state) if outside is not None else state)


def flags(**conditions: Column) -> Column:
    """The names of the conditions that hold, sorted."""
    return F.array_sort(F.array_compact(F.array(*(F.when(c, F.lit(k)) for k, c in conditions.items()))))


def whole_day(df: DataFrame, day: str, error: Column) -> DataFrame:
    """Adds ``day_ok``: a day with one row in error is refused as a whole. The days are one small aggregation."""
    bad = df.groupBy(day).agg((~F.bool_or(F.coalesce(error, F.lit(True)))).alias("day_ok"))
    return df.join(bad, day)


def reconciliation(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per key: rows in, accepted, rejected, outside, and whether they add up."""
    n = {k: F.count_if(F.col("disposition") == k) for k in ("accepted", "rejected", "outside")}
    out = df.groupBy(*by).agg(F.count("*").alias("rows"), *(v.alias(k) for k, v in n.items()))
    return out.withColumn("balanced", F.col("rows") == F.col("accepted") + F.col("rejected") + F.col("outside"))


def conservation(variants: DataFrame, source: DataFrame, count: str) -> DataFrame:
    """(observed, source, conserved): the sum of a count column against the rows it came from."""
    a = variants.agg(F.sum(count).alias("observed"))
    return a.crossJoin(source.agg(F.count("*").alias("source"))).withColumn("conserved", F.col("observed") == F.col("source"))


def bucket_of(code: str, buckets: int = 32) -> Column:
    """Bucket of a code by the number in its last six characters; null where they are none."""
    return F.pmod(F.right(F.col(code).cast("string"), F.lit(6)).try_cast("int"), F.lit(buckets))


def chunks(df: DataFrame, start: str, end: str, days: int) -> DataFrame:
    """[chunk_start, chunk_end) pieces of each row's [start, end), at most ``days`` long."""
    at = F.explode(F.sequence(F.col(start), F.date_sub(end, 1), F.expr(f"interval {days} days"))).alias("chunk_start")
    return df.where(F.col(start) < F.col(end)).select("*", at).withColumn("chunk_end", F.least(F.date_add("chunk_start", days), end))


def expected_bars(calendar: DataFrame, step: str) -> DataFrame:
    """One row per expected bar of each session's [open, close), sessions over midnight included."""
    return calendar.select("session", F.explode(F.expr(f"filter(sequence(open, close, interval {step}), x -> x < close)")).alias("ts"))


def prefix_within(df: DataFrame, by: Sequence[str], order: Sequence[str], cost: str, most) -> DataFrame:
    """The first rows of each key whose running cost stays within the bound."""
    run = F.sum(cost).over(Window.partitionBy(*by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("running", run).where(F.col("running") <= most)


OCC = r"^([A-Z]{1,6}) *([0-9]{6})([CP])([0-9]{8})$"


def occ_fields(symbol: Column) -> dict[str, Column]:
    """Root, expiration, side and strike of an OCC option symbol; null for another text."""
    good = symbol.rlike(OCC)
    part = lambda i: F.when(good, F.regexp_extract(symbol, OCC, i))
    return {"root": part(1), "expiration": F.try_to_date(part(2), "yyMMdd"), "option_type": F.when(part(3) == "C", "call").when(part(3) == "P", "put"), "strike": part(4).cast("double") / 1000}


def occ_agrees(symbol: Column, **fields: Column) -> Column:
    """Whether a symbol says what the named fields say."""
    made, out = occ_fields(symbol), F.lit(True)
    for name, value in fields.items():
        out = out & made[name].eqNullSafe(value)
    return out


def quote_flags(bid: str, ask: str, time: Column, now: Column, stale_seconds: int) -> Column:
    """Reasons against a quote, sorted: missing, zero, negative, crossed, stale, future."""
    b, a, age = F.col(bid), F.col(ask), F.unix_timestamp(now) - F.unix_timestamp(time)
    return flags(missing=b.isNull() | a.isNull(), zero=(b == 0) | (a == 0), negative=(b < 0) | (a < 0), crossed=b > a, stale=age > stale_seconds, future=age < 0)


def calendar_faults(previous: DataFrame, now: DataFrame, day: str = "session") -> DataFrame:
    """Why a new calendar is refused: a session twice, one on a weekend, one lost within the overlap, a smaller span."""
    twice = now.groupBy(day).agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate").alias("fault"), F.col(day))
    weekend = now.where(F.dayofweek(day).isin(1, 7)).select(F.lit("weekend").alias("fault"), F.col(day)).distinct()
    ends = now.agg(F.min(day).alias("a"), F.max(day).alias("z"))
    old = previous.crossJoin(F.broadcast(ends))
    gone = old.where(F.col(day).between(F.col("a"), F.col("z"))).join(now.select(day).distinct(), day, "left_anti").select(F.lit("lost").alias("fault"), F.col(day))
    shrunk = old.where((F.col(day) < F.col("a")) | (F.col(day) > F.col("z"))).select(F.lit("shrunk").alias("fault"), F.col(day))
    return twice.unionByName(weekend).unionByName(gone).unionByName(shrunk)
