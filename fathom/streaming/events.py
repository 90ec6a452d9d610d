"""Event-time operators over streams (and, but for the sinks, over tables alike).

Every stateful operator needs a watermark; rows older than it are dropped by Spark and counted in its progress.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from fathom.session import scratch


def files(spark: SparkSession, folder: str, schema: T.StructType, kind: str = "parquet", pattern: str | None = None, per_batch: int | None = None) -> DataFrame:
    """A file stream; ``per_batch`` files a batch hold back a source that is ahead of its sink."""
    reader = spark.readStream.schema(schema).format(kind)
    for name, value in (("pathGlobFilter", pattern), ("maxFilesPerTrigger", per_batch)):
        reader = reader.option(name, value) if value else reader
    return reader.load(folder)


def run_to_end(df: DataFrame, mode: str = "append", tag: str = "stream") -> DataFrame:
    """All that a stream gives until its source is read up, through an idempotent sink in the shared folder.

    Each batch is written under its number, so a batch that runs again replaces itself. Of complete and
    update mode the caller gets every batch's rows with ``batch``; see :func:`last_batch`.
    """
    spark, path = df.sparkSession, scratch(df.sparkSession, tag)

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={number}")

    query = df.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    schema = T.StructType([*df.schema, T.StructField("batch", T.LongType())])
    return spark.read.schema(schema).parquet(f"{path}/out")


def last_batch(df: DataFrame) -> DataFrame:
    """The rows of a complete-mode result as it stood in the end."""
    newest = df.agg(F.max("batch").alias("batch"))
    return df.join(newest, "batch", "left_semi").drop("batch")


def bars(df: DataFrame, by: str, ts: str, value: str, tie: str, width: str, delay: str, slide: str | None = None) -> DataFrame:
    """OHLCV per key and tumbling (or sliding) event-time window."""
    at = F.struct(F.col(ts), F.col(tie))
    grouped = df.withWatermark(ts, delay).groupBy(F.window(ts, width, slide), F.col(by).alias("symbol"))
    agg = grouped.agg(F.min_by(value, at).alias("open"), F.max(value).alias("high"), F.min(value).alias("low"), F.max_by(value, at).alias("close"), F.count("*").alias("volume"))
    return agg.select("symbol", F.col("window.start").alias("start"), F.col("window.end").alias("end"), "open", "high", "low", "close", "volume")


def sessions(df: DataFrame, by: str, ts: str, gap: str, delay: str) -> DataFrame:
    """Sessions of a key: rows no further apart than the gap."""
    agg = df.withWatermark(ts, delay).groupBy(F.session_window(ts, gap), F.col(by)).agg(F.count("*").alias("n"))
    return agg.select(by, F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def once(df: DataFrame, key: Sequence[str], ts: str, delay: str) -> DataFrame:
    """One row of each key within the watermark: an insert that may come again is taken once."""
    return df.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def fresh(df: DataFrame, ts: str, received: Column, max_age: str, max_ahead: str) -> DataFrame:
    """Rows with a set of ``reasons`` against them: stale or future by the time of receipt."""
    late = received > F.col(ts) + F.expr(f"interval {max_age}")
    ahead = F.col(ts) > received + F.expr(f"interval {max_ahead}")
    return df.withColumn("reasons", F.array_compact(F.array(F.when(late, "stale"), F.when(ahead, "future"))))


def matched(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str, delay: str) -> DataFrame:
    """Stream-stream join: right rows of the key at most ``within`` before the left row."""
    l, r = left.withWatermark(left_ts, delay), right.withWatermark(right_ts, delay)
    near = (F.col(f"r.{right_ts}") <= F.col(f"l.{left_ts}")) & (F.col(f"r.{right_ts}") >= F.col(f"l.{left_ts}") - F.expr(f"interval {within}"))
    return l.alias("l").join(r.alias("r"), (F.col(f"l.{key}") == F.col(f"r.{key}")) & near)


def sequence_gaps(df: DataFrame, by: str, seq: str) -> DataFrame:
    """Per key and batch: rows, gaps between one number and the next, and the last number, over state that outlives batches."""
    schema = T.StructType([df.schema[by], T.StructField("rows", T.LongType()), T.StructField("gaps", T.LongType()), T.StructField("last", T.LongType())])

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        rows, gaps, last = state.get if state.exists else (0, 0, None)
        numbers = sorted(n for b in batches for n in b[seq])
        for n in numbers:
            gaps += int(last is not None and n > last + 1)
            last, rows = n if last is None else max(last, n), rows + 1
        state.update((rows, gaps, last))
        yield pd.DataFrame([(key[0], rows, gaps, last)], columns=schema.names)

    return df.groupBy(by).applyInPandasWithState(step, schema, "rows long, gaps long, last long", "update", GroupStateTimeout.NoTimeout)


def missed_slots(df: DataFrame, by: str, ts: str, start: str, seconds: int, slots: int) -> DataFrame:
    """(by, slot) of a session's slots in which a key sent nothing; a table operator for the session's end."""
    seen = df.select(by, F.floor((F.unix_timestamp(ts) - F.unix_timestamp(F.lit(start).cast("timestamp"))) / seconds).alias("slot")).distinct()
    every = df.select(by).distinct().select(by, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(slots - 1).cast("long"))).alias("slot"))
    return every.join(seen, [by, "slot"], "left_anti")
