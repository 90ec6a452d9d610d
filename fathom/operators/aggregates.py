"""Aggregations beyond plain ``groupBy``: holdings, digests, conflicts, conditional counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def holdings(df: DataFrame, keys: Sequence[str], measures: Sequence[str], value: str, drop_zero: Sequence[str] = ()) -> DataFrame:
    """Sums by key with each row's weight in the whole, rounded half-up to 6. Rows with a null key go, as in pandas.

    Columns in ``drop_zero`` that are zero throughout are left out; one small aggregation tells.
    """
    agg = df.na.drop(subset=list(keys)).groupBy(*keys).agg(*(F.sum(m).alias(m) for m in measures))
    if drop_zero:
        totals = agg.agg(*(F.max(F.abs(m)).alias(m) for m in drop_zero)).first()
        agg = agg.drop(*(m for m in drop_zero if not totals[m]))
    total = df.na.drop(subset=list(keys)).agg(F.sum(value).alias("_total"))
    return agg.crossJoin(F.broadcast(total)).withColumn("weight", F.round(F.col(value) / F.col("_total"), 6)).drop("_total")


def variants(df: DataFrame, key: Sequence[str], literals: Sequence[str], flag: str) -> DataFrame:
    """Each different literal row once: how often, by how many sources, any and all of a flag, and the variants of its key."""
    rows = df.groupBy(*key, *literals).agg(F.count("*").alias("observations"), F.count_distinct("source").alias("sources"), F.bool_or(flag).alias("any_flag"), F.bool_and(flag).alias("all_flag"))
    return rows.withColumn("variant_count", F.count("*").over(Window.partitionBy(*key)))


def conditional_counts(df: DataFrame, by: Sequence[str], **conditions) -> DataFrame:
    return df.groupBy(*by).agg(*(F.count_if(c).alias(k) for k, c in conditions.items()))


def collisions(df: DataFrame, column: str) -> DataFrame:
    """Rows less distinct values: 0 where the column is a key."""
    return df.agg((F.count(column) - F.count_distinct(column)).alias("collisions"))


def row_hash(columns: Sequence[str]):
    """SHA-256 of a canonical text of the columns: each with its length before it, null as ``-``."""
    parts = (F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-")) for c in columns)
    return F.sha2(F.concat(*parts), 256)


def content_digest(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """A digest of all rows that doesn't depend on their order or partitions.

    Each row's SHA-256 is cut into four numbers of 60 bits, and these are added up over all rows; the digest hashes the
    number of rows and the four sums. Sums combine before the shuffle and no rows are gathered. Equal rows count each.
    """
    rows = df.select(*by, row_hash(columns).alias("h"))
    sums = [F.sum(F.conv(F.substring("h", 16 * i + 1, 15), 16, 10).cast("decimal(20,0)")).cast("decimal(38,0)").cast("string") for i in range(4)]
    return rows.groupBy(*by).agg(F.count("*").alias("rows"), F.sha2(F.concat_ws(",", F.count("*").cast("string"), *sums), 256).alias("digest"))


def children(df: DataFrame, by: Sequence[str], child: str) -> DataFrame:
    return df.groupBy(*by).agg(F.array_join(F.sort_array(F.collect_set(F.col(child).cast("string"))), ",").alias("children"))


def reasons(df: DataFrame, reason: str) -> DataFrame:
    """Rows by reason, null ones as ``valid``."""
    return df.groupBy(F.coalesce(reason, F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


def watermark(df: DataFrame, by: Sequence[str], available: str) -> DataFrame:
    return df.groupBy(*by).agg(F.max(available).alias("watermark"), F.count("*").alias("rows"))


def json_counts(df: DataFrame, by: Sequence[str], payload: str, path: str, values: Sequence[str]) -> DataFrame:
    """How many rows have each of the values at a path of their JSON."""
    at = F.get_json_object(payload, path)
    return df.groupBy(*by).agg(*(F.sum(F.when(at == v, 1).otherwise(0)).alias(f"n_{v}") for v in values))


def session_report(df: DataFrame, by: Sequence[str], value: str, expected: int) -> DataFrame:
    """Received, missed and distinct slots, the sum of values, and a health word."""
    agg = df.groupBy(*by).agg(F.count("*").alias("received"), F.count_distinct("slot").alias("slots"), F.sum(value).alias("total"))
    missed = F.greatest(F.lit(expected) - F.col("slots"), F.lit(0))
    return agg.withColumns({"missed": missed, "health": F.when(missed == 0, "complete").when(F.col("slots") * 2 >= expected, "partial").otherwise("poor")})
