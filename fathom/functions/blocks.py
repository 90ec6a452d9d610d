"""Window results for keys whose rows are too many for one task.

A series is numbered in two levels: counts of (key, time bucket) are summed up on a small table, and rows
are ranked within their bucket. The number cuts the series into blocks of equal length. A frame of n rows
then needs its block and the last n - 1 rows of the one before, which are sent along as a halo; a running
value needs its block and the combined value of all blocks before it. No task sorts a whole series.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column) -> DataFrame:
    """Adds ``_o``, each row's place in its series from 0. ``bucket`` must not fall along the order."""
    df = df.withColumn("_b", bucket)
    counts = df.groupBy(*by, "_b").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select(*by, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    rank = F.row_number().over(Window.partitionBy(*by, "_b").orderBy(*order)) - 1
    return df.withColumn("_r", rank).join(base, [*by, "_b"]).withColumn("_o", F.col("_base") + F.col("_r")).drop("_b", "_r", "_base")


def rolling(df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column, n: int, values: dict[str, Column], rows: int = 100_000) -> DataFrame:
    """Aggregates over full frames of the last ``n`` rows, computed in blocks of ``rows`` with a halo; null before the n-th row."""
    rows = max(rows, n)
    cut = numbered(df, by, order, bucket).withColumn("_block", F.floor(F.col("_o") / rows))
    halo = cut.where(F.col("_o") % rows >= rows - (n - 1)).withColumns({"_block": F.col("_block") + 1, "_halo": F.lit(True)})
    both = cut.withColumn("_halo", F.lit(False)).unionByName(halo)
    frame = Window.partitionBy(*by, "_block").orderBy("_o").rowsBetween(-(n - 1), 0)
    made = both.select("*", *(F.when(F.col("_o") >= n - 1, v.over(frame)).alias(k) for k, v in values.items()))
    return made.where("NOT _halo").drop("_o", "_block", "_halo")


def spread(df: DataFrame, column: str, name: str, rows: int = 1_000_000) -> DataFrame | None:
    """Adds a bucket that rises with a number or time, of about ``rows`` rows each (256 to 4096 buckets); None for other types.

    The cuts are approximate percentiles: a bounded few numbers that come to the driver.
    """
    kind = dict(df.dtypes)[column]
    if kind not in ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz") and not kind.startswith("decimal"):
        return None
    value = (F.unix_micros(F.col(column).cast("timestamp")) if kind.startswith(("date", "timestamp")) else F.col(column)).cast("double")
    bits = min(12, max(8, (df.count() // rows).bit_length()))
    found = df.agg(F.percentile_approx(value, [i / (1 << bits) for i in range(1, 1 << bits)], 1 << (bits + 4))).first()[0]
    cuts = F.array(*map(F.lit, sorted(set(found or [0.0]))))
    # How many of the sorted cuts lie below, one halving after another. Null, which sorts first, is above none.
    df = df.withColumn(name, F.lit(0))
    for width in (1 << i for i in reversed(range(bits))):
        df = df.withColumn(name, F.when(F.try_element_at(cuts, F.col(name) + width) < value, F.col(name) + width).otherwise(F.col(name)))
    return df


def lagged(df: DataFrame, by: Sequence[str], order: Sequence[str], value: Column, lags: int, rows: int = 100_000) -> DataFrame:
    """Adds ``_l1`` ... ``_l<lags>``, the values of the rows before in order (null before the start), in blocks with a halo.

    Where the first column of the order is neither a number nor a time, one window goes over the whole series.
    """
    df = df.withColumn("_x", value)
    cut = spread(df, order[0], "_cut")
    if cut is None:
        w = Window.partitionBy(*by).orderBy(*order)
        return df.withColumns({f"_l{i}": F.lag("_x", i).over(w) for i in range(1, lags + 1)}).drop("_x")
    rows = max(rows, lags + 1)
    cut = numbered(cut, by, order, F.col("_cut")).withColumn("_block", F.floor(F.col("_o") / rows))
    halo = cut.where(F.col("_o") % rows >= rows - lags).withColumns({"_block": F.col("_block") + 1, "_halo": F.lit(True)})
    w = Window.partitionBy(*by, "_block").orderBy("_o")
    made = cut.withColumn("_halo", F.lit(False)).unionByName(halo).withColumns({f"_l{i}": F.lag("_x", i).over(w) for i in range(1, lags + 1)})
    return made.where("NOT _halo").drop("_x", "_o", "_block", "_halo", "_cut")


def running_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column, value: Column, name: str) -> DataFrame:
    """Sum of all rows so far: the sum within the bucket on top of that of all buckets before."""
    df = df.withColumns({"_b": bucket, "_v": value})
    sums = df.groupBy(*by, "_b").agg(F.sum("_v").alias("_s"))
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select(*by, "_b", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_base"))
    inside = F.sum("_v").over(Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("_i", inside).join(base, [*by, "_b"]).withColumn(name, F.col("_base") + F.col("_i")).drop("_b", "_v", "_i", "_base")
