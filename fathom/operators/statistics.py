"""Descriptive and rolling statistics, quantiles, correlation. Moments are population moments unless said."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.windows import full, last_n, ordered

MOMENTS = {"mean": F.avg, "variance": F.var_pop, "stdev": F.stddev_pop, "skew": F.skewness, "kurtosis": F.kurtosis}


def describe(df: DataFrame, by: Sequence[str], target: str, stats: Sequence[str] = tuple(MOMENTS)) -> DataFrame:
    """Moments per key in one aggregation; ``kurtosis`` is excess."""
    return df.groupBy(*by).agg(*(MOMENTS[s](target).alias(s) for s in stats))


def quantile(df: DataFrame, by: Sequence[str], target: str, p: float) -> DataFrame:
    """Exact quantile with linear interpolation, in the column ``<p>_quantile``."""
    return df.groupBy(*by).agg(F.percentile(target, p).alias(f"{p}_quantile"))


def summary(df: DataFrame, by: Sequence[str], target: str) -> DataFrame:
    """count, mean, sample std, variance, min, quartiles, max."""
    agg = df.groupBy(*by).agg(F.count(target).alias("count"), F.avg(target).alias("mean"), F.stddev_samp(target).alias("std"), F.min(target).alias("min"), F.percentile(target, [0.25, 0.5, 0.75]).alias("_q"), F.max(target).alias("max"))
    return agg.select(*by, "count", "mean", "std", (F.col("std") * F.col("std")).alias("var"), "min", *(F.col("_q")[i].alias(n) for i, n in enumerate(("p25", "p50", "p75"))), "max")


def rolling(df: DataFrame, by: Sequence[str], order: Sequence[str], target: str, n: int, stat: str) -> DataFrame:
    """``rolling_<stat>_<n>`` over full windows only; rows before the first full window go."""
    w, x = ordered(by, order), F.col(target)
    if stat == "median":
        values = {f"rolling_median_{n}": F.percentile(x, 0.5)}
    else:
        values = {f"rolling_{stat}_{n}": MOMENTS[stat](x)}
    out = df.select("*", *(full(v, x, w, n).alias(k) for k, v in values.items()))
    return out.where(F.col(next(iter(values))).isNotNull())


def rolling_quantile(df: DataFrame, by: Sequence[str], order: Sequence[str], target: str, n: int, p: float) -> DataFrame:
    """Median and ``p`` quantile of full windows, both interpolated; one frame for the two."""
    w = ordered(by, order)
    out = df.withColumn("_q", full(F.percentile(target, [0.5, p]), target, w, n)).where("_q IS NOT NULL")
    return out.select(*df.columns, F.col("_q")[0].alias(f"rolling_median_{n}"), F.col("_q")[1].alias(f"rolling_quantile_{p}_{n}"))


def too_short(df: DataFrame, by: Sequence[str], n: int) -> DataFrame:
    """Series with fewer rows than a window of ``n``: must be empty before a rolling operator is trusted."""
    return df.groupBy(*by).agg(F.count("*").alias("rows")).where(F.col("rows") < n)


def average_rank(value: Column, w) -> Column:
    """Rank from 1 over a partition, ties sharing their mean; null for null. ``w`` is the unordered partition."""
    return F.when(value.isNotNull(), F.rank().over(w.orderBy(value.asc_nulls_last())) + (F.count(value).over(w.orderBy(value.asc_nulls_last()).rangeBetween(0, 0)) - 1) / 2)


def pairs(long: DataFrame, on: str, name: str, value: str) -> DataFrame:
    """(``a`` <= ``b``, ``x``, ``y``): values of two names at the same ``on``; an equi-join, not a product."""
    a = long.select(F.col(on).alias("on"), F.col(name).alias("a"), F.col(value).alias("x"))
    b = long.select(F.col(on).alias("on"), F.col(name).alias("b"), F.col(value).alias("y"))
    return a.join(b, "on").where("a <= b")


def correlation(x: str, y: str) -> Column:
    """Pearson's correlation of rows that know both values, null where a side is constant (``corr`` fails there)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def correlation_matrix(long: DataFrame, on: str, name: str, value: str, method: str = "pearson") -> DataFrame:
    """(``symbol``, ``comp_to``, ``corr``) for every ordered pair of names, over their common rows."""
    both = pairs(long, on, name, value).where("x IS NOT NULL AND y IS NOT NULL")
    if method == "spearman":
        part = Window.partitionBy("a", "b")
        both = both.select("a", "b", average_rank(F.col("x"), part).alias("x"), average_rank(F.col("y"), part).alias("y"))
    half = both.groupBy("a", "b").agg(correlation("x", "y").alias("corr"))
    mirror = half.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "corr")
    return half.unionByName(mirror).select(F.col("a").alias("symbol"), F.col("b").alias("comp_to"), F.nanvl("corr", F.lit(None)).alias("corr"))


def discordant(x: np.ndarray, y: np.ndarray) -> int:
    """Pairs that ``x`` and ``y`` order against each other, ties in neither counted: inversions of the ranks, bit by bit, in n log n."""
    places = np.unique(y, return_inverse=True)[1][np.lexsort((y, x))]
    found, bits = 0, max(1, int(places.max(initial=0)).bit_length())
    for bit in reversed(range(bits)):
        order = np.argsort(places >> (bit + 1), kind="stable")  # rows whose higher bits agree, in their order
        high, group = (places[order] >> bit) & 1, places[order] >> (bit + 1)
        ones = np.cumsum(high)
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        before = np.repeat((ones - high)[starts], np.diff(np.r_[starts, len(group)]))
        found += int(((ones - before) * (1 - high)).sum())
    return found


def tau_b(x: np.ndarray, y: np.ndarray) -> float:
    """Kendall's tau-b, NaN where a side has one value only."""

    def tied(*by: np.ndarray) -> int:
        n = np.unique(np.stack(by), axis=1, return_counts=True)[1].astype(np.int64)
        return int((n * (n - 1) // 2).sum())

    every, tx, ty, both = len(x) * (len(x) - 1) // 2, tied(x), tied(y), tied(x, y)
    below = math.sqrt(every - tx) * math.sqrt(every - ty)
    return (every - tx - ty + both - 2 * discordant(x, y)) / below if below else float("nan")


def kendall(long: DataFrame, on: str, name: str, value: str) -> DataFrame:
    """Kendall's tau-b of each pair of names by counting inversions, n log n in the rows of a pair.

    One worker holds the common rows of one pair: a daily series each, not ticks.
    """
    both = pairs(long, on, name, value).where("a < b AND x IS NOT NULL AND y IS NOT NULL").select("a", "b", F.col("x").cast("double"), F.col("y").cast("double"))

    def one(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tau = tau_b(rows["x"].to_numpy(), rows["y"].to_numpy())
        return pd.DataFrame({"symbol": [key[0]], "comp_to": [key[1]], "corr": [tau]})

    kind = both.schema["a"].dataType.simpleString()
    made = both.groupBy("a", "b").applyInPandas(one, f"symbol {kind}, comp_to {kind}, corr double")
    return made.withColumn("corr", F.nanvl("corr", F.lit(None)))


def beta(df: DataFrame, by: Sequence[str], y: str, x: str) -> DataFrame:
    """Sample covariance and beta of ``y`` on ``x``."""
    return df.groupBy(*by).agg(F.covar_samp(y, x).alias("cov"), F.try_divide(F.covar_samp(y, x), F.var_samp(x)).alias("beta"))


def histogram(df: DataFrame, target: str, bins: int = 40) -> DataFrame:
    """Counts of equal bins by their centre; the greatest value is in the last bin. Two small aggregations."""
    ends = df.agg(F.min(target).alias("lo"), F.max(target).alias("hi"))
    at = F.least(F.floor((F.col(target) - F.col("lo")) / ((F.col("hi") - F.col("lo")) / bins)), F.lit(bins - 1))
    counted = df.where(F.col(target).isNotNull()).crossJoin(F.broadcast(ends)).groupBy(F.coalesce(at, F.lit(0)).cast("int").alias("bin"), "lo", "hi").agg(F.count("*").alias("n"))
    return counted.select("bin", (F.col("lo") + (F.col("bin") + 0.5) * (F.col("hi") - F.col("lo")) / bins).alias("centre"), "n")


def centred_rank(df: DataFrame, by: Sequence[str], target: str, least: int = 2) -> DataFrame:
    """(rank - 1) / (n - 1) - 0.5 over each cross-section, ties averaged; ``rank_null_reason`` where there is none."""
    part = Window.partitionBy(*by)
    n = F.count(target).over(part)
    value = F.when((n >= least) & F.col(target).isNotNull(), (average_rank(F.col(target), part) - 1) / (n - 1) - 0.5)
    reason = F.when(F.col(target).isNull(), "missing_value").when(n < least, "cross_section_too_small")
    return df.select("*", value.alias("rank_value"), reason.alias("rank_null_reason"))


def any_in_window(flag: Column, w, lookback: int, skip: int) -> Column:
    """Whether ``flag`` held in any of the rows t-lookback ... t-skip."""
    return F.coalesce(F.max(flag.cast("int")).over(w.rowsBetween(-lookback, -skip)), F.lit(0)) > 0


def rolling_sum(df: DataFrame, by: Sequence[str], order: Sequence[str], target: str, n: int = 4) -> DataFrame:
    """Sum of the last ``n`` rows, null until there are as many."""
    w = ordered(by, order)
    return df.withColumn(f"sum_{n}", F.when(F.count("*").over(last_n(w, n)) == n, F.sum(target).over(last_n(w, n))))
