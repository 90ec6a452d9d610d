"""Performance of return series and portfolio risk. Returns are long rows (symbol, date, ret)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.windows import full, ordered, so_far

YEAR = 252


def omega(df: DataFrame, by: Sequence[str], ret: str, start: float = 0.0, end: float = 1.5, steps: int = 50) -> DataFrame:
    """(threshold, omega) on a grid of yearly thresholds: gains above over losses below, in one aggregation.

    The daily threshold is (1 + x) ** sqrt(1 / 252) - 1.
    """
    grid = [start + (end - start) * i / (steps - 1) for i in range(steps)]

    def one(x: float) -> Column:
        over = F.col(ret) - ((1 + x) ** math.sqrt(1 / YEAR) - 1)
        return F.struct(F.lit(x).alias("threshold"), (F.sum(F.greatest(over, F.lit(0.0))) / (F.sum(F.greatest(-over, F.lit(0.0))) + 1e-6)).alias("omega"))

    return df.groupBy(*by).agg(F.array(*map(one, grid)).alias("g")).select(*by, F.inline("g"))


def sharpe(df: DataFrame, by: Sequence[str], order: Sequence[str], target: str, window: int = 252, rfr: float = 0.0) -> DataFrame:
    """Rolling sum of returns less the rate, over the deviation of the level scaled to the window."""
    w = ordered(by, order)
    df = df.withColumn("_r", F.col(target) / F.lag(target).over(w) - 1)
    ratio = F.try_divide(full(F.sum("_r"), "_r", w, window) - rfr, full(F.stddev_samp(target), target, w, window) / math.sqrt(window))
    return df.withColumn(f"sharpe_{window}", ratio).drop("_r")


def sortino(df: DataFrame, by: Sequence[str], order: Sequence[str], target: str, window: int = 252, adjusted: bool = False) -> DataFrame:
    """Rolling sum of returns over the population deviation of the window's negative rolling sums, in percent a year."""
    w = ordered(by, order)
    df = df.withColumn("_r", F.col(target) / F.lag(target).over(w) - 1)
    df = df.withColumn("_s", full(F.sum("_r"), "_r", w, window))
    down = F.stddev_pop(F.when(F.col("_s") < 0, F.col("_s"))).over(w.rowsBetween(-(window - 1), 0)) / math.sqrt(YEAR) * 100
    out = F.try_divide(F.col("_s"), down)
    return df.withColumn(f"sortino_{window}", out / math.sqrt(2) if adjusted else out).drop("_r", "_s")


def growth(ret: Column, w) -> Column:
    """Product of 1 + return so far: 0 from a return of -100 % on, of the other sign after one below it."""
    return F.product(1 + ret).over(so_far(w))


def series_metrics(df: DataFrame, by: Sequence[str], order: Sequence[str], ret: str) -> DataFrame:
    """Yearly mean and deviation, Sharpe, Sortino, deepest drawdown, 5 % value at risk and the mean beyond it."""
    w = ordered(by, order)
    df = df.withColumn("_g", growth(F.col(ret), w))
    df = df.withColumn("_dd", F.col("_g") / F.greatest(F.max("_g").over(so_far(w)), F.lit(1.0)) - 1)
    df = df.withColumn("_v", F.percentile(ret, 0.05).over(Window.partitionBy(*by)))
    x = F.col(ret)
    agg = df.groupBy(*by).agg((F.avg(x) * YEAR).alias("mean"), (F.stddev_samp(x) * math.sqrt(YEAR)).alias("volatility"), F.min("_dd").alias("max_drawdown"), F.first("_v").alias("var_5"), F.avg(F.when(x <= F.col("_v"), x)).alias("cvar_5"), (F.sqrt(F.avg(F.pow(F.least(x, F.lit(0.0)), 2.0))) * math.sqrt(YEAR)).alias("_d"))
    return agg.select(*by, "mean", "volatility", F.try_divide("mean", "volatility").alias("sharpe"), F.try_divide("mean", "_d").alias("sortino"), "max_drawdown", "var_5", "cvar_5")


def drawdown(df: DataFrame, by: Sequence[str], order: Sequence[str], ret: str) -> DataFrame:
    """Cumulative return in percent, growth path and drawdown; the first return counts."""
    w = ordered(by, order)
    df = df.withColumn("growth", growth(F.coalesce(F.col(ret), F.lit(0.0)), w))
    return df.withColumns({"cumulative": (F.col("growth") - 1) * 100, "drawdown": F.try_divide("growth", F.max("growth").over(so_far(w))) - 1})


def portfolio_returns(df: DataFrame, weights: DataFrame, date: str = "date") -> DataFrame:
    """Weighted return a day; weights are one row a symbol."""
    return df.join(weights, "symbol").groupBy(date).agg(F.sum(F.col("ret") * F.col("weight")).alias("ret"), F.count("*").alias("n"))


def covariances(df: DataFrame, date: str = "date") -> DataFrame:
    """Long sample covariance matrix by an equi-join on the date."""
    a = df.select(date, F.col("symbol").alias("a"), F.col("ret").alias("x"))
    b = df.select(date, F.col("symbol").alias("b"), F.col("ret").alias("y"))
    return a.join(b, date).groupBy("a", "b").agg(F.covar_samp("x", "y").alias("cov"))


def risk_contribution(df: DataFrame, weights: DataFrame, date: str = "date") -> DataFrame:
    """Each symbol's part of the portfolio's variance: w (C w) / w' C w, yearly."""
    c = covariances(df, date).join(weights.select(F.col("symbol").alias("b"), F.col("weight").alias("wb")), "b")
    marginal = c.groupBy(F.col("a").alias("symbol")).agg((F.sum(F.col("cov") * F.col("wb")) * YEAR).alias("marginal")).join(weights, "symbol")
    marginal = marginal.withColumn("_p", F.col("weight") * F.col("marginal"))
    total = marginal.agg(F.sum("_p").alias("variance"))
    return marginal.crossJoin(F.broadcast(total)).select("symbol", "weight", "marginal", (F.col("_p") / F.col("variance")).alias("contribution"), "variance")


def tail_contribution(df: DataFrame, weights: DataFrame, date: str = "date", p: float = 0.05) -> DataFrame:
    """Each symbol's part of the portfolio's mean loss on its worst days."""
    total = portfolio_returns(df, weights, date).select(date, F.col("ret").alias("pr"))
    worst = total.crossJoin(F.broadcast(total.agg(F.percentile("pr", p).alias("v")))).where("pr <= v")
    cvar = worst.agg(F.avg("pr").alias("cvar"))
    tail = df.join(worst.select(date), date).groupBy("symbol").agg(F.avg("ret").alias("m")).join(weights, "symbol")
    return tail.crossJoin(F.broadcast(cvar)).select("symbol", (F.col("weight") * F.col("m") / F.col("cvar")).alias("contribution"), "cvar")


def nav_history(df: DataFrame, by: Sequence[str], order: Sequence[str], ret: str, value: float) -> DataFrame:
    """Growth path scaled so that each series ends at the present value; null where the series ends at nothing."""
    w = ordered(by, order)
    df = df.withColumn("_g", growth(F.coalesce(F.col(ret), F.lit(0.0)), w))
    last = F.last("_g").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return df.withColumn("nav", F.try_divide(F.col("_g"), last) * value).drop("_g")


def shocks(weights: DataFrame, betas: DataFrame, moves: Sequence[float], leverage: float = 1.0, funding: float = 0.0) -> DataFrame:
    """Scenario grid: loss of the levered portfolio for each market move, less the cost of funding."""
    grid = F.explode(F.array(*map(F.lit, moves))).alias("move")
    rows = weights.join(betas, "symbol").agg(F.sum(F.col("weight") * F.col("beta")).alias("beta"))
    return rows.select("beta", grid).withColumn("result", F.col("move") * F.col("beta") * leverage - funding * (leverage - 1))


def max_sharpe(mean: np.ndarray, cov: np.ndarray, lower: float = 0.0, upper: float = 1.0, steps: int = 2000) -> np.ndarray:
    """Weights within bounds that sum to 1 and give the greatest Sharpe ratio, by projected gradient.

    Works on the small matrices that aggregations give: as many rows as the portfolio has instruments.
    """
    n = len(mean)

    def project(v: np.ndarray) -> np.ndarray:
        lo, hi = (v - upper).min() - 1, (v - lower).max() + 1
        for _ in range(80):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if np.clip(v - mid, lower, upper).sum() > 1 else (lo, mid)
        return np.clip(v - (lo + hi) / 2, lower, upper)

    w = project(np.full(n, 1 / n))
    best, top = w, -np.inf
    for k in range(steps):
        risk = math.sqrt(max(w @ cov @ w, 1e-300))
        value = w @ mean / risk
        if value > top:
            best, top = w, value
        g = mean / risk - (w @ mean) * (cov @ w) / risk**3
        w = project(w + 0.5 / math.sqrt(k + 1) * g / max(np.abs(g).max(), 1e-300))
    return best
