"""Regressions by Gram matrices, diagnostics, panel estimators and unit-root tests.

A regression is one aggregation: the sums of all products of its few columns. Only those sums, as many as
columns squared, come to the driver, where the normal equations are solved. Residuals stay a column.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathom.functions.blocks import lagged
from fathom.functions import timeseries as ts
from fathom.functions.distributions import chi2_upper, f_upper, t_two_sided
from fathom.functions.windows import ordered


@dataclass
class Gram:
    """Sums of products of the regressors (constant first) and the target."""

    names: list[str]
    n: int
    xx: np.ndarray
    xy: np.ndarray
    yy: float


def _sums(y: Column, xs: Sequence[Column]) -> list[Column]:
    cols = [*xs, y]
    return [F.count("*").alias("n"), *(F.sum(a * b).alias(f"p{i}_{j}") for i, a in enumerate(cols) for j, b in enumerate(cols) if i <= j)]


def _gram(row, names: Sequence[str]) -> Gram:
    k = len(names)
    full = np.array([[float(row[f"p{min(i, j)}_{max(i, j)}"] or 0) for j in range(k + 1)] for i in range(k + 1)])
    return Gram(list(names), row["n"], full[:k, :k], full[:k, k], float(full[k, k]))


def gram(df: DataFrame, y: str, xs: Sequence[str], constant: bool = True) -> Gram:
    """Over rows where all columns are known."""
    names = (["const"] if constant else []) + list(xs)
    rows = df.na.drop(subset=[y, *xs])
    cols = ([F.lit(1.0)] if constant else []) + [F.col(x).cast("double") for x in xs]
    return _gram(rows.agg(*_sums(F.col(y).cast("double"), cols)).first(), names)


@dataclass
class Fit:
    names: list[str]
    n: int
    beta: np.ndarray
    cov: np.ndarray
    rss: float
    tss: float
    df: int

    @property
    def se(self) -> np.ndarray:
        return np.sqrt(np.maximum(np.diag(self.cov), 0))

    @property
    def r2(self) -> float:
        return 1 - self.rss / self.tss if self.tss else 0.0


def solve(g: Gram, extra_df: int = 0) -> Fit:
    """Least squares from sums; ``extra_df`` degrees of freedom are spent besides, as on means taken away."""
    scale = 1 / np.sqrt(np.maximum(np.diag(g.xx), 1e-300))
    inverse = np.linalg.pinv(g.xx * np.outer(scale, scale), hermitian=True) * np.outer(scale, scale)
    beta = inverse @ g.xy
    rss = max(float(g.yy - beta @ g.xy), 0.0)
    tss = g.yy - g.xy[0] ** 2 / g.n if g.names[:1] == ["const"] and g.n else g.yy
    df = max(1, g.n - len(g.names) - extra_df)
    return Fit(g.names, g.n, beta, inverse * rss / df, rss, tss, df)


def ols(df: DataFrame, y: str, xs: Sequence[str], constant: bool = True) -> Fit:
    return solve(gram(df, y, xs, constant))


def coefficients(spark, fit: Fit) -> DataFrame:
    """(variable, coefficient, std_error, t, p)."""
    rows = [(n, float(b), float(s), float(b / s) if s else math.inf, float(t_two_sided(float(b / s), fit.df)) if s else 0.0) for n, b, s in zip(fit.names, fit.beta, fit.se, strict=True)]
    return spark.createDataFrame(rows, "variable string, coefficient double, std_error double, t double, p double")


def residual(fit: Fit, y: str) -> Column:
    out = F.col(y).cast("double")
    for n, b in zip(fit.names, fit.beta, strict=True):
        out = out - (F.lit(float(b)) if n == "const" else F.col(n) * float(b))
    return out


def durbin_watson(df: DataFrame, fit: Fit, y: str, order: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Sum of squared steps of the residuals over their sum of squares, in order."""
    rows = lagged(df.withColumn("_e", residual(fit, y)).select(*dict.fromkeys([*by, *order]), "_e"), by, order, F.col("_e"), 1)
    step = rows.withColumn("_d", F.col("_e") - F.col("_l1"))
    return step.agg((F.sum(F.col("_d") * F.col("_d")) / F.sum(F.col("_e") * F.col("_e"))).alias("durbin_watson"))


def summary(df: DataFrame, y: str, xs: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row: n, R squared, adjusted, F and p, log likelihood, AIC, BIC, Durbin-Watson, Jarque-Bera, skew, kurtosis."""
    fit = ols(df, y, xs)
    k = len(xs)
    f = ((fit.tss - fit.rss) / k) / (fit.rss / fit.df) if fit.rss else math.inf
    ll = -fit.n / 2 * (math.log(2 * math.pi * max(fit.rss, 1e-300) / fit.n) + 1)
    e = df.select(residual(fit, y).alias("e")).agg(F.skewness("e").alias("s"), F.kurtosis("e").alias("k")).first()
    jb = fit.n / 6 * (e["s"] ** 2 + e["k"] ** 2 / 4)
    row = (fit.n, fit.r2, 1 - (1 - fit.r2) * (fit.n - 1) / fit.df, f, f_upper(f, k, fit.df), ll, 2 * (k + 1) - 2 * ll, math.log(fit.n) * (k + 1) - 2 * ll, jb, chi2_upper(jb, 2), e["s"], e["k"] + 3)
    names = ("n", "r_squared", "adj_r_squared", "f", "f_p", "log_likelihood", "aic", "bic", "jarque_bera", "jarque_bera_p", "skew", "kurtosis")
    made = df.sparkSession.createDataFrame([tuple(float(v) for v in row)], ", ".join(f"{n} double" for n in names))
    return made.crossJoin(durbin_watson(df, fit, y, order))


def breusch_godfrey(df: DataFrame, y: str, xs: Sequence[str], order: Sequence[str], lags: int = 1) -> DataFrame:
    """LM and F tests of residual autocorrelation: an auxiliary regression on the residuals' past, zero before the start."""
    fit = ols(df, y, xs)
    rows = lagged(df.withColumn("_e", residual(fit, y)).select(*dict.fromkeys([*order, *xs]), "_e"), [], order, F.col("_e"), lags)
    rows = rows.withColumns({f"_l{i}": F.coalesce(f"_l{i}", F.lit(0.0)) for i in range(1, lags + 1)})
    g = gram(rows, "_e", [*xs, *(f"_l{i}" for i in range(1, lags + 1))])
    aux, base = solve(g), float(g.yy)
    lm = g.n * (1 - aux.rss / base)
    f = (base - aux.rss) / lags / (aux.rss / aux.df)
    return df.sparkSession.createDataFrame([tuple(map(float, (lm, chi2_upper(lm, lags), f, f_upper(f, lags, aux.df))))], "lm double, lm_p double, f double, f_p double")


def vif(df: DataFrame, xs: Sequence[str]) -> DataFrame:
    """Variance inflation of each column: the diagonal of the inverse correlation matrix, from one aggregation."""
    pairs = [(i, j) for i in range(len(xs)) for j in range(i + 1, len(xs))]
    row = df.agg(*(F.corr(xs[i], xs[j]).alias(f"c{i}_{j}") for i, j in pairs)).first()
    c = np.eye(len(xs))
    for i, j in pairs:
        c[i, j] = c[j, i] = row[f"c{i}_{j}"]
    return df.sparkSession.createDataFrame([(x, float(v)) for x, v in zip(xs, np.diag(np.linalg.pinv(c)), strict=True)], "variable string, vif double")


def capm(df: DataFrame, by: Sequence[str], excess: str, market: str) -> DataFrame:
    """Alpha, beta, systematic and unsystematic risk of excess returns on the market's. The market is taken as given: no rate is taken off twice."""
    return df.groupBy(*by).agg(F.regr_intercept(excess, market).alias("alpha"), F.regr_slope(excess, market).alias("beta"), F.regr_r2(excess, market).alias("systematic"), (1 - F.regr_r2(excess, market)).alias("unsystematic"))


# --- panels ------------------------------------------------------------------------------------------


def demeaned(df: DataFrame, entity: str, columns: Sequence[str]) -> DataFrame:
    part = Window.partitionBy(entity)
    return df.withColumns({c: F.col(c) - F.avg(c).over(part) for c in columns})


def pooled(df: DataFrame, y: str, xs: Sequence[str]) -> Fit:
    return ols(df, y, xs)


def between(df: DataFrame, entity: str, y: str, xs: Sequence[str]) -> Fit:
    """Least squares on the entities' means."""
    return ols(df.na.drop(subset=[y, *xs]).groupBy(entity).agg(*(F.avg(c).alias(c) for c in (y, *xs))), y, xs)


def fixed(df: DataFrame, entity: str, y: str, xs: Sequence[str]) -> Fit:
    """Within estimator: entity effects are taken out by their means, and their number off the degrees of freedom."""
    rows = df.na.drop(subset=[y, *xs])
    n = rows.select(entity).distinct().count()
    return solve(gram(demeaned(rows, entity, [y, *xs]), y, xs, constant=False), extra_df=n)


def first_difference(df: DataFrame, entity: str, time: str, y: str, xs: Sequence[str]) -> Fit:
    w = ordered([entity], [time])
    return ols(df.withColumns({c: F.col(c) - F.lag(c).over(w) for c in (y, *xs)}), y, xs, constant=False)


def random_effects(df: DataFrame, entity: str, y: str, xs: Sequence[str]) -> Fit:
    """Swamy-Arora: quasi-demeaned by 1 - sqrt(s_e / (T s_u + s_e)), T of each entity."""
    rows = df.na.drop(subset=[y, *xs])
    inside, means = fixed(rows, entity, y, xs), between(rows, entity, y, xs)
    s_e = inside.rss / inside.df
    stats = rows.groupBy(entity).agg(F.count("*").alias("t")).agg(F.count("*").alias("k"), F.sum(1 / F.col("t")).alias("h")).first()
    s_u = max(0.0, means.rss / means.df - s_e * stats["h"] / stats["k"])
    part = Window.partitionBy(entity)
    theta = 1 - F.sqrt(F.lit(s_e) / (F.count("*").over(part) * s_u + s_e))
    moved = rows.withColumn("_th", theta)
    moved = moved.withColumns({c: F.col(c) - F.col("_th") * F.avg(c).over(part) for c in (y, *xs)}).withColumn("_one", 1 - F.col("_th"))
    fit = solve(gram(moved, y, ["_one", *xs], constant=False))
    fit.names = ["const", *xs]
    return fit


def fama_macbeth(df: DataFrame, time: str, y: str, xs: Sequence[str]) -> DataFrame:
    """Mean and standard error of the coefficients of a regression for each time; the regressions run where the rows are."""
    names, k = ["const", *xs], len(xs) + 1
    cols = [F.lit(1.0), *(F.col(x).cast("double") for x in xs)]
    sums = df.na.drop(subset=[y, *xs]).groupBy(time).agg(*_sums(F.col(y).cast("double"), cols))

    def each(rows: pd.DataFrame) -> pd.DataFrame:
        out = [(n, float(b)) for r in rows.to_dict("records") if r["n"] > k for n, b in zip(names, solve(_gram(r, names)).beta, strict=True)]
        return pd.DataFrame(out, columns=["variable", "b"])

    betas = sums.mapInPandas(lambda it: map(each, it), "variable string, b double")
    agg = betas.groupBy("variable").agg(F.avg("b").alias("coefficient"), (F.stddev_samp("b") / F.sqrt(F.count("b"))).alias("std_error"), F.count("b").alias("periods"))
    return agg.withColumn("t", F.try_divide("coefficient", "std_error"))


# --- tests on whole series ---------------------------------------------------------------------------


def _grouped(df: DataFrame, by: Sequence[str], order: Sequence[str], run, schema: str) -> DataFrame:
    order = list(order)

    def each(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(order, kind="stable")
        return pd.DataFrame([{**{b: rows[b].iloc[0] for b in by}, **run(rows)}])

    keys = ", ".join(f"{b} {t}" for b, t in df.dtypes if b in by)
    return df.groupBy(*by).applyInPandas(each, f"{keys}, {schema}")


def unit_root(df: DataFrame, by: Sequence[str], order: Sequence[str], x: str, regression: str = "c", max_lag: int | None = None, autolag: str | None = "AIC") -> DataFrame:
    """Augmented Dickey-Fuller of each series: statistic, p, lags, observations."""

    def run(rows: pd.DataFrame) -> dict:
        return dict(zip(("adf", "adf_p", "lags", "nobs"), ts.adf(rows[x].dropna().to_numpy(float), regression, max_lag, autolag), strict=True))

    return _grouped(df, by, order, run, "adf double, adf_p double, lags long, nobs long")


def unit_root_and_kpss(df: DataFrame, by: Sequence[str], order: Sequence[str], x: str, regression: str = "c") -> DataFrame:
    def run(rows: pd.DataFrame) -> dict:
        v = rows[x].dropna().to_numpy(float)
        return dict(zip(("adf", "adf_p", "adf_lags", "nobs"), ts.adf(v, regression), strict=True)) | dict(zip(("kpss", "kpss_p", "kpss_lags"), ts.kpss(v, regression), strict=True))

    return _grouped(df, by, order, run, "adf double, adf_p double, adf_lags long, nobs long, kpss double, kpss_p double, kpss_lags long")


def normality(df: DataFrame, by: Sequence[str], x: str) -> DataFrame:
    """Kurtosis, skew and Jarque-Bera by aggregation; Shapiro-Wilk (from 12 values; its p is approximate beyond 5000) and Kolmogorov-Smirnov per series."""

    def run(rows: pd.DataFrame) -> dict:
        v = rows[x].dropna().to_numpy(float)
        w, wp = ts.shapiro(v) if len(v) >= 12 else (None, None)
        d, dp = ts.ks_normal(v)
        return {"shapiro": w, "shapiro_p": wp, "ks": d, "ks_p": dp}

    moments = df.groupBy(*by).agg(F.count(x).alias("n"), F.kurtosis(x).alias("kurtosis"), F.skewness(x).alias("skew"))
    moments = moments.withColumn("jarque_bera", F.col("n") / 6 * (F.col("skew") ** 2 + F.col("kurtosis") ** 2 / 4)).withColumn("jarque_bera_p", F.exp(-F.col("jarque_bera") / 2))
    return moments.join(_grouped(df.select(*by, x), by, [x], run, "shapiro double, shapiro_p double, ks double, ks_p double"), list(by))


def cointegration(long: DataFrame, time: str, name: str, value: str) -> DataFrame:
    """Engle-Granger for every two names over their common times: c, gamma, alpha, adf, p."""
    a = long.select(time, F.col(name).alias("a"), F.col(value).alias("y"))
    b = long.select(time, F.col(name).alias("b"), F.col(value).alias("x"))

    def run(rows: pd.DataFrame) -> dict:
        return dict(zip(("c", "gamma", "alpha", "adf", "p"), ts.engle_granger(rows["y"].to_numpy(float), rows["x"].to_numpy(float)), strict=True))

    return _grouped(a.join(b, time).where("a < b").na.drop(), ["a", "b"], [time], run, "c double, gamma double, alpha double, adf double, p double")


def causality(df: DataFrame, by: Sequence[str], order: Sequence[str], y: str, x: str, lag: int = 3) -> DataFrame:
    """Granger causality of ``x`` for ``y`` at one lag."""
    names = ("f", "f_p", "chi2", "chi2_p", "lr", "lr_p")
    return _grouped(df.na.drop(subset=[y, x]), by, order, lambda rows: ts.granger(rows[y].to_numpy(float), rows[x].to_numpy(float), lag), ", ".join(f"{n} double" for n in names))
