"""Prices and curves from published formulas, as columns where closed, as vectorised UDFs where iterative."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def norm_cdf(x: Column) -> Column:
    """Normal distribution function by Abramowitz and Stegun 26.2.17, absolute error under 7.5e-8."""
    # The coefficients of the approximation.
    b = (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)
    t = 1 / (1 + 0.2316419 * F.abs(x))
    poly = F.lit(0.0)
    for c in reversed(b):
        poly = (poly + c) * t
    tail = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(x >= 0, 1 - tail).otherwise(tail)


def d1_d2(s: Column, k: Column, t: Column, r: Column, q: Column, v: Column) -> tuple[Column, Column]:
    root = v * F.sqrt(t)
    one = (F.ln(s / k) + (r - q + v * v / 2) * t) / root
    return one, one - root


def black_scholes(df: DataFrame, s="spot", k="strike", t="years", r="rate", q="dividend", v="vol", kind="option_type") -> DataFrame:
    """Adds ``theo``, ``delta``, ``gamma``, ``vega`` and ``theta`` (a year) of European options."""
    S, K, T, R, Q, V = (F.col(c) for c in (s, k, t, r, q, v))
    a, b = d1_d2(S, K, T, R, Q, V)
    sign = F.when(F.col(kind) == "call", 1.0).otherwise(-1.0)
    carry, disc, pdf = F.exp(-Q * T), F.exp(-R * T), F.exp(-a * a / 2) / math.sqrt(2 * math.pi)
    return df.withColumns({
        "theo": sign * (S * carry * norm_cdf(sign * a) - K * disc * norm_cdf(sign * b)),
        "delta": sign * carry * norm_cdf(sign * a),
        "gamma": carry * pdf / (S * V * F.sqrt(T)),
        "vega": S * carry * pdf * F.sqrt(T),
        "theta": -S * carry * pdf * V / (2 * F.sqrt(T)) - sign * R * K * disc * norm_cdf(sign * b) + sign * Q * S * carry * norm_cdf(sign * a),
    })


_erf = np.vectorize(math.erf, otypes=[float])


def bs_price(s, k, t, r, q, v, sign):
    root = v * np.sqrt(t)
    d1 = (np.log(s / k) + (r - q + v * v / 2) * t) / root
    cdf = lambda x: 0.5 * (1 + _erf(x / math.sqrt(2)))
    price = sign * (s * np.exp(-q * t) * cdf(sign * d1) - k * np.exp(-r * t) * cdf(sign * (d1 - root)))
    return price, s * np.exp(-q * t) * np.exp(-d1 * d1 / 2) / math.sqrt(2 * math.pi) * np.sqrt(t)


def implied_vol(price, s, k, t, r, q, sign, steps: int = 60):
    """Volatility by Newton steps kept within a bisection bracket; NaN where no volatility gives the price."""
    price, s, k, t, r, q, sign = (np.asarray(x, float) for x in (price, s, k, t, r, q, sign))
    lo, hi = np.full(price.shape, 1e-6), np.full(price.shape, 5.0)
    with np.errstate(all="ignore"):
        possible = (bs_price(s, k, t, r, q, lo, sign)[0] <= price) & (bs_price(s, k, t, r, q, hi, sign)[0] >= price) & (price > 0)
        v = np.full(price.shape, 0.3)
        for _ in range(steps):
            got, vega = bs_price(s, k, t, r, q, v, sign)
            lo, hi = np.where(got < price, v, lo), np.where(got >= price, v, hi)
            step = v - (got - price) / vega
            v = np.where((step > lo) & (step < hi), step, (lo + hi) / 2)
    return np.where(possible, v, np.nan)


def with_implied_vol(df: DataFrame, price="price", s="spot", k="strike", t="years", r="rate", q="dividend", kind="option_type") -> DataFrame:
    """Adds ``implied_vol``, null where there is none; rows go through numpy in Arrow batches."""
    names = [price, s, k, t, r, q]

    @F.pandas_udf("double")
    def solve(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for *values, sign in batches:
            yield pd.Series(implied_vol(*values, sign))

    sign = F.when(F.col(kind) == "call", 1.0).otherwise(-1.0)
    return df.withColumn("implied_vol", F.nanvl(solve(*names, sign), F.lit(None).cast("double")))


def american_price(s, k, t, r, q, v, sign, steps: int = 200):
    """Cox-Ross-Rubinstein binomial prices with early exercise, vectorised over options."""
    s, k, t, r, q, v, sign = (np.atleast_1d(np.asarray(x, float))[:, None] for x in (s, k, t, r, q, v, sign))
    dt = t / steps
    u = np.exp(v * np.sqrt(dt))
    p = (np.exp((r - q) * dt) - 1 / u) / (u - 1 / u)
    disc = np.exp(-r * dt)
    j = np.arange(steps + 1)[None, :]
    value = np.maximum(sign * (s * u ** (2.0 * j - steps) - k), 0)
    for n in range(steps - 1, -1, -1):
        value = disc * (p * value[:, 1 : n + 2] + (1 - p) * value[:, : n + 1])
        value = np.maximum(value, sign * (s * u ** (2.0 * j[:, : n + 1] - n) - k))
    return value[:, 0]


def with_american(df: DataFrame, s="spot", k="strike", t="years", r="rate", q="dividend", v="vol", kind="option_type", steps: int = 200) -> DataFrame:
    """Adds ``american``; batches of options are priced together."""

    @F.pandas_udf("double")
    def price(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for *values, sign in batches:
            yield pd.Series(american_price(*values, sign, steps=steps)) if len(sign) else pd.Series([], dtype=float)

    return df.withColumn("american", price(s, k, t, r, q, v, F.when(F.col(kind) == "call", 1.0).otherwise(-1.0)))


def discount_at(curve: DataFrame, points: DataFrame, years: str = "years") -> DataFrame:
    """Discount factors at given times, log-linear between the nodes (``t``, ``df``) and flat in the rate beyond; 1 at time 0.

    The curve is a few dozen nodes: it becomes one row of arrays.
    """
    nodes = curve.agg(F.sort_array(F.collect_list(F.struct("t", "df"))).alias("nodes"))
    x = F.col(years)
    below = F.try_element_at(F.filter("nodes", lambda n: n["t"] <= x), F.lit(-1))
    above = F.try_element_at(F.filter("nodes", lambda n: n["t"] > x), F.lit(1))
    t0, l0 = F.coalesce(below["t"], F.lit(0.0)), F.coalesce(F.ln(below["df"]), F.lit(0.0))
    line = l0 + (F.ln(above["df"]) - l0) * (x - t0) / (above["t"] - t0)
    flat = F.when(t0 > 0, l0 * x / t0).otherwise(0.0)
    return points.crossJoin(F.broadcast(nodes)).withColumn("discount", F.exp(F.when(above.isNull(), flat).otherwise(line))).drop("nodes")


def bootstrap(par: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Discount factors from yearly par rates (years, rate): each from the ones before it."""
    out: list[tuple[float, float]] = []
    for t, rate in sorted(par):
        paid = sum(d for u, d in out if u < t)
        out.append((t, (1 - rate * paid) / (1 + rate)))
    return out


def hazard_curve(spreads: Sequence[tuple[float, float]], recovery: float = 0.4) -> list[tuple[float, float, float]]:
    """(years, hazard, survival) from credit spreads by the credit triangle, forward hazard between the nodes."""
    out, before, survived = [], 0.0, 0.0
    for t, spread in sorted(spreads):
        total = spread / (1 - recovery) * t
        out.append((t, (total - survived) / (t - before), math.exp(-total)))
        before, survived = t, total
    return out


def bond_yield(price, coupon, years, face: float = 100.0, frequency: int = 2, steps: int = 80):
    """Yield to maturity by Newton steps within a bracket, vectorised; periods are whole."""
    price, coupon, n = np.asarray(price, float), np.asarray(coupon, float) * face / frequency, np.rint(np.asarray(years, float) * frequency)
    lo, hi, y = np.full(price.shape, -0.9), np.full(price.shape, 10.0), np.full(price.shape, 0.05)
    for _ in range(steps):
        g = 1 + y / frequency
        with np.errstate(all="ignore"):
            annuity = np.where(np.abs(y) < 1e-12, n, (1 - g**-n) / (y / frequency))
            pv = coupon * annuity + face * g**-n
            slope = (coupon * (n * g ** (-n - 1) * (y / frequency) - (1 - g**-n)) / (y / frequency) ** 2 - n * face * g ** (-n - 1)) / frequency
        lo, hi = np.where(pv > price, y, lo), np.where(pv <= price, y, hi)
        step = y - (pv - price) / slope
        y = np.where((step > lo) & (step < hi), step, (lo + hi) / 2)
    return y


def with_bond_yield(df: DataFrame, price="price", coupon="coupon", years="years") -> DataFrame:
    @F.pandas_udf("double")
    def solve(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for p, c, t in batches:
            yield pd.Series(bond_yield(p, c, t))

    return df.withColumn("ytm", solve(price, coupon, years))


def fx_atm_strike(df: DataFrame, s="spot", t="years", rd="rate", rf="foreign", v="vol") -> DataFrame:
    """Forward and delta-neutral at-the-money strike."""
    forward = F.col(s) * F.exp((F.col(rd) - F.col(rf)) * F.col(t))
    return df.withColumns({"forward": forward, "atm_strike": forward * F.exp(F.col(v) * F.col(v) * F.col(t) / 2)})


def var_es(df: DataFrame, by: Sequence[str], pnl: str, level: float = 0.95) -> DataFrame:
    """Empirical value at risk and expected shortfall, as losses."""
    cut = F.percentile(pnl, 1 - level).over(Window.partitionBy(*by))
    rows = df.withColumn("_c", cut)
    return rows.groupBy(*by).agg((-F.first("_c")).alias("var"), (-F.avg(F.when(F.col(pnl) <= F.col("_c"), F.col(pnl)))).alias("es"))
