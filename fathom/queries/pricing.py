"""Pricing over the derived options chain and return series."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import pricing as pr

from .base import BARS, Registry, bars, r, rounded
from .options import CHAIN, chain

query = Registry()


def quoted(spark, d):
    c = chain(spark, d).where("iv IS NOT NULL AND dte > 0")
    return c.select("contract_symbol", "option_type", "strike", F.col("price").alias("spot"), (F.col("dte") / 365).alias("years"), F.lit(0.03).alias("rate"), F.lit(0.01).alias("dividend"), F.col("iv").alias("vol"))


# The same approximation of the normal distribution as the engine's.
CDF = "(CASE WHEN {x} >= 0 THEN 1 - {t} ELSE {t} END)"
TAIL = "exp(-{x} * {x} / 2) / sqrt(2 * pi()) * (0.319381530 * k_{n} - 0.356563782 * power(k_{n}, 2) + 1.781477937 * power(k_{n}, 3) - 1.821255978 * power(k_{n}, 4) + 1.330274429 * power(k_{n}, 5))"


def cdf(n: str) -> str:
    return CDF.format(x=n, t=TAIL.format(x=n, n=n))


@query(f"""WITH {CHAIN}, q AS (SELECT contract_symbol, CASE option_type WHEN 'call' THEN 1.0 ELSE -1.0 END::DOUBLE AS sg, price AS s, strike::DOUBLE AS k, dte / 365 AS t, iv AS v FROM chain WHERE iv IS NOT NULL AND dte > 0),
    d AS (SELECT *, sg * (ln(s / k) + (0.02 + v * v / 2) * t) / (v * sqrt(t)) AS a, sg * ((ln(s / k) + (0.02 + v * v / 2) * t) / (v * sqrt(t)) - v * sqrt(t)) AS b FROM q), e AS (SELECT *, 1 / (1 + 0.2316419 * abs(a)) AS k_a, 1 / (1 + 0.2316419 * abs(b)) AS k_b FROM d)
    SELECT contract_symbol, {r(f"sg * (s * exp(-0.01 * t) * {cdf('a')} - k * exp(-0.03 * t) * {cdf('b')})", "theo", 4)}, {r(f"sg * exp(-0.01 * t) * {cdf('a')}", "delta", 4)}, {r("exp(-0.01 * t) * exp(-a * a / 2) / sqrt(2 * pi()) / (s * v * sqrt(t))", "gamma", 4)} FROM e""".replace("0.02 +", "0.03 - 0.01 +"))
def black_scholes(spark, d):
    return rounded(pr.black_scholes(quoted(spark, d)).select("contract_symbol", "theo", "delta", "gamma"), 4)


@query()
def implied_volatility(spark, d):
    """All quoted contracts; null where no volatility gives the price."""
    theo = pr.black_scholes(quoted(spark, d)).withColumn("price", F.col("theo"))
    return pr.with_implied_vol(theo).select("contract_symbol", "implied_vol")


@query()
def american_options(spark, d):
    return pr.with_american(quoted(spark, d)).select("contract_symbol", "american")


@query()
def discount_curve(spark, d):
    curve = spark.createDataFrame(pr.bootstrap([(1.0, 0.03), (2.0, 0.032), (3.0, 0.035), (5.0, 0.04)]), "t double, df double")
    return pr.discount_at(curve, spark.range(1, 41).select((F.col("id") / 5).alias("years")))


@query()
def credit_curve(spark, d):
    return spark.createDataFrame(pr.hazard_curve([(1.0, 0.01), (3.0, 0.015), (5.0, 0.02)]), "years double, hazard double, survival double")


@query()
def bond_yields(spark, d):
    bonds = spark.range(1, 200).select("id", (90 + F.col("id") % 21).cast("double").alias("price"), (F.col("id") % 9 / 100).alias("coupon"), (1 + F.col("id") % 30).cast("double").alias("years"))
    return pr.with_bond_yield(bonds)


@query(f"WITH {CHAIN} SELECT contract_symbol, {r('price * exp((0.03 - 0.01) * dte / 365)', 'forward')}, {r('price * exp((0.03 - 0.01) * dte / 365) * exp(iv * iv * dte / 365 / 2)', 'atm_strike')} FROM chain WHERE iv IS NOT NULL AND dte > 0")
def fx_atm_strike(spark, d):
    return rounded(pr.fx_atm_strike(quoted(spark, d).withColumnRenamed("dividend", "foreign")).select("contract_symbol", "forward", "atm_strike"))


@query(f"""WITH {BARS}, x AS (SELECT symbol, close - lag(close) OVER (PARTITION BY symbol ORDER BY ts) AS pnl FROM bars), c AS (SELECT *, quantile_cont(pnl, 0.05) OVER (PARTITION BY symbol) AS c FROM x WHERE pnl IS NOT NULL)
    SELECT symbol, {r("-any_value(c)", '"var"')}, {r("-avg(pnl) FILTER (WHERE pnl <= c)", "es")} FROM c GROUP BY 1""")
def value_at_risk(spark, d):
    from fathom.functions.windows import ordered

    pnl = (F.col("close") - F.lag("close").over(ordered(["symbol"], ["ts"]))).alias("pnl")
    return rounded(pr.var_es(bars(spark, d).select("symbol", pnl).where("pnl IS NOT NULL"), ["symbol"], "pnl"))


QUERIES, SQL = query.queries, query.sql
