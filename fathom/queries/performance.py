"""Performance and portfolio risk over monthly order totals as prices."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from fathom.functions.windows import ordered
from fathom.operators import performance as pf

from .base import BARS, DAILY, Registry, bars, daily, r, rounded

query = Registry()
#: Weekly totals as levels; returns are damped to a tenth so that growth stays positive.
LEVELS = f"{DAILY}, lv AS (SELECT symbol, date_trunc('week', date) AS date, sum(value) AS level FROM daily GROUP BY 1, 2)"
RET = f"{LEVELS}, rt AS (SELECT symbol, date, (level / lag(level) OVER (PARTITION BY symbol ORDER BY date) - 1) / 10 AS ret FROM lv), x AS (SELECT * FROM rt WHERE ret IS NOT NULL)"
WEIGHTS = "w AS (SELECT symbol, CAST(row_number() OVER (ORDER BY symbol) AS DOUBLE) / 15 AS weight FROM (SELECT DISTINCT symbol FROM x))"


def levels(spark, d):
    return daily(spark, d).groupBy("symbol", F.date_trunc("week", "date").cast("timestamp_ntz").alias("date")).agg(F.sum("value").alias("level"))


def rets(spark, d):
    w = ordered(["symbol"], ["date"])
    return levels(spark, d).select("symbol", "date", ((F.col("level") / F.lag("level").over(w) - 1) / 10).alias("ret")).where("ret IS NOT NULL")


def weights(spark, d):
    names = rets(spark, d).select("symbol").distinct()
    return names.withColumn("weight", F.row_number().over(ordered([], ["symbol"])).cast("double") / 15)


@query(f"""WITH {RET}, g AS (SELECT unnest(range(50)) * 1.5 / 49 AS threshold), o AS (SELECT symbol, threshold, ret - (power(1 + threshold, sqrt(1.0 / 252)) - 1) AS d FROM x, g)
    SELECT symbol, {r("threshold")}, {r("sum(greatest(d, 0)) / (sum(greatest(-d, 0)) + 0.000001)", "omega", 4)} FROM o GROUP BY symbol, threshold""")
def omega_ratio(spark, d):
    return pf.omega(rets(spark, d), ["symbol"], "ret").select("symbol", (F.round("threshold", 6) + F.lit(0.0)).alias("threshold"), F.round("omega", 4).alias("omega"))


F30 = "(PARTITION BY symbol ORDER BY ts ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)"


@query(f"""WITH {BARS}, c AS (SELECT *, close / lag(close) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM bars)
    SELECT symbol, ts, round(CASE WHEN count(ret) OVER {F30} = 30 THEN (sum(ret) OVER {F30} - 0.01) / (stddev_samp(close) OVER {F30} / sqrt(30)) END, 6) + 0.0 AS sharpe_30 FROM c""")
def sharpe_ratio(spark, d):
    return rounded(pf.sharpe(bars(spark, d), ["symbol"], ["ts"], "close", 30, 0.01).select("symbol", "ts", "sharpe_30"))


@query(f"""WITH {BARS}, c AS (SELECT symbol, ts, 1000 + close AS level FROM bars), d AS (SELECT *, level / lag(level) OVER (PARTITION BY symbol ORDER BY ts) - 1 AS ret FROM c),
    s AS (SELECT *, CASE WHEN count(ret) OVER {F30} = 30 THEN sum(ret) OVER {F30} END AS s FROM d), k AS (SELECT *, stddev_pop(CASE WHEN s < 0 THEN s END) OVER {F30} / sqrt(252) * 100 AS k, count(CASE WHEN s < 0 THEN s END) OVER {F30} AS n FROM s)
    SELECT symbol, ts, round(CASE WHEN n > 1 THEN s / nullif(k, 0) / sqrt(2) END, 3) + 0.0 AS sortino_30 FROM k""")
def sortino_ratio(spark, d):
    df = bars(spark, d).select("symbol", "ts", (1000 + F.col("close")).alias("level"))
    return rounded(pf.sortino(df, ["symbol"], ["ts"], "level", 30, adjusted=True).select("symbol", "ts", "sortino_30"), 3)


@query(f"""WITH {RET}, g AS (SELECT *, product(1 + ret) OVER (PARTITION BY symbol ORDER BY date) AS g FROM x), dd AS (SELECT *, g / greatest(max(g) OVER (PARTITION BY symbol ORDER BY date), 1) - 1 AS dd, quantile_cont(ret, 0.05) OVER (PARTITION BY symbol) AS v FROM g)
    SELECT symbol, {r("avg(ret) * 252", "mean")}, {r("stddev_samp(ret) * sqrt(252)", "volatility")}, {r("avg(ret) * 252 / (stddev_samp(ret) * sqrt(252))", "sharpe")}, {r("avg(ret) * 252 / (sqrt(avg(power(least(ret, 0), 2))) * sqrt(252))", "sortino")},
           {r("min(dd)", "max_drawdown")}, {r("any_value(v)", "var_5")}, {r("avg(ret) FILTER (WHERE ret <= v)", "cvar_5")} FROM dd GROUP BY symbol""")
def series_metrics(spark, d):
    return rounded(pf.series_metrics(rets(spark, d), ["symbol"], ["date"], "ret"))


@query(f"""WITH {RET}, g AS (SELECT *, product(1 + ret) OVER (PARTITION BY symbol ORDER BY date) AS g FROM x)
    SELECT symbol, date, {r("g", "growth")}, {r("(g - 1) * 100", "cumulative", 4)}, {r("g / max(g) OVER (PARTITION BY symbol ORDER BY date) - 1", "drawdown")} FROM g""")
def drawdown_path(spark, d):
    df = pf.drawdown(rets(spark, d), ["symbol"], ["date"], "ret").select("symbol", "date", "growth", "cumulative", "drawdown")
    return df.select("symbol", "date", *((F.round(c, p) + F.lit(0.0)).alias(c) for c, p in (("growth", 6), ("cumulative", 4), ("drawdown", 6))))


@query(f"WITH {RET}, {WEIGHTS} SELECT date, {r('sum(ret * weight)', 'ret')}, count(*) AS n FROM x JOIN w USING (symbol) GROUP BY 1")
def portfolio_returns(spark, d):
    return rounded(pf.portfolio_returns(rets(spark, d), weights(spark, d)))


COV = "c AS (SELECT p.symbol AS a, q.symbol AS b, covar_samp(p.ret, q.ret) AS cov FROM x p JOIN x q USING (date) GROUP BY 1, 2)"


@query(f"WITH {RET}, {COV} SELECT a, b, {r('cov', places=9)} FROM c")
def covariance_matrix(spark, d):
    return rounded(pf.covariances(rets(spark, d)), 9)


@query(f"""WITH {RET}, {WEIGHTS}, {COV}, m AS (SELECT a AS symbol, sum(cov * weight) * 252 AS marginal FROM c JOIN w ON w.symbol = b GROUP BY 1), k AS (SELECT symbol, weight, marginal, sum(weight * marginal) OVER () AS variance FROM m JOIN w USING (symbol))
    SELECT symbol, {r("weight")}, {r("marginal")}, {r("weight * marginal / variance", "contribution")}, {r("variance")} FROM k""")
def risk_contribution(spark, d):
    return rounded(pf.risk_contribution(rets(spark, d), weights(spark, d)))


@query(f"""WITH {RET}, {WEIGHTS}, p AS (SELECT date, sum(ret * weight) AS pr FROM x JOIN w USING (symbol) GROUP BY 1), t AS (SELECT * FROM p WHERE pr <= (SELECT quantile_cont(pr, 0.05) FROM p)), m AS (SELECT symbol, avg(ret) AS m FROM x JOIN t USING (date) GROUP BY 1)
    SELECT symbol, {r("weight * m / (SELECT avg(pr) FROM t)", "contribution")}, round((SELECT avg(pr) FROM t), 6) AS cvar FROM m JOIN w USING (symbol)""")
def tail_contribution(spark, d):
    return rounded(pf.tail_contribution(rets(spark, d), weights(spark, d)))


@query(f"WITH {RET}, g AS (SELECT *, product(1 + ret) OVER (PARTITION BY symbol ORDER BY date) AS g FROM x) SELECT symbol, date, {r('g / last_value(g) OVER (PARTITION BY symbol ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) * 1000', 'nav', 4)} FROM g")
def nav_history(spark, d):
    return rounded(pf.nav_history(rets(spark, d), ["symbol"], ["date"], "ret", 1000.0).select("symbol", "date", "nav"), 4)


@query(f"WITH {RET}, {WEIGHTS}, b AS (SELECT sum(weight * 1.5) AS beta FROM w) SELECT {r('beta')}, {r('move')}, {r('move * beta * 2 - 0.03', 'result')} FROM b, (SELECT unnest([-0.2, -0.1, 0.1]::DOUBLE[]) AS move)")
def shock_grid(spark, d):
    w = weights(spark, d)
    return rounded(pf.shocks(w, w.select("symbol", F.lit(1.5).alias("beta")), [-0.2, -0.1, 0.1], 2.0, 0.03))


@query()
def max_sharpe_weights(spark, d):
    """Greatest Sharpe ratio with at most two fifths in one symbol, from aggregated means and covariances."""
    x = rets(spark, d)
    mean = {r["symbol"]: r["m"] for r in x.groupBy("symbol").agg(F.avg("ret").alias("m")).collect()}
    names = sorted(mean)
    cov = np.zeros((len(names), len(names)))
    for r in pf.covariances(x).collect():
        cov[names.index(r["a"]), names.index(r["b"])] = r["cov"]
    w = pf.max_sharpe(np.array([mean[n] for n in names]), cov, 0.0, 0.4)
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, w, strict=True)], "symbol string, weight double")


QUERIES, SQL = query.queries, query.sql
