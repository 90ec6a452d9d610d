"""Regressions and tests; SQL has simple regressions and moments, the rest is tested against numpy."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import econometrics as ec

from .base import BARS, Registry, bars, r, rounded, table
from .performance import RET, rets

query = Registry()
XS = ["l_quantity", "l_discount", "l_tax"]


def line(spark, d):
    return table(spark, d, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def panel(spark, d):
    """(entity, time) means of two measures."""
    return table(spark, d, "lineitem").groupBy((F.col("l_suppkey") % 20).alias("entity"), F.year("l_shipdate").alias("time")).agg(F.avg("l_extendedprice").alias("y"), F.avg("l_quantity").alias("x"), F.avg("l_discount").alias("z"))


def places(df, **digits):
    return df.select(*((F.round(c, digits[c]) + F.lit(0.0)).alias(c) if c in digits else F.col(c) for c in df.columns))


@query("""WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a, regr_r2(l_extendedprice, l_quantity) AS r2, count(*) AS n, regr_syy(l_extendedprice, l_quantity) AS syy, regr_sxx(l_extendedprice, l_quantity) AS sxx, avg(l_quantity) AS m FROM lineitem)
    SELECT 'l_quantity' AS variable, round(b, 4) AS coefficient, round(sqrt(syy * (1 - r2) / (n - 2) / sxx), 4) AS std_error FROM f UNION ALL SELECT 'const', round(a, 4), round(sqrt(syy * (1 - r2) / (n - 2) * (1.0 / n + m * m / sxx)), 4) FROM f""")
def ols_simple(spark, d):
    return ec.coefficients(spark, ec.ols(line(spark, d), "l_extendedprice", ["l_quantity"])).select("variable", F.round("coefficient", 4).alias("coefficient"), F.round("std_error", 4).alias("std_error"))


@query()
def ols_regression(spark, d):
    return ec.coefficients(spark, ec.ols(line(spark, d), "l_extendedprice", XS))


@query()
def ols_summary(spark, d):
    return ec.summary(line(spark, d), "l_extendedprice", XS, ["id", "l_partkey", "l_suppkey"])


@query("""WITH f AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem), e AS (SELECT l_extendedprice - a - b * l_quantity AS e, l_orderkey * 10 + l_linenumber AS id, l_partkey, l_suppkey FROM lineitem, f),
    s AS (SELECT e, e - lag(e) OVER (ORDER BY id, l_partkey, l_suppkey) AS d FROM e) SELECT round(sum(d * d) / sum(e * e), 6) AS durbin_watson FROM s""")
def autocorrelation(spark, d):
    df = line(spark, d)
    return rounded(ec.durbin_watson(df, ec.ols(df, "l_extendedprice", ["l_quantity"]), "l_extendedprice", ["id", "l_partkey", "l_suppkey"]))


@query()
def residual_autocorrelation(spark, d):
    return ec.breusch_godfrey(line(spark, d), "l_extendedprice", XS, ["id", "l_partkey", "l_suppkey"], 2)


@query("SELECT x AS variable, round(1 / (1 - power(c, 2)), 6) AS vif FROM (SELECT corr(l_quantity, l_extendedprice) AS c FROM lineitem), (VALUES ('l_quantity'), ('l_extendedprice')) t(x)")
def variance_inflation(spark, d):
    return rounded(ec.vif(line(spark, d), ["l_quantity", "l_extendedprice"]))


@query(f"""WITH {RET}, m AS (SELECT date, avg(ret) AS market FROM x GROUP BY 1) SELECT symbol, {r("regr_intercept(ret, market)", "alpha")}, {r("regr_slope(ret, market)", "beta")}, {r("regr_r2(ret, market)", "systematic")}, {r("1 - regr_r2(ret, market)", "unsystematic")} FROM x JOIN m USING (date) GROUP BY symbol""")
def capm(spark, d):
    df = rets(spark, d)
    return rounded(ec.capm(df.join(df.groupBy("date").agg(F.avg("ret").alias("market")), "date"), ["symbol"], "ret", "market"))


PANEL = "p AS (SELECT l_suppkey % 20 AS entity, year(l_shipdate) AS time, avg(l_extendedprice) AS y, avg(l_quantity) AS x FROM lineitem GROUP BY 1, 2)"


def slope(rows, name="coefficient"):
    return rows.select("variable", F.round("coefficient", 4).alias(name))


@query(f"WITH {PANEL} SELECT 'x' AS variable, round(regr_slope(y, x), 4) AS coefficient FROM p UNION ALL SELECT 'const', round(regr_intercept(y, x), 4) FROM p")
def panel_pooled(spark, d):
    return slope(ec.coefficients(spark, ec.pooled(panel(spark, d), "y", ["x"])))


@query(f"WITH {PANEL}, m AS (SELECT avg(y) AS y, avg(x) AS x FROM p GROUP BY entity) SELECT 'x' AS variable, round(regr_slope(y, x), 4) AS coefficient FROM m UNION ALL SELECT 'const', round(regr_intercept(y, x), 4) FROM m")
def panel_between(spark, d):
    return slope(ec.coefficients(spark, ec.between(panel(spark, d), "entity", "y", ["x"])))


@query(f"WITH {PANEL}, m AS (SELECT y - avg(y) OVER (PARTITION BY entity) AS y, x - avg(x) OVER (PARTITION BY entity) AS x FROM p) SELECT 'x' AS variable, round(sum(x * y) / sum(x * x), 4) AS coefficient FROM m")
def panel_fixed(spark, d):
    return slope(ec.coefficients(spark, ec.fixed(panel(spark, d), "entity", "y", ["x"])))


@query(f"WITH {PANEL}, m AS (SELECT y - lag(y) OVER w AS y, x - lag(x) OVER w AS x FROM p WINDOW w AS (PARTITION BY entity ORDER BY time)) SELECT 'x' AS variable, round(sum(x * y) / sum(x * x), 4) AS coefficient FROM m")
def panel_first_difference(spark, d):
    return slope(ec.coefficients(spark, ec.first_difference(panel(spark, d), "entity", "time", "y", ["x"])))


@query(f"""WITH {PANEL}, b AS (SELECT time, regr_slope(y, x) AS x, regr_intercept(y, x) AS c FROM p GROUP BY 1)
    SELECT 'x' AS variable, round(avg(x), 4) AS coefficient, round(stddev_samp(x) / sqrt(count(*)), 4) AS std_error, count(*) AS periods FROM b UNION ALL SELECT 'const', round(avg(c), 4), round(stddev_samp(c) / sqrt(count(*)), 4), count(*) FROM b""")
def panel_fama_macbeth(spark, d):
    return places(ec.fama_macbeth(panel(spark, d), "time", "y", ["x"]).drop("t"), coefficient=4, std_error=4)


@query()
def panel_random_effects(spark, d):
    return ec.coefficients(spark, ec.random_effects(panel(spark, d), "entity", "y", ["x", "z"]))


@query()
def unit_root(spark, d):
    return ec.unit_root(bars(spark, d), ["symbol"], ["ts"], "close")


@query()
def unit_root_kpss(spark, d):
    return ec.unit_root_and_kpss(bars(spark, d), ["symbol"], ["ts"], "close")


@query()
def normality(spark, d):
    return ec.normality(bars(spark, d), ["symbol"], "close")


@query(f"""WITH {BARS}, m AS (SELECT symbol, avg(close) AS mu, var_pop(close) AS v FROM bars GROUP BY 1), k AS (SELECT symbol, count(*) AS n, avg(power(close - mu, 3)) / power(any_value(v), 1.5) AS s, kurtosis_pop(close) AS k FROM bars JOIN m USING (symbol) GROUP BY 1)
    SELECT symbol, {r("n / 6 * (s * s + k * k / 4)", "jarque_bera", 4)} FROM k""")
def jarque_bera(spark, d):
    return ec.normality(bars(spark, d), ["symbol"], "close").select("symbol", (F.round("jarque_bera", 4) + F.lit(0.0)).alias("jarque_bera"))


@query()
def cointegration(spark, d):
    from .performance import levels

    return ec.cointegration(levels(spark, d), "date", "symbol", "level")


@query()
def granger_causality(spark, d):
    return ec.causality(bars(spark, d), ["symbol"], ["ts"], "close", "volume", 3)


QUERIES, SQL = query.queries, query.sql
