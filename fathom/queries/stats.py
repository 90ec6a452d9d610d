"""Statistics over bars and daily totals."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from fathom.functions import blocks
from fathom.functions.windows import ordered, so_far
from fathom.operators import statistics as st

from .base import BARS, DAILY, Registry, bars, daily, r, rounded, table

query = Registry()
KEYS, TS = ["symbol"], ["ts"]
SKEW = "(avg({x}*{x}*{x}) - 3*avg({x})*avg({x}*{x}) + 2*avg({x})*avg({x})*avg({x})) / power(var_pop({x}), 1.5)"


def rolling_sql(expr: str, name: str, n: int) -> str:
    return f"""WITH {BARS}, w AS (SELECT *, {expr} OVER f AS v, count(close) OVER f AS c FROM bars
        WINDOW f AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW))
        SELECT symbol, ts, open, high, low, close, volume, {r("v", name)} FROM w WHERE c = {n}"""


@query(f"""WITH {BARS}, m AS (SELECT symbol, avg(close) AS mu, var_pop(close) AS v FROM bars GROUP BY 1)
    SELECT symbol, {r("any_value(mu)", "mean")}, {r("var_pop(close)", "variance")}, {r("stddev_pop(close)", "stdev")},
           {r("avg(power(close - mu, 3)) / power(any_value(v), 1.5)", "skew")}, {r("kurtosis_pop(close)", "kurtosis")} FROM bars JOIN m USING (symbol) GROUP BY symbol""")
def stats_moments(spark, d):
    return rounded(st.describe(bars(spark, d), KEYS, "close"))


@query(f"WITH {BARS} SELECT symbol, {r('quantile_cont(close, 0.3)', '"0.3_quantile"')} FROM bars GROUP BY symbol")
def stats_quantile(spark, d):
    return rounded(st.quantile(bars(spark, d), KEYS, "close", 0.3))


@query(f"""WITH {BARS} SELECT symbol, count(close) AS count, {r("avg(close)", "mean")}, {r("stddev_samp(close)", "std")}, {r("var_samp(close)", "var")}, {r("min(close)", "min")},
    {r("quantile_cont(close, 0.25)", "p25")}, {r("quantile_cont(close, 0.5)", "p50")}, {r("quantile_cont(close, 0.75)", "p75")}, {r("max(close)", "max")} FROM bars GROUP BY symbol""")
def stats_summary(spark, d):
    return rounded(st.summary(bars(spark, d), KEYS, "close"))


for _stat, _expr in {"mean": "avg(close)", "variance": "var_pop(close)", "stdev": "stddev_pop(close)", "kurtosis": "kurtosis_pop(close)", "median": "quantile_cont(close, 0.5)"}.items():

    @query(rolling_sql(_expr, f"rolling_{_stat}_20", 20), name=f"rolling_{_stat}")
    def _rolling(spark, d, stat=_stat):
        return rounded(st.rolling(bars(spark, d), KEYS, TS, "close", 20, stat))


@query(f"""WITH {BARS}, f AS (SELECT *, list(close) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS xs FROM bars),
    m AS (SELECT *, list_avg(xs) AS mu FROM f WHERE len(xs) = 20)
    SELECT symbol, ts, open, high, low, close, volume, {r("list_avg([power(x - mu, 3) for x in xs]) / power(list_avg([power(x - mu, 2) for x in xs]), 1.5)", "rolling_skew_20")} FROM m""")
def rolling_skew(spark, d):
    return rounded(st.rolling(bars(spark, d), KEYS, TS, "close", 20, "skew"))


@query(f"""WITH {BARS}, w AS (SELECT *, quantile_cont(close, 0.5) OVER f AS m, quantile_cont(close, 0.25) OVER f AS q, count(close) OVER f AS c FROM bars
        WINDOW f AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 14 PRECEDING AND CURRENT ROW))
        SELECT symbol, ts, open, high, low, close, volume, {r("m", "rolling_median_15")}, {r("q", '"rolling_quantile_0.25_15"')} FROM w WHERE c = 15""")
def rolling_median_quantile(spark, d):
    return rounded(st.rolling_quantile(bars(spark, d), KEYS, TS, "close", 15, 0.25))


@query("SELECT user_id, count(*) AS rows FROM events GROUP BY user_id HAVING count(*) < 60")
def window_length_guard(spark, d):
    return st.too_short(table(spark, d, "events"), ["user_id"], 60)


@query(f"""WITH {DAILY}, p AS (SELECT a.symbol, b.symbol AS comp_to, corr(a.value, b.value) AS c FROM daily a JOIN daily b USING (date) GROUP BY 1, 2)
    SELECT symbol, comp_to, {r("c", "corr")} FROM p""")
def correlation_pearson(spark, d):
    return rounded(st.correlation_matrix(daily(spark, d), "date", "symbol", "value"))


@query(f"""WITH {DAILY}, p AS (SELECT a.symbol, b.symbol AS comp_to, a.value AS x, b.value AS y FROM daily a JOIN daily b USING (date)),
    k AS (SELECT symbol, comp_to, rank() OVER (PARTITION BY symbol, comp_to ORDER BY x) + (count(*) OVER (PARTITION BY symbol, comp_to, x) - 1) / 2 AS x,
                 rank() OVER (PARTITION BY symbol, comp_to ORDER BY y) + (count(*) OVER (PARTITION BY symbol, comp_to, y) - 1) / 2 AS y FROM p)
    SELECT symbol, comp_to, {r("corr(x, y)", "corr")} FROM k GROUP BY 1, 2""")
def correlation_spearman(spark, d):
    return rounded(st.correlation_matrix(daily(spark, d), "date", "symbol", "value", "spearman"))


@query(f"""WITH {DAILY}, b AS (SELECT a.symbol, c.symbol AS comp_to, a.date AS d, a.value AS x, c.value AS y FROM daily a JOIN daily c ON a.date = c.date AND a.symbol < c.symbol)
    SELECT p.symbol, p.comp_to, {r("sum(sign(p.x - q.x) * sign(p.y - q.y)) / sqrt(sum(abs(sign(p.x - q.x))) * sum(abs(sign(p.y - q.y))))", "corr")}
    FROM b p JOIN b q ON p.symbol = q.symbol AND p.comp_to = q.comp_to AND p.d < q.d GROUP BY 1, 2""")
def correlation_kendall(spark, d):
    return rounded(st.kendall(daily(spark, d), "date", "symbol", "value"))


@query(f"SELECT l_returnflag, {r('covar_samp(l_extendedprice, l_quantity)', 'cov', 3)}, {r('covar_samp(l_extendedprice, l_quantity) / var_samp(l_quantity)', 'beta', 3)} FROM lineitem GROUP BY 1")
def covariance_beta(spark, d):
    return rounded(st.beta(table(spark, d, "lineitem"), ["l_returnflag"], "l_extendedprice", "l_quantity"), 3)


@query(f"""WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (SELECT CAST(least(floor((value - lo) / ((hi - lo) / 40)), 39) AS INT) AS bin, lo, hi FROM events, e)
    SELECT bin, {r("lo + (bin + 0.5) * (hi - lo) / 40", "centre")}, count(*) AS n FROM b GROUP BY bin, lo, hi""")
def histogram_40(spark, d):
    return rounded(st.histogram(table(spark, d, "events"), "value", 40))


@query("""WITH x AS (SELECT o_orderpriority, o_orderkey, o_totalprice, CAST(o_orderdate AS DATE) AS day FROM orders),
    k AS (SELECT *, count(*) OVER (PARTITION BY day) AS n, rank() OVER (PARTITION BY day ORDER BY o_totalprice) + (count(*) OVER (PARTITION BY day, o_totalprice) - 1) / 2 AS rk FROM x)
    SELECT o_orderkey, day, CASE WHEN n >= 2 THEN round((rk - 1) / (n - 1) - 0.5, 6) + 0.0 END AS rank_value, CASE WHEN n < 2 THEN 'cross_section_too_small' END AS rank_null_reason FROM k""")
def cross_section_rank(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("day"), "o_totalprice")
    return rounded(st.centred_rank(df, ["day"], "o_totalprice").drop("o_totalprice"))


@query(f"""WITH {BARS} SELECT symbol, ts, coalesce(max(CAST(volume > 3 AS INT)) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 10 PRECEDING AND 2 PRECEDING), 0) > 0 AS busy FROM bars""")
def any_in_window(spark, d):
    return bars(spark, d).select("symbol", "ts", st.any_in_window(F.col("volume") > 3, ordered(KEYS, TS), 10, 2).alias("busy"))


@query(f"""WITH {BARS} SELECT symbol, ts, round(lag(close, 2) OVER w / lag(close, 12) OVER w - 1, 6) + 0.0 AS momentum FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts)""")
def lagged_ratio(spark, d):
    w = ordered(KEYS, TS)
    return rounded(bars(spark, d).select("symbol", "ts", (F.lag("close", 2).over(w) / F.lag("close", 12).over(w) - 1).alias("momentum")))


@query(f"""WITH {DAILY}, q AS (SELECT symbol, date_trunc('quarter', date) AS quarter, sum(value) AS value FROM daily GROUP BY 1, 2)
    SELECT symbol, quarter, {r("value", places=2)}, CASE WHEN count(*) OVER w = 4 THEN round(sum(value) OVER w, 2) + 0.0 END AS sum_4 FROM q
    WINDOW w AS (PARTITION BY symbol ORDER BY quarter ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)""")
def rolling_four_quarters(spark, d):
    q = daily(spark, d).groupBy("symbol", F.date_trunc("quarter", "date").cast("timestamp_ntz").alias("quarter")).agg(F.sum("value").alias("value"))
    return rounded(st.rolling_sum(q, KEYS, ["quarter"], "value", 4), 2)


@query(f"""WITH {BARS}, x AS (SELECT symbol, ts, close / lag(close) OVER w - 1 AS ret, close - lag(close) OVER w AS diff, CAST(row_number() OVER w AS INT) AS ordinal, max(close) OVER w AS peak, count(*) OVER (PARTITION BY symbol) AS n
    FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts))
    SELECT symbol, ts, {r("ret")}, {r("diff")}, ordinal, {r("peak")}, n FROM x""")
def shift_diff_change(spark, d):
    w = ordered(KEYS, TS)
    x, before = F.col("close"), F.lag("close").over(w)
    n = F.count("*").over(Window.partitionBy(*KEYS))
    return rounded(bars(spark, d).select("symbol", "ts", (x / before - 1).alias("ret"), (x - before).alias("diff"), F.row_number().over(w).alias("ordinal"), F.max("close").over(so_far(w)).alias("peak"), n.alias("n")))


@query(f"""WITH {BARS} SELECT symbol, ts, CASE WHEN count(*) OVER w = 20 THEN round(avg(close) OVER w, 6) + 0.0 END AS mean, CASE WHEN count(*) OVER w = 20 THEN round(max(high) OVER w, 6) + 0.0 END AS top FROM bars
    WINDOW w AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def rolling_in_blocks(spark, d):
    out = blocks.rolling(bars(spark, d), KEYS, TS, F.to_date("ts"), 20, {"mean": F.avg("close"), "top": F.max("high")}, rows=50)
    return rounded(out.select("symbol", "ts", "mean", "top"))


@query("SELECT event_id, CAST(sum(user_id) OVER (PARTITION BY event_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM events")
def running_in_blocks(spark, d):
    out = blocks.running_sum(table(spark, d, "events"), ["event_type"], ["ts", "event_id"], F.to_date("ts"), F.col("user_id"), "total")
    return out.select("event_id", "total")


QUERIES, SQL = query.queries, query.sql
