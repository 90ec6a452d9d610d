"""Indicators that window frames express."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from fathom.operators import indicators as ta

from .base import BARS, Registry, bars, r, rounded

query = Registry()
W = "(PARTITION BY symbol ORDER BY ts ROWS BETWEEN {} PRECEDING AND CURRENT ROW)"


def frame(n: int) -> str:
    return W.format(n - 1)


def out(df, *names):
    return rounded(df.select("symbol", "ts", *(f"`{n}`" for n in names)))


def over(expr: str, n: int, seen: str = "close") -> str:
    """An aggregate over full frames."""
    return f"CASE WHEN count({seen}) OVER {frame(n)} = {n} THEN {expr} OVER {frame(n)} END"


def weighted(x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER {frame(n)} = {n} THEN list_sum([v * i for v, i in list({x}) OVER {frame(n)}]) / {n * (n + 1) / 2} END"


@query(f"WITH {BARS} SELECT symbol, ts, {r(over('avg(close)', 10), 'sma_10')} FROM bars")
def sma(spark, d):
    return out(ta.sma(bars(spark, d), length=10), "sma_10")


@query(f"WITH {BARS}, s AS (SELECT *, {over('avg(close)', 10)} AS v FROM bars) SELECT symbol, ts, {r('lag(v, 3) OVER (PARTITION BY symbol ORDER BY ts)', 'sma_10')} FROM s")
def sma_offset(spark, d):
    return out(ta.sma(bars(spark, d), length=10, offset=3), "sma_10")


@query(f"WITH {BARS} SELECT symbol, ts, {r(weighted('close', 10), 'wma_10')} FROM bars")
def wma(spark, d):
    return out(ta.wma(bars(spark, d), length=10), "wma_10")


@query(f"WITH {BARS}, x AS (SELECT *, 2 * {weighted('close', 8)} - {weighted('close', 16)} AS raw FROM bars) SELECT symbol, ts, {r(weighted('raw', 4), 'hma_16')} FROM x")
def hma(spark, d):
    return out(ta.hma(bars(spark, d), length=16), "hma_16")


@query(f"""WITH {BARS}, x AS (SELECT *, {over("min(low)", 14)} AS lo, {over("max(high)", 14)} AS hi FROM bars), k AS (SELECT *, 100 * (close - lo) / nullif(hi - lo, 0) AS k0 FROM x),
    s AS (SELECT *, {over("avg(k0)", 3, "k0")} AS k1 FROM k) SELECT symbol, ts, {r("k1", "stochk_14_3_3")}, {r(over("avg(k1)", 3, "k1"), "stochd_14_3_3")} FROM s""")
def stoch(spark, d):
    return out(ta.stoch(bars(spark, d)), "stochk_14_3_3", "stochd_14_3_3")


@query(f"""WITH {BARS}, x AS (SELECT *, (high + low + close) / 3 AS tp FROM bars), m AS (SELECT *, list(tp) OVER {frame(14)} AS l, avg(tp) OVER {frame(14)} AS a FROM x)
    SELECT symbol, ts, round(CASE WHEN len(l) = 14 THEN (tp - a) / nullif(0.015 * list_sum([abs(v - a) for v in l]) / 14, 0) END, 6) + 0.0 AS cci_14 FROM m""")
def cci(spark, d):
    return out(ta.cci(bars(spark, d)), "cci_14")


@query(f"""WITH {BARS}, x AS (SELECT *, list(close) OVER {frame(14)} AS l FROM bars)
    SELECT symbol, ts, round(CASE WHEN len(l) = 14 THEN -list_sum([v * (15 - i) for v, i in l]) / list_sum(l) END, 6) + 0.0 AS cg_14 FROM x""")
def cg(spark, d):
    return out(ta.cg(bars(spark, d)), "cg_14")


@query(f"""WITH {BARS}, k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS b, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM bars),
    f AS (SELECT symbol, count(*) AS n, regr_slope(ln(close), i) AS s, regr_r2(ln(close), i) AS r2 FROM k WHERE b <= 90 GROUP BY symbol)
    SELECT symbol, {r("r2", "r_squared")}, {r("pow(exp(s), 252) - 1", "fit_coef", 4)}, {r("(pow(exp(s), 252) - 1) * r2", "factor", 4)} FROM f WHERE n = 90""")
def clenow(spark, d):
    df = ta.clenow(bars(spark, d))
    return df.select("symbol", *((F.round(c, p) + F.lit(0.0)).alias(c) for c, p in (("r_squared", 6), ("fit_coef", 4), ("factor", 4))))


@query(f"""WITH {BARS}, n AS (SELECT *, row_number() OVER w AS i, list(high) OVER f AS hs, list(low) OVER f AS ls FROM bars
        WINDOW w AS (PARTITION BY symbol ORDER BY ts), f AS {frame(11)}),
    u AS (SELECT *, 11 - list_max([j for v, j in hs if v = list_max(hs)]) AS ageu, 11 - list_max([j for v, j in ls if v = list_min(ls)]) AS aged FROM n),
    v AS (SELECT symbol, ts, CASE WHEN i >= 11 THEN 100 * (1 - ageu / 10) END AS a, CASE WHEN i >= 11 THEN 100 * (1 - aged / 10) END AS b FROM u)
    SELECT symbol, ts, {r("a", "aroonu_10")}, {r("b", "aroond_10")}, {r("a - b", "aroonosc_10")} FROM v""")
def aroon(spark, d):
    return out(ta.aroon(bars(spark, d), length=10), "aroonu_10", "aroond_10", "aroonosc_10")


def mid(n: int) -> str:
    return f"({over('max(high)', n, 'high')} + {over('min(low)', n, 'low')}) / 2"


@query(f"""WITH {BARS}, m AS (SELECT *, {mid(9)} AS t, {mid(26)} AS k, {mid(52)} AS b FROM bars)
    SELECT symbol, ts, {r("t", "tenkan")}, {r("k", "kijun")}, {r("lag((t + k) / 2, 25) OVER w", "span_a")}, {r("lag(b, 25) OVER w", "span_b")}, {r("lead(close, 25) OVER w", "chikou")}
    FROM m WINDOW w AS (PARTITION BY symbol ORDER BY ts)""")
def ichimoku(spark, d):
    return out(ta.ichimoku(bars(spark, d)), "tenkan", "kijun", "span_a", "span_b", "chikou")


@query(f"""WITH {BARS}, m AS (SELECT *, {mid(9)} AS t, {mid(26)} AS k, {mid(52)} AS b, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS bk, max(ts) OVER (PARTITION BY symbol) AS e FROM bars)
    SELECT symbol, e + to_hours(CAST(26 - bk AS INT)) AS ts, {r("(t + k) / 2", "span_a")}, {r("b", "span_b")} FROM m WHERE bk < 26""")
def ichimoku_future(spark, d):
    return rounded(ta.ichimoku_ahead(bars(spark, d)))


@query(f"""WITH {BARS}, s AS (SELECT *, coalesce(CAST(sign(close - lag(close, 4) OVER w) AS INT), 0) AS g FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
    c AS (SELECT *, CASE WHEN g IS DISTINCT FROM lag(g) OVER (PARTITION BY symbol ORDER BY ts) THEN 1 ELSE 0 END AS n FROM s),
    i AS (SELECT *, sum(n) OVER (PARTITION BY symbol ORDER BY ts) AS island FROM c), k AS (SELECT *, row_number() OVER (PARTITION BY symbol, island ORDER BY ts) AS run FROM i)
    SELECT symbol, ts, CAST(CASE WHEN g > 0 THEN run ELSE 0 END AS INT) AS td_seq_up, CAST(CASE WHEN g < 0 THEN run ELSE 0 END AS INT) AS td_seq_dn FROM k""")
def demark(spark, d):
    return out(ta.demark(bars(spark, d)), "td_seq_up", "td_seq_dn")


@query(f"""WITH {BARS}, x AS (SELECT *, {over("avg(close)", 20)} AS m, 2 * {over("stddev_samp(close)", 20)} AS s FROM bars)
    SELECT symbol, ts, {r("m", '"bbm_20_2.0"')}, {r("m - s", '"bbl_20_2.0"')}, {r("m + s", '"bbu_20_2.0"')}, {r("200 * s / m", '"bbb_20_2.0"')}, {r("(close - m + s) / nullif(2 * s, 0)", '"bbp_20_2.0"')} FROM x""")
def bollinger_bands(spark, d):
    return out(ta.bbands(bars(spark, d), length=20), *(f"bb{c}_20_2.0" for c in "mlubp"))


@query(f"""WITH {BARS}, x AS (SELECT *, {over("min(low)", 20, "low")} AS lo, {over("max(high)", 20, "high")} AS hi FROM bars)
    SELECT symbol, ts, {r("lo", "dcl_20_20")}, {r("(lo + hi) / 2", "dcm_20_20")}, {r("hi", "dcu_20_20")} FROM x""")
def donchian(spark, d):
    return out(ta.donchian(bars(spark, d)), "dcl_20_20", "dcm_20_20", "dcu_20_20")


@query(f"""WITH {BARS}, x AS (SELECT *, coalesce(sign(close - lag(close) OVER (PARTITION BY symbol ORDER BY ts)), 1) * volume AS s FROM bars)
    SELECT symbol, ts, CAST(sum(s) OVER (PARTITION BY symbol ORDER BY ts) AS DOUBLE) AS obv FROM x""")
def obv(spark, d):
    return out(ta.obv(bars(spark, d)), "obv")


AD = "sum(coalesce((2 * close - low - high) / nullif(high - low, 0), 0) * volume) OVER (PARTITION BY symbol ORDER BY ts)"


@query(f"WITH {BARS} SELECT symbol, ts, {r(AD, 'ad')} FROM bars")
def ad(spark, d):
    return out(ta.ad(bars(spark, d)), "ad")


@query(f"""WITH {BARS} SELECT symbol, ts, round(sum((high + low + close) / 3 * volume) OVER p / sum(volume) OVER p, 6) + 0.0 AS vwap_day FROM bars
    WINDOW p AS (PARTITION BY symbol, date_trunc('day', ts) ORDER BY ts)""")
def vwap(spark, d):
    return out(ta.vwap(bars(spark, d)), "vwap_day")


LEVELS = ", ".join(map(str, ta.FIB))


@query(f"""WITH {BARS}, k AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS b FROM bars),
    e AS (SELECT symbol, min(close) AS lo, max(close) AS hi, first(ts ORDER BY close, ts) AS lt, first(ts ORDER BY close DESC, ts) AS ht FROM k WHERE b <= 120 GROUP BY symbol)
    SELECT symbol, CASE WHEN lt < ht THEN 'right' ELSE 'left' END AS leg, round(CAST(l AS DOUBLE), 6) + 0.0 AS level,
           round(CASE WHEN lt < ht THEN hi + (lo - hi) * l ELSE lo + (hi - lo) * l END, 6) + 0.0 AS price FROM e, (SELECT unnest([{LEVELS}]::DOUBLE[]) AS l)""")
def fibonacci(spark, d):
    return rounded(ta.fib(bars(spark, d)))


# A price of zero has no logarithm; DuckDB gives an infinite one, which a rolling window must not take in.
BASE = f"""{BARS}, z AS (SELECT symbol, ts, nullif(open, 0) AS open, nullif(high, 0) AS high, nullif(low, 0) AS low, nullif(close, 0) AS close FROM bars),
    c AS (SELECT *, ln(close / lag(close) OVER w) AS c, ln(open / lag(close) OVER w) AS o, ln(high / low) AS hl, ln(close / open) AS co, ln(high / open) AS ho, ln(low / open) AS lo
    FROM z WINDOW w AS (PARTITION BY symbol ORDER BY ts)), t AS (SELECT *, ho * (ho - co) + lo * (lo - co) AS rs, CASE WHEN c IS NOT NULL THEN ho * (ho - co) + lo * (lo - co) END AS rs2 FROM c)"""


def estimator(model: str, n: int) -> str:
    """An estimator over the last ``n`` bars in SQL."""
    k, left = 0.34 / (1.34 + (n + 1) / (n - 1)), f"nullif(count(c) OVER (PARTITION BY symbol) - {n - 1}, 0)"
    return {
        "std": f"{over('stddev_samp(c)', n, 'c')} * sqrt(252)",
        "parkinson": f"sqrt({over('avg(hl * hl / (4 * ln(2)))', n, 'hl')} * 252)",
        "garman_klass": f"sqrt({over('avg(0.5 * hl * hl - (2 * ln(2) - 1) * co * co)', n, 'hl')} * 252)",
        "rogers_satchell": f"sqrt({over('avg(rs)', n, 'rs')} * 252)",
        "hodges_tompkins": f"{over('stddev_samp(c)', n, 'c')} * sqrt(252) / (1 - {n} / {left} + {n * n - 1} / (3 * power({left}, 2)))",
        "yang_zhang": f"sqrt({over('sum(o * o)', n, 'o')} / {n - 1} + {k} * {over('sum(c * c)', n, 'c')} / {n - 1} + {1 - k} * {over('sum(rs2)', n, 'rs2')} / {n - 1}) * {math.sqrt(252)}",
    }[model]


def cones_sql(model: str) -> str:
    each = " UNION ALL ".join(f"SELECT symbol, ts, {n} AS win, {estimator(model, n)} AS v FROM t" for n in ta.CONE_WINDOWS)
    return f"""WITH {BASE}, v AS ({each})
        SELECT symbol, win AS "window", {r("last(v ORDER BY ts)", "realized")}, {r("min(v)", "min")}, {r("quantile_cont(v, 0.25)", "lower")}, {r("quantile_cont(v, 0.5)", "median")}, {r("quantile_cont(v, 0.75)", "upper")}, {r("max(v)", "max")}
        FROM v WHERE v IS NOT NULL GROUP BY 1, 2"""


for _model in ta.MODELS:

    @query(f"WITH {BASE} SELECT symbol, ts, {r(estimator(_model, 30), f'vol_{_model}')} FROM t", name=f"volatility_{_model}")
    def _volatility(spark, d, model=_model):
        return out(ta.volatility(bars(spark, d), model), f"vol_{model}")

    @query(cones_sql(_model), name="volatility_cones" if _model == "std" else f"volatility_cones_{_model}")
    def _cones(spark, d, model=_model):
        return rounded(ta.cones(bars(spark, d), model=model))


SCALE = {
    "z": "({0} - avg({0}) OVER p) / stddev_samp({0}) OVER p",
    "m": "({0} - min({0}) OVER p) / (max({0}) OVER p - min({0}) OVER p)",
    "a": "{0} / max(abs({0})) OVER p",
}


def rotation_sql(value: str, method: str) -> str:
    z = SCALE[method]
    return f"""WITH {BASE}, s AS (SELECT symbol, ts, {value} AS x FROM t JOIN bars USING (symbol, ts)), b AS (SELECT x.symbol, x.ts, x.x / nullif(y.x, 0) * 100 AS ratio FROM s x JOIN s y ON x.ts = y.ts AND y.symbol = 'click' AND x.symbol <> 'click' WHERE x.x IS NOT NULL AND y.x IS NOT NULL),
        m AS (SELECT *, ln(ratio / lag(ratio, 60) OVER w + 1e-10) - ln(ratio / lag(ratio, 10) OVER w + 1e-10) AS momentum FROM b WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
        n AS (SELECT * FROM m WHERE momentum IS NOT NULL)
        SELECT symbol, ts, {r("ratio")}, {r("momentum")}, {r(z.format("ratio"), f"{method}_ratio")}, {r(z.format("momentum"), f"{method}_momentum")} FROM n WINDOW p AS (PARTITION BY symbol)"""


@query(rotation_sql("bars.close", "z"))
def relative_rotation(spark, d):
    return rounded(ta.relative_rotation(bars(spark, d), "click", long=60, short=10))


@query(rotation_sql("bars.volume", "m"))
def relative_rotation_volume(spark, d):
    return rounded(ta.relative_rotation(bars(spark, d), "click", long=60, short=10, study="volume", method="m"))


@query(rotation_sql(estimator("std", 21), "a"))
def relative_rotation_volatility(spark, d):
    return rounded(ta.relative_rotation(bars(spark, d), "click", long=60, short=10, study="volatility", method="a"))


QUERIES, SQL = query.queries, query.sql
