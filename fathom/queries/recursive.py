"""Indicators that refer to their own past; the SQL walks each series with a recursive query."""

from __future__ import annotations

from fathom.operators import indicators as ta

from .base import BARS, Registry, bars, r, rounded
from .indicators import AD, out

query = Registry()
W = "(PARTITION BY symbol ORDER BY ts)"


def smooth(source: str, column: str, n: int, alpha: float, name: str) -> str:
    """CTEs that leave (symbol, ts, v) in ``name``."""
    return f"""{name}_x AS (SELECT symbol, ts, x, row_number() OVER {W} AS k FROM (SELECT symbol, ts, {column} AS x FROM {source}) WHERE x IS NOT NULL),
    {name} AS (SELECT symbol, (SELECT ts FROM {name}_x y WHERE y.symbol = a.symbol AND y.k = {n}) AS ts, {n} AS k, avg(x) AS v FROM {name}_x a WHERE k <= {n} GROUP BY symbol HAVING count(*) = {n}
      UNION ALL SELECT b.symbol, b.ts, CAST(b.k AS INT), {alpha} * b.x + {1 - alpha} * p.v FROM {name} p JOIN {name}_x b ON b.symbol = p.symbol AND b.k = p.k + 1)"""


def ema(source: str, column: str, n: int, name: str) -> str:
    return smooth(source, column, n, 2 / (n + 1), name)


def rma(source: str, column: str, n: int, name: str) -> str:
    return smooth(source, column, n, 1 / n, name)


def joined(*names: str) -> str:
    return "FROM bars " + " ".join(f"LEFT JOIN {n} USING (symbol, ts)" for n in names)


@query(f"WITH RECURSIVE {BARS}, {ema('bars', 'close', 20, 'e')} SELECT symbol, ts, {r('e.v', 'ema_20')} {joined('e')}", name="ema")
def _ema(spark, d):
    return out(ta.ema_(bars(spark, d), length=20), "ema_20")


@query(f"WITH RECURSIVE {BARS}, z AS (SELECT symbol, ts, 2 * close - lag(close, 9) OVER {W} AS x FROM bars), {ema('z', 'x', 20, 'e')} SELECT symbol, ts, {r('e.v', 'zlma_20')} {joined('e')}")
def zlma(spark, d):
    return out(ta.zlma(bars(spark, d), length=20), "zlma_20")


@query(f"""WITH RECURSIVE {BARS}, {ema("bars", "close", 12, "f")}, {ema("bars", "close", 26, "s")}, l AS (SELECT s.symbol, s.ts, f.v - s.v AS x FROM f JOIN s USING (symbol, ts)), {ema("l", "x", 9, "g")}
    SELECT symbol, ts, {r("l.x", "macd_12_26_9")}, {r("l.x - g.v", "macdh_12_26_9")}, {r("g.v", "macds_12_26_9")} {joined("l", "g")}""")
def macd(spark, d):
    return out(ta.macd(bars(spark, d)), "macd_12_26_9", "macdh_12_26_9", "macds_12_26_9")


@query(f"""WITH RECURSIVE {BARS}, c AS (SELECT symbol, ts, close - lag(close) OVER {W} AS x FROM bars), {rma("c", "CASE WHEN x IS NOT NULL THEN greatest(x, 0) END", 14, "u")}, {rma("c", "CASE WHEN x IS NOT NULL THEN greatest(-x, 0) END", 14, "n")}
    SELECT symbol, ts, {r("100 * u.v / (u.v + n.v)", "rsi_14")} {joined("u", "n")}""")
def rsi(spark, d):
    return out(ta.rsi(bars(spark, d)), "rsi_14")


TR = f"tr AS (SELECT symbol, ts, CASE WHEN p IS NOT NULL THEN greatest(high - low, abs(high - p), abs(low - p)) END AS x FROM (SELECT *, lag(close) OVER {W} AS p FROM bars))"


@query(f"WITH RECURSIVE {BARS}, {TR}, {rma('tr', 'x', 14, 'a')} SELECT symbol, ts, {r('a.v', 'atr_14')} {joined('a')}")
def atr(spark, d):
    return out(ta.atr(bars(spark, d)), "atr_14")


@query(f"""WITH RECURSIVE {BARS}, {TR}, {ema("bars", "close", 20, "m")}, {ema("tr", "x", 20, "b")} SELECT symbol, ts, {r("m.v - 2 * b.v", "kcl_20")}, {r("m.v", "kcb_20")}, {r("m.v + 2 * b.v", "kcu_20")} {joined("m", "b")}""")
def keltner(spark, d):
    return out(ta.kc(bars(spark, d)), "kcl_20", "kcb_20", "kcu_20")


@query(f"""WITH RECURSIVE {BARS}, {TR}, mv AS (SELECT symbol, ts, high - lag(high) OVER {W} AS u, lag(low) OVER {W} - low AS n FROM bars),
    dm AS (SELECT symbol, ts, CASE WHEN u IS NOT NULL THEN CASE WHEN u > n AND u > 0 THEN u ELSE 0 END END AS p, CASE WHEN n IS NOT NULL THEN CASE WHEN n > u AND n > 0 THEN n ELSE 0 END END AS q FROM mv),
    {rma("tr", "x", 14, "t")}, {rma("dm", "p", 14, "a")}, {rma("dm", "q", 14, "b")},
    di AS (SELECT symbol, ts, 100 * a.v / t.v AS dp, 100 * b.v / t.v AS dn FROM t JOIN a USING (symbol, ts) JOIN b USING (symbol, ts)), dx AS (SELECT symbol, ts, 100 * abs(dp - dn) / (dp + dn) AS x FROM di), {rma("dx", "x", 14, "e")}
    SELECT symbol, ts, {r("e.v", "adx_14")}, {r("dp", "dmp_14")}, {r("dn", "dmn_14")} {joined("di", "e")}""")
def adx(spark, d):
    return out(ta.adx(bars(spark, d), length=14), "adx_14", "dmp_14", "dmn_14")


@query(f"WITH RECURSIVE {BARS}, a AS (SELECT symbol, ts, {AD} AS x FROM bars), {ema('a', 'x', 3, 'f')}, {ema('a', 'x', 10, 's')} SELECT symbol, ts, {r('f.v - s.v', 'adosc_3_10')} {joined('f', 's')}")
def adosc(spark, d):
    return out(ta.adosc(bars(spark, d)), "adosc_3_10")


@query(f"""WITH RECURSIVE {BARS}, k AS (SELECT *, (high + low) / 2 AS m, row_number() OVER {W} AS k FROM bars),
    z AS (SELECT *, min(m) OVER f AS lo, greatest(max(m) OVER f - min(m) OVER f, 0.001) AS span FROM k WINDOW f AS (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
    v AS (SELECT symbol, ts, k, greatest(-0.999, least(0.999, 0.66 * ((m - lo) / span - 0.5))) AS v FROM z WHERE k = 14
      UNION ALL SELECT z.symbol, z.ts, z.k, greatest(-0.999, least(0.999, 0.66 * ((m - lo) / span - 0.5) + 0.67 * v.v)) FROM v JOIN z ON z.symbol = v.symbol AND z.k = v.k + 1),
    s AS (SELECT symbol, ts, k, 0.5 * ln((1 + v) / (1 - v)) AS y FROM v WHERE k = 14 UNION ALL SELECT v.symbol, v.ts, v.k, 0.5 * ln((1 + v.v) / (1 - v.v)) + 0.5 * s.y FROM s JOIN v ON v.symbol = s.symbol AND v.k = s.k + 1)
    SELECT symbol, ts, {r("s.y", "fisher_14")}, {r("lag(s.y) OVER (PARTITION BY symbol ORDER BY ts)", "fishers_14_1")} {joined("s")}""")
def fisher(spark, d):
    return out(ta.fisher(bars(spark, d)), "fisher_14", "fishers_14_1")


@query(f"""WITH RECURSIVE {BARS}, k AS (SELECT *, (open + high + low + close) / 4 AS c, row_number() OVER {W} AS k FROM bars),
    h AS (SELECT symbol, ts, k, (open + close) / 2 AS o, c FROM k WHERE k = 1 UNION ALL SELECT k.symbol, k.ts, k.k, (h.o + h.c) / 2, k.c FROM h JOIN k ON k.symbol = h.symbol AND k.k = h.k + 1)
    SELECT symbol, ts, {r("o", "ha_open")}, {r("greatest(high, o, c)", "ha_high")}, {r("least(low, o, c)", "ha_low")}, {r("h.c", "ha_close")} FROM bars JOIN h USING (symbol, ts)""")
def heikin_ashi(spark, d):
    return out(ta.heikin_ashi(bars(spark, d)), "ha_open", "ha_high", "ha_low", "ha_close")


@query(f"""WITH RECURSIVE {BARS}, t AS (SELECT *, low < lag(low, 1) OVER w AND lag(low, 1) OVER w < lag(low, 2) OVER w AND low < lead(low, 1) OVER w AND lead(low, 1) OVER w < lead(low, 2) OVER w AS s,
        high > lag(high, 1) OVER w AND lag(high, 1) OVER w > lag(high, 2) OVER w AND high > lead(high, 1) OVER w AND lead(high, 1) OVER w > lead(high, 2) OVER w AS u,
        avg(high - low) OVER (PARTITION BY symbol) AS gap FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
    l AS (SELECT symbol, ts, CASE WHEN s THEN low ELSE high END AS level, gap, row_number() OVER {W} AS k FROM t WHERE s OR u),
    g AS (SELECT symbol, k, [level] AS acc, true AS ok FROM l WHERE k = 1
      UNION ALL SELECT l.symbol, l.k, CASE WHEN len([a for a in g.acc if abs(a - l.level) <= l.gap]) = 0 THEN list_append(g.acc, l.level) ELSE g.acc END, len([a for a in g.acc if abs(a - l.level) <= l.gap]) = 0
      FROM g JOIN l ON l.symbol = g.symbol AND l.k = g.k + 1)
    SELECT symbol, ts, {r("level")} FROM l JOIN g USING (symbol, k) WHERE ok""")
def support_resistance(spark, d):
    return rounded(ta.support_resistance(bars(spark, d)))


QUERIES, SQL = query.queries, query.sql
