"""Options over a chain that is derived from ``part``: a contract a part, with made-up but fixed quotes."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import options as op

from .base import Registry, r, rounded, table

query = Registry()
CHAIN = """chain AS (SELECT 'U' || (p_partkey % 5) AS underlying, 'C' || p_partkey AS contract_symbol, DATE '2024-01-01' + CAST(p_partkey % 12 * 15 AS INT) AS expiration,
    CAST(p_partkey % 12 * 15 AS INT) AS dte, CAST(900.0 + p_size * 20.0 AS DOUBLE) AS strike, CASE WHEN p_partkey % 2 = 0 THEN 'call' ELSE 'put' END AS option_type, CAST(1400.0 AS DOUBLE) AS price,
    p_retailprice / 100 AS bid, p_retailprice / 100 + 0.5 AS ask, p_partkey % 50 AS open_interest, p_partkey % 30 AS volume,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 0.1 + (p_partkey % 40) / 100.0 END::DOUBLE AS iv, (CASE WHEN p_partkey % 2 = 0 THEN 1 ELSE -1 END) * (p_partkey % 100) / 100.0 AS delta, (p_partkey % 7) / 1000.0 AS gamma
    FROM part)"""


def chain(spark, d):
    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.concat(F.lit("U"), k % 5).alias("underlying"), F.concat(F.lit("C"), k).alias("contract_symbol"), F.date_add(F.lit("2024-01-01").cast("date"), (k % 12 * 15).cast("int")).alias("expiration"),
        (k % 12 * 15).cast("int").alias("dte"), (900.0 + F.col("p_size") * 20.0).alias("strike"), F.when(k % 2 == 0, "call").otherwise("put").alias("option_type"), F.lit(1400.0).alias("price"),
        (F.col("p_retailprice") / 100).alias("bid"), (F.col("p_retailprice") / 100 + 0.5).alias("ask"), (k % 50).alias("open_interest"), (k % 30).alias("volume"),
        F.when(k % 11 != 0, 0.1 + (k % 40) / 100.0).alias("iv"), (F.when(k % 2 == 0, 1).otherwise(-1) * (k % 100) / 100.0).alias("delta"), ((k % 7) / 1000.0).alias("gamma"),
    )


@query(f"""WITH {CHAIN} SELECT contract_symbol, {r("CASE option_type WHEN 'call' THEN strike + ask ELSE strike - ask END", "breakeven")}, CAST(trunc(delta * 100 * open_interest * price) AS BIGINT) AS dex,
    CAST(trunc((CASE option_type WHEN 'call' THEN 1 ELSE -1 END) * (gamma * 100 * open_interest * price * price * 0.01)) AS BIGINT) AS gex FROM chain""")
def options_enrich(spark, d):
    return rounded(op.enrich(chain(spark, d)).select("contract_symbol", "breakeven", "dex", "gex"))


@query(f"WITH {CHAIN} SELECT underlying, count(DISTINCT expiration) AS expirations, count(DISTINCT strike) AS strikes, bool_or(iv IS NOT NULL) AS has_iv, bool_or(delta IS NOT NULL) AS has_greeks FROM chain GROUP BY 1")
def options_facts(spark, d):
    return op.facts(chain(spark, d))


@query(f"""WITH {CHAIN}, g AS (SELECT underlying, expiration, sum(open_interest) FILTER (WHERE option_type = 'call') AS c, sum(open_interest) FILTER (WHERE option_type = 'put') AS p FROM chain GROUP BY 1, 2), t AS (SELECT underlying, sum(open_interest) AS whole FROM chain GROUP BY 1)
    SELECT underlying, expiration, CAST(nullif(c, 0) AS BIGINT) AS calls, CAST(nullif(p, 0) AS BIGINT) AS puts, CAST(nullif(coalesce(c, 0) + coalesce(p, 0), 0) AS BIGINT) AS total, round(nullif(p, 0) / nullif(c, 0), 4) AS pcr,
           round(nullif(coalesce(c, 0) + coalesce(p, 0), 0) / whole * 100, 4) AS net_percent FROM g JOIN t USING (underlying) WHERE nullif(c, 0) IS NOT NULL OR nullif(p, 0) IS NOT NULL""")
def options_by_expiration(spark, d):
    return op.by_group(chain(spark, d), ["underlying", "expiration"], "open_interest")


@query(f"""WITH {CHAIN}, e AS (SELECT *, abs(CAST(trunc(delta * 100 * open_interest * price) AS BIGINT)) AS dex FROM chain), t AS (SELECT underlying, sum(dex) AS whole FROM e GROUP BY 1),
    g AS (SELECT underlying, strike, sum(dex) FILTER (WHERE option_type = 'call') AS c, sum(dex) FILTER (WHERE option_type = 'put') AS p FROM e WHERE (option_type = 'call' AND strike >= price) OR (option_type = 'put' AND strike <= price) GROUP BY 1, 2)
    SELECT underlying, strike, CAST(nullif(c, 0) AS BIGINT) AS calls, CAST(nullif(p, 0) AS BIGINT) AS puts, CAST(nullif(coalesce(c, 0) + coalesce(p, 0), 0) AS BIGINT) AS total, round(nullif(p, 0) / nullif(c, 0), 4) AS pcr,
           round(nullif(coalesce(c, 0) + coalesce(p, 0), 0) / whole * 100, 4) AS net_percent FROM g JOIN t USING (underlying) WHERE nullif(c, 0) IS NOT NULL OR nullif(p, 0) IS NOT NULL""")
def options_exposure_by_strike(spark, d):
    """Delta exposure out of the money, by strike, in percent of the whole chain's."""
    return op.by_group(op.enrich(chain(spark, d)), ["underlying", "strike"], "dex", moneyness="otm")


@query(f"""WITH {CHAIN} SELECT underlying, CASE grouping_id(expiration, strike) WHEN 3 THEN 'total' WHEN 1 THEN 'expiration' ELSE 'strike' END AS level, expiration, strike,
    CAST(sum(CASE option_type WHEN 'call' THEN volume ELSE 0 END) AS BIGINT) AS calls, CAST(sum(CASE option_type WHEN 'put' THEN volume ELSE 0 END) AS BIGINT) AS puts, CAST(sum(volume) AS BIGINT) AS total
    FROM chain GROUP BY GROUPING SETS ((underlying), (underlying, expiration), (underlying, strike))""")
def options_grouping_sets(spark, d):
    return op.grouping(chain(spark, d), "volume")


@query(f"WITH {CHAIN} SELECT underlying, first(expiration ORDER BY abs(dte - 70), dte) AS expiration FROM chain GROUP BY 1")
def nearest_expiration(spark, d):
    return op.nearest_expiration(chain(spark, d), 70)


@query(f"WITH {CHAIN} SELECT underlying, expiration, first(strike ORDER BY abs(strike - price * 1.05), strike) AS strike FROM chain WHERE option_type = 'call' AND strike >= price * 1.05 GROUP BY 1, 2")
def nearest_strike(spark, d):
    return op.nearest_strike(chain(spark, d), 0.05, "call", one_sided=True)


def leg(name: str, option: str, moved: float, price: str = "ask") -> str:
    o = f"ORDER BY abs(strike - price * {1 + moved}), strike, {price}"
    return f"{name} AS (SELECT underlying, expiration, first(strike {o}) AS k, first({price} {o}) AS p, first(price {o}) AS s FROM chain WHERE option_type = '{option}' AND {price} IS NOT NULL GROUP BY 1, 2)"


def strategy(name: str, a: tuple, b: tuple, cost: str, up: str, down: str) -> str:
    return f"""(WITH {leg("a", *a)}, {leg("b", *b)}, j AS (SELECT a.underlying, a.expiration, a.k AS ak, b.k AS bk, a.p AS ap, b.p AS bp, a.s, {cost} AS cost FROM a JOIN b USING (underlying, expiration))
        SELECT underlying, expiration, '{name}' AS strategy, {r("ak", "a_strike")}, {r("bk", "b_strike")}, {r("ap", "a_price")}, {r("bp", "b_price")}, {r("cost")}, {r("cost / s * 100", "cost_percent")},
               round(CAST({up} AS DOUBLE), 6) + 0.0 AS breakeven_upper, round(CAST({down} AS DOUBLE), 6) + 0.0 AS breakeven_lower FROM j)"""


ALL = " UNION ALL ".join([
    strategy("straddle", ("call", 0), ("put", 0), "a.p + b.p", "ak + cost", "bk - cost"), strategy("strangle", ("call", 0.05), ("put", -0.05), "a.p + b.p", "ak + cost", "bk - cost"),
    strategy("vertical_call", ("call", -0.025), ("call", 0.025, "bid"), "a.p - b.p", "ak + cost", "NULL"), strategy("vertical_put", ("put", 0.025), ("put", -0.025, "bid"), "a.p - b.p", "NULL", "ak - cost"),
    strategy("synthetic_long", ("call", 0), ("put", 0, "bid"), "a.p - b.p", "ak + cost", "NULL"), strategy("synthetic_short", ("put", 0), ("call", 0, "bid"), "a.p - b.p", "NULL", "ak - cost"),
])


@query(f"WITH {CHAIN} {ALL}")
def options_strategies(spark, d):
    return rounded(op.strategies(chain(spark, d)))


@query(f"""WITH {CHAIN}, i AS (SELECT * FROM chain WHERE iv IS NOT NULL), m AS (SELECT underlying, expiration, option_type, first(iv ORDER BY abs(strike - price), strike, iv) AS a FROM i GROUP BY 1, 2, 3)
    SELECT underlying, expiration, option_type, count(*) AS n, {r("avg(iv) - any_value(a)", "skew")} FROM i JOIN m USING (underlying, expiration, option_type) GROUP BY 1, 2, 3""")
def options_vertical_skew(spark, d):
    df = chain(spark, d)
    df = df.groupBy("underlying", "expiration", "option_type", "strike", "price").agg(F.min("iv").alias("iv")).join(df.groupBy("underlying", "expiration", "option_type", "strike", "price").agg(F.sort_array(F.collect_list("iv")).alias("ivs")), ["underlying", "expiration", "option_type", "strike", "price"])
    skew = op.vertical_skew(df).join(df.select("underlying", "expiration", "option_type", "strike", F.explode("ivs").alias("one")), ["underlying", "expiration", "option_type", "strike"])
    return rounded(skew.groupBy("underlying", "expiration", "option_type").agg(F.count("*").alias("n"), (F.avg("one") - F.any_value("atm_iv")).alias("skew")))


@query(f"""WITH {CHAIN}, i AS (SELECT underlying, expiration, strike, option_type, price, min(iv) AS iv FROM chain WHERE iv IS NOT NULL GROUP BY ALL)
    SELECT underlying, expiration, {r("first(iv ORDER BY abs(strike - price * 0.8), strike) FILTER (WHERE option_type = 'put')", "put_iv")}, {r("first(iv ORDER BY abs(strike - price * 1.2), strike) FILTER (WHERE option_type = 'call')", "call_iv")},
           {r("first(iv ORDER BY abs(strike - price * 0.8), strike) FILTER (WHERE option_type = 'put') - first(iv ORDER BY abs(strike - price * 1.2), strike) FILTER (WHERE option_type = 'call')", "skew")} FROM i GROUP BY 1, 2""")
def options_horizontal_skew(spark, d):
    one = chain(spark, d).groupBy("underlying", "expiration", "strike", "option_type", "price").agg(F.min("iv").alias("iv"))
    return rounded(op.horizontal_skew(one))


TRADES = """trades AS (SELECT 'U' || (user_id % 5) AS underlying, event_id, ts, CASE WHEN event_id % 2 = 0 THEN 'call' ELSE 'put' END AS option_type, event_id % 9 + 1 AS size, value AS trade_price,
    CASE WHEN event_id % 10 = 0 THEN NULL ELSE value - (event_id % 3) END AS bid, value + (event_id % 4) AS ask FROM events),
    sided AS (SELECT *, CASE WHEN trade_price > (bid + ask) / 2 THEN 'buy' WHEN trade_price < (bid + ask) / 2 THEN 'sell' WHEN trade_price > lag(trade_price) OVER w THEN 'buy'
        WHEN trade_price < lag(trade_price) OVER w THEN 'sell' ELSE 'unknown' END AS side FROM trades WINDOW w AS (PARTITION BY underlying ORDER BY ts, event_id))"""


def sided(spark, d):
    from pyspark.sql import Window

    e = F.col("event_id")
    t = table(spark, d, "events").select(F.concat(F.lit("U"), F.col("user_id") % 5).alias("underlying"), "event_id", "ts", F.when(e % 2 == 0, "call").otherwise("put").alias("option_type"), (e % 9 + 1).alias("size"), F.col("value").alias("trade_price"), F.when(e % 10 != 0, F.col("value") - (e % 3)).alias("bid"), (F.col("value") + (e % 4)).alias("ask"))
    before = F.lag("trade_price").over(Window.partitionBy("underlying").orderBy("ts", "event_id"))
    return t.withColumn("side", op.trade_side(F.col("trade_price"), F.col("bid"), F.col("ask"), before))


@query(f"WITH {TRADES} SELECT event_id, side FROM sided")
def trade_classification(spark, d):
    return sided(spark, d).select("event_id", "side")


@query(f"""WITH {TRADES}, g AS (SELECT underlying, CAST(sum(CASE option_type WHEN 'call' THEN size ELSE 0 END) AS BIGINT) AS call_volume, CAST(sum(CASE option_type WHEN 'put' THEN size ELSE 0 END) AS BIGINT) AS put_volume,
    CAST(sum(CASE side WHEN 'buy' THEN size WHEN 'sell' THEN -size ELSE 0 END) AS BIGINT) AS signed_volume, {r("sum(size * trade_price)", "premium", 3)} FROM sided GROUP BY 1)
    SELECT *, round(CASE WHEN call_volume > 0 THEN put_volume / call_volume END, 3) AS pcr FROM g""")
def options_flow(spark, d):
    return rounded(op.flow(sided(spark, d), ["underlying"]), 3)


@query(f"""WITH {CHAIN}, n AS (SELECT underlying, first(expiration ORDER BY abs(dte - 90), dte) AS expiration FROM chain GROUP BY 1), i AS (SELECT * FROM chain JOIN n USING (underlying, expiration) WHERE iv IS NOT NULL),
    u AS (SELECT underlying, expiration, strike, option_type, price, min(iv) AS iv, min(delta) AS delta FROM i GROUP BY ALL),
    a AS (SELECT underlying, first(iv ORDER BY abs(strike - price), strike, option_type) AS atm, first(iv ORDER BY abs(abs(delta) - 0.25), strike) FILTER (WHERE option_type = 'put') AS p, first(iv ORDER BY abs(abs(delta) - 0.25), strike) FILTER (WHERE option_type = 'call') AS c FROM u GROUP BY 1)
    SELECT underlying, {r("atm", "atm_iv")}, {r("p - c", "skew25")}, {r("atm - 0.25", "premium")}, CASE WHEN atm - 0.25 > 0.05 THEN 'rich' WHEN atm - 0.25 < -0.05 THEN 'cheap' ELSE 'fair' END AS label FROM a""")
def options_signal(spark, d):
    full = chain(spark, d)
    one = full.where("iv IS NOT NULL").groupBy("underlying", "expiration", "dte", "strike", "option_type", "price").agg(F.min("iv").alias("iv"), F.min("delta").alias("delta"))
    return rounded(op.signal(one.unionByName(full.where("iv IS NULL").select(*one.columns)), 0.25))


@query(f"""WITH {CHAIN}, o AS (SELECT contract_symbol, 0.2::DOUBLE AS iv FROM chain WHERE volume % 2 = 0), q AS (SELECT contract_symbol, 0.3::DOUBLE AS iv FROM chain)
    SELECT contract_symbol, {r("coalesce(chain.iv, o.iv, q.iv)", "iv")}, CASE WHEN chain.iv IS NOT NULL THEN 'chain' WHEN o.iv IS NOT NULL THEN 'other' ELSE 'model' END AS iv_source FROM chain LEFT JOIN o USING (contract_symbol) LEFT JOIN q USING (contract_symbol)""")
def iv_gap_fill(spark, d):
    c = chain(spark, d)
    other, model = c.where("volume % 2 = 0").select("contract_symbol", F.lit(0.2).alias("iv")), c.select("contract_symbol", F.lit(0.3).alias("iv"))
    return rounded(op.fill_iv(c, [("other", other), ("model", model)]).select("contract_symbol", "iv", "iv_source"))


QUERIES, SQL = query.queries, query.sql
