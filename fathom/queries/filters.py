"""Filters and projections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from fathom.operators import filters as fl

from .base import BARS, DAILY, Registry, bars, daily, r, rounded, table
from .options import CHAIN, chain

query = Registry()


@query(f"WITH {DAILY} SELECT symbol, date, {r('value', places=2)} FROM daily WHERE upper(symbol) IN ('1-URGENT', '2-HIGH') AND date BETWEEN '1996-01-01' AND '1996-12-31'")
def filter_symbol_dates(spark, d):
    rows = fl.symbol_dates(daily(spark, d), ["1-urgent", "2-High"], dt.date(1996, 1, 1), dt.date(1996, 12, 31))
    return rounded(fl.guarded(rows, 100_000, ["date", "symbol"]), 2)


@query("SELECT s AS symbol FROM (VALUES ('CLICK'), ('NOWHERE'), ('NEVER')) t(s) WHERE s NOT IN (SELECT upper(event_type) FROM events)")
def filter_missing_symbols(spark, d):
    return fl.missing_symbols(table(spark, d, "events").select(F.col("event_type").alias("symbol")), ["click", "nowhere", "never"])


@query("""WITH e AS (SELECT user_id, event_id, CAST(ts AS DATE) AS day FROM events), m AS (SELECT user_id, max(day) AS day FROM e GROUP BY 1) SELECT event_id, user_id, day FROM e JOIN m USING (user_id, day)""")
def filter_latest_snapshot(spark, d):
    rows = table(spark, d, "events").select("event_id", "user_id", F.to_date("ts").alias("day"))
    return fl.latest_snapshot(rows, ["user_id"], "day").select("event_id", "user_id", "day")


@query("SELECT o_orderkey, CASE lower(trim(o_orderstatus)) WHEN 'c' THEN 'call' WHEN 'p' THEN 'put' ELSE lower(trim(o_orderstatus)) END AS side FROM orders")
def filter_side(spark, d):
    return table(spark, d, "orders").select("o_orderkey", fl.side("o_orderstatus").alias("side"))


@query("SELECT o_orderkey FROM orders WHERE o_totalprice >= 1000 AND o_totalprice <= 200000 AND o_orderstatus = 'O'")
def filter_operators(spark, d):
    df = table(spark, d, "orders")
    return df.where(fl.compare("o_totalprice", ">=", 1000.0) & fl.compare("o_totalprice", "<=", 200000.0) & fl.compare("o_orderstatus", "=", "O")).select("o_orderkey")


@query(f"WITH {CHAIN} SELECT contract_symbol, strike, option_type FROM chain WHERE (option_type = 'call' AND strike > price) OR (option_type = 'put' AND strike < price)")
def filter_moneyness(spark, d):
    return fl.moneyness(chain(spark, d), "otm").select("contract_symbol", "strike", "option_type")


@query(f"""WITH {CHAIN} SELECT contract_symbol, strike, dte, option_type, iv FROM chain WHERE dte BETWEEN 10 AND 90 AND iv > 0 AND abs(strike / price - 1) <= 0.25 AND open_interest > 0
    AND ((option_type = 'call' AND strike > price) OR (option_type = 'put' AND strike < price))""")
def filter_surface(spark, d):
    return fl.surface(chain(spark, d), "iv", (10, 90), within=0.25, oi=True, kind="otm").select("contract_symbol", "strike", "dte", "option_type", "iv")


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_discount > 0.05 THEN l_discount END AS spread FROM lineitem WHERE l_quantity >= 10 AND l_quantity <= 20 AND (l_discount <= 0.05 OR l_discount <= 0.08)""")
def filter_screener(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", F.when(F.col("l_discount") > 0.05, F.col("l_discount")).alias("spread"))
    return fl.screen(df, {"l_quantity": (10, 20), "spread": (None, 0.08)}).drop("l_quantity")


@query("SELECT p_partkey FROM part WHERE contains(lower(p_name), 'an') OR contains(lower(p_type), 'an')")
def filter_text_search(spark, d):
    return fl.text_search(table(spark, d, "part"), "AN", ["p_name", "p_type"]).select("p_partkey")


@query("SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer")
def project_rename(spark, d):
    df = fl.standard_names(table(spark, d, "customer").toDF("Id", "Name", "Nation Key", "Balance", "Mkt-Segment"))
    return fl.project(df, ["id", "name", "balance"])


#: Rounded as a decimal number, as the engine does: in binary a tie may fall either way.
DECIMAL = "CAST(round(CAST(CAST({0} * k AS VARCHAR) AS DECIMAL(38, 20)), 6) AS DOUBLE) AS {0}"
ADJUST = f"{BARS}, a AS (SELECT *, CASE WHEN volume = 1 THEN NULL WHEN volume = 2 THEN 0.0 ELSE 1.0 / volume END AS k FROM bars)"


def factored(spark, d):
    v = F.col("volume")
    return bars(spark, d).withColumn("k", F.when(v == 2, 0.0).when(v > 2, 1.0 / v)).withColumn("vwap", F.col("close"))


@query(f"WITH {ADJUST} SELECT symbol, ts, {DECIMAL.format('open')}, {DECIMAL.format('high')}, {DECIMAL.format('low')}, {DECIMAL.format('close')}, CAST(NULL AS DOUBLE) AS vwap FROM a WHERE k > 0")
def adjust_basis(spark, d):
    return rounded(fl.adjusted(factored(spark, d).where("k > 0"), "split", {"split": "k"}).select("symbol", "ts", "open", "high", "low", "close", "vwap"))


@query(f"WITH {ADJUST} SELECT symbol, ts, CASE WHEN k IS NULL THEN 'missing_factor' ELSE 'factor_not_positive' END AS fault FROM a WHERE k IS NULL OR k <= 0")
def adjust_faults(spark, d):
    return fl.adjustment_faults(factored(spark, d), ["symbol", "ts"], "k")


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def project_numeric(spark, d):
    return fl.numeric_only(table(spark, d, "orders"))


@query("SELECT event_id, value FROM (SELECT event_id, nullif(user_id % 3, 0) AS a, nullif(user_id % 5, 0) AS b, value FROM events) WHERE a IS NOT NULL AND b IS NOT NULL")
def drop_null_rows(spark, d):
    u = F.col("user_id")
    df = table(spark, d, "events").select("event_id", F.nullif(u % 3, F.lit(0)).alias("a"), F.nullif(u % 5, F.lit(0)).alias("b"), "value")
    return fl.present_rows(df, ["a", "b"]).select("event_id", "value")


@query("""SELECT event_id, CASE WHEN coalesce(nullif(user_id % 7, 3) = 0, true) THEN 'quarantine' WHEN coalesce(value > 100, true) OR event_type = 'click' THEN 'conditional' ELSE 'clean' END AS quality FROM events""")
def classify_quality(spark, d):
    q = fl.quality([F.nullif(F.col("user_id") % 7, F.lit(3)) == 0], [F.col("value") > 100, F.col("event_type") == "click"])
    return table(spark, d, "events").select("event_id", q.alias("quality"))


@query(r"""WITH t AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(user_id AS VARCHAR) || '.5' WHEN 1 THEN '1e5' WHEN 2 THEN '-' || CAST(user_id AS VARCHAR) ELSE ' 7' END AS s FROM events)
    SELECT event_id, CASE WHEN regexp_full_match(s, '-?[0-9]{1,20}(\.[0-9]{1,18})?') THEN CAST(try_cast(s AS DECIMAL(38, 18)) AS DOUBLE) END AS v FROM t""")
def lexical_numbers(spark, d):
    u, k = F.col("user_id").cast("string"), F.col("event_id") % 4
    df = table(spark, d, "events").select("event_id", F.when(k == 0, F.concat(u, F.lit(".5"))).when(k == 1, "1e5").when(k == 2, F.concat(F.lit("-"), u)).otherwise(" 7").alias("s"))
    return df.select("event_id", fl.lexical_decimal("s").cast("double").alias("v"))


@query(f"WITH {BARS} SELECT symbol, ts, low <= least(open, close) AND high >= greatest(open, close) AS ok FROM bars")
def ohlc_check(spark, d):
    return bars(spark, d).select("symbol", "ts", fl.ohlc_ordered().alias("ok"))


@query("SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18, 2)) * 0.01 AS DOUBLE) AS ratio FROM orders")
def percent_units(spark, d):
    return table(spark, d, "orders").select("o_orderkey", fl.percent_to_ratio("o_totalprice").cast("double").alias("ratio"))


QUERIES, SQL = query.queries, query.sql
