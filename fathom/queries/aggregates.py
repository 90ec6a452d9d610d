"""Aggregations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import aggregates as ag
from fathom.plans.bars import friday_week, resample

from .base import BARS, DAILY, Registry, bars, daily, r, rounded, table

query = Registry()


@query(f"""WITH g AS (SELECT l_suppkey, l_returnflag, sum(l_quantity) AS l_quantity, sum(l_extendedprice) AS l_extendedprice FROM lineitem GROUP BY 1, 2)
    SELECT l_suppkey, l_returnflag, {r("l_quantity", places=2)}, {r("l_extendedprice", places=2)}, round(l_extendedprice / (SELECT sum(l_extendedprice) FROM lineitem), 6) AS weight FROM g""")
def agg_holdings(spark, d):
    df = table(spark, d, "lineitem").withColumn("none", F.lit(0.0))
    out = ag.holdings(df, ["l_suppkey", "l_returnflag"], ["l_quantity", "l_extendedprice", "none"], "l_extendedprice", drop_zero=["none"])
    return rounded(out.withColumns({c: F.round(c, 2) for c in ("l_quantity", "l_extendedprice")}))


@query("""WITH v AS (SELECT user_id, event_type, floor(value / 50) AS band, count(*) AS observations, count(DISTINCT CAST(ts AS DATE)) AS sources, bool_or(value > 100) AS any_flag, bool_and(value > 100) AS all_flag FROM events GROUP BY 1, 2, 3)
    SELECT user_id, event_type, CAST(band AS BIGINT) AS band, observations, sources, any_flag, all_flag, count(*) OVER (PARTITION BY user_id, event_type) AS variant_count FROM v""")
def agg_variants(spark, d):
    df = table(spark, d, "events").select("user_id", "event_type", F.floor(F.col("value") / 50).alias("band"), F.to_date("ts").alias("source"), (F.col("value") > 100).alias("flag"))
    return ag.variants(df, ["user_id", "event_type"], ["band"], "flag")


@query("SELECT event_type, count(*) FILTER (WHERE value > 100) AS large, count(*) FILTER (WHERE value <= 10) AS small, count(*) FILTER (WHERE user_id IS NULL) AS unknown FROM events GROUP BY 1")
def agg_filtered_counts(spark, d):
    return ag.conditional_counts(table(spark, d, "events"), ["event_type"], large=F.col("value") > 100, small=F.col("value") <= 10, unknown=F.col("user_id").isNull())


@query("SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2")
def agg_disposition(spark, d):
    return table(spark, d, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count("*").alias("n"))


@query("SELECT count(o_custkey) - count(DISTINCT o_custkey) AS collisions FROM orders")
def agg_collisions(spark, d):
    return ag.collisions(table(spark, d, "orders"), "o_custkey")


H = "sha256(concat(" + ", ".join(f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')" for c in ("s_suppkey", "s_name", "s_nationkey")) + "))"


@query(f"""WITH h AS (SELECT s_nationkey, {H} AS h FROM supplier)
    SELECT s_nationkey, count(*) AS rows, sha256(concat_ws(',', count(*), {", ".join(f"CAST(sum(CAST('0x' || substr(h, {16 * i + 1}, 15) AS BIGINT)) AS VARCHAR)" for i in range(4))})) AS digest FROM h GROUP BY 1""")
def agg_content_digest(spark, d):
    return ag.content_digest(table(spark, d, "supplier"), ["s_suppkey", "s_name", "s_nationkey"], ["s_nationkey"])


@query("SELECT n_regionkey, string_agg(n_nationkey, ',' ORDER BY n_nationkey) AS children FROM (SELECT n_regionkey, CAST(n_nationkey AS VARCHAR) AS n_nationkey FROM nation) GROUP BY 1")
def agg_children(spark, d):
    return ag.children(table(spark, d, "nation"), ["n_regionkey"], "n_nationkey")


@query("SELECT coalesce(CASE WHEN value > 200 THEN 'large' WHEN value < 5 THEN 'small' END, 'valid') AS reason, count(*) AS n FROM events GROUP BY 1")
def agg_reasons(spark, d):
    return ag.reasons(table(spark, d, "events").select(F.when(F.col("value") > 200, "large").when(F.col("value") < 5, "small").alias("why")), "why")


@query("SELECT event_type, max(ts) AS watermark, count(*) AS rows FROM events GROUP BY 1")
def agg_watermark(spark, d):
    return ag.watermark(table(spark, d, "events"), ["event_type"], "ts")


@query("SELECT event_type, CAST(sum(CASE json_extract_string(props, '$.k') WHEN '1' THEN 1 ELSE 0 END) AS BIGINT) AS n_1, CAST(sum(CASE json_extract_string(props, '$.k') WHEN '69' THEN 1 ELSE 0 END) AS BIGINT) AS n_69 FROM events GROUP BY 1")
def agg_json_counts(spark, d):
    return ag.json_counts(table(spark, d, "events"), ["event_type"], "props", "$.k", ["1", "69"])


@query(f"""WITH g AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS received, count(DISTINCT hour(ts)) AS slots, sum(value) AS total FROM events GROUP BY 1, 2)
    SELECT event_type, day, received, slots, {r("total", places=3)}, CAST(greatest(24 - slots, 0) AS BIGINT) AS missed, CASE WHEN slots >= 24 THEN 'complete' WHEN slots >= 12 THEN 'partial' ELSE 'poor' END AS health FROM g""")
def agg_session_report(spark, d):
    df = table(spark, d, "events").select("event_type", F.to_date("ts").alias("day"), F.hour("ts").alias("slot"), "value")
    return rounded(ag.session_report(df, ["event_type", "day"], "value", 24), 3)


RESAMPLED = "first(open ORDER BY ts) AS open, max(high) AS high, min(low) AS low, last(close ORDER BY ts) AS close, CAST(sum(volume) AS BIGINT) AS volume"


@query(f"WITH {BARS} SELECT symbol, date_trunc('month', ts) AS bucket, {RESAMPLED} FROM bars GROUP BY 1, 2")
def resample_month(spark, d):
    return resample(bars(spark, d), F.date_trunc("month", "ts").cast("timestamp_ntz"))


@query(f"WITH {BARS} SELECT symbol, CAST(ts AS DATE) + CAST((12 - dayofweek(ts)) % 7 AS INT) AS bucket, {RESAMPLED} FROM bars GROUP BY 1, 2")
def resample_week_friday(spark, d):
    return resample(bars(spark, d), friday_week(F.to_date("ts")))


@query(f"WITH {BARS} SELECT symbol, CAST(ts AS DATE) AS day, last(close ORDER BY ts) AS close FROM bars GROUP BY 1, 2")
def resample_last(spark, d):
    return bars(spark, d).groupBy("symbol", F.to_date("ts").alias("day")).agg(F.max_by("close", "ts").alias("close"))


@query(f"""SELECT CAST(o_orderdate AS DATE) AS day, {", ".join(f"round(avg(o_totalprice) FILTER (WHERE o_orderstatus = '{s}'), 4) AS {s}" for s in "FOP")} FROM orders GROUP BY 1""")
def pivot_mean(spark, d):
    return rounded(table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).pivot("o_orderstatus", ["F", "O", "P"]).agg(F.avg("o_totalprice")), 4)


@query("SELECT nullif(user_id % 3, 0) AS k, count(*) AS n FROM events GROUP BY 1")
def agg_null_keys(spark, d):
    return table(spark, d, "events").groupBy(F.nullif(F.col("user_id") % 3, F.lit(0)).alias("k")).agg(F.count("*").alias("n"))


@query(f"SELECT l_returnflag, l_linestatus, {r('sum(l_quantity)', 'q', 2)}, count(*) AS n FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)")
def agg_cube(spark, d):
    return rounded(table(spark, d, "lineitem").cube("l_returnflag", "l_linestatus").agg(F.sum("l_quantity").alias("q"), F.count("*").alias("n")), 2)


@query(f"""WITH {DAILY} SELECT symbol, year(date) AS y, {r("sum(value)", "total", 2)}, grouping_id(symbol, year(date)) AS g FROM daily GROUP BY ROLLUP (symbol, year(date))""")
def agg_rollup(spark, d):
    return rounded(daily(spark, d).rollup("symbol", F.year("date").cast("long").alias("y")).agg(F.sum("value").alias("total"), F.grouping_id().alias("g")), 2)


@query("""SELECT o_custkey % 10 AS strike, CAST(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS calls, CAST(sum(CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END) AS BIGINT) AS puts,
    min(o_orderdate) AS started, max(o_orderdate) AS updated, round(sum(CASE WHEN o_orderstatus <> 'O' THEN 1 ELSE 0 END) / nullif(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END), 0), 6) AS ratio FROM orders GROUP BY ROLLUP (o_custkey % 10)""")
def agg_flow_by_strike(spark, d):
    o = F.col("o_orderstatus") == "O"
    g = table(spark, d, "orders").rollup((F.col("o_custkey") % 10).alias("strike")).agg(F.count_if(o).alias("calls"), F.count_if(~o).alias("puts"), F.min("o_orderdate").alias("started"), F.max("o_orderdate").alias("updated"))
    return rounded(g.withColumn("ratio", F.when(F.col("calls") > 0, F.col("puts") / F.col("calls"))))


QUERIES, SQL = query.queries, query.sql
