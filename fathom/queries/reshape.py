"""Sorts, top-k, set operations, reshaping."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import reshape as rs

from .base import DAILY, Registry, daily, r, rounded, table

query = Registry()


@query("SELECT l_returnflag, l_orderkey, l_linenumber, l_extendedprice, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC, l_orderkey * 10 + l_linenumber) AS rank FROM lineitem) WHERE rank <= 5")
def top_k_per_group(spark, d):
    df = table(spark, d, "lineitem").withColumn("id", F.col("l_orderkey") * 10 + F.col("l_linenumber"))
    return rs.top_k(df, ["l_returnflag"], "l_extendedprice", "id", 5).select("l_returnflag", "l_orderkey", "l_linenumber", "l_extendedprice", "rank")


@query("SELECT event_id, value FROM events ORDER BY value DESC, event_id LIMIT 25")
def top_rows(spark, d):
    return table(spark, d, "events").select("event_id", "value").orderBy(F.col("value").desc(), "event_id").limit(25)


@query("SELECT user_id, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def first_per_group(spark, d):
    return rs.first_of(table(spark, d, "events"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_id", "value")


@query("SELECT user_id, first(event_id ORDER BY abs(value - 100), ts, event_id) AS event_id FROM events GROUP BY 1")
def min_by_composite(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.min_by("event_id", F.struct(F.abs(F.col("value") - 100), "ts", "event_id")).alias("event_id"))


@query("SELECT o_orderkey, CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '3-MEDIUM' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END AS place FROM orders")
def sort_category(spark, d):
    return table(spark, d, "orders").select("o_orderkey", rs.category_key("o_orderpriority", ["5-LOW", "3-MEDIUM", "1-URGENT"]).alias("place"))


@query("SELECT r_name, CAST(row_number() OVER (ORDER BY r_name = 'EUROPE', r_name DESC) AS INT) AS n FROM region")
def sort_total_last(spark, d):
    from pyspark.sql import Window

    w = Window.orderBy(rs.world_last("r_name", "EUROPE"), F.col("r_name").desc())
    return table(spark, d, "region").select("r_name", F.row_number().over(w).alias("n"))


@query("SELECT label, m AS months FROM (VALUES ('year_5', 60.0::DOUBLE), ('month_3', 3.0), ('other', NULL)) t(label, m)")
def sort_duration(spark, d):
    df = spark.createDataFrame([("year_5",), ("month_3",), ("other",)], "label string")
    return df.select("label", rs.duration_months(F.col("label")).alias("months"))


@query("SELECT o_orderkey FROM orders WHERE o_orderkey > 500 ORDER BY o_orderkey LIMIT 100")
def keyset_page(spark, d):
    return rs.page_after(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 500, 100)


@query("SELECT c_custkey AS id, 'customer' AS kind, c_acctbal AS balance, CAST(NULL AS VARCHAR) AS extra FROM customer UNION ALL SELECT s_suppkey, 'supplier', s_acctbal, s_name FROM supplier")
def union_by_name(spark, d):
    c = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.lit("customer").alias("kind"), F.col("c_acctbal").alias("balance"))
    s = table(spark, d, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("id"), F.col("s_acctbal").alias("balance"), F.col("s_name").alias("extra"))
    return c.unionByName(s, allowMissingColumns=True)


@query("(SELECT c_nationkey AS k FROM customer EXCEPT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def set_except(spark, d):
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).subtract(table(spark, d, "supplier").where("s_acctbal > 5000").select("s_nationkey"))


@query("(SELECT c_nationkey AS k FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier)")
def set_intersect(spark, d):
    return table(spark, d, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").select("s_nationkey"))


@query("""(SELECT *, 'left' AS side FROM (SELECT o_custkey AS k FROM orders EXCEPT ALL SELECT c_custkey FROM customer)) UNION ALL (SELECT *, 'right' AS side FROM (SELECT c_custkey FROM customer EXCEPT ALL SELECT o_custkey FROM orders))""")
def set_equality(spark, d):
    """All orders' customers against all customers."""
    return rs.same_members(table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").alias("k")))


@query("SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-02' AND user_id NOT IN (SELECT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-28')")
def set_lost(spark, d):
    e = table(spark, d, "events")
    return rs.lost(e.where("ts < timestamp_ntz'2024-01-02'"), e.where("ts >= timestamp_ntz'2024-01-28'"), "user_id")


@query("SELECT DISTINCT l_shipdate, l_linestatus FROM lineitem")
def set_distinct(spark, d):
    return table(spark, d, "lineitem").select("l_shipdate", "l_linestatus").distinct()


@query("""WITH h AS (SELECT DISTINCT event_type, date_trunc('hour', ts) AS ts FROM events), e AS (SELECT event_type, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM h GROUP BY 1) SELECT * FROM e WHERE (event_type, ts) NOT IN (SELECT (event_type, ts) FROM h)""")
def missing_times(spark, d):
    h = table(spark, d, "events").select("event_type", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("ts")).distinct()
    return rs.missing_times(h, "event_type", "ts", "1 hour")


@query("UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME variable VALUE value")
def melt(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return rs.melt(df, ["l_orderkey", "l_linenumber"], ["l_quantity", "l_discount", "l_tax"])


NAMES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(f"""WITH {DAILY} SELECT date, {", ".join(f"round(max(value) FILTER (WHERE symbol = '{n}'), 2) AS " + '"' + n + '"' for n in NAMES)} FROM daily GROUP BY 1""")
def pivot_wide(spark, d):
    wide = rs.pivot(daily(spark, d), ["date"], "symbol", NAMES, "value")
    return wide.select("date", *(F.round(f"`{n}`", 2).alias(n) for n in NAMES))


@query("""SELECT 'r_key' AS field, max(k) FILTER (WHERE r_name = 'ASIA') AS ASIA, max(k) FILTER (WHERE r_name = 'EUROPE') AS EUROPE FROM (SELECT r_name, CAST(r_regionkey AS BIGINT) AS k FROM region)
    UNION ALL SELECT 'r_len', max(length(r_name)) FILTER (WHERE r_name = 'ASIA'), max(length(r_name)) FILTER (WHERE r_name = 'EUROPE') FROM region""")
def transpose(spark, d):
    df = table(spark, d, "region").select("r_name", F.col("r_regionkey").cast("long").alias("r_key"), F.length("r_name").cast("long").alias("r_len"))
    return rs.transposed(df, "r_name", ["ASIA", "EUROPE"])


@query(f"""SELECT c_custkey, {r("CASE WHEN c_custkey % 10 = 0 THEN c_acctbal + 1000 ELSE c_acctbal END", "c_acctbal", 2)} FROM customer UNION ALL SELECT -1, 5.0""")
def upsert_replace(spark, d):
    c = table(spark, d, "customer").select("c_custkey", "c_acctbal")
    new = c.where("c_custkey % 10 = 0").select("c_custkey", (F.col("c_acctbal") + 1000).alias("c_acctbal")).unionByName(spark.createDataFrame([(-1, 5.0)], "c_custkey long, c_acctbal double"))
    return rounded(rs.upsert(c, new, ["c_custkey"]), 2)


@query("SELECT c_custkey FROM customer UNION ALL SELECT -1")
def upsert_ignore(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    return rs.upsert(c, c.where("c_custkey % 10 = 0").unionByName(spark.createDataFrame([(-1,)], "c_custkey long")), ["c_custkey"], replace=False)


QUERIES, SQL = query.queries, query.sql
