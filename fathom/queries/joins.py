"""Joins over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import joins as jn

from .base import BARS, DAILY, Registry, bars, daily, r, rounded, table

query = Registry()


def views(spark, d, kind):
    return table(spark, d, "events").where(F.col("event_type") == kind)


@query(f"""WITH {DAILY}, m AS (SELECT date, avg(value) AS market FROM daily GROUP BY 1) SELECT symbol, date, {r("value", places=4)}, {r("market", places=4)} FROM daily JOIN m USING (date)""")
def join_on_date(spark, d):
    df = daily(spark, d)
    return rounded(df.join(df.groupBy("date").agg(F.avg("value").alias("market")), "date"), 4)


@query("""SELECT o.o_orderkey, c.c_name, c.c_custkey IS NOT NULL AS matched FROM orders o LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) c ON o.o_custkey = c.c_custkey""")
def join_left_validated(spark, d):
    right = table(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    out, _ = jn.validated_left(table(spark, d, "orders").select("o_orderkey", "o_custkey"), right, ["o_custkey"])
    return out.select("o_orderkey", "c_name", "matched")


@query("SELECT o_custkey AS key, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1")
def join_duplicate_keys(spark, d):
    _, twice = jn.validated_left(table(spark, d, "customer").select(F.col("c_custkey").alias("key")), table(spark, d, "orders").select(F.col("o_custkey").alias("key")), ["key"])
    return twice


@query("SELECT l_orderkey, l_linenumber, first(l_extendedprice) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS first_price FROM lineitem")
def join_group_first(spark, d):
    return jn.first_of_group(table(spark, d, "lineitem"), ["l_orderkey"], "l_extendedprice", ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "first_price").select("l_orderkey", "l_linenumber", "first_price")


@query(f"""SELECT n_name, r_name, count(*) AS orders, {r("sum(o_totalprice)", "total", 2)} FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1, 2""")
def join_four_way(spark, d):
    o, c, n, g = (table(spark, d, t) for t in ("orders", "customer", "nation", "region"))
    met = o.join(c, o.o_custkey == c.c_custkey).join(n, c.c_nationkey == n.n_nationkey).join(g, n.n_regionkey == g.r_regionkey)
    return rounded(met.groupBy("n_name", "r_name").agg(F.count("*").alias("orders"), F.sum("o_totalprice").alias("total")), 2)


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')")
def join_anti(spark, d):
    o = table(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, d, "customer").join(o, "c_custkey", "left_anti").select("c_custkey")


@query("SELECT s_suppkey FROM supplier WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity > 49)")
def join_semi(spark, d):
    li = table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_suppkey").alias("s_suppkey"))
    return table(spark, d, "supplier").join(li, "s_suppkey", "left_semi").select("s_suppkey")


@query("""SELECT l_returnflag, bool_or(p_size > 49) AS any_large, count(*) AS n, coalesce(max(CASE WHEN p_size > 49 THEN p_name END), 'none') AS name FROM lineitem LEFT JOIN part ON l_partkey = p_partkey GROUP BY 1""")
def join_then_bool_or(spark, d):
    li, p = table(spark, d, "lineitem"), table(spark, d, "part")
    met = li.join(p, li.l_partkey == p.p_partkey, "left")
    large = F.col("p_size") > 49
    return met.groupBy("l_returnflag").agg(F.bool_or(large).alias("any_large"), F.count("*").alias("n"), F.coalesce(F.max(F.when(large, F.col("p_name"))), F.lit("none")).alias("name"))


LEFT, RIGHT = "l AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase')", "q AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY 1, 2)"


def sides(spark, d):
    left = views(spark, d, "purchase").select("event_id", "user_id", "ts")
    return left, views(spark, d, "view").groupBy("user_id", "ts").agg(F.max("value").alias("value"))


@query(f"WITH {LEFT}, {RIGHT} SELECT l.event_id, l.user_id, l.ts, q.value FROM l ASOF LEFT JOIN q ON l.user_id = q.user_id AND l.ts >= q.ts")
def join_asof(spark, d):
    left, right = sides(spark, d)
    return jn.asof(left, right, ["user_id"], "ts", "ts", ["value"])


@query(f"WITH {LEFT}, {RIGHT} SELECT l.event_id, l.user_id, l.ts, q.value FROM l ASOF LEFT JOIN q ON l.user_id = q.user_id AND l.ts >= q.ts")
def join_asof_bucketed(spark, d):
    left, right = sides(spark, d)
    return jn.asof_bucketed(left, right, ["user_id"], "ts", "ts", ["value"])


@query(f"""WITH {LEFT}, {RIGHT}, f AS (SELECT user_id, first(value ORDER BY ts) AS v FROM q GROUP BY 1), a AS (SELECT l.*, q.value FROM l ASOF LEFT JOIN q ON l.user_id = q.user_id AND l.ts >= q.ts)
    SELECT event_id, user_id, ts, coalesce(value, v) AS value FROM a LEFT JOIN f USING (user_id)""")
def join_asof_nearest(spark, d):
    left, right = sides(spark, d)
    return jn.asof_or_nearest(left, right, ["user_id"], "ts", "ts", "value")


@query("""SELECT user_id, event_type, event_id, value FROM events WHERE ts <= TIMESTAMP '2024-01-15' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""")
def join_known_at(spark, d):
    df = jn.known_at(table(spark, d, "events"), ["user_id", "event_type"], "ts", F.lit("2024-01-15").cast("timestamp_ntz"), ["ts", "event_id"])
    return df.select("user_id", "event_type", "event_id", "value")


@query("""SELECT o_orderkey, o_orderdate, last(l_quantity ORDER BY l_shipdate, l_linenumber, l_quantity) AS q FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_shipdate <= o_orderdate + INTERVAL 60 DAY AND l_linenumber <= 3 GROUP BY 1, 2""")
def join_bitemporal(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderdate").withColumns({"valid": F.expr("o_orderdate + INTERVAL 60 DAYS"), "decided": F.lit(3), "key": F.col("o_orderkey")})
    li = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("key"), "l_shipdate", "l_linenumber", "l_quantity")
    return jn.bitemporal(o, li, ["key"], "valid", "l_shipdate", "l_linenumber", "decided", "l_quantity").select("o_orderkey", "o_orderdate", F.col("l_quantity").alias("q"))


@query("SELECT a.p AS a, b.p AS b FROM (SELECT DISTINCT o_orderpriority AS p FROM orders) a JOIN (SELECT DISTINCT o_orderpriority AS p FROM orders) b ON a.p < b.p")
def join_name_pairs(spark, d):
    return jn.name_pairs(table(spark, d, "orders"), "o_orderpriority")


@query(f"""WITH {BARS}, g AS (SELECT * FROM (SELECT DISTINCT symbol FROM bars), (SELECT DISTINCT ts FROM bars)) SELECT symbol, ts, close, close IS NOT NULL AS present FROM g LEFT JOIN bars USING (symbol, ts)""")
def join_complete_grid(spark, d):
    b = bars(spark, d).select("symbol", "ts", "close")
    return jn.complete_grid(b.select("ts").distinct(), b.select("symbol").distinct(), b, ["symbol", "ts"])


@query(f"""WITH {BARS}, g AS (SELECT * FROM (SELECT DISTINCT symbol FROM bars), (SELECT DISTINCT ts FROM bars)), f AS (SELECT symbol, ts, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts) AS close FROM g LEFT JOIN bars USING (symbol, ts))
    SELECT * FROM f WHERE close IS NOT NULL""")
def join_forward_fill(spark, d):
    b = bars(spark, d).select("symbol", "ts", "close")
    return jn.forward_filled(b.select("symbol").distinct(), b, "symbol", "ts", "close")


@query(f"""WITH {BARS}, x AS (SELECT symbol, ts, CASE WHEN volume > 2 THEN close END AS v, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM bars),
    y AS (SELECT *, max(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY symbol ORDER BY ts) AS a, min(CASE WHEN v IS NOT NULL THEN i END) OVER (PARTITION BY symbol ORDER BY ts DESC) AS z FROM x)
    SELECT y.symbol, y.ts, round(coalesce(y.v, p.v + (q.v - p.v) * (y.i - y.a) / (y.z - y.a)), 6) + 0.0 AS close FROM y LEFT JOIN x p ON p.symbol = y.symbol AND p.i = y.a LEFT JOIN x q ON q.symbol = y.symbol AND q.i = y.z""")
def interpolate_gaps(spark, d):
    b = bars(spark, d).select("symbol", "ts", F.when(F.col("volume") > 2, F.col("close")).alias("close"))
    return rounded(jn.interpolated(b, ["symbol"], "ts", "close"))


@query("""SELECT e.event_id, t.label FROM events e LEFT JOIN (VALUES ('click', 'a'), ('view', 'b')) t(k, label) ON e.event_type = t.k""")
def join_lookup(spark, d):
    small = spark.createDataFrame([("click", "a"), ("view", "b")], "event_type string, label string")
    return table(spark, d, "events").join(small, "event_type", "left").select("event_id", "label")


@query("""WITH l AS (SELECT event_type, user_id, last(ts ORDER BY ts, event_id) AS ts, last(value ORDER BY ts, event_id) AS value FROM events WHERE ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-20' GROUP BY 1, 2)
    SELECT event_type, count(*) AS n, max(ts) AS newest, epoch(max(ts)) - epoch(min(ts)) <= 86400 * 5 AS within_skew FROM l GROUP BY 1""")
def basket_latest(spark, d):
    from fathom.sources.basket import basket

    at, age = F.lit("2024-01-20").cast("timestamp_ntz"), F.expr("INTERVAL 10 DAYS")
    rows = basket(table(spark, d, "events"), ["event_type", "user_id"], "ts", ["ts", "event_id"], at, age)
    skew = (F.unix_timestamp(F.max("ts")) - F.unix_timestamp(F.min("ts"))) <= 86400 * 5
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.max("ts").alias("newest"), skew.alias("within_skew"))


QUERIES, SQL = query.queries, query.sql
