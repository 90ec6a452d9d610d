"""Mini-languages and source transforms."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import languages as lang

from .base import DAILY, Registry, daily, r, rounded, table

query = Registry()


@query("SELECT p_partkey FROM part WHERE (contains(lower(concat_ws(' ', p_name, p_type, p_brand)), 'brand#1') AND contains(lower(concat_ws(' ', p_name, p_type, p_brand)), 'a')) OR contains(lower(concat_ws(' ', p_name, p_type, p_brand)), 'part 1')".replace("brand#1", "brand"))
def search_syntax(spark, d):
    return table(spark, d, "part").where(lang.search('the brand + a | "part 1"', ["p_name", "p_type", "p_brand"])).select("p_partkey")


@query("SELECT event_id FROM events WHERE value > 50 AND event_type <> 'view'")
def where_expression(spark, d):
    return lang.where_text(table(spark, d, "events"), "value > 50 AND event_type <> 'view'").select("event_id")


@query(f"SELECT event_type, {r('avg(value)', 'm')} FROM events GROUP BY event_type")
def sql_over_view(spark, d):
    return rounded(lang.over_view(table(spark, d, "events"), "SELECT event_type, avg(value) AS m FROM df GROUP BY event_type"))


@query("SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-06-30' AND (o_orderpriority ILIKE '%urgent%' OR o_orderpriority ILIKE '%HIGH%')")
def report_filter(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return lang.report_filter(o, "day", F.lit("1996-01-01").cast("date"), F.lit("1996-06-30").cast("date"), ["urgent", "HIGH"], ["o_orderpriority"]).select("o_orderkey")


@query("WITH f AS (SELECT *, CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderstatus = 'O') SELECT DISTINCT o_custkey, o_orderpriority FROM f WHERE day >= (SELECT max(day) FROM f) - 28")
def recent_distinct(spark, d):
    o = table(spark, d, "orders").withColumn("day", F.to_date("o_orderdate"))
    return lang.recent_distinct(o, ["o_custkey", "o_orderpriority"], "day", 4, o_orderstatus="O")


@query(f"WITH {DAILY} SELECT symbol, date, {r('value', places=2)} FROM daily WHERE symbol IN ('1-URGENT', '5-LOW') AND date >= DATE '1996-01-01' AND date <= DATE '1997-12-31' QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY date DESC) <= 10")
def dimension_key(spark, d):
    import datetime as dt

    return rounded(lang.dimensions(daily(spark, d), ["symbol"], "1-URGENT+5-LOW", "date", dt.date(1996, 1, 1), dt.date(1997, 12, 31), 10), 2)


@query("SELECT DISTINCT user_id, event_type FROM events WHERE ts < TIMESTAMP '2024-01-16' AND (user_id, event_type) NOT IN (SELECT (user_id, event_type) FROM events WHERE ts >= TIMESTAMP '2024-01-16')")
def dimension_constraints(spark, d):
    """Combinations of the month's first half that its second half doesn't list; the halves are all events."""
    e = table(spark, d, "events")
    return lang.impossible(e.where("ts < timestamp_ntz'2024-01-16'").select("user_id", "event_type").distinct(), e.where("ts >= timestamp_ntz'2024-01-16'"), ["user_id", "event_type"])


@query("SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS date, round(l_discount / 100, 8) AS pct, l_quantity FROM lineitem WHERE CAST(l_shipdate AS DATE) IN (SELECT DISTINCT CAST(l_shipdate AS DATE) AS d FROM lineitem ORDER BY d DESC LIMIT 5)")
def positions_report(spark, d):
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("date"), F.col("l_discount").alias("pct"), "l_quantity", F.col("l_quantity").alias("same"))
    return rounded(lang.positions_report(li, {"same": "l_quantity"}, ["pct"], "date", 5), 8)


@query("""SELECT o_orderpriority, o_orderstatus, sum(v) FILTER (WHERE y = 1995) AS "1995", sum(v) FILTER (WHERE y = 1996) AS "1996" FROM (SELECT o_orderpriority, o_orderstatus, year(o_orderdate) AS y, count(*) AS v FROM orders GROUP BY 1, 2, 3) GROUP BY 1, 2 HAVING coalesce("1995", 0) <> 0 OR coalesce("1996", 0) <> 0""".replace("sum(v)", "max(v)"))
def indicator_pivot(spark, d):
    rows = table(spark, d, "orders").groupBy("o_orderpriority", "o_orderstatus", F.year("o_orderdate").cast("string").alias("y")).agg(F.count("*").alias("v"))
    return lang.indicator_pivot(rows, ["o_orderpriority", "o_orderstatus"], "y", ["1995", "1996"], "v")


@query("SELECT 'N' || n_nationkey AS id, 1 AS level, r_name || ' / ' || n_name AS path FROM nation JOIN region ON n_regionkey = r_regionkey UNION ALL SELECT 'R' || r_regionkey, 0, r_name FROM region")
def title_tree(spark, d):
    n = table(spark, d, "nation").select(F.concat(F.lit("N"), "n_nationkey").alias("id"), F.concat(F.lit("R"), "n_regionkey").alias("parent"), F.col("n_name").alias("title"))
    g = table(spark, d, "region").select(F.concat(F.lit("R"), "r_regionkey").alias("id"), F.lit(None).cast("string").alias("parent"), F.col("r_name").alias("title"))
    return lang.ordered_tree(n.unionByName(g), "id", "parent", "title")


@query("SELECT event_id, event_type FROM events WHERE CAST(ts AS DATE) IN (SELECT DISTINCT CAST(ts AS DATE) AS d FROM events ORDER BY d DESC LIMIT 3)")
def latest_dates(spark, d):
    e = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return lang.latest_dates(e, "day", 3).select("event_id", "event_type")


@query("WITH n AS (SELECT s_name, row_number() OVER (ORDER BY s_name) - 1 AS n FROM (SELECT DISTINCT s_name FROM supplier)) SELECT CAST(floor(n / 30) AS BIGINT) AS chunk, string_agg(s_name, ',' ORDER BY s_name) AS symbols FROM n GROUP BY 1")
def symbol_chunks(spark, d):
    return lang.chunked(table(spark, d, "supplier"), "s_name", 30)


@query("""WITH m AS (SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS topic, l_linestatus AS field, avg(l_discount) AS v FROM lineitem GROUP BY 1, 2, 3) SELECT date, topic, round(max(v) FILTER (WHERE field = 'O') / 100, 8) AS O, round(max(v) FILTER (WHERE field = 'F') / 100, 8) AS F FROM m GROUP BY 1, 2""")
def survey_pivot(spark, d):
    li = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("topic")).pivot("l_linestatus", ["O", "F"]).agg(F.avg("l_discount"))
    return li.select("date", "topic", *(F.round(F.col(c) / 100, 8).alias(c) for c in ("O", "F")))


QUERIES, SQL = query.queries, query.sql
