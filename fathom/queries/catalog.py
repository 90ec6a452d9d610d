"""Files written and read back, and catalogs over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fathom.operators import catalog as ct
from fathom.session import scratch
from fathom.sources import readers, sinks

from .base import Registry, r, rounded, table

query = Registry()
ORDERS = "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE, o_orderpriority STRING, o_orderstatus STRING"
NAMES = [f.split()[0] for f in ORDERS.split(", ")]


def orders(spark, d) -> DataFrame:
    return table(spark, d, "orders").select(*NAMES)


@query(f"SELECT {', '.join(NAMES)} FROM orders")
def csv_written_and_read(spark, d):
    path = scratch(spark, "csv")
    sinks.csv(orders(spark, d), path)
    return readers.csv(spark, path, ORDERS)


@query("SELECT event_id, ts, event_type, value FROM events")
def json_lines_written_and_read(spark, d):
    path = scratch(spark, "json")
    sinks.jsonl(table(spark, d, "events").select("event_id", "ts", "event_type", "value"), path)
    return readers.json(spark, path, "event_id BIGINT, ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE")


@query("SELECT c_custkey, c_name, c_acctbal FROM customer")
def xml_written_and_read(spark, d):
    path = scratch(spark, "xml")
    table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal").write.format("xml").option("rowTag", "customer").save(path)
    return readers.xml(spark, path, "customer", "c_custkey BIGINT, c_name STRING, c_acctbal DOUBLE")


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice, o_orderpriority, o_orderstatus FROM orders")
def partitions_replaced(spark, d):
    path, df = scratch(spark, "parts"), orders(spark, d)
    sinks.parquet(df, path, partitions=["o_orderstatus"])
    sinks.replace_partitions(df.where("o_orderstatus = 'P'").withColumn("o_totalprice", F.col("o_totalprice") * 2), path, ["o_orderstatus"])
    return readers.parquet(spark, path)


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' AND o_orderpriority = '1-URGENT' THEN -1.0 ELSE o_totalprice END AS o_totalprice, o_orderpriority, o_orderstatus FROM orders")
def partitions_upserted(spark, d):
    path, df = scratch(spark, "upsert"), orders(spark, d)
    sinks.parquet(df, path, partitions=["o_orderstatus"])
    sinks.upsert_partitions(df.where("o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'").withColumn("o_totalprice", F.lit(-1.0)), path, ["o_orderkey"], "o_orderstatus")
    return readers.parquet(spark, path)


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0.0 END AS o_totalprice, o_orderpriority, o_orderstatus FROM orders")
def rows_appended_once(spark, d):
    path, df = scratch(spark, "append"), orders(spark, d)
    sinks.parquet(df.where("o_orderstatus = 'O'"), path)
    for _ in range(2):  # sent again, a batch adds nothing
        sinks.append_new(df.withColumn("o_totalprice", F.lit(0.0)), path, ["o_orderkey"])
    return readers.parquet(spark, path)


@query(f"""SELECT o_orderpriority, o_orderstatus, CASE WHEN o_orderstatus IN ('F', 'P') THEN 2 ELSE 1 END AS revisions, count(*) AS n, {r("sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice + 1 ELSE o_totalprice END)", "total", 2)}
    FROM orders GROUP BY 1, 2""")
def snapshot_revisions(spark, d):
    """Three commits: all orders, those in state F and P with another price, then those in state P as they were."""
    df, key = orders(spark, d), ["o_orderpriority", "o_orderstatus"]
    held = ct.Snapshots(spark, scratch(spark, "snapshots"), key, df.schema)
    dearer = df.withColumn("o_totalprice", F.col("o_totalprice") + 1)
    for batch in (df, dearer.where("o_orderstatus IN ('F', 'P')"), df.where("o_orderstatus = 'P'")):
        held.commit(batch)
    now = held.current().groupBy(*key).agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
    return rounded(held.revisions().groupBy(*key).agg(F.count("*").cast("int").alias("revisions")).join(now, key), 2)


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
    (l_partkey, l_suppkey, l_returnflag) IN (SELECT (l_partkey, l_suppkey, l_returnflag) FROM lineitem WHERE l_quantity = 50) AS calendar_unknown,
    (l_partkey, l_suppkey, l_returnflag) IN (SELECT (l_partkey, l_suppkey, l_returnflag) FROM lineitem WHERE l_discount = 0) AS calendar_conflict FROM lineitem""")
def marks_of_small_tables(spark, d):
    li, key = table(spark, d, "lineitem"), ["l_partkey", "l_suppkey", "l_returnflag"]
    out = ct.marked(li, {"calendar_unknown": li.where("l_quantity = 50"), "calendar_conflict": li.where("l_discount = 0")}, key)
    return out.select("l_orderkey", "l_linenumber", *key, "calendar_unknown", "calendar_conflict")


@query("""SELECT l_orderkey AS snapshot_id, l_partkey AS value_id, l_linenumber, l_extendedprice, l_returnflag AS adjustment_basis, o_orderdate AS source_available_at, c_acctbal AS known_at, p_size FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
    JOIN part ON p_partkey = l_partkey WHERE o_orderstatus = 'F' AND l_returnflag = 'R' AND p_size > 10 AND EXISTS (SELECT 1 FROM lineitem x WHERE x.l_orderkey = lineitem.l_orderkey AND x.l_returnflag = 'R' AND x.l_quantity > 25)""")
def consumable_bars(spark, d):
    o, c, p, li = (table(spark, d, t) for t in ("orders", "customer", "part", "lineitem"))
    line = li.select(F.col("l_orderkey").alias("snapshot_id"), F.col("l_returnflag").alias("adjustment_basis"), F.col("l_partkey").alias("value_id"), "l_linenumber", "l_extendedprice", "l_quantity")
    pointers = o.select(F.col("o_orderkey").alias("snapshot_id"), F.lit("R").alias("adjustment_basis"), F.col("o_custkey").alias("event_id"))
    snapshots = o.select(F.col("o_orderkey").alias("snapshot_id"), F.when(F.col("o_orderstatus") == "F", "ready").otherwise("open").alias("state"), F.col("o_orderdate").alias("source_available_at"))
    sizes = p.select(F.col("p_partkey").alias("value_id"), "p_size", F.when(F.col("p_size") > 10, "clean").otherwise("refused").alias("disposition"))
    literals = line.select("snapshot_id", "value_id").distinct().join(sizes, "value_id")
    admitted = line.where("l_quantity > 25").select("snapshot_id", "adjustment_basis").distinct()
    return ct.consumable(pointers, c.select(F.col("c_custkey").alias("event_id"), F.col("c_acctbal").alias("known_at")), admitted, snapshots, line.drop("l_quantity"), literals)


VARIANTS = """s AS (SELECT DISTINCT l_suppkey AS code, l_shipdate AS date, l_returnflag AS requested, CASE WHEN l_tax > 0.07 THEN 'X' ELSE l_returnflag END AS given, CAST(l_quantity AS INTEGER) AS close, l_discount = 0.1 AS range_fault FROM lineitem),
    a AS (SELECT l_suppkey AS code, bool_or(l_discount > 0.02 AND l_linestatus = 'F') OR bool_or(l_tax = 0) AS admissible FROM lineitem GROUP BY 1), v AS (SELECT s.*, count(*) OVER (PARTITION BY code, date, requested) AS variant_count, admissible FROM s JOIN a USING (code)),
    f AS (SELECT *, variant_count > 1 OR range_fault OR NOT admissible OR requested <> given AS refused FROM v)"""


@query(f"""WITH {VARIANTS}, u AS (SELECT 'conflicts' AS name, * FROM f WHERE variant_count > 1 UNION ALL SELECT 'quarantine', * FROM f WHERE refused
    UNION ALL SELECT 'unadjusted', * FROM f WHERE NOT refused AND requested = 'N' UNION ALL SELECT 'forward', * FROM f WHERE NOT refused AND requested = 'R')
    SELECT name, requested, count(*) AS n, CAST(sum(close) AS DOUBLE) AS total FROM u GROUP BY 1, 2""")
def catalog_views(spark, d):
    li, key = table(spark, d, "lineitem"), ["code", "date", "requested"]
    given = F.when(F.col("l_tax") > 0.07, "X").otherwise(F.col("l_returnflag")).alias("given")
    seen = li.select(F.col("l_suppkey").alias("code"), F.col("l_shipdate").alias("date"), F.col("l_returnflag").alias("requested"), given, F.col("l_quantity").cast("int").cast("string").alias("close"), (F.col("l_discount") == 0.1).alias("range_fault")).distinct()
    lineage = li.select(F.col("l_suppkey").alias("value_id"), (F.col("l_discount") > 0.02).alias("complete"), (F.col("l_linestatus") == "F").alias("source_ok"), (F.col("l_tax") == 0).alias("confirmed_partial"))
    admitted = ct.admission(lineage).select(F.col("value_id").alias("code"), "admissible")
    variants = seen.withColumn("variant_count", F.count("*").over(Window.partitionBy(*key))).join(admitted, "code")
    names = ct.publish(ct.catalog_views(variants, ["range_fault"], {"N": "unadjusted", "R": "forward"}, ["close"]), "catalog_")
    return spark.sql(" UNION ALL ".join(f"SELECT '{n[8:]}' AS name, requested, count(*) AS n, sum(CAST(close AS DOUBLE)) AS total FROM {n} GROUP BY requested" for n in names))


CONTRACTS = """k AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_discount = 0.1 THEN 'odd' ELSE lpad(CAST(l_orderkey AS VARCHAR), 7, '0') || l_linenumber END AS symbol, CASE WHEN l_tax = 0.08 THEN 'S' ELSE 'X' END AS exchange,
    CASE WHEN l_returnflag = 'A' THEN 'call' WHEN l_returnflag = 'N' THEN 'put' END AS option_type, l_quantity - 2 AS strike, l_shipdate AS expiration, CASE WHEN l_tax > 0.01 THEN l_quantity - 5 END AS unit FROM lineitem)"""


@query(f"""WITH {CONTRACTS}, g AS (SELECT *, CASE WHEN symbol = 'odd' THEN 'invalid_code' WHEN count(*) OVER (PARTITION BY symbol) > 1 THEN 'duplicate_contract' WHEN exchange <> 'X' THEN 'exchange_mismatch' WHEN option_type IS NULL THEN 'invalid_option_type' WHEN strike <= 0 THEN 'invalid_strike'
    WHEN expiration < DATE '1995-01-01' THEN 'expired_contract' WHEN unit <= 0 THEN 'invalid_contract_unit' END AS reason FROM k)
    SELECT l_orderkey, l_linenumber, l_partkey, reason, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS disposition, CASE WHEN unit IS NULL THEN 'metadata_source_date_unavailable,unknown_contract_unit' ELSE 'metadata_source_date_unavailable' END AS quality_flags FROM g""")
def contract_master(spark, d):
    def when(condition, value):
        return F.when(F.expr(condition), value)

    symbol = when("l_discount = 0.1", F.lit("odd")).otherwise(F.concat(F.lpad(F.col("l_orderkey").cast("string"), 7, "0"), "l_linenumber"))
    made = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", symbol.alias("symbol"), F.lit("510050").alias("underlying"), when("l_tax = 0.08", F.lit("S")).otherwise("X").alias("exchange"), F.lit("web").alias("metadata_source"),
        when("l_returnflag = 'A'", F.lit("call")).when(F.col("l_returnflag") == "N", "put").alias("option_type"), (F.col("l_quantity") - 2).alias("strike"), F.col("l_shipdate").cast("date").alias("expiration"),
        F.lit(None).cast("date").alias("source_date"), when("l_tax > 0.01", F.col("l_quantity") - 5).alias("contract_unit"),
    )
    out = ct.contract_master(made, F.lit("1995-01-01").cast("date"), "X", "web", ["510050"])
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "reason", "disposition", F.array_join("quality_flags", ",").alias("quality_flags"))


@query("""SELECT CAST(o_orderdate AS DATE) AS date, o_orderstatus AS symbol, min(o_totalprice) - 1000 AS open, max(o_totalprice) AS close, CAST(count_if(o_totalprice > 400000) AS DOUBLE) AS stock_splits FROM orders
    WHERE o_orderdate >= TIMESTAMP '1993-01-01' AND o_orderdate < TIMESTAMP '1997-01-01' GROUP BY 1, 2 HAVING min(o_totalprice) > 1000""")
def stacked_tickers(spark, d):
    price, symbols = F.col("o_totalprice"), ["F", "O", "P"]
    fields = {"Open": F.min(price) - 1000, "Close": F.max(price), "Dividends": F.sum(F.lit(0.0)), "Stock Splits": F.count_if(price > 400000).cast("double")}
    wide = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("date")).pivot("o_orderstatus", symbols).agg(*(v.alias(k) for k, v in fields.items()))
    return ct.stacked_tickers(wide, symbols, list(fields), start="1993-01-01", end="1996-12-31")


QUERIES, SQL = query.queries, query.sql
