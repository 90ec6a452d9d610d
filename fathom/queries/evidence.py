"""Evidence pipelines over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.operators import evidence as ev
from fathom.operators import joins as jn

from .base import BARS, Registry, bars, table

query = Registry()
HASH = "sha256(coalesce(length(CAST(band AS VARCHAR)) || ':' || CAST(band AS VARCHAR), '-'))"
REV = f"""x AS (SELECT event_id, user_id, event_type, ts, CAST(floor(value / 60) AS BIGINT) AS band FROM events), h AS (SELECT *, {HASH} AS values_hash FROM x),
    c AS (SELECT *, values_hash IS NOT DISTINCT FROM lag(values_hash) OVER w AS duplicate FROM h WINDOW w AS (PARTITION BY user_id, event_type ORDER BY ts, event_id)),
    v AS (SELECT *, CAST(sum(CASE WHEN duplicate THEN 0 ELSE 1 END) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS BIGINT) AS revision FROM c)"""


def journal(spark, d):
    x = table(spark, d, "events").select("event_id", "user_id", "event_type", "ts", F.floor(F.col("value") / 60).alias("band"))
    return ev.revisions(x, ["user_id", "event_type"], ["ts", "event_id"], ["band"])


@query(f"WITH {REV} SELECT event_id, values_hash, duplicate, revision FROM v")
def revision_log(spark, d):
    return journal(spark, d).select("event_id", "values_hash", "duplicate", "revision")


@query(f"WITH {REV} SELECT user_id, event_type, event_id, revision FROM v WHERE ts <= TIMESTAMP '2024-01-20' QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY revision DESC, ts, event_id) = 1")
def revision_as_of(spark, d):
    df = journal(spark, d).where("ts <= timestamp_ntz'2024-01-20'")
    return df.groupBy("user_id", "event_type").agg(F.min_by(F.struct("event_id", "revision"), F.struct(-F.col("revision"), "ts", "event_id")).alias("r")).select("user_id", "event_type", "r.event_id", "r.revision")


@query("SELECT l_orderkey, l_linenumber FROM (SELECT l_orderkey, l_linenumber, l_shipdate, lag(l_shipdate) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS b FROM lineitem) WHERE l_shipdate < b")
def clock_faults(spark, d):
    return ev.clock_faults(table(spark, d, "lineitem"), ["l_orderkey"], ["l_linenumber", "l_partkey", "l_suppkey"], "l_shipdate").select("l_orderkey", "l_linenumber")


@query("SELECT user_id, last(CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END ORDER BY ts, event_id) AS snapshot_id FROM events WHERE ts <= TIMESTAMP '2024-01-20' GROUP BY 1")
def visibility_pointer(spark, d):
    e = table(spark, d, "events").select("user_id", "event_id", F.col("ts").alias("known_at"), F.when(F.col("event_type") != "error", F.col("event_id").cast("string")).alias("snapshot_id"))
    return ev.pointer(e, ["user_id"], F.lit("2024-01-20").cast("timestamp_ntz"))


CLASSED = """c AS (SELECT event_id, event_type, CASE WHEN user_id % 13 = 0 THEN 'identity' WHEN value < 1 THEN 'too_small' WHEN value > 200 THEN 'too_large' END AS reason, event_type = 'view' AS o FROM events),
    k AS (SELECT *, CASE WHEN o THEN 'outside' WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS disposition FROM c)"""


def classed(spark, d):
    rules = [("identity", F.col("user_id") % 13 == 0), ("too_small", F.col("value") < 1), ("too_large", F.col("value") > 200)]
    return ev.classified(table(spark, d, "events"), rules, F.col("event_type") == "view")


@query(f"WITH {CLASSED} SELECT event_id, reason, disposition FROM k")
def classify_rows(spark, d):
    return classed(spark, d).select("event_id", "reason", "disposition")


@query(f"WITH {CLASSED} SELECT event_type, count(*) AS rows, count(*) FILTER (WHERE disposition = 'accepted') AS accepted, count(*) FILTER (WHERE disposition = 'rejected') AS rejected, count(*) FILTER (WHERE disposition = 'outside') AS outside, true AS balanced FROM k GROUP BY 1")
def reconcile(spark, d):
    return ev.reconciliation(classed(spark, d), ["event_type"])


@query("SELECT CAST(count(*) AS BIGINT) AS observed, count(*) AS source, true AS conserved FROM events")
def conservation_check(spark, d):
    e = table(spark, d, "events")
    return ev.conservation(e.groupBy("user_id", "event_type").agg(F.count("*").alias("n")), e, "n")


@query(f"""WITH {BARS}, f AS (SELECT symbol, ts, CAST(ts AS DATE) AS day, volume = 1 AS e, list_sort(list_filter([CASE WHEN high = low THEN 'flat' END, CASE WHEN close > open THEN 'up' END, CASE WHEN volume > 5 THEN 'busy' END], lambda x: x IS NOT NULL)) AS flags FROM bars)
    SELECT symbol, ts, array_to_string(flags, ',') AS flags, NOT bool_or(symbol = 'click' AND e) OVER (PARTITION BY day) AS day_ok FROM f""")
def futures_day_check(spark, d):
    b = bars(spark, d).withColumn("day", F.to_date("ts"))
    b = b.withColumn("flags", F.array_join(ev.flags(flat=F.col("high") == F.col("low"), up=F.col("close") > F.col("open"), busy=F.col("volume") > 5), ","))
    return ev.whole_day(b, "day", (F.col("symbol") == "click") & (F.col("volume") == 1)).select("symbol", "ts", "flags", "day_ok")


@query("SELECT s_suppkey, CAST(right(s_name, 6) AS INT) % 32 AS bucket FROM supplier")
def bucket_codes(spark, d):
    return table(spark, d, "supplier").select("s_suppkey", ev.bucket_of("s_name").alias("bucket"))


@query("""WITH s AS (SELECT o_custkey, min(CAST(o_orderdate AS DATE)) AS a, max(CAST(o_orderdate AS DATE)) AS z FROM orders GROUP BY 1), c AS (SELECT o_custkey, a, z, CAST(unnest(generate_series(CAST(a AS TIMESTAMP), z - INTERVAL 1 DAY, INTERVAL 90 DAY)) AS DATE) AS chunk_start FROM s WHERE a < z)
    SELECT o_custkey, chunk_start, least(chunk_start + 90, z) AS chunk_end FROM c""")
def plan_chunks(spark, d):
    s = table(spark, d, "orders").groupBy("o_custkey").agg(F.min(F.to_date("o_orderdate")).alias("a"), F.max(F.to_date("o_orderdate")).alias("z"))
    return ev.chunks(s, "a", "z", 90).select("o_custkey", "chunk_start", "chunk_end")


@query("""WITH c AS (SELECT DISTINCT CAST(ts AS DATE) AS session FROM events) SELECT session, unnest(generate_series(session + INTERVAL 21 HOUR, session + INTERVAL 26 HOUR, INTERVAL 30 MINUTE)) AS ts FROM c""")
def expected_bars(spark, d):
    c = table(spark, d, "events").select(F.to_date("ts").alias("session")).distinct()
    c = c.withColumns({"open": F.expr("cast(session as timestamp_ntz) + interval 21 hours"), "close": F.expr("cast(session as timestamp_ntz) + interval 26 hours 1 minute")})
    return ev.expected_bars(c, "30 minutes")


@query("SELECT event_id, running FROM (SELECT event_id, CAST(sum(event_id % 7 + 1) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM events) WHERE running <= 100")
def batch_cursor(spark, d):
    e = table(spark, d, "events").withColumn("cost", F.col("event_id") % 7 + 1)
    return ev.prefix_within(e, ["user_id"], ["ts", "event_id"], "cost", 100).select("event_id", "running")


SYMBOLS = """s AS (SELECT p_partkey, CASE WHEN p_partkey % 9 = 0 THEN 'bad symbol' ELSE 'ABC' || strftime(DATE '2024-01-01' + CAST(p_partkey % 300 AS INT), '%y%m%d') || CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'P' END || lpad(CAST(p_size * 1000 AS VARCHAR), 8, '0') END AS occ FROM part)"""


@query(f"""WITH {SYMBOLS} SELECT p_partkey, CASE WHEN p_partkey % 9 <> 0 THEN 'ABC' END AS root, CASE WHEN p_partkey % 9 <> 0 THEN DATE '2024-01-01' + CAST(p_partkey % 300 AS INT) END AS expiration,
    CASE WHEN p_partkey % 9 <> 0 THEN CASE WHEN p_partkey % 2 = 0 THEN 'call' ELSE 'put' END END AS option_type, CASE WHEN p_partkey % 9 <> 0 THEN CAST(p_size AS DOUBLE) END AS strike, p_partkey % 9 <> 0 AND p_size > 25 AS agrees FROM part""")
def occ_symbols(spark, d):
    k = F.col("p_partkey")
    day = F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int"))
    occ = F.when(k % 9 == 0, "bad symbol").otherwise(F.concat(F.lit("ABC"), F.date_format(day, "yyMMdd"), F.when(k % 2 == 0, "C").otherwise("P"), F.lpad((F.col("p_size") * 1000).cast("string"), 8, "0")))
    p = table(spark, d, "part").withColumn("occ", occ)
    agrees = ev.occ_agrees(F.col("occ"), strike=F.when(F.col("p_size") > 25, F.col("p_size").cast("double")).otherwise(-1.0))
    return p.select("p_partkey", *(v.alias(n) for n, v in ev.occ_fields(F.col("occ")).items()), agrees.alias("agrees"))


@query("""WITH q AS (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 11 = 0 THEN 0 WHEN event_id % 13 = 0 THEN -value ELSE value END AS bid, value + event_id % 3 - 1 AS ask, epoch(TIMESTAMP '2024-01-20') - epoch(date_trunc('second', ts)) AS age FROM events)
    SELECT event_id, array_to_string(list_sort(list_filter([CASE WHEN bid IS NULL OR ask IS NULL THEN 'missing' END, CASE WHEN bid = 0 OR ask = 0 THEN 'zero' END, CASE WHEN bid < 0 OR ask < 0 THEN 'negative' END, CASE WHEN bid > ask THEN 'crossed' END,
        CASE WHEN age > 864000 THEN 'stale' END, CASE WHEN age < 0 THEN 'future' END], lambda x: x IS NOT NULL)), ',') AS flags FROM q""")
def quote_flags(spark, d):
    e, v = F.col("event_id"), F.col("value")
    q = table(spark, d, "events").select("event_id", "ts", F.when(e % 10 == 0, None).when(e % 11 == 0, 0.0).when(e % 13 == 0, -v).otherwise(v).alias("bid"), (v + e % 3 - 1).alias("ask"))
    return q.select("event_id", F.array_join(ev.quote_flags("bid", "ask", F.col("ts"), F.lit("2024-01-20").cast("timestamp_ntz"), 864000), ",").alias("flags"))


@query("""WITH o AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS session FROM orders), n AS (SELECT session FROM o WHERE dayofmonth(session) <> 5 AND session < DATE '1998-01-01'), e AS (SELECT min(session) AS a, max(session) AS z FROM n)
    SELECT 'weekend' AS fault, session FROM n WHERE dayofweek(session) IN (0, 6) UNION ALL SELECT 'lost', session FROM o, e WHERE session BETWEEN a AND z AND session NOT IN (SELECT session FROM n)
    UNION ALL SELECT 'shrunk', session FROM o, e WHERE session < a OR session > z""")
def calendar_faults(spark, d):
    old = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("session")).distinct()
    return ev.calendar_faults(old, old.where((F.dayofmonth("session") != 5) & (F.col("session") < "1998-01-01")))


@query("""SELECT b.l_orderkey, b.l_linenumber, o.o_orderdate FROM lineitem b JOIN orders o ON b.l_orderkey = o.o_orderkey JOIN (SELECT o_orderkey, max(o_orderdate) AS k FROM orders WHERE o_orderdate <= TIMESTAMP '1996-06-30' GROUP BY 1) p ON p.o_orderkey = o.o_orderkey
    WHERE b.l_returnflag = 'R' AND b.l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""")
def as_of_reader(spark, d):
    li = table(spark, d, "lineitem").where("l_returnflag = 'R' AND l_shipdate BETWEEN timestamp_ntz'1996-01-01' AND timestamp_ntz'1996-12-31'")
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    known = jn.known_at(o, ["l_orderkey"], "o_orderdate", F.lit("1996-06-30").cast("timestamp_ntz"), ["o_orderdate"])
    return li.join(known, "l_orderkey").select("l_orderkey", "l_linenumber", "o_orderdate")


QUERIES, SQL = query.queries, query.sql
