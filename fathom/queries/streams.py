"""Streams over ``events``, read as files and run to their end; SQL gives the batch result that they must equal."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.streaming import events as ev

from .base import Registry, r, rounded, table

query = Registry()
OHLC = "first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low, last(value ORDER BY ts, event_id) AS close, count(*) AS volume"


def stream(spark, d):
    schema = table(spark, d, "events").schema
    return ev.files(spark, d, schema, pattern="events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))


def plain(df, *names):
    """Timestamps without zone, as SQL has them."""
    return df.withColumns({n: F.col(n).cast("timestamp_ntz") for n in names})


@query(f"""WITH w AS (SELECT event_type AS symbol, time_bucket(INTERVAL 1 HOUR, ts) AS start, {OHLC} FROM events GROUP BY 1, 2)
    SELECT symbol, start, start + INTERVAL 1 HOUR AS "end", open, high, low, close, volume FROM w WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_bars(spark, d):
    out = ev.run_to_end(ev.bars(stream(spark, d), "event_type", "ts", "value", "event_id", "1 hour", "10 minutes"))
    return plain(out.drop("batch"), "start", "end")


@query(f"""WITH e AS (SELECT *, unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start FROM events), w AS (SELECT event_type AS symbol, start, {OHLC} FROM e GROUP BY 1, 2)
    SELECT symbol, start, start + INTERVAL 1 HOUR AS "end", open, high, low, close, volume FROM w WHERE start + INTERVAL 1 HOUR <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_sliding(spark, d):
    out = ev.run_to_end(ev.bars(stream(spark, d), "event_type", "ts", "value", "event_id", "1 hour", "10 minutes", "30 minutes"))
    return plain(out.drop("batch"), "start", "end")


@query("""WITH s AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 2 HOUR THEN 0 ELSE 1 END AS n FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), g AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS g FROM s),
    a AS (SELECT user_id, min(ts) AS start, max(ts) + INTERVAL 2 HOUR AS "end", count(*) AS n FROM g GROUP BY user_id, g) SELECT * FROM a WHERE "end" <= (SELECT max(ts) - INTERVAL 10 MINUTE FROM events)""")
def stream_sessions(spark, d):
    return plain(ev.run_to_end(ev.sessions(stream(spark, d), "user_id", "ts", "2 hours", "10 minutes")).drop("batch"), "start", "end")


@query("SELECT event_id, count(*) AS n FROM events GROUP BY 1")
def stream_dedup(spark, d):
    twice = stream(spark, d)
    out = ev.run_to_end(ev.once(twice.withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2)))), ["event_id"], "ts", "10 minutes"))
    return out.groupBy("event_id").agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN TIMESTAMP '2024-01-20' > ts + INTERVAL 10 DAY THEN 'stale' WHEN ts > TIMESTAMP '2024-01-20' + INTERVAL 5 DAY THEN 'future' ELSE '' END AS reasons FROM events")
def stream_freshness(spark, d):
    out = ev.run_to_end(ev.fresh(stream(spark, d), "ts", F.lit("2024-01-20").cast("timestamp"), "10 days", "5 days"))
    return out.select("event_id", F.array_join("reasons", ",").alias("reasons"))


@query("SELECT l.event_id AS purchase, q.event_id AS click FROM events l JOIN events q ON l.user_id = q.user_id AND q.event_type = 'click' AND q.ts <= l.ts AND q.ts >= l.ts - INTERVAL 3 HOUR WHERE l.event_type = 'purchase'")
def stream_join(spark, d):
    left, right = stream(spark, d).where("event_type = 'purchase'"), stream(spark, d).where("event_type = 'click'")
    met = ev.matched(left, right, "user_id", "ts", "ts", "3 hours", "10 minutes")
    return ev.run_to_end(met.select(F.col("l.event_id").alias("purchase"), F.col("r.event_id").alias("click"))).drop("batch")


@query(f"SELECT event_type, count(*) AS n, {r('sum(value)', 'total', 3)} FROM events GROUP BY 1")
def stream_totals(spark, d):
    agg = stream(spark, d).groupBy("event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return rounded(ev.last_batch(ev.run_to_end(agg, "complete")), 3)


@query("""WITH g AS (SELECT user_id, event_id, event_id > lag(event_id) OVER (PARTITION BY user_id ORDER BY event_id) + 1 AS gap FROM events) SELECT user_id, count(*) AS rows, count(*) FILTER (WHERE gap) AS gaps, max(event_id) AS last FROM g GROUP BY 1""")
def stream_sequence_gaps(spark, d):
    out = ev.run_to_end(ev.sequence_gaps(stream(spark, d).select("user_id", "event_id"), "user_id", "event_id"), "update")
    return out.groupBy("user_id").agg(F.max_by(F.struct("rows", "gaps", "last"), "batch").alias("s")).select("user_id", "s.*")


@query("""WITH s AS (SELECT DISTINCT event_type, CAST(floor((epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2024-01-01')) / 3600) AS BIGINT) AS slot FROM events), e AS (SELECT * FROM (SELECT DISTINCT event_type FROM events), (SELECT unnest(range(720)) AS slot)) SELECT * FROM e WHERE (event_type, slot) NOT IN (SELECT (event_type, slot) FROM s)""")
def missed_slots(spark, d):
    return ev.missed_slots(table(spark, d, "events"), "event_type", "ts", "2024-01-01", 3600, 720)


QUERIES, SQL = query.queries, query.sql
