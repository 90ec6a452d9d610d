"""Scalar functions over events, documents, pages and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from fathom.functions import scalars as sc
from fathom.functions import udf
from fathom.sources import readers

from .base import BARS, PLACES, Registry, bars, r, rounded, table

query = Registry()


@query(r"""SELECT p_partkey, contains(p_name, 'a') AS has, replace(p_name, ' ', '_') AS replaced, trim(p_type) AS trimmed, length(p_name) AS n, ends_with(p_type, 'L') AS ends, lower(p_brand) AS low, upper(p_name) AS up,
    regexp_extract(p_brand, '([0-9]+)', 1) AS digits, regexp_full_match(p_brand, 'Brand#[0-9]+') AS brand, split_part(p_type, ' ', 1) AS first_word, len(regexp_extract_all(p_name, '[aeiou]')) AS vowels, regexp_replace(p_name, '[^a-z]+', '-', 'g') AS slug FROM part""")
def string_functions(spark, d):
    n, t, b = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    return table(spark, d, "part").select("p_partkey", F.contains(n, F.lit("a")).alias("has"), F.replace(n, F.lit(" "), F.lit("_")).alias("replaced"), F.trim(t).alias("trimmed"), F.length(n).cast("long").alias("n"), F.endswith(t, F.lit("L")).alias("ends"), F.lower(b).alias("low"), F.upper(n).alias("up"), F.regexp_extract(b, "([0-9]+)", 1).alias("digits"), b.rlike("^Brand#[0-9]+$").alias("brand"), F.split_part(t, F.lit(" "), F.lit(1)).alias("first_word"), F.size(F.regexp_extract_all(n, F.lit("[aeiou]"), F.lit(0))).cast("long").alias("vowels"), F.regexp_replace(n, "[^a-z]+", "-").alias("slug"))


@query("SELECT s AS name, v AS snake FROM (VALUES ('openInterest', 'open_interest'), ('Net Change %', 'net_change'), ('HTMLPage', 'html_page'), ('a-b', 'a_b')) t(s, v)")
def snake_case(spark, d):
    df = spark.createDataFrame([("openInterest",), ("Net Change %",), ("HTMLPage",), ("a-b",)], "name string")
    return df.select("name", sc.snake_case(F.col("name")).alias("snake"))


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, strftime(o_orderdate, '%Y/%m/%d') AS text, datediff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') AS days, CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
    CAST(o_orderdate + INTERVAL 1 MONTH AS DATE) AS later, strftime(o_orderdate, '%G-W%V') AS week, dayofweek(o_orderdate) + 1 AS weekday, last_day(o_orderdate) AS month_end FROM orders""")
def date_functions(spark, d):
    day = F.to_date("o_orderdate")
    return table(spark, d, "orders").select("o_orderkey", day.alias("day"), F.date_format("o_orderdate", "yyyy/MM/dd").alias("text"), F.datediff(F.lit("2000-01-01").cast("date"), day).cast("long").alias("days"), sc.quarter_end(day).alias("quarter_end"), F.add_months(day, 1).alias("later"), sc.iso_week(day).alias("week"), F.dayofweek(day).cast("long").alias("weekday"), F.last_day(day).alias("month_end"))


@query("SELECT event_id, CAST(floor((epoch(date_trunc('second', ts)) - epoch(TIMESTAMP '2024-01-01')) / 900) AS BIGINT) AS slot, time_bucket(INTERVAL 15 MINUTE, ts) AS bucket FROM events")
def time_slots(spark, d):
    return table(spark, d, "events").select("event_id", sc.slot_of(F.col("ts"), F.lit("2024-01-01").cast("timestamp_ntz"), 900).alias("slot"), F.window("ts", "15 minutes").start.cast("timestamp_ntz").alias("bucket"))


@query(f"SELECT event_id, {r("CASE WHEN value = 0 THEN '-Infinity'::DOUBLE ELSE ln(value) END", 'l')}, {r('sqrt(value)', 's')}, {r('exp(-value / 100)', 'e')}, {r('abs(value - 50)', 'a')}, round_even(value, 1) AS h, {r('greatest(least(value, 90), 10)', 'clip')}, {r('power(value, 1.5)', 'p', 4)}, sign(value - 50) AS sg FROM events".replace("sign(value - 50) AS sg", "CAST(sign(value - 50) AS DOUBLE) AS sg"))
def math_functions(spark, d):
    v = F.col("value")
    six = {"l": sc.ln(v), "s": F.sqrt(v), "e": F.exp(-v / 100), "a": F.abs(v - 50), "clip": F.greatest(F.least(v, F.lit(90.0)), F.lit(10.0))}
    found = {c: sc.half_up(x, PLACES) + F.lit(0.0) for c, x in six.items()} | {"h": sc.half_even(v, 1), "p": sc.half_up(sc.three_halves(v), 4) + F.lit(0.0), "sg": sc.sign(v - 50)}
    return table(spark, d, "events").select("event_id", *(found[c].alias(c) for c in ("l", "s", "e", "a", "h", "clip", "p", "sg")))


@query("SELECT event_id, CASE WHEN user_id % 3 = 0 THEN NULL ELSE value END AS finite, coalesce(nullif(user_id % 4, 0), -1) AS filled, CASE WHEN user_id % 4 = 0 THEN NULL ELSE CAST(user_id % 4 AS DOUBLE) END AS znull, try_cast(CASE WHEN user_id % 2 = 0 THEN 'x' ELSE CAST(user_id AS VARCHAR) END AS BIGINT) AS number FROM events")
def null_functions(spark, d):
    u, v = F.col("user_id"), F.col("value")
    odd = F.when(u % 3 == 0, F.when(u % 2 == 0, float("nan")).otherwise(float("inf"))).otherwise(v)
    text = F.when(u % 2 == 0, "x").otherwise(u.cast("string"))
    return table(spark, d, "events").select("event_id", sc.finite(odd).alias("finite"), F.coalesce(F.nullif(u % 4, F.lit(0)), F.lit(-1)).alias("filled"), sc.zero_as_null((u % 4).cast("double")).alias("znull"), text.try_cast("bigint").alias("number"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.none') AS missing, len(json_keys(props)) AS n, '{\"event_id\":' || event_id || ',\"event_type\":\"' || event_type || '\"}' AS j FROM events")
def json_functions(spark, d):
    return table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"), F.get_json_object("props", "$.none").alias("missing"), F.size(F.json_object_keys("props")).cast("long").alias("n"), sc.canonical_json("event_id", "event_type").alias("j"))


@query("SELECT vec_id, len(embedding) AS n, round(list_sum([x * x for x in embedding::DOUBLE[]]), 4) AS norm, round(list_max(embedding)::DOUBLE, 5) AS top, CAST(list_position(embedding, list_max(embedding)) AS BIGINT) AS place, round(list_sum((embedding::DOUBLE[])[1:8]), 4) AS head FROM embeddings")
def array_functions(spark, d):
    e = F.col("embedding").cast("array<double>")
    plus = lambda a, x: a + x
    return table(spark, d, "embeddings").select("vec_id", F.size(e).cast("long").alias("n"), F.round(F.aggregate(F.transform(e, lambda x: x * x), F.lit(0.0), plus), 4).alias("norm"), F.round(F.array_max(e), 5).alias("top"), F.array_position(e, F.array_max(e)).alias("place"), F.round(F.aggregate(F.slice(e, 1, 8), F.lit(0.0), plus), 4).alias("head"))


@query("SELECT doc_id, sha256(text) AS sha, md5(text) AS md5, strlen(text) AS bytes, length(text) AS chars, levenshtein(lang, source) AS edit FROM documents")
def hash_functions(spark, d):
    t = F.col("text")
    return table(spark, d, "documents").select("doc_id", F.sha2(t, 256).alias("sha"), F.md5(t).alias("md5"), F.octet_length(t).cast("long").alias("bytes"), F.char_length(t).cast("long").alias("chars"), F.levenshtein("lang", "source").cast("long").alias("edit"))


@query("SELECT s AS label, v AS value FROM (VALUES ('1.2B', 1.2e9::DOUBLE), ('350K', 350000.0), ('-4M', -4e6), ('12%', 0.12), ('7', 7.0), ('n/a', NULL)) t(s, v)")
def magnitude_suffix(spark, d):
    df = spark.createDataFrame([("1.2B",), ("350K",), ("-4M",), ("12%",), ("7",), ("n/a",)], "label string")
    return df.select("label", F.round(sc.magnitude(F.col("label")), 6).alias("value"))


@query(r"""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '[ \t\r\n]+', ' ', 'g')) AS text, regexp_extract(html, '<title>(.*?)</title>', 1) AS title FROM pages""")
def html_text(spark, d):
    return table(spark, d, "pages").select("page_id", sc.strip_tags(F.col("html")).alias("text"), F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"))


@query(r"SELECT page_id, unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) AS href FROM pages")
def html_links(spark, d):
    return table(spark, d, "pages").select("page_id", F.explode(F.regexp_extract_all("html", F.lit('<a href="([^"]*)"'), F.lit(1))).alias("href"))


@query("SELECT event_id, CASE WHEN value > 100 THEN 'a' WHEN value > 10 THEN 'b' ELSE 'c' END AS band, greatest(user_id, 50) AS g, least(user_id, 50) AS l, CAST({'a': 1, 'b': 2}[CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END] AS INT) AS m FROM events".replace("CAST({'a': 1, 'b': 2}[CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END] AS INT)", "CASE WHEN user_id % 2 = 0 THEN 1 ELSE 2 END"))
def conditional_functions(spark, d):
    v, u = F.col("value"), F.col("user_id")
    lookup = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    return table(spark, d, "events").select("event_id", F.when(v > 100, "a").when(v > 10, "b").otherwise("c").alias("band"), F.greatest(u, F.lit(50)).alias("g"), F.least(u, F.lit(50)).alias("l"), lookup[F.when(u % 2 == 0, "a").otherwise("b")].alias("m"))


@query("SELECT user_id, first(event_id ORDER BY 1 - levenshtein(event_type, 'clik') / greatest(length(event_type), 4) DESC, event_id) AS nearest FROM events GROUP BY 1")
def fuzzy_match(spark, d):
    e = table(spark, d, "events")
    return e.groupBy("user_id").agg(F.min_by("event_id", F.struct(-sc.similar(F.col("event_type"), F.lit("clik")), "event_id")).alias("nearest"))


@query(f"""WITH s AS (SELECT event_type, list_sort(list(value)) AS v FROM events GROUP BY 1) SELECT event_type, {r("list_avg(v[len(v) // 10 + 1:len(v) - len(v) // 10])", "m")} FROM s""")
def udaf_trimmed_mean(spark, d):
    return rounded(table(spark, d, "events").groupBy("event_type").agg(udf.trimmed_mean("value").alias("m")))


@query("SELECT r_regionkey, CAST(n AS INT) AS n, n * 4 AS start, least((n + 1) * 4, r_regionkey * 3 + 1) AS stop FROM region, (SELECT unnest(range(10)) AS n) WHERE n * 4 < r_regionkey * 3 + 1")
def udtf_chunks(spark, d):
    udf.register(spark)
    return spark.sql("SELECT r_regionkey, n, start, stop FROM {t}, LATERAL chunks(0, r_regionkey * 3 + 1, 4)", t=table(spark, d, "region"))


@query(f"WITH {BARS} SELECT symbol, ts, {r('(high + low + close) / 3', 'typical_price')} FROM bars")
def registered_column(spark, d):
    return rounded(udf.apply(bars(spark, d), "typical_price").select("symbol", "ts", "typical_price"))


@query("SELECT page_id, CAST(len(regexp_extract_all(lower(html), '<table[\\s>]')) AS INT) AS tables FROM pages")
def html_table_scan(spark, d):
    """The number of tables of every page."""
    pages = table(spark, d, "pages")
    found = readers.html_tables(pages, "page_id", "html").groupBy("page_id").agg(F.count_distinct("table").cast("int").alias("tables"))
    return pages.select("page_id").join(found, "page_id", "left").select("page_id", F.coalesce("tables", F.lit(0)).alias("tables"))


@query()
def html_table_rows(spark, d):
    """Every row of every table of all pages."""
    return readers.html_tables(table(spark, d, "pages"), "page_id", "html")


QUERIES, SQL = query.queries, query.sql
