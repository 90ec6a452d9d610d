"""The operators' queries over the whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audio, chat, curriculum, decontaminate, language_id, ngram_lm, simhash, token_counts, url_filter, warc

TOKENIZER = "word_bpe_49k.json"
LM_FOLDS, LANG_FOLDS = 10, 5
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(ident: str, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``; a null id counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(ident).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op3_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audio.audio_features(table(spark, sf_dir, "documents")).drop("media", "tensors", "spans")


def op4_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("held_out", fold("doc_id", LM_FOLDS) == 0)
    model = ngram_lm.learn(docs.where(~F.col("held_out")))
    return ngram_lm.score(docs, model, carry=("held_out",))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op6_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = curriculum.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans", "version")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", fold("doc_id", LANG_FOLDS) == 0)
    model = language_id.train(docs.where(~F.col("held_out")))
    return language_id.identify(docs, model, carry=("held_out",)).drop("accepted")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(table(spark, sf_dir, "conversations"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_simhash, op2_token_counts, op3_audio, op4_ngram_lm, op5_url_filter, op6_curriculum, op7_decontaminate, op8_language_id, op9_chat_format, op10_warc)}

LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def decontaminate_sql(documents: str = "documents") -> str:
    words = rf"regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
        WITH d AS (SELECT doc_id, {words} AS w FROM {documents}),
        b AS (SELECT item_id, {words} AS w FROM benchmark),
        starts AS (SELECT item_id, w, least(len(w), 10) AS m, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
        bw AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS win FROM starts),
        sizes AS (SELECT DISTINCT m FROM bw),
        spots AS (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, sizes WHERE len(w) >= m),
        dw AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS win FROM spots),
        hit AS (SELECT doc_id, i, m, item_id FROM dw JOIN bw USING (m, win)),
        inside AS (SELECT DISTINCT doc_id, unnest(range(i, i + m)) AS p FROM hit),
        n AS (SELECT doc_id, count(*) AS n_hit FROM inside GROUP BY doc_id),
        its AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS h
                FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               coalesce(h, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN n USING (doc_id) LEFT JOIN its USING (doc_id)"""


def curriculum_sql(documents: str = "documents") -> str:
    return rf"""
        WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM {documents}),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source),
        w AS (SELECT *, CASE place % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS weight, 2.0::DOUBLE * source_size AS cap FROM s),
        o AS (SELECT *, coalesce(sum(cap) OVER before, 0) AS given, sum(weight) OVER rest AS remaining
              FROM w WINDOW before AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                            rest AS (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        l AS (SELECT max((1.5 * (SELECT sum(source_size) FROM s) - given) / remaining) FILTER (WHERE (1.5 * (SELECT sum(source_size) FROM s) - given) / remaining * weight <= cap) AS level FROM o),
        t AS (SELECT source, place, source_size, least(cap, weight * coalesce(level, 0)) AS target FROM o, l),
        k AS (SELECT d.*, place, source_size, target, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS key FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        r AS (SELECT *, sum(size) OVER (PARTITION BY place ORDER BY key, doc_id, size ROWS UNBOUNDED PRECEDING) - size AS start, CAST(floor(target + 0.5) AS BIGINT) AS demand FROM k)
        SELECT doc_id, size, source_size, round(target, 6) AS target,
               CAST(greatest(least(size, demand - start), 0) + greatest(least(size, demand - start - source_size), 0) AS BIGINT) AS taken
        FROM r"""


URL_SQL = f"""
    WITH u AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    p AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
    rules (h, q, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)}),
    fits AS (SELECT page_id, max_by(h || q, length(h) + length(q)) AS rule, max_by(v, length(h) + length(q)) AS verdict
             FROM p JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, q) GROUP BY page_id)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN fits USING (page_id)"""

CHAT_SQL = """
    WITH c AS (SELECT conv_id, count(*) AS n, list(length(coalesce(role, '')) || ':' || coalesce(role, '') || length(coalesce(text, '')) || ':' || coalesce(text, '')
                      ORDER BY turn, role, text) AS ts,
                      string_agg('<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered
               FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
    f AS (SELECT conv_id, n, rendered, array_to_string(ts, chr(30)) AS whole, ts FROM c),
    heads AS (SELECT whole, min(conv_id) AS conv_id, count(*) AS n_logged FROM f GROUP BY whole),
    prefixes AS (SELECT DISTINCT array_to_string(ts[1:i], chr(30)) AS whole FROM (SELECT ts, unnest(range(1, n)) AS i FROM f))
    SELECT conv_id, n AS n_turns, n_logged, rendered FROM heads JOIN f USING (conv_id) WHERE heads.whole NOT IN (SELECT whole FROM prefixes)"""

WARC_SQL = """
    WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
    f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
           CASE WHEN first <> page_id THEN first END AS refers_to
    FROM p LEFT JOIN f USING (payload_digest)"""

ORACLE_SQL = {"op5_url_filter": URL_SQL, "op6_curriculum": curriculum_sql(), "op7_decontaminate": decontaminate_sql(), "op9_chat_format": CHAT_SQL, "op10_warc": WARC_SQL}
