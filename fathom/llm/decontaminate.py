"""Benchmark decontamination by winnowing, in DataFrame functions alone.

Word K-grams are hashed; of every W consecutive K-grams the least hash is kept, and neighbouring windows that keep the
same one count once. W windows of K-grams span SPAN = K + W - 1 words, so two texts that share SPAN words keep an equal
fingerprint at the same place of the shared span: no shared span of that length is missed. The fingerprints of all
documents are joined with those of the items. Only documents that share one are read again: each hit is extended
to its whole windows, compared word by word, and windows that overlap or touch become one stretch.

Items shorter than SPAN have one window, the whole item; it is found by the hash of as many words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, written

K, W = 5, 6
SPAN = K + W - 1
APART = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what stands between words once A-Z are lower-cased


def words_of(text: Column) -> Column:
    """The words of a text. Splitting goes over it once; ``regexp_extract_all`` copies the text for every match."""
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), APART), "")


def places(last: Column) -> Column:
    """0 ... last as an array; empty if ``last`` is negative."""
    return F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))


def gram_hash(words: Column, at: Column, n: int) -> Column:
    return F.xxhash64(*(words[at + j] for j in range(n)))


def with_grams(df: DataFrame) -> DataFrame:
    """Adds ``n`` and the K-gram hashes ``g`` to a table with ``words``."""
    df = df.withColumn("n", F.size("words"))
    return df.withColumn("g", F.transform(places(F.col("n") - K), lambda i: gram_hash(F.col("words"), i, K)))


def kept_hash(at: Column) -> Column:
    """The fingerprint that winnowing keeps of the W K-grams from ``at``."""
    return F.least(*(F.col("g")[at + j] for j in range(W)))


def window_text(at: Column, n) -> Column:
    return F.array_join(F.slice("words", at + 1, n), " ")


def item_windows(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(``m`` words, ``fp``, ``window``, ``item_ids``): each different window of the items once."""
    table = with_grams(items.select(F.col(id_col).alias("item"), words_of(F.col(text_col)).alias("words")))
    long = F.transform(places(F.col("n") - SPAN), lambda i: F.struct(F.lit(SPAN).alias("m"), kept_hash(i).alias("fp"), window_text(i, F.lit(SPAN)).alias("window")))
    short = F.lit(None)
    for m in range(1, SPAN):
        short = F.when(F.col("n") == m, gram_hash(F.col("words"), F.lit(0), m)).otherwise(short)
    one = F.array(F.struct(F.col("n").alias("m"), short.alias("fp"), window_text(F.lit(0), F.col("n")).alias("window")))
    found = F.when(F.col("n") >= SPAN, long).when(F.col("n") > 0, one)
    rows = table.select("item", F.explode(found).alias("x")).select("item", "x.m", "x.fp", "x.window")
    return rows.groupBy("m", "fp", "window").agg(F.collect_set(F.coalesce(F.col("item").cast("string"), F.lit(""))).alias("item_ids"))


def fingerprint_at(i: Column, m: int) -> Column:
    return kept_hash(i) if m == SPAN else gram_hash(F.col("words"), i, m)


def prints(lengths: list[int]) -> Column:
    """The different fingerprints (m, fp) of a document's windows of each length."""

    def of(m: int) -> Column:
        return F.transform(F.array_distinct(F.transform(places(F.col("n") - m), lambda i: fingerprint_at(i, m))), lambda fp: F.struct(F.lit(m).alias("m"), fp.alias("fp")))

    return F.concat(*map(of, lengths)) if lengths else F.array().cast("array<struct<m:int,fp:bigint>>")


def candidates(lengths: list[int]) -> Column:
    """(pos, m, fp, window) wherever a fingerprint is among those ``own`` that the items share."""

    def of(m: int) -> Column:
        at = F.filter(places(F.col("n") - m), lambda i: F.array_contains("own", F.struct(F.lit(m).alias("m"), fingerprint_at(i, m).alias("fp"))))
        return F.transform(at, lambda i: F.struct(i.alias("pos"), F.lit(m).alias("m"), fingerprint_at(i, m).alias("fp"), window_text(i, F.lit(m)).alias("window")))

    return F.concat(*map(of, lengths)) if lengths else F.array().cast("array<struct<pos:int,m:int,fp:bigint,window:string>>")


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``, ``spans``, ``version``.

    ``version`` is the XXH64 of the text, which tells rows of one id apart. A window is SPAN consecutive words of an item, or a shorter item as a whole; ``n_hit`` counts the
    document's words inside occurrences of windows, ``spans`` lists the maximal stretches of such words as [first, end). Null
    and empty texts have no words: such a document is clean, such an item has no window. Null ids and
    repeated rows are carried; a null item id counts as an item named by the empty string. With no items
    every document is clean. Columns beside the named ones are not touched.
    """
    windows = written(item_windows(items, item_id_col, item_text_col), "windows")
    lengths = sorted(r["m"] for r in windows.select("m").distinct().collect())  # at most SPAN numbers
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(F.col(id_col).alias("id"), F.xxhash64(text).alias("version"), text.alias("text"))
    drawn = with_grams(narrow.select("id", "version", words_of(F.col("text")).alias("words")))
    drawn = written(drawn.select("id", "version", F.col("n").cast("long").alias("n_words"), prints(lengths).alias("prints")), "prints")
    rows = drawn.select("id", "version", F.explode("prints").alias("x")).select("id", "version", "x.m", "x.fp")
    both = rows.join(windows.select("m", "fp").distinct(), ["m", "fp"])
    own = both.groupBy(F.col("id").alias("i"), F.col("version").alias("v")).agg(F.collect_set(F.struct("m", "fp")).alias("own"))
    own = written(own, "matched")
    named = F.col("id").eqNullSafe(F.col("i")) & (F.col("version") == F.col("v"))
    met = with_grams(narrow.join(own, named).select("id", "version", "own", words_of(F.col("text")).alias("words")))
    hits = met.select("id", "version", F.explode(candidates(lengths)).alias("h")).select("id", "version", "h.*")
    met = hits.join(windows, ["m", "fp", "window"])
    stretch = F.struct("pos", (F.col("pos") + F.col("m")).alias("end"))
    per = met.groupBy("id", "version").agg(F.sort_array(F.collect_set(stretch)).alias("at"), F.sort_array(F.array_distinct(F.flatten(F.collect_set("item_ids")))).alias("found"))
    merged = F.aggregate(
        "at",
        F.array().cast("array<struct<pos:int,end:int>>"),
        lambda acc, x: F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["end"] >= x["pos"]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.try_element_at(acc, F.lit(-1))["pos"].alias("pos"), F.greatest(F.try_element_at(acc, F.lit(-1))["end"], x["end"]).alias("end"))))).otherwise(
            F.concat(acc, F.array(x))
        ),
    )
    per = per.select(F.col("id").alias("i"), F.col("version").alias("v"), merged.alias("spans"), F.size("found").cast("long").alias("n_items"), F.sha2(F.array_join("found", ","), 256).alias("sha"))
    out = drawn.join(per, named, "left")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["pos"])
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("id").alias(id_col), "n_words", F.coalesce(n_hit, zero).alias("n_hit"), F.coalesce("n_items", zero).alias("n_items"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("items_sha256"), (F.coalesce(n_hit, zero) > 0).alias("contaminated"), "spans", "version",
    )
