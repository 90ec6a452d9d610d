"""Mixing sources to target weights by a time-varying curriculum.

Each source has a target number of words and a schedule: a piecewise linear weight over training time
[0, 1]. The integral of the schedule, scaled to the target, is the source's cumulative demand. Documents
stand in a fixed order by hash; the demand is met by passes over them. The inverse of the demand at a
document's first word is its training position, by which documents are range-sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

WEIGHTS, SHARE, EPOCHS = (3.0, 1.0, 2.0), 1.5, 2
#: Knots (time, weight) by rank, repeating as the weights do; only their shape counts, not their height.
SCHEDULES = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (0.5, 1.5), (1.0, 0.5)))
SPACE = r"[\x20\x09-\x0D]+"


def order_key(ident: Column) -> Column:
    """A document's place in its source's order: the first 60 bits of its id's MD5 (0 for a null id)."""
    return F.coalesce(F.conv(F.substring(F.md5(ident.cast("string").cast("binary")), 1, 15), 16, 10).cast("long"), F.lit(0).cast("long"))


def word_count(text: Column) -> Column:
    """Words of a text, 0 for null. Splitting goes over it once; ``regexp_count`` copies the text for every match."""
    return F.coalesce(F.size(F.array_remove(F.split(text, SPACE), "")), F.lit(0)).cast("long")


def bucket_bits(rows: int) -> int:
    """Bits of the hash that cut a source of so many rows into about as many buckets as each holds rows."""
    return rows.bit_length() // 2


def segments(knots: tuple[tuple[float, float], ...]) -> list[tuple[float, ...]]:
    """(t0, w0, slope, W0, W1) of each linear piece, weights scaled so that the whole integral is 1."""
    areas = [(t1 - t0) * (w0 + w1) / 2 for (t0, w0), (t1, w1) in zip(knots, knots[1:], strict=False)]
    total, done, out = sum(areas), 0.0, []
    for ((t0, w0), (t1, w1)), area in zip(zip(knots, knots[1:], strict=False), areas, strict=True):
        out.append((t0, w0 / total, (w1 - w0) / (t1 - t0) / total, done / total, (done + area) / total))
        done += area
    return out


def inverse_integral(y: Column, knots: tuple[tuple[float, float], ...]) -> Column:
    """The time at which a schedule has given the share ``y`` of its demand."""
    out = F.lit(float(knots[-1][0]))
    for t0, w0, slope, before, after in reversed(segments(knots)):
        r = F.greatest(y - before, F.lit(0.0))
        root = w0 + F.sqrt(F.greatest(F.lit(w0 * w0) + 2 * slope * r, F.lit(0.0)))
        out = F.when(y <= after, t0 + F.when(r > 0, 2 * r / root).otherwise(0.0)).otherwise(out)
    return out


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = EPOCHS) -> DataFrame:
    """Adds ``place`` (0, 1, ... by code point, null last) and ``target`` to (``source``, ``source_size``).

    ``share`` of all words is dealt by weight. A source whose part would exceed ``most`` times its size
    stops there and the rest is dealt again among the others, until none is above. Only sums come to the driver.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = written(sources.withColumn("place", place).withColumn("weight", weight), "sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    level, full = None, -1
    while True:
        stopped = F.lit(False) if level is None else F.col("source_size") * most < F.col("weight") * level
        row = ranked.agg(F.count_if(stopped).alias("full"), F.sum(F.when(stopped, F.col("source_size") * most).otherwise(0.0)).alias("given"), F.sum(F.when(stopped, 0.0).otherwise(F.col("weight"))).alias("left")).first()
        if row["full"] in (full, None) or not row["left"]:
            break
        full, level = row["full"], (share * total - row["given"]) / row["left"]
    return ranked.withColumn("target", F.least(F.col("source_size") * float(most), F.col("weight") * (level or 0.0))).drop("weight")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights=WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, schedules=SCHEDULES) -> DataFrame:
    """One row per row of ``docs`` in training order: ``id_col``, ``size``, ``source_size``, ``target``, ``taken``, ``position``, ``passes``.

    ``size`` counts white-space separated words (null: 0). ``passes`` lists (pass, position, words) for
    each time the document is taken; the last one of a source may take only its first words, so a
    source's ``taken`` adds up to its target, rounded. ``position`` is that of the first pass, null if none.
    Documents of no words are never taken. Null sources are one source, the last; null ids sort first in their source's order, and ties go by size. Repeated rows are
    documents of their own. Reruns agree. An empty table gives an empty result.
    """
    sized = written(docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), word_count(F.col(text_col)).alias("size")), "sizes")
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n")), weights, share, epochs)
    sources = written(sources, "targets")
    # Each source's order is cut into buckets of the hash, so that no running sum goes over a whole source.
    most = sources.agg(F.max("n")).first()[0] or 0
    bits = bucket_bits(most)
    known = F.broadcast(sources) if sources.count() <= 100_000 else sources
    placed = sized.join(known.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s"))).select("id", "size", "place", "source_size", "target", order_key(F.col("id")).alias("key"))
    placed = placed.withColumn("bucket", F.shiftright("key", 60 - bits))
    sums = placed.groupBy("place", "bucket").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("place", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("place", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.join(sums, ["place", "bucket"]).withColumn("start", F.col("base") + F.sum("size").over(within) - F.col("size"))
    demand = F.floor(F.col("target") + 0.5).cast("long")

    def one(k: int) -> Column:
        at = F.col("start") + k * F.col("source_size")
        share_of = F.least(at / F.col("target"), F.lit(1.0))
        time = F.lit(None).cast("double")
        for i, knots in enumerate(schedules):
            time = F.when(F.col("place") % len(schedules) == i, inverse_integral(share_of, knots)).otherwise(time)
        words = F.greatest(F.least(F.col("size"), demand - at), F.lit(0).cast("long"))
        return F.when(words > 0, F.struct(F.lit(k).alias("pass"), time.alias("position"), words.alias("words")))

    passes = F.array_compact(F.array(*(one(k) for k in range(epochs))))
    placed = placed.withColumn("passes", passes)
    taken = F.aggregate("passes", F.lit(0).cast("long"), lambda a, p: a + p["words"])
    out = placed.select(F.col("id").alias(id_col), "size", "source_size", "target", taken.alias("taken"), F.try_element_at("passes", F.lit(1))["position"].alias("position"), "passes")
    return out.repartitionByRange(F.col("position").asc_nulls_last(), id_col).sortWithinPartitions(F.col("position").asc_nulls_last(), id_col)


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(``id_col``, ``pass``, ``position``, ``words``): one row for each time a document is taken, range-sorted by position."""
    rows = mixed.select(id_col, F.explode("passes").alias("p")).select(id_col, "p.pass", "p.position", "p.words")
    return rows.repartitionByRange("position", id_col).sortWithinPartitions("position", id_col)
