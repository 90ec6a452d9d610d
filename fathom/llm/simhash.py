"""SimHash near-duplicates: 64-bit fingerprints, pigeonring candidates, connected components.

Two fingerprints link at ``MOST`` (3) or fewer differing bits. The 64 bits form a ring of eight segments. By
the pigeonring principle, if all differences sum to at most 3, some segment starts a chain whose first l
segments differ in at most 3 l / 8 bits: the first two are equal, the first five differ in one bit at most, the first
seven in two. Of the 24 bits of the third to fifth segment, cut into equal parts, all parts but one are equal. These and the two equal
segments are the key of a join; the other budgets of the chain prune the pairs of a key before the full
Hamming distance is taken. More parts give longer keys and more of them, so their number grows with the
fingerprints and a key stays short of partners by chance at any size.

Copies never meet in pairs: documents of one fingerprint are one node. Links become components by
alternating large-star and small-star rounds over written edge tables.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import as_batch, byte_slices, discard, written

SEED, SHINGLE, MOST = 42, 3, 3
RING, EQUAL, NEAR = 8, 2, 5  # segments; those of a chain that are equal; those that differ in one bit at most
BLOCK = 1 << 16  # shingles whose bits are spread out at once


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of a whole text: a bit is 1 if set in over half the XXH64 of its word shingles.

    Words are runs without ASCII white space after A-Z are lower-cased. Fewer words than a shingle: the
    whole sequence is the only shingle. No word, or null: 0.
    """
    words = (text or "").encode("utf-8").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(shingle, len(words))
    counts, digest, total = np.zeros(64, np.int64), xxhash.xxh64_intdigest, len(words) - k + 1
    for at in range(0, total, BLOCK):
        stop = min(total, at + BLOCK)
        hashes = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[at:stop].tolist(), ends[at + k - 1 : stop + k - 1].tolist())], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > total).tobytes(), "big")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """One row (``id_col``, ``fp`` as a signed long) per row of ``docs``; other columns are not read."""
    narrow = docs.select(id_col, text_col)
    schema = narrow.select(id_col, F.lit(0).cast("long").alias("fp")).schema
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in byte_slices(batches, 1):
            fps = np.array([text_fingerprint(t, shingle) for t in b.column(1).to_pylist()], dtype=np.uint64)
            yield as_batch(arrow, b.column(0), pa.array(fps.view(np.int64)))

    return narrow.mapInArrow(run, schema)


def parts_for(rows: int) -> int:
    """Into how many parts the nearly equal bits are cut, so that keys are longer than the fingerprints are many."""
    return next((p for p in (2, 3, 4, 6, 12) if rows < 1 << (40 - 24 // p)), 24)


def links(nodes: DataFrame, fp: str = "fp", parts: int | None = None) -> DataFrame:
    """Pairs (``a`` < ``b``) of distinct fingerprints that differ in at most 3 bits, each once.

    ``nodes`` must hold each fingerprint once.
    """
    parts = parts or parts_for(nodes.count())
    step, width = 64 // RING, (NEAR - EQUAL) * 64 // RING
    size, keys = width // parts, []
    for start in range(RING):
        turned = F.expr(f"(`{fp}` << {step * start}) | shiftrightunsigned(`{fp}`, {64 - step * start})") if start else F.col(fp)
        equal = F.shiftrightunsigned(turned, 64 - EQUAL * step)
        near = F.shiftrightunsigned(turned, 64 - NEAR * step).bitwiseAND(F.lit((1 << width) - 1))
        for part in range(parts):
            held = ((1 << width) - 1) ^ (((1 << size) - 1) << (part * size))  # all parts but this
            key = F.shiftleft(F.lit(parts * start + part).cast("long"), 40).bitwiseOR(F.shiftleft(equal, width)).bitwiseOR(near.bitwiseAND(F.lit(held)))
            keys.append(F.struct(key.alias("key"), turned.alias("turned")))
    rows = nodes.select(F.col(fp).alias("n"), F.explode(F.array(*keys)).alias("k")).select("n", "k.key", "k.turned")
    a, b = rows.alias("a"), rows.alias("b")
    differ = F.col("a.turned").bitwiseXOR(F.col("b.turned"))
    chain = F.lit(True)
    for length in (NEAR, RING - 1):
        chain = chain & (F.bit_count(F.shiftrightunsigned(differ, 64 - length * step)) <= MOST * length // RING)
    pairs = a.join(b, (F.col("a.key") == F.col("b.key")) & (F.col("a.n") < F.col("b.n")) & chain & (F.bit_count(differ) <= MOST))
    return pairs.select(F.col("a.n").alias("a"), F.col("b.n").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``component``) for every node of the edges (``a``, ``b``); the component is its smallest node.

    Each round joins the edges with a written table of minima, so that a node with very many edges is a
    skewed join, which Spark splits, and never a group in one task.
    """

    def seen(table: DataFrame):
        return table.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    now = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges")
    before, after = None, seen(now)
    while after[0] and after != before:
        old, now = now, small_star(large_star(now))
        before, after = after, seen(now)
        discard(old)
    tops = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(tops)


def large_star(down: DataFrame) -> DataFrame:
    """Large-star: every larger neighbour of a node is tied to the least of its neighbourhood."""
    both = down.unionByName(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
    tied = written(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "edges")
    discard(low)
    return tied


def small_star(down: DataFrame) -> DataFrame:
    """Small-star: a node and its smaller neighbours are tied to the least of them. ``down`` is written, and goes."""
    low = written(down.groupBy("u").agg(F.min("v").alias("m")), "low")
    met = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    tied = written(met.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    discard(low, down)
    return tied


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``fingerprint`` (16 hex digits), ``component_id``.

    ``component_id`` is the smallest id reachable over links, the row's own included. Null and empty texts
    have fingerprint zero and link like any other. Rows that repeat an id are nodes of that id. Rows without an id link
    and lead on like others; where no row that is reached has an id the component is null. An empty table gives an empty
    result. Columns beside the two are not touched.
    """
    fps = written(fingerprints(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "id", "text"), "fingerprints")
    nodes = written(fps.groupBy("fp").agg(F.min("id").alias("least")), "nodes")
    # An id on rows of several fingerprints ties these together.
    spans = fps.where("id IS NOT NULL").groupBy("id").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).where("lo <> hi").select("id", "lo")
    tied = fps.join(spans, "id").where("lo <> fp").select(F.col("lo").alias("a"), F.col("fp").alias("b")).distinct()
    joined = components(links(nodes).unionByName(tied))
    named = written(nodes.join(joined.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.coalesce("component", "fp").alias("component")), "named")
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    labelled = written(named.join(least, "component").select("fp", "component_id"), "labelled")
    discard(nodes, named)
    return fps.join(labelled, "fp").select(F.col("id").alias(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
