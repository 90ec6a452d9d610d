"""URL filters: a blocked Bloom filter passes possible hits to an exact hash join.

Listed rules are canonical URLs: a lower-case host and a path prefix. Of a page's URL only those
(host suffix, path prefix) keys are formed whose shape (labels, length) some rule has. The keys are
probed in a split-block Bloom filter of the rules; what passes is joined with the rules by equality,
which removes false positives, and the longest rule decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

WORDS, BITS_PER_KEY, MOST_BLOCKS = 8, 16, 1 << 20  # a block is 8 words of 32 bits; at most 32 MB are broadcast
#: Odd multipliers, one for each word of a block.
SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31], dtype=np.uint32)


class BlockedBloom:
    """Split-block Bloom filter over 64-bit hashes; a key sets one bit in each word of one block."""

    def __init__(self, blocks: int):
        self.table = np.zeros((blocks, WORDS), np.uint32)

    def _place(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        h = hashes.view(np.uint64) if hashes.dtype == np.int64 else hashes.astype(np.uint64)
        block = ((h >> np.uint64(32)) * np.uint64(len(self.table))) >> np.uint64(32)
        low = (h & np.uint64(0xFFFFFFFF)).astype(np.uint32)
        return block.astype(np.int64), np.uint32(1) << ((low[:, None] * SALTS) >> np.uint32(27))

    def add(self, hashes: np.ndarray) -> None:
        block, bits = self._place(hashes)
        np.bitwise_or.at(self.table, block, bits)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        block, bits = self._place(hashes)
        return ((self.table[block] & bits) == bits).all(axis=1)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL: empty for null or without ``://``; only A-Z of the host are lower-cased."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def bloom_of(keys: DataFrame, *columns: str) -> BlockedBloom:
    """The filter of all keys, by XXH64. Tasks build partial filters; its size is bounded, and a longer list only passes more false hits."""
    n = keys.count()
    blocks = min(MOST_BLOCKS, max(1, -(-n * BITS_PER_KEY // (32 * WORDS))))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bloom = BlockedBloom(blocks)
        for b in batches:
            bloom.add(b["h"].to_numpy(np.int64))
        used = np.flatnonzero(bloom.table.any(axis=1))
        for at in range(0, len(used), 1 << 14):
            part = used[at : at + (1 << 14)]
            yield pd.DataFrame({"block": part, **{f"w{i}": bloom.table[part, i].astype(np.int64) for i in range(WORDS)}})

    words = [f"w{i}" for i in range(WORDS)]
    parts = keys.select(F.xxhash64(*columns).alias("h")).mapInPandas(partial, "block long, " + ", ".join(f"{c} long" for c in words))
    whole = BlockedBloom(blocks)
    for row in parts.groupBy("block").agg(*(F.bit_or(c).alias(c) for c in words)).toLocalIterator():
        whole.table[row["block"]] = [row[c] for c in words]
    return whole


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: ``id_col``, ``host``, ``path``, ``rule`` (or null), ``verdict``.

    ``rules`` has ``host`` (lower case, not empty), ``path`` and ``verdict``. A rule fits its host and all
    subdomains where the URL's path starts with the rule's. The longest host plus path wins; of equally long ones the longer host, then the later verdict by code point (block before allow).
    Without a fitting rule the verdict is ``default``. Null ids and URLs and repeated rows are carried;
    without rules every verdict is the default. Columns beside the two are not touched.
    """
    host, path = url_parts(F.col("url"))
    base = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url")).withColumns({"host": host, "path": path})
    rules = rules.select("host", "path", "verdict").where("host <> ''").distinct()
    # One row per shape: at most the labels of a host times the lengths of paths, however long the list.
    shapes = rules.select(F.size(F.split("host", r"\.")).alias("labels"), F.length("path").alias("length")).distinct().collect()
    keys = [
        F.when((F.size(F.split("host", r"\.")) >= s["labels"]) & (F.length("path") >= s["length"]), F.struct(F.substring_index("host", ".", -s["labels"]).alias("host"), F.substring("path", 1, s["length"]).alias("path")))
        for s in sorted(shapes)
    ]
    if not keys:
        return base.select(F.col("id").alias(id_col), "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    bloom = pages.sparkSession.sparkContext.broadcast(bloom_of(rules, "host", "path"))

    @F.pandas_udf("boolean")
    def possible(hashes: pd.Series) -> pd.Series:
        return pd.Series(bloom.value.has(hashes.to_numpy(np.int64)))

    tried = base.select("id", "url", F.explode(F.array_compact(F.array(*keys))).alias("k")).select("id", "url", "k.host", "k.path")
    hits = tried.where(possible(F.xxhash64("host", "path")))
    rank = F.struct((F.length("host") + F.length("path")).alias("n"), F.length("host").alias("h"), "verdict", F.concat("host", "path").alias("rule"))
    best = hits.join(rules, ["host", "path"]).groupBy(F.col("id").alias("i"), F.col("url").alias("u")).agg(F.max(rank).alias("best"))
    out = base.join(best, F.col("id").eqNullSafe(F.col("i")) & F.col("url").eqNullSafe(F.col("u")), "left")
    return out.select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
