"""Token counts by the whole-token shortcut.

Offline, once per tokenizer, every vocabulary string that may be a whole pre-token is encoded alone;
those that give exactly one token form the whole-token set. In a text, white space always separates
pre-tokens, so a text's count is the sum over its white-space-delimited pieces. A piece's pre-tokens
found in the set count one each; only the rest run the merges. Counts of pieces are kept in a bounded
table, so a piece that repeats costs one lookup.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import as_batch, byte_slices

KEPT_PIECES, KEPT_LENGTH = 400_000, 64  # bounds of a worker's table: pieces, characters of a piece
#: White space to Python's split() but not to the tokenizer's patterns: such texts are cut another way.
ODD_SPACE = re.compile(r"[\x1c-\x1f]")
SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")


def load(path: str):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def whole_tokens(path: str) -> frozenset[str]:
    """The vocabulary strings, in the model's byte alphabet and without the word-end mark, that encode alone as one token."""
    tokenizer = load(path)
    end = tokenizer.model.end_of_word_suffix or ""
    names = [v for v in tokenizer.get_vocab(with_added_tokens=False) if v.endswith(end) and len(v) > len(end)]
    alone = (v[: len(v) - len(end)] for v in names)
    return frozenset(v for v in alone if len(tokenizer.model.tokenize(v)) == 1)


class Counter(dict):
    """piece -> tokens; a missing piece is counted and, if short, kept."""

    def __init__(self, path: str, whole: frozenset[str]):
        super().__init__()
        self.tokenizer, self.whole = load(path), whole
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, piece: str) -> int:
        n = self.count_piece(piece)
        if len(piece) <= KEPT_LENGTH:
            if len(self) >= KEPT_PIECES:
                self.clear()
            self[piece] = n
        return n

    def count_piece(self, piece: str) -> int:
        t = self.tokenizer
        if any(s in piece for s in self.special):  # the library finds added tokens in the raw text
            return len(t.encode(piece, add_special_tokens=False).ids)
        normal = t.normalizer.normalize_str(piece) if t.normalizer else piece
        pre = [p for p, _ in t.pre_tokenizer.pre_tokenize_str(normal)]
        return sum(1 if p in self.whole else len(t.model.tokenize(p)) for p in pre)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        pieces = SPACE.split(text) if ODD_SPACE.search(text) else text.split()
        return sum(map(self.__getitem__, pieces))


def token_counts(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, ``n_bytes``, ``n_tokens``, ``over_limit`` (n_tokens > ``limit``).

    Counts are those of the tokenizers library without begin, end or template tokens, truncation or
    padding. The tokenizer must cut at white space and drop it, as the word-level file does. Null and empty texts have 0 bytes and
    0 tokens. Null ids and repeated rows are carried. Columns beside the two are not touched.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = narrow.select("id", F.lit(0).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_tokens")).schema
    arrow = to_arrow_schema(schema)
    whole = docs.sparkSession.sparkContext.broadcast(whole_tokens(tokenizer_path))  # at most one entry per vocabulary string

    def run(batches):
        counter = Counter(tokenizer_path, whole.value)
        for b in byte_slices(batches, 1):
            texts = b.column(1).to_pylist()
            yield as_batch(arrow, b.column(0), np.fromiter((len(t.encode("utf-8")) if t else 0 for t in texts), np.int64, len(texts)), np.fromiter(map(counter.count, texts), np.int64, len(texts)))

    return narrow.mapInArrow(run, schema).select(F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
