"""Chat formatting by cumulative-snapshot collapse, in DataFrame functions alone.

Logs often hold a conversation several times, each snapshot a turn or more longer. Every conversation gets
a rolling hash for each of its prefixes (SHA-256 over the previous hash, the role and the text, lengths
included). An anti-join of whole-conversation hashes with the distinct hashes of proper prefixes leaves
the maximal conversations, one of each, and only those are rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def field(value: Column) -> Column:
    """A value with its length before it, so that no two lists of fields read alike."""
    return F.concat(F.length(value).cast("string"), F.lit(":"), value)


def roll(before: Column, turn: Column) -> Column:
    return F.sha2(F.concat(before, field(turn["role"]), field(turn["text"])), 256)


def render(turns: Column) -> Column:
    """Turns as ``<|im_start|>role`` newline, text, ``<|im_end|>`` newline, in order."""
    return F.array_join(F.transform(turns, lambda t: F.concat(F.lit(OPEN), t["role"], F.lit("\n"), t["text"], F.lit(f"{CLOSE}\n"))), "")


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per maximal conversation: ``conv_id``, ``n_turns``, ``n_logged``, ``rendered``.

    Conversations that are a prefix of a longer one go; of equal ones that with the smallest id stays, and
    ``n_logged`` counts those equal ones. Turns are ordered by number; of equal numbers by role and text, and repeated rows are turns
    of their own. A null role or text is an empty one, a null turn number comes first. Rows without a
    conversation id belong to no conversation and are left out. Columns beside the four are not touched.
    """
    turn = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    convs = turns.where(F.col(conv_col).isNotNull()).groupBy(F.col(conv_col).alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    hashes = F.aggregate("turns", F.array().cast("array<string>"), lambda acc, t: F.concat(acc, F.array(roll(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("")), t))))
    convs = written(convs.withColumn("hashes", hashes), "conversations")
    whole = F.element_at("hashes", -1)
    heads = convs.groupBy(whole.alias("whole")).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_logged"))
    prefixes = convs.select(F.explode(F.slice("hashes", 1, F.size("hashes") - 1)).alias("whole")).distinct()
    maximal = heads.join(prefixes, "whole", "left_anti").select("conv_id", "n_logged")
    kept = convs.select("conv_id", "turns").join(maximal, "conv_id")
    return kept.select(F.col("conv_id").alias(conv_col), F.size("turns").cast("long").alias("n_turns"), "n_logged", render(F.col("turns")).alias("rendered"))
