"""Conversations as paths of a prefix tree.

A node is a sequence of initial turns. It is named by its smallest conversation, the owner,
and its depth, so along a conversation the owners rise and its own nodes are the last ones.
Sequences are told apart by two 62-bit sums of hashes of (place, role, text).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from staffcast.llm.ordered import masked, running


def ordered_turns(table: DataFrame, keep) -> DataFrame:
    """(conv_id, place, role, text, a, b): turns numbered from 1 in each conversation by `turn`,
    null first; rows of one turn stand by role, then by the MD5 of their text. Null roles and
    texts are empty, rows without a conv_id are left out. a and b are hashes of role and text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = table.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        text.alias("text"), F.md5(text).alias("digest"), F.lit(1).cast("long").alias("one"))
    placed = running(rows, ["conv_id"], [F.col("turn").asc_nulls_first(), "role", "digest"], {"place": "one"}, keep)
    return placed.select(
        "conv_id", "place", "role", "text", masked(F.xxhash64("role", "digest")).alias("a"),
        masked(F.xxhash64("digest", F.lit(1), "role")).alias("b"))


def owners(rows: DataFrame, keep) -> DataFrame:
    """Of rows (conv, depth, a, b, ...), the same rows with the owner of the node that they reach
    in place of a and b."""
    salted = rows.withColumns({
        "a": masked(F.xxhash64("depth", "a")), "b": masked(F.xxhash64("b", "depth"))})
    reached = running(salted, ["conv"], ["depth"], {"sum_a": "a", "sum_b": "b"}, keep).drop("a", "b")
    node = ["depth", "sum_a", "sum_b"]
    return reached.join(reached.groupBy(*node).agg(F.min("conv").alias("owner")), node).drop("sum_a", "sum_b")
