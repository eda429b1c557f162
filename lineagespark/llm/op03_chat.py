"""Chat formatting: collapse cumulative snapshots, render maximal conversations.

A logger that stores the conversation after every turn leaves prefixes of the final one. The
rolling hash of the first t turns is the running bit_xor of hashes of (place, role, text), so it
comes from one window over small rows; two hashes of 64 bits with different seeds are kept. A
conversation goes when its own hash is a proper prefix of another (anti-join on distinct hashes)
or when an equal conversation has a smaller id. Texts are shuffled once, for rendering.

Rows without ``conv_id`` belong to no conversation and are left out. Turns are ordered by
``turn`` (null first), then role, then text; repeated rows are one turn. Null roles render as
``unknown`` and null texts as empty; both differ from the literal values in the hash. An empty
table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORDER = ["turn", "role", "text_hash", "text_salt"]


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """``(conv_id, place, n_turns, p1, p2)``: the rolling hash after every turn."""
    part = lambda seed: F.xxhash64(F.lit(seed), F.col("role").isNull(), "role", F.col("text").isNull(), "text")
    rows = turns.filter("conv_id IS NOT NULL").select("conv_id", "turn", "role", part(11).alias("text_hash"), part(12).alias("text_salt")).distinct()
    by_turn = Window.partitionBy("conv_id").orderBy(*ORDER)
    so_far = by_turn.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("place", F.row_number().over(by_turn))
    return rows.select(
        "conv_id", "place", F.bit_xor(F.xxhash64("place", "text_hash", F.lit(1))).over(so_far).alias("p1"),
        F.bit_xor(F.xxhash64("place", "text_salt", F.lit(2))).over(so_far).alias("p2"), F.count(F.lit(1)).over(Window.partitionBy("conv_id")).alias("n_turns"),
    )


def maximal(turns: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, n_equal)`` of the conversations that no other one continues."""
    steps = prefix_hashes(turns)
    whole = steps.filter("place = n_turns").groupBy("n_turns", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_equal"))
    inner = steps.filter("place < n_turns").select(F.col("place").cast("long").alias("n_turns"), "p1", "p2").distinct()
    return whole.join(inner, ["n_turns", "p1", "p2"], "left_anti").select("conv_id", "n_turns", "n_equal")


def chat_documents(turns: DataFrame, opening: str = "<|{role}|>\n", closing: str = "<|end|>\n") -> DataFrame:
    """``(conv_id, n_turns, n_equal, text)``: one rendered text per maximal conversation."""
    kept = maximal(turns)
    before, after = opening.split("{role}")
    said = turns.select("conv_id", "turn", "role", "text").join(kept, "conv_id")
    part = lambda seed: F.xxhash64(F.lit(seed), F.col("role").isNull(), "role", F.col("text").isNull(), "text")
    line = F.concat(F.lit(before), F.coalesce("role", F.lit("unknown")), F.lit(after), F.coalesce("text", F.lit("")), F.lit("\n" + closing))
    one = said.select("conv_id", "n_turns", "n_equal", F.struct("turn", "role", part(11).alias("text_hash"), part(12).alias("text_salt"), line.alias("line")).alias("_t"))
    grouped = one.groupBy("conv_id", "n_turns", "n_equal").agg(F.sort_array(F.collect_set("_t")).alias("_t"))
    return grouped.select("conv_id", "n_turns", "n_equal", F.array_join(F.transform("_t", lambda t: t["line"]), "").alias("text"))
