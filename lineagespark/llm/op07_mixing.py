"""Mixing sources to target weights by weighted fair queueing.

Every source's documents are shuffled by a hash of their id. A document's virtual finish time is
its source's words so far, itself included, divided by the source's target; a source that is to
be repeated starts another pass behind its last document. Documents are taken in the order of
finish times until the next one would pass the total budget, so at every moment all sources have
been served in proportion to their targets.

The global order is never sorted in one place. Finish times fall into slices; slice totals show
in which slice the budget ends, and only that slice is ordered, again in parts. A source is cut
into parts by the hash, so one that holds a third of all rows is many windows.

Null sources are one source, the last. Null and empty texts have size 0 and are never taken.
Repeated rows are taken on their own. A table without words gives targets and takings of 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineagespark.llm.common import NO_ID, running, word_count, written

WEIGHTS, MAX_PASSES = (1, 2, 3), 3
SLICES = 1024


def source_targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = MAX_PASSES) -> DataFrame:
    """``sources(no_source, src, source_size)`` with ``place`` and ``target``; one row per source.

    Targets share the sum of all sizes by weight; one stops at ``passes`` times its source and
    its excess is shared again. In the order of size / weight the sources that stop come first,
    so one running sum finds them.
    """
    # The table has a row per source, a few bytes each: its windows are not cut.
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    whole = F.lit(1)
    for w in weights:
        whole = whole * w
    place = F.row_number().over(Window.orderBy("no_source", "src"))
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    big = lambda c: F.col(c).cast("decimal(20,0)")
    by_need = Window.orderBy(F.col("source_size") * whole / F.col("weight"), "place")
    df = sources.withColumn("place", place).withColumn("weight", weight.cast("long"))
    df = df.withColumn("_total", F.sum("source_size").over(everything)).withColumn("_weights", F.sum("weight").over(everything))
    earlier = by_need.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumn("_given", passes * F.coalesce(F.sum("source_size").over(earlier), F.lit(0))).withColumn("_used", F.coalesce(F.sum("weight").over(earlier), F.lit(0)))
    df = df.withColumn("_left", F.col("_total") - F.col("_given")).withColumn("_rest", F.col("_weights") - F.col("_used"))
    stops = passes * big("source_size") * big("_rest") <= big("weight") * big("_left")
    df = df.withColumn("_stops", stops)
    level = F.max(F.when(~F.col("_stops"), F.struct((-F.col("_used")).alias("first"), (F.col("_left").cast("double") / F.col("_rest")).alias("level")))).over(everything)["level"]
    target = F.when(F.col("_stops"), (passes * F.col("source_size")).cast("double")).otherwise(F.col("weight") * level)
    return df.select("no_source", "src", "source_size", "place", target.alias("target"))


def _slice(finish: Column) -> Column:
    """A number that never falls as finish times rise, with a few thousand values."""
    return F.when(finish < 2, F.floor(finish * SLICES)).otherwise(2 * SLICES + F.floor(F.log2(finish / 2) * (SLICES // 4))).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, passes: int = MAX_PASSES, seed: str = "mix") -> DataFrame:
    """``(doc_id, source, text_hash, size, source_size, target, taken)``, one row per document."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))
    rows = docs.select(
        "doc_id", "source", F.xxhash64("text").alias("text_hash"), word_count(F.col("text")).alias("size"), order.alias("_order"),
        F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("src"), F.substring(order, 1, 3).alias("_part"),
    )
    rows = written(rows, "sizes")
    sources = rows.groupBy("no_source", "src").agg(F.sum("size").alias("source_size"))
    targets = written(source_targets(sources, weights, passes), "targets")
    summed = running(rows, ["no_source", "src"], "_part", [F.col("_order"), F.col("size"), F.col("text_hash")], F.col("size"), "_so_far")
    queue = written(summed.join(targets, ["no_source", "src"]), "queue")

    finish = lambda turn: (turn * F.col("source_size") + F.col("_so_far")).cast("double") / F.col("target")
    key = lambda turn: F.struct(finish(turn).alias("finish"), F.col("place"), F.col("_order").alias("order"), F.col("_so_far").alias("so_far"), F.lit(turn).alias("turn") if isinstance(turn, int) else turn.alias("turn"))
    due = queue.filter("size > 0").withColumn("_turn", F.explode(F.array(*[F.lit(t) for t in range(passes)])))
    due = due.select("size", key(F.col("_turn")).alias("_key")).withColumn("_slice", _slice(F.col("_key.finish")))
    budget = queue.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("_budget"))
    totals = due.groupBy("_slice").agg(F.sum("size").alias("_words"))
    ahead = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a few thousand slices
    reached = totals.withColumn("_sum", F.sum("_words").over(ahead)).crossJoin(F.broadcast(budget)).filter("_sum > _budget")
    cut = reached.agg(F.min(F.struct(F.col("_slice").alias("slice"), (F.col("_budget") - F.col("_sum") + F.col("_words")).alias("room"))).alias("_cut"))
    cut = written(cut.select(F.col("_cut.slice").alias("_cut_slice"), F.col("_cut.room").alias("_room")), "cut")  # one row

    last = due.join(F.broadcast(cut), F.col("_slice") == F.col("_cut_slice"))
    fine = F.floor((F.col("_key.finish") * SLICES - F.floor(F.col("_key.finish") * SLICES)) * SLICES)
    last = last.withColumn("_fine", F.when(F.col("_key.finish") < 2, fine).otherwise(F.lit(0)))
    last = running(last, [], "_fine", [F.col("_key")], F.col("size"), "_filled")
    edge = last.filter("_filled <= _room").agg(F.max("_key").alias("_last"))
    end = cut.crossJoin(F.broadcast(edge))  # one row each
    taken = lambda t: F.when(F.col("_cut_slice").isNull() | (_slice(finish(t)) < F.col("_cut_slice")) | ((_slice(finish(t)) == F.col("_cut_slice")) & (key(t) <= F.col("_last"))), F.col("size")).otherwise(0)
    words = sum((F.coalesce(taken(t), F.lit(0)) for t in range(passes)), F.lit(0))
    out = queue.crossJoin(F.broadcast(end)).withColumn("taken", F.when(F.col("size") > 0, words).otherwise(0).cast("long"))
    return out.select("doc_id", "source", "text_hash", "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, with all their columns.

    Equal rows are told apart by a number, so each meets one row of the mix.
    """
    columns = docs.columns
    one = lambda df, text: df.withColumn("_id", F.coalesce("doc_id", F.lit(NO_ID))).withColumn("_text", text).withColumn("_src", F.coalesce("source", F.lit(""))).withColumn("_none", F.col("source").isNull())
    ids = ["_id", "_text", "_src", "_none"]
    numbered = lambda df: df.withColumn("_nth", F.row_number().over(Window.partitionBy(*ids).orderBy(F.lit(1))))
    times = F.when(F.col("size") > 0, (F.col("taken") / F.col("size")).cast("int")).otherwise(0)
    plan = numbered(one(mix(docs, **how), F.col("text_hash"))).select(*ids, "_nth", times.alias("_times"))
    rows = numbered(one(docs, F.xxhash64("text"))).join(plan, [*ids, "_nth"]).filter("_times > 0")
    return rows.withColumn("_copy", F.explode(F.array_repeat(F.lit(1), F.col("_times")))).select(*[F.col(c) for c in columns])
