"""Context selection: priority turns, mandatory sets, strata, diversity and ensembles.

Selections are small by contract (their size is a parameter), so loops run one job per pick or
per turn over distributed candidates; each step is written to the shared folder.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lineagespark.functions.dates import add_sample_interval
from lineagespark.functions.geo import place_of
from lineagespark.functions.text import clean
from lineagespark.operators.distances import encode_profiles
from lineagespark.operators.ranking import reserved_background, seeded, stratified_pool
from lineagespark.session import durable


def priority_pool(ranked: DataFrame, candidates: DataFrame, stratum: list[str], limit: int, seed: int, background_fraction: float = 0.25) -> DataFrame:
    """Queries take turns choosing their best free candidate; reserved slots go to background.

    ``ranked(query_id, sample_id, tier, distance, allele_differences, neg_shared)``. In a turn
    an earlier query has priority over a later one. The turn is solved by proposals: every
    query proposes its best candidate not lost yet, the earliest proposer keeps it, the others
    propose again until nobody loses; this equals going through the queries one by one.
    """
    spark = ranked.sparkSession
    total = candidates.count()
    budget = min(limit, total)
    slots = budget - reserved_background(budget, background_fraction)
    order = Window.partitionBy("query_id").orderBy("tier", "distance", "allele_differences", "neg_shared", "sample_id")
    # A query can lose at most ``slots`` candidates to others, so its first ``slots`` suffice.
    queue = durable(ranked.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= max(slots, 1)), "queue")
    chosen = spark.createDataFrame([], "sample_id string, query_id string, turn int, tier int")
    turn, count = 0, 0
    while count < slots:
        turn += 1
        free = queue.join(chosen.select("sample_id"), "sample_id", "left_anti")
        lost = spark.createDataFrame([], "query_id string, sample_id string")
        while True:
            best = F.min(F.struct("rank", "sample_id", "tier"))
            proposals = free.join(lost, ["query_id", "sample_id"], "left_anti").groupBy("query_id").agg(best.alias("b"))
            proposals = durable(proposals.select("query_id", F.col("b.sample_id").alias("sample_id"), F.col("b.tier").alias("tier")), "proposals")
            holders = proposals.groupBy("sample_id").agg(F.min("query_id").alias("holder"))
            losers = proposals.join(holders, "sample_id").filter("query_id <> holder").select("query_id", "sample_id")
            losers = durable(losers, "losers")
            if losers.isEmpty():
                break
            lost = lost.unionByName(losers)
        picked = proposals.orderBy("query_id").limit(slots - count).select("sample_id", "query_id", F.lit(turn).alias("turn"), "tier")
        chosen = durable(chosen.unionByName(picked), "chosen")
        now = chosen.count()
        if now == count:
            break
        count = now
    reason = F.concat(F.when(F.col("tier") == 0, "lineage_priority:").otherwise("cgmlst_priority:"), F.col("query_id"))
    priority = chosen.select("sample_id", reason.alias("selection_reason"))
    rest = candidates.join(chosen, "sample_id", "left_anti")
    label = "balanced_same_st_background" if count else "balanced_same_st_fallback"
    background = stratified_pool(rest, stratum, budget - count, seed).select("sample_id", F.lit(label).alias("selection_reason"))
    return priority.unionByName(background)


def mandatory_members(nearest: DataFrame, pinned: DataFrame, count: int, method: str = "cgmlst") -> DataFrame:
    """Pinned members, then every query's neighbours up to its tie-expanded cutoff.

    ``nearest(query_id, sample_id, value)``. Order is round robin: first neighbours of every
    query, then second ones; every reason of a member is kept. ``pinned(sample_id)`` may carry
    ``ord``, the order in which the user named the pins; without it they come by id.
    """
    by_value = Window.partitionBy("query_id").orderBy("value")
    kept = nearest.withColumn("_k", F.rank().over(by_value)).filter(F.col("_k") <= count)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("value", "sample_id")))
    why = F.concat(F.lit(f"{method}_neighbour:"), "query_id", F.lit(":rank="), F.col("rank").cast("string"))
    reasons = kept.groupBy("sample_id").agg(
        F.min(F.struct("rank", "query_id")).alias("first"), F.array_sort(F.collect_list(F.struct("rank", "query_id", why.alias("why")))).alias("r")
    )
    turn = F.min("ord") if "ord" in pinned.columns else F.lit(0)
    pins = pinned.groupBy("sample_id").agg(turn.alias("pin_ord")).withColumn("pin", F.lit("user_requested"))
    both = reasons.join(pins, "sample_id", "full_outer")
    all_reasons = F.concat(F.when(F.col("pin").isNull(), F.array().cast("array<string>")).otherwise(F.array("pin")), F.coalesce(F.col("r.why"), F.array().cast("array<string>")))
    # The mandatory set is what a study must hold; its order is one sort of that set.
    position = F.row_number().over(
        Window.orderBy(F.col("pin").isNull(), F.col("pin_ord").asc_nulls_last(), F.when(F.col("pin").isNull(), F.col("first.rank")), F.when(F.col("pin").isNull(), F.col("first.query_id")), "sample_id")
    )
    return both.select("sample_id", all_reasons.alias("reasons"), position.alias("ord"))


def strata(context: DataFrame, as_of: str) -> DataFrame:
    """Cell of each context sample: genetic group, date bin, place and host.

    ``context(sample_id, group_id, collection_date, date_start, date_end, date_precision,
    nuts2, region, country, host)``.
    """
    dated = add_sample_interval(context, "_i", "collection_date", "date_start", "date_end", "date_precision", as_of)
    first, last = F.date_format("_i.start", "yyyy"), F.date_format("_i.end", "yyyy")
    date_bin = F.when(F.col("_i.status") != "valid", "Unknown").when(first == last, first).otherwise(F.concat_ws("..", first, last))
    return dated.select(
        "sample_id", F.coalesce("group_id", F.lit("unassigned")).alias("group_id"), date_bin.alias("date_bin"),
        F.coalesce(place_of("nuts2", "region", "country"), F.lit("Unknown")).alias("place"),
        F.when(clean("host") == "", "Unknown").otherwise(clean("host")).alias("host_group"),
    )


CELL = ["group_id", "date_bin", "place", "host_group"]


def stratum_quotas(cells: DataFrame, mandatory: DataFrame, size: int, seed: int) -> DataFrame:
    """Cells with an optional slot: seeded order, at most a quarter of the size, frozen once."""
    marked = cells.join(mandatory.select("sample_id", F.lit(1).alias("_m")), "sample_id", "left")
    counts = marked.groupBy(*CELL).agg(F.count(F.lit(1)).alias("available"), F.count_if(F.col("_m").isNull()).alias("free")).filter("free > 0")
    slots = max(0, min(size - mandatory.count(), math.ceil(size / 4)))
    return counts.orderBy(seeded(seed, *CELL), *CELL).limit(slots)


def coverage(cells: DataFrame, selected: DataFrame) -> DataFrame:
    """Available and selected members of every stratum."""
    marked = cells.join(selected.select("sample_id", F.lit(1).alias("_s")).distinct(), "sample_id", "left")
    return marked.groupBy(*CELL).agg(F.count(F.lit(1)).alias("available"), F.count("_s").alias("selected"))


def encoded_lookup(calls: DataFrame, min_overlap: float):
    """Distances from one sample to all others, on demand, from encoded profiles.

    Returns ``f(picks) -> (sample_id, pick, distance)``: the picks of one round (a few rows)
    meet the whole table in one equi-join on scope, without a stored pair table.
    """
    encoded = durable(encode_profiles(calls), "profiles")

    def from_picks(picks: DataFrame) -> DataFrame:
        # A round has as many picks as there are replicates, a bound set by the caller.
        chosen = picks.join(encoded, "sample_id").select("scope_id", F.col("sample_id").alias("pick"), F.col("codes").alias("_p"), *[c for c in picks.columns if c != "sample_id"])
        joined = encoded.join(F.broadcast(chosen), "scope_id")
        cells = F.zip_with("codes", "_p", lambda a, b: F.when((a > 0) & (b > 0), F.when(a != b, 1).otherwise(0)))
        shared = F.size(F.filter(cells, lambda x: x.isNotNull()))
        differ = F.aggregate(cells, F.lit(0), lambda s, x: s + F.coalesce(x, F.lit(0)))
        good = (shared > 0) & (shared / F.size("codes") >= min_overlap) & (F.col("sample_id") != F.col("pick"))
        return joined.filter(good).select("sample_id", "pick", (differ / shared).alias("distance"), *[c for c in picks.columns if c != "sample_id"])

    return from_picks


def farthest_first(pool: DataFrame, start: DataFrame, lookup, size: int, seed: int) -> DataFrame:
    """Max-min diversity: each pick is farthest from all earlier members.

    Keeps one running minimum per candidate and joins it with the distances from the last pick
    only. Where nothing comparable is left, the seeded order decides.
    """
    runs = start.select("sample_id", F.lit("1").alias("selection_id"))
    ids = pool.sparkSession.createDataFrame([("1", seed)], "selection_id string, seed int")
    out = _farthest(pool, runs, ids, lookup, size)
    return out.select("sample_id", "ord", "reason")


def _farthest(pool: DataFrame, members: DataFrame, runs: DataFrame, lookup, size: int) -> DataFrame:
    """Farthest-first for several runs at once; a run is one column value, not a loop.

    ``members(sample_id, selection_id)`` start each run; ``runs(selection_id, seed)``.
    """
    order = Window.partitionBy("selection_id").orderBy("sample_id")
    chosen = durable(members.withColumn("ord", F.row_number().over(order)).withColumn("reason", F.lit("mandatory")), "members")
    state = durable(
        pool.crossJoin(F.broadcast(runs)).join(chosen.select("selection_id", "sample_id"), ["selection_id", "sample_id"], "left_anti")
        .withColumn("nearest", F.lit(None).cast("double")),
        "state",
    )
    last = chosen.select("selection_id", "sample_id")
    begun = chosen.groupBy("selection_id").count().agg(F.min("count")).first()[0] or 0
    for _ in range(max(0, min(size, pool.count()) - begun)):
        near = lookup(last).groupBy("selection_id", "sample_id").agg(F.min("distance").alias("_d"))
        state = state.join(near, ["selection_id", "sample_id"], "left").withColumn("nearest", F.least("nearest", "_d")).drop("_d")
        state = durable(state, "state")
        draw = F.sha2(F.concat_ws(":", "seed", "sample_id"), 256)
        best = F.max(F.struct(F.coalesce("nearest", F.lit(-1.0)).alias("v"), draw.alias("h"), "sample_id"))
        pick = durable(state.groupBy("selection_id").agg(best.alias("b")).select("selection_id", F.col("b.sample_id").alias("sample_id"), F.col("b.v").alias("v")), "pick")
        if pick.isEmpty():
            break
        tail = chosen.groupBy("selection_id").agg(F.max("ord").alias("_o"))
        reason = F.when(F.col("v") >= 0, "cgmlst_diversity_representative").otherwise("metadata_background_no_comparable_profile")
        added = pick.join(tail, "selection_id", "left").select("sample_id", "selection_id", (F.coalesce("_o", F.lit(0)) + 1).alias("ord"), reason.alias("reason"))
        chosen = durable(chosen.unionByName(added), "members")
        state = state.join(pick.select("selection_id", "sample_id"), ["selection_id", "sample_id"], "left_anti")
        last = pick.select("selection_id", "sample_id")
    return chosen


def ensemble(pool: DataFrame, mandatory: DataFrame, cells: DataFrame, lookup, size: int, replicates: int, seed: int) -> DataFrame:
    """Alternative selections that share the mandatory set and the frozen stratum quotas.

    ``(selection_id, seed, sample_id, ord, reason)``; only representatives vary with the seed.
    """
    spark = pool.sparkSession
    runs = spark.range(replicates).select(F.format_string("selection-%03d", F.col("id") + 1).alias("selection_id"), (F.lit(seed) + F.col("id")).cast("int").alias("seed"))
    base = durable(mandatory.select("sample_id").distinct(), "mandatory")
    quotas = stratum_quotas(cells, base, size, seed).select(*CELL)
    free = cells.join(base, "sample_id", "left_anti").join(quotas, CELL, "left_semi")
    draw = F.min(F.struct(F.sha2(F.concat_ws(":", "seed", "sample_id"), 256).alias("h"), "sample_id"))
    drawn = free.crossJoin(F.broadcast(runs)).groupBy("selection_id", *CELL).agg(draw.alias("b")).select("selection_id", F.col("b.sample_id").alias("sample_id"))
    fixed = base.crossJoin(F.broadcast(runs.select("selection_id")))
    start = fixed.select("sample_id", "selection_id").unionByName(drawn.select("sample_id", "selection_id"))
    chosen = _farthest(pool, start, runs, lookup, size)
    why = drawn.select("selection_id", "sample_id", F.lit("genetic_group_time_region_representative").alias("_q"))
    return chosen.join(why, ["selection_id", "sample_id"], "left").withColumn("reason", F.coalesce("_q", "reason")).drop("_q").join(runs, "selection_id")


def overlaps(members: DataFrame) -> DataFrame:
    """Pairwise overlap of selections, with repeats of an earlier set marked."""
    sizes = members.groupBy("selection_id").agg(F.countDistinct("sample_id").alias("n"))
    m = members.select("selection_id", "sample_id").distinct()
    pairs = m.alias("a").join(m.alias("b"), (F.col("a.sample_id") == F.col("b.sample_id")) & (F.col("a.selection_id") < F.col("b.selection_id"))).groupBy(
        F.col("a.selection_id").alias("left"), F.col("b.selection_id").alias("right")
    ).agg(F.count(F.lit(1)).alias("shared"))
    ids = sizes.select("selection_id")
    every = ids.alias("a").join(ids.alias("b"), F.col("a.selection_id") < F.col("b.selection_id")).select(F.col("a.selection_id").alias("left"), F.col("b.selection_id").alias("right"))
    size = lambda side: sizes.select(F.col("selection_id").alias(side), F.col("n").alias(f"n_{side}"))
    out = every.join(pairs, ["left", "right"], "left").join(size("left"), "left").join(size("right"), "right").withColumn("intersection", F.coalesce("shared", F.lit(0)))
    union = F.col("n_left") + F.col("n_right") - F.col("intersection")
    return out.select("left", "right", "intersection", union.alias("union"), (F.col("intersection") / union).alias("jaccard"), (F.col("intersection") == union).alias("duplicate"))


def missing_metadata(samples: DataFrame, as_of: str, fields: list[str]) -> DataFrame:
    """Per field, how many members lack it; dates must be valid, not merely present."""
    dated = add_sample_interval(samples, "_i", "collection_date", "date_start", "date_end", "date_precision", as_of)
    tests = [F.struct(F.lit(f).alias("field"), (clean(f) == "").alias("lacks")) for f in fields]
    tests.append(F.struct(F.lit("collection_date").alias("field"), (F.col("_i.status") != "valid").alias("lacks")))
    rows = dated.select(F.explode(F.array(*tests)).alias("t"))
    return rows.groupBy("t.field").agg(F.count_if("t.lacks").alias("missing"), F.count(F.lit(1)).alias("members"))
