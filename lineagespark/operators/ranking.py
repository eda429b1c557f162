"""Nearest neighbours with ties, best-of-group picks and bounded balanced pools."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.dates import add_date_interval
from lineagespark.functions.text import clean
from lineagespark.operators.distances import encode_profiles, encoded_query_distances, tiered_query_distances
from lineagespark.session import durable


def role_distances(calls: DataFrame, samples: DataFrame, min_overlap: float, nearest: int | None = None) -> DataFrame:
    """Evidence of every input against the context of its scope; calls are encoded once.

    Roles are joined to the encoded rows, one per sample, not to the long calls.
    """
    encoded = durable(encode_profiles(calls), "profiles")
    side = lambda test: encoded.join(samples.filter(test).select("sample_id"), "sample_id", "left_semi").select(*encoded.columns)
    return encoded_query_distances(side(F.col("origin").isin(C.FOCAL_ORIGINS)), side(F.col("origin") == "context"), min_overlap, nearest)


def tiered_role_distances(calls: DataFrame, samples: DataFrame, min_overlap: float, first: int) -> DataFrame:
    """Per input its first context samples, those of its own ``samples.lineage`` (tier 0) before all others."""
    encoded = durable(encode_profiles(calls), "profiles")
    side = lambda test: encoded.join(samples.filter(test).select("sample_id", "lineage"), "sample_id")
    return tiered_query_distances(side(F.col("origin").isin(C.FOCAL_ORIGINS)), side(F.col("origin") == "context"), min_overlap, first)


def keep_smallest(df: DataFrame, group: list[str], value: str, tie_count: str | None = None) -> DataFrame:
    """Rows at the group's smallest value, ties kept. Partial aggregates and joins, no sort.

    ``df`` is read twice, so callers pass a stored or cheap table.
    """
    best = df.groupBy(*group).agg(F.min(value).alias("_best"))
    kept = df.join(best, group).filter(F.col(value) == F.col("_best")).drop("_best")
    if tie_count:
        kept = kept.join(kept.groupBy(*group).agg(F.count(F.lit(1)).alias(tie_count)), group)
    return kept


def nearest_context(calls: DataFrame, samples: DataFrame, min_overlap: float, as_of: str) -> DataFrame:
    """For every input, its nearest context samples by raw differences with every tie.

    An input without any comparable context keeps one row that says so.
    """
    near = keep_smallest(durable(role_distances(calls, samples, min_overlap, nearest=1), "nearest"), ["query_id"], "allele_differences", "tied_neighbours")
    dated = add_date_interval(samples, "_i", "collection_date", None)
    future = F.col("_i.start") > F.lit(as_of).cast("date")
    facts = dated.select(
        F.col("sample_id").alias("context_id"), F.when(clean("country") != "", clean("country")).otherwise("Unknown").alias("country"),
        "collection_date", F.when(~future, F.col("_i.year")).alias("year"),
        F.when(future, "future_collection_date").when(F.col("_i").isNotNull(), "valid").otherwise("missing_or_invalid").alias("date_status"),
    )
    everyone = samples.filter(F.col("origin").isin(C.FOCAL_ORIGINS)).select(F.col("sample_id").alias("query_id"))
    out = everyone.join(near.join(facts, "context_id"), "query_id", "left")
    return out.select(
        "query_id", "context_id", F.when(F.col("context_id").isNull(), "no_comparable_context").otherwise("matched").alias("status"),
        "country", "collection_date", "year", "date_status", "tied_neighbours", "allele_differences", "shared_called_loci", "scheme_loci",
        "call_overlap", "distance",
    )


def top_with_ties(df: DataFrame, group: list[str], value: str, n: int) -> DataFrame:
    """Rows ranked within the first ``n`` positions, boundary ties kept, with rank and tie size.

    ``rank <= n`` lets Spark cut every partition to its own top before the shuffle.
    """
    ranked = df.withColumn("rank", F.rank().over(Window.partitionBy(*group).orderBy(value))).filter(F.col("rank") <= n)
    return ranked.withColumn("tied", F.count(F.lit(1)).over(Window.partitionBy(*group, value)))


def nearest_within_tolerance(pairs: DataFrame, value: str, n: int, tolerance: float = 1e-12) -> DataFrame:
    """n nearest of every sample with ties inside ``tolerance``; pairs count both ways."""
    side = lambda own, other: F.struct(F.col(own).alias("sample_id"), F.col(other).alias("other"), F.col(value))
    both = pairs.select(F.inline(F.array(side("sample_a", "sample_b"), side("sample_b", "sample_a"))))
    order = Window.partitionBy("sample_id").orderBy(value, "other")
    both = durable(both, "neighbours")
    cutoff = both.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= n).groupBy("sample_id").agg(F.max(value).alias("boundary"))
    return both.join(cutoff, "sample_id").filter(F.col(value) <= F.col("boundary") + tolerance)


def nearest_snp_context(pairs: DataFrame) -> DataFrame:
    """Best context of every focal sample: fewest SNPs, most callable sites, then id.

    ``pairs(focal, context, snps, callable_sites)``.
    """
    best = F.min(F.struct("snps", (-F.col("callable_sites")).alias("neg"), "context"))
    return pairs.groupBy("focal").agg(best.alias("b")).select(
        "focal", F.col("b.context").alias("context"), F.col("b.snps").alias("snps"), (-F.col("b.neg")).alias("callable_sites")
    )


def nearest_focal(screening: DataFrame) -> DataFrame:
    """Nearest focal of each candidate from ``(candidate, focal, distance, mismatch)``."""
    best = F.min(F.struct("distance", "mismatch", "focal"))
    return screening.groupBy("candidate").agg(best.alias("b")).select(
        "candidate", F.col("b.distance").alias("min_distance"), F.col("b.mismatch").alias("mismatch"), F.col("b.focal").alias("nearest_focal")
    )


def seeded(seed: int, *columns) -> Column:
    """Reproducible order that depends on the seed and the identity only."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *columns), 256)


def round_robin(df: DataFrame, stratum: list[str], within: list, limit: int, seed: int, ident: str) -> DataFrame:
    """Up to ``limit`` rows, one per stratum per round; strata take turns in seeded order.

    Only the first ``limit`` rows of a stratum can be chosen, so ``turn <= limit`` cuts hot
    strata before the shuffle; the rest is a bounded top-n.
    """
    order = Window.partitionBy(*stratum).orderBy(*within)
    turned = df.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= limit)
    turned = turned.withColumn("_s", seeded(seed, *[F.coalesce(F.col(s).cast("string"), F.lit("")) for s in stratum]))
    return turned.orderBy("turn", "_s", ident).limit(limit).drop("_s")


def stratified_pool(df: DataFrame, stratum: list[str], limit: int, seed: int, ident: str = "sample_id") -> DataFrame:
    """Balanced pool over strata, the same for any input order."""
    return round_robin(df, stratum, [seeded(seed, F.col(ident)), F.col(ident)], limit, seed, ident)


def select_context(
    candidates: DataFrame, screening: DataFrame, stratum: list[str], max_context: int, nearest_per_focal: int, seed: int
) -> tuple[DataFrame, DataFrame]:
    """Nearest candidates of each focal by support, then balanced background up to the budget.

    ``candidates(sample_id, <stratum>)``, ``screening(candidate, focal, distance, mismatch)``.
    Returns the selection with its reasons and a one-row audit.
    """
    screening = durable(screening, "screening")
    annotated = candidates.join(nearest_focal(screening).withColumnRenamed("candidate", "sample_id"), "sample_id")
    order = Window.partitionBy("focal").orderBy("distance", "candidate")
    top = screening.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= nearest_per_focal)
    support = top.groupBy(F.col("candidate").alias("sample_id")).agg(
        F.count(F.lit(1)).alias("support"), F.array_join(F.array_sort(F.collect_set("focal")), "|").alias("focals")
    )
    near = annotated.join(support, "sample_id").orderBy(F.desc("support"), "min_distance", "sample_id").limit(max_context)
    near = near.withColumn("selection_reason", F.concat(F.lit("nearest_to="), F.col("focals"))).withColumn("priority", F.lit(0))
    rest = annotated.join(near.select("sample_id"), "sample_id", "left_anti").withColumn("support", F.lit(0)).withColumn("focals", F.lit(""))
    background = round_robin(rest, stratum, ["min_distance", "sample_id"], max_context, seed, "sample_id")
    label = F.concat(F.lit("stratified_background="), F.concat_ws("|", *stratum))
    background = background.withColumn("selection_reason", label).withColumn("priority", F.col("turn")).drop("turn")
    both = near.unionByName(background)
    shuffled = both.withColumn("_s", seeded(seed, *stratum)).orderBy("priority", F.when(F.col("priority") == 0, "").otherwise(F.col("_s")), "sample_id").limit(max_context)
    chosen = shuffled.drop("_s", "priority", "support", "focals")
    covered = top.join(chosen.select(F.col("sample_id").alias("candidate")), "candidate", "left_semi").agg(F.countDistinct("focal").alias("covered_focals"))
    audit = chosen.agg(F.count(F.lit(1)).alias("selected")).crossJoin(covered).crossJoin(
        screening.agg(F.countDistinct("focal").alias("focals"), F.countDistinct("candidate").alias("screened"))
    )
    return chosen, audit


def group_quotas(df: DataFrame, group: list[str], limit: int, within: list) -> DataFrame:
    """Rows kept when groups take turns in group order until the budget is spent."""
    order = Window.partitionBy(*group).orderBy(*within)
    turned = df.withColumn("turn", F.row_number().over(order)).filter(F.col("turn") <= limit)
    return turned.orderBy("turn", *group).limit(limit)


def pick_reference(samples: DataFrame, group: list[str]) -> DataFrame:
    """Reference of each group: the explicit one, else the largest N50, then the largest id.

    More than one explicit reference is reported, not resolved.
    """
    best = F.max(F.struct(F.col("is_reference").cast("int").alias("flag"), "n50", "sample_id"))
    return samples.groupBy(*group).agg(best.alias("b"), F.count_if("is_reference").alias("explicit")).select(
        *group, F.when(F.col("explicit") <= 1, F.col("b.sample_id")).alias("reference"),
        F.when(F.col("explicit") > 1, "multiple_references").when(F.col("explicit") == 1, "explicit").otherwise("largest_n50").alias("status"),
    )


def earliest_per_patient(samples: DataFrame) -> DataFrame:
    """Ids kept when repeat isolates of a patient are dropped: earliest date, unknown years last."""
    from lineagespark.functions.dates import year_text

    year = F.when(year_text("collection_date") == "", "9999").otherwise(year_text("collection_date"))
    first = samples.filter(clean("patient_id") != "").groupBy("patient_id").agg(
        F.min(F.struct(year.alias("y"), "collection_date", "sample_id")).alias("b")
    ).select(F.col("b.sample_id").alias("sample_id"))
    return samples.filter(clean("patient_id") == "").select("sample_id").unionByName(first)


def unit_representatives(members: DataFrame) -> DataFrame:
    """Representative of each unit: passed QC first, then the smallest id.

    ``members(unit, source_genome_id, qc_pass)``.
    """
    worse = F.when(F.coalesce("qc_pass", F.lit(False)), 0).otherwise(1)
    return members.groupBy("unit").agg(F.min(F.struct(worse.alias("w"), "source_genome_id")).alias("b"), F.count(F.lit(1)).alias("members")).select(
        "unit", F.col("b.source_genome_id").alias("representative"), "members"
    )


def adaptive_levels(queries: DataFrame, context: DataFrame, min_context: int) -> DataFrame:
    """Narrowest lineage level with enough context for every represented prefix, per subgroup.

    Both sides hold ``(id, st, species, database_sha256, key_4, key_5, key_6, key_7)`` with
    scoped keys, empty when unresolved. A context row counts for a dataset (st, species,
    key_4) only when its fingerprint fits every input of the dataset. Level 5 is the fallback.
    """
    dataset = ["st", "species", "key_4"]
    usable = queries.filter("key_4 <> '' AND key_5 <> '' AND st <> ''")
    digest = F.lower(clean("database_sha256"))
    fits = usable.groupBy(*dataset).agg(
        F.min(F.when(digest != "", digest)).alias("_lo"), F.max(F.when(digest != "", digest)).alias("_hi"), F.count(F.lit(1)).alias("dataset_inputs")
    )
    pool = context.filter("key_4 <> '' AND st <> ''").withColumn("_h", digest).join(fits, dataset)
    pool = pool.filter((F.col("_h") == "") | F.col("_lo").isNull() | ((F.col("_h") == F.col("_lo")) & (F.col("_h") == F.col("_hi"))))
    levels = lambda df, extra: df.select(
        *extra, F.explode(F.array(*[F.struct(F.lit(d).alias("level"), F.col(f"key_{d}").alias("key")) for d in (5, 6, 7)])).alias("l")
    ).select(*extra, "l.level", "l.key")
    counts = levels(pool, dataset).filter("key <> ''").groupBy(*dataset, "level", "key").agg(F.count(F.lit(1)).alias("n"))
    subgroup = [*dataset, "key_5"]
    prefixes = levels(usable, subgroup).groupBy(*subgroup, "level", "key").agg(F.count(F.lit(1)).alias("inputs"))
    judged = prefixes.join(counts, [*dataset, "level", "key"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    per = judged.groupBy(*subgroup, "level").agg(
        F.when(F.max(F.col("key") == ""), 0).otherwise(F.min("n")).alias("smallest"), F.sum("n").alias("matched"), F.sum("inputs").alias("inputs")
    )
    enough = F.max(F.when(F.col("smallest") >= min_context, F.struct("level", "matched", "smallest")))
    five = F.max(F.when(F.col("level") == 5, F.struct("level", "matched", "smallest")))
    return per.groupBy(*subgroup).agg(F.coalesce(enough, five).alias("c"), F.max("inputs").alias("inputs")).select(
        *subgroup, "inputs", F.col("c.level").alias("selected_level"), F.col("c.matched").alias("selected_context"),
        (F.col("c.smallest") < min_context).alias("limited_context"),
    )


def label_with_dataset(catalogue: DataFrame, queries: DataFrame, key: list[str]) -> DataFrame:
    """Dataset name of catalogue rows that exactly one compatible dataset claims.

    ``queries(<key>, database_sha256, dataset)``; a blank fingerprint is a wildcard.
    """
    from lineagespark.functions.scopes import hashes_agree

    claims = queries.select(*key, F.col("database_sha256").alias("_q"), "dataset").distinct()
    joined = catalogue.join(claims, key, "left")
    name = F.when(hashes_agree("database_sha256", "_q"), F.col("dataset"))
    return joined.groupBy("id").agg(F.min(name).alias("_lo"), F.max(name).alias("_hi")).select(
        "id", F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).alias("dataset")
    )


def neighbour_agreement(first: DataFrame, second: DataFrame) -> DataFrame:
    """Shared and united neighbours of two ``(sample_id, other)`` lists, and their Jaccard."""
    a = first.select("sample_id", "other").distinct().withColumn("_a", F.lit(1))
    b = second.select("sample_id", "other").distinct().withColumn("_b", F.lit(1))
    both = a.join(b, ["sample_id", "other"], "full_outer")
    shared = F.count(F.when(F.col("_a").isNotNull() & F.col("_b").isNotNull(), 1))
    return both.groupBy("sample_id").agg(shared.alias("shared"), F.count(F.lit(1)).alias("united")).withColumn("jaccard", F.col("shared") / F.col("united"))


def neighbourhoods(snp: DataFrame, tree: DataFrame, focal: DataFrame, n: int) -> DataFrame:
    """Nearest by two metrics per focal, how many agree, and focals that lack a metric.

    ``snp`` and ``tree`` are ``(focal, context, value)``.
    """
    top = lambda df: top_with_ties(df, ["focal"], "value", n).select(F.col("focal").alias("sample_id"), F.col("context").alias("other"))
    a, b = top(snp), top(tree)
    agree = neighbour_agreement(a, b)
    count = lambda df, name: df.groupBy("sample_id").agg(F.count(F.lit(1)).alias(name))
    out = focal.select(F.col("focal").alias("sample_id")).join(agree, "sample_id", "left").join(count(a, "snp_neighbours"), "sample_id", "left").join(count(b, "tree_neighbours"), "sample_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    status = F.when(F.col("snp_neighbours").isNull() | F.col("tree_neighbours").isNull(), "missing_evidence").otherwise("available")
    return out.select("sample_id", status.alias("status"), zero("snp_neighbours"), zero("tree_neighbours"), zero("shared"))


def hash_sample(df: DataFrame, ident: str, n: int, seed: int) -> DataFrame:
    """n rows in seeded hash order: reproducible and independent of input order."""
    return df.orderBy(seeded(seed, F.col(ident)), ident).limit(n)


def reserved_background(budget: int, fraction: float) -> int:
    return min(budget, math.ceil(budget * fraction))
