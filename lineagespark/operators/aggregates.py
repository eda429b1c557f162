"""Counts, compositions and summaries with explicit denominators.

Grouped sums combine map-side; medians use Spark's counting percentile, whose state is the
number of distinct values (SNP counts, lengths), not the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineagespark.functions.text import blank_to_null, clean
from lineagespark.operators.joins import bin_edge, interval_segments
from lineagespark.operators.ranking import pick_reference


def assembly_statistics(lengths: DataFrame) -> DataFrame:
    """Contigs, total length and N50 per assembly from ``(assembly, length)``.

    Equal lengths are counted first, so the running sum sees distinct lengths only.
    """
    sizes = lengths.filter("length > 0").groupBy("assembly", "length").agg(F.count(F.lit(1)).alias("n"))
    longest = Window.partitionBy("assembly").orderBy(F.desc("length"))
    running = sizes.withColumn("run", F.sum(F.col("n") * F.col("length")).over(longest))
    totals = sizes.groupBy("assembly").agg(
        F.sum("n").alias("contigs"), F.sum(F.col("n") * F.col("length")).alias("total_length")
    )
    half = running.join(totals, "assembly").filter(F.col("run") * 2 >= F.col("total_length"))
    n50 = half.groupBy("assembly").agg(F.max("length").alias("n50"))
    return totals.join(n50, "assembly")


# -- cohorts ------------------------------------------------------------------------------------


def lineage_plan(samples: DataFrame, minimum: int = 3) -> DataFrame:
    """Per species and lineage: sizes, dates, places, reference and whether it can be analysed."""
    key = ["species", "lineage"]
    filled = blank_to_null("collection_date")
    counts = samples.groupBy(*key).agg(
        F.count(F.lit(1)).alias("samples"), F.countDistinct(filled).alias("distinct_dates"), F.min(filled).alias("first_date"),
        F.max(filled).alias("last_date"), F.countDistinct(blank_to_null("location")).alias("locations"),
    )
    reference = pick_reference(samples, key).select(*key, "reference")
    return counts.join(reference, key).withColumn("ready", F.col("samples") >= minimum)


def profile_coverage(rows: DataFrame, label: str, available: Column) -> DataFrame:
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias("total"), F.count_if(available).alias("profiles_available"))


def years_observed(members: DataFrame, group: str = "group_id") -> DataFrame:
    """Years seen per group from ``(group, year)`` with null for undated."""
    return members.groupBy(group).agg(
        F.countDistinct("year").alias("observed_years"), (F.max("year") - F.min("year")).alias("year_span"),
        F.count("year").alias("dated_records"), F.count(F.lit(1)).alias("total_records"),
    )


def time_place_cells(members: DataFrame, group: str = "group_id") -> DataFrame:
    """Time and place concentration per group from ``(group, place, year)``."""
    cells = members.groupBy(group, "place", "year").agg(F.count(F.lit(1)).alias("n"))
    known = F.when(F.col("place").isNotNull() & F.col("year").isNotNull(), F.col("n"))
    return cells.groupBy(group).agg(
        F.count(known).alias("cells"), F.coalesce(F.sum(known), F.lit(0)).alias("records_with_time_and_place"),
        F.sum("n").alias("total_records"), (F.max(known) / F.sum(known)).alias("largest_cell_fraction"),
    )


# -- pair summaries --------------------------------------------------------------------------------


def screen_outliers(per: DataFrame, min_robust_z: float = 10.0, min_ratio: float = 5.0) -> DataFrame:
    """Samples whose median distance is far from the cohort's, by two rules at once, from ``(sample_id, median_snps, median_proportion)``.

    With no spread a sample above the centre has infinite score; with a zero centre any
    positive median has infinite ratio.
    """
    per = per.filter("median_proportion IS NOT NULL")
    centre = per.agg(F.median("median_proportion").alias("centre"))
    spread = per.crossJoin(F.broadcast(centre)).agg(F.median(F.abs(F.col("median_proportion") - F.col("centre"))).alias("mad"))
    # One-row tables: their broadcast does not grow.
    df = per.crossJoin(F.broadcast(centre)).crossJoin(F.broadcast(spread))
    value, infinite = F.col("median_proportion"), F.lit(float("inf"))
    ratio = F.when(F.col("centre") > 0, value / F.col("centre")).when(value > 0, infinite).otherwise(1.0)
    z = F.when(F.col("mad") > 0, 0.6745 * (value - F.col("centre")) / F.col("mad")).when(value > F.col("centre"), infinite).otherwise(0.0)
    return df.select(
        "sample_id", "median_snps", "median_proportion", "centre", "mad", ratio.alias("ratio"), z.alias("robust_z"),
        ((z >= min_robust_z) & (ratio >= min_ratio)).alias("flagged"),
    )


def patient_sensitivity(samples: DataFrame, summaries: DataFrame, kept: DataFrame) -> DataFrame:
    """One row: focal distances with and without repeat isolates of a patient.

    ``summaries`` has the categories ``full`` and ``one_per_patient`` of ``alignments.focal_summaries``, ``kept`` the retained ids.
    """
    focal = samples.filter(F.lower(clean("origin")) != "context")
    keep = focal.join(kept, "sample_id", "left_semi").select("sample_id")
    coded = F.count_if(clean("patient_id") != "")
    counts = focal.agg(F.count(F.lit(1)).alias("focal_samples"), coded.alias("samples_with_patient_id"))
    counts = counts.withColumn("patient_metadata_complete", (F.col("focal_samples") > 0) & (F.col("focal_samples") == F.col("samples_with_patient_id")))
    removed = keep.agg(F.count(F.lit(1)).alias("retained"))
    of = lambda p, c: F.max(F.when(F.col("category") == p, F.col(c)))
    stats = [x for p in ("full", "one_per_patient") for x in (
        F.coalesce(of(p, "comparisons"), F.lit(0)).alias(f"{p}_pairs"), of(p, "minimum").alias(f"{p}_min"), of(p, "median").alias(f"{p}_median"), of(p, "maximum").alias(f"{p}_max"),
    )]
    return counts.crossJoin(removed).crossJoin(summaries.agg(*stats)).withColumn("excluded", F.col("focal_samples") - F.col("retained"))


# -- composition --------------------------------------------------------------------------------------


def country_composition(units: DataFrame) -> DataFrame:
    """Country shares per cohort, prefix depth and group, each group its own denominator.

    ``units(cohort, depth, group_key, status, scheme, version, source, country, raw_n)``: one
    row per deduplicated unit and depth. Units without a usable group stay, by status.
    """
    usable = (F.col("group_key") != "") & F.col("status").isin("resolved", "provisional", "complete", "partial")
    keyed = units.select(
        "cohort", "depth", F.when(usable, F.col("group_key")).otherwise("").alias("group_key"),
        F.when(usable, "lineage").otherwise("assignment_coverage").alias("category"), F.when(usable, "").otherwise(F.col("status")).alias("missing_status"),
        "scheme", "version", "source", F.coalesce(blank_to_null("country"), F.lit("Unknown")).alias("country"), "raw_n",
    )
    key = ["cohort", "depth", "group_key", "category", "missing_status", "scheme", "version", "source"]
    counts = keyed.groupBy(*key, "country").agg(F.count(F.lit(1)).alias("count"), F.sum("raw_n").alias("raw_records"))
    whole = Window.partitionBy(*key)
    total = F.sum("count").over(whole)
    unknown = F.sum(F.when(F.col("country") == "Unknown", F.col("count")).otherwise(0)).over(whole)
    return counts.select(
        *key, "country", "count", total.alias("denominator"), (total - unknown).alias("known_country"), unknown.alias("unknown_country"),
        (F.col("count") / total * 100).alias("percentage"), "raw_records",
    )


def composition_summary(composition: DataFrame) -> DataFrame:
    """Assigned, unresolved and singleton groups per cohort and depth."""
    groups = composition.groupBy("cohort", "depth", "group_key", "category", "missing_status", "scheme", "version", "source").agg(F.sum("count").alias("n"))
    lineage = F.col("category") == "lineage"
    assigned = F.coalesce(F.sum(F.when(lineage, F.col("n"))), F.lit(0))
    return groups.groupBy("cohort", "depth").agg(
        F.sum("n").alias("total_units"), assigned.alias("assigned_units"), F.count_if(lineage).alias("lineage_groups"),
        F.count_if(lineage & (F.col("n") == 1)).alias("singleton_groups"),
    )


def focused_composition(composition: DataFrame) -> DataFrame:
    """Groups at the deepest level any focal unit resolves, with counts of each cohort."""
    focal = composition.filter("cohort = 'focal_survey' AND category = 'lineage'")
    # One row: the chosen depth.
    depth = focal.agg(F.max("depth").alias("depth"))
    at = composition.join(F.broadcast(depth), "depth").filter("category = 'lineage'")
    keys = at.filter("cohort = 'focal_survey'").select("group_key").distinct()
    counts = at.join(keys, "group_key", "left_semi").groupBy("depth", "group_key").agg(
        *[F.coalesce(F.sum(F.when(F.col("cohort") == c, F.col("count"))), F.lit(0)).alias(n)
          for c, n in (("focal_survey", "focal_n"), ("selected_context", "selected_context_n"), ("public_catalogue", "public_n"))]
    )
    # Group labels number the focal groups of one report, in key order.
    label = F.concat(F.lit("Group "), F.row_number().over(Window.partitionBy("depth").orderBy("group_key")).cast("string"))
    return counts.withColumn("group_id", label)


def composition_matrix(composition: DataFrame, countries: list[str]) -> DataFrame:
    """One row per cohort, depth and group; one column per country."""
    return composition.filter("category = 'lineage'").groupBy("cohort", "depth", "group_key").pivot("country", countries).agg(F.sum("count")).na.fill(0)


def geography_counts(samples: DataFrame) -> DataFrame:
    """Counts by origin, country, region and nuts2, blanks as Unknown."""
    known = lambda c: F.coalesce(blank_to_null(c), F.lit("Unknown")).alias(c)
    return samples.groupBy(F.coalesce(blank_to_null("origin"), F.lit("context")).alias("origin"), known("country"), known("region"), known("nuts2")).agg(
        F.count(F.lit(1)).alias("count")
    )


def catalogue_completeness(records: DataFrame) -> DataFrame:
    """One row of completeness counts for a catalogue, in one scan."""
    filled = lambda c: F.count_if(clean(c) != "")
    precision = [F.count_if(F.col("date_precision") == p).alias(f"date_{p}") for p in ("day", "month", "year", "interval", "missing", "invalid")]
    return records.agg(
        F.count(F.lit(1)).alias("records"), F.count_if("qc_pass").alias("qc_pass"), F.count_if(~F.col("qc_pass")).alias("qc_fail"),
        F.count_if(F.col("qc_pass").isNull()).alias("qc_unknown"), F.count_if(~clean("country").isin("", "Unknown")).alias("known_country"),
        *precision, filled("host").alias("host"), filled("biosample").alias("biosample"),
    )


def level_counts(records: DataFrame) -> DataFrame:
    """Input and context counts of every group key that an input has, at each level.

    ``records(role, level, group_key)``.
    """
    keyed = records.filter("group_key <> ''").groupBy("level", "group_key").agg(
        F.count_if(F.col("role") == "input").alias("input_count"), F.count_if(F.col("role") == "context").alias("context_count")
    )
    return keyed.filter("input_count > 0")


def context_evidence(samples: DataFrame, manifest: DataFrame, top: int = 10) -> tuple[DataFrame, DataFrame]:
    """Origin and place counts per lineage, and each lineage's nearest context rows.

    ``manifest(species, lineage, sample_id, min_distance)``; unknown distances come last.
    """
    key = ["species", "lineage"]
    origin = F.lower(clean("origin"))
    counts = samples.groupBy(*key).agg(
        F.count_if(origin == "local").alias("local"), F.count_if(origin == "context").alias("context"),
        F.countDistinct(F.when(origin == "context", blank_to_null("country"))).alias("context_countries"),
    )
    rows = manifest.join(samples.filter(origin == "context").select(*key, "sample_id"), [*key, "sample_id"], "left_semi")
    order = Window.partitionBy(*key).orderBy(F.col("min_distance").asc_nulls_last(), "sample_id")
    return counts, rows.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= top)


def stage_funnel(records: DataFrame, gates: list[tuple[str, Column]]) -> DataFrame:
    """Records left after each gate, applied in order, and how many each gate lost. One scan."""
    passed, tests = F.lit(True), []
    for name, test in gates:
        passed = passed & F.coalesce(test, F.lit(False))
        tests.append((name, passed))
    counts = records.agg(F.count(F.lit(1)).alias("_all"), *[F.count_if(t).alias(n) for n, t in tests])
    names = ["_all", *[n for n, _ in tests]]
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(n).alias("stage"), F.col(n).alias("remaining"), (F.col(p) - F.col(n)).alias("lost"))
        for i, (p, n) in enumerate(zip(names, names[1:]), 1)
    ]
    return counts.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def mapping_coverage(cells: DataFrame) -> DataFrame:
    """Mapped loci per sample and whether all are, from cell statuses."""
    return cells.groupBy("sample_id").agg(
        F.count_if(F.col("status") == "mapped").alias("mapped_loci"), F.count(F.lit(1)).alias("total_loci"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("missing_call", "missing_sequence", "invalid_cds")],
    ).withColumn("complete", F.col("mapped_loci") == F.col("total_loci"))


def shares(rows: DataFrame, column: str, group: list[str]) -> DataFrame:
    """Counts of one column per group with the group total as denominator."""
    counts = rows.groupBy(*group, column).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("denominator", F.sum("count").over(Window.partitionBy(*group)))


# -- genome coordinates ----------------------------------------------------------------------------------


CHUNK = 100_000


def covered_islands(intervals: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Union of closed intervals as disjoint islands, cut at chunk boundaries.

    Only the longest interval of each start in a chunk matters, so a chunk sorts at most
    ``chunk`` rows however many intervals cover it.
    """
    parts = intervals.select("start", "end").distinct().withColumn(
        "chunk", F.explode(F.sequence(F.floor((F.col("start") - 1) / chunk), F.floor((F.col("end") - 1) / chunk)))
    )
    clipped = parts.select(
        "chunk", F.greatest("start", F.col("chunk") * chunk + 1).alias("start"), F.least("end", (F.col("chunk") + 1) * chunk).alias("end")
    ).groupBy("chunk", "start").agg(F.max("end").alias("end"))
    order = Window.partitionBy("chunk").orderBy("start")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = clipped.withColumn("_new", F.when(F.col("start") <= reach + 1, 0).otherwise(1)).withColumn("_island", F.sum("_new").over(order))
    return marked.groupBy("chunk", "_island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("_island")


def site_masks(alignment: DataFrame) -> DataFrame:
    """Per site: the ordered two-allele mask and the strict mask.

    ``alignment(sample_id, ord, block, bases)`` with equal blocks. Records are read in ``ord``
    order and a site is given up at its third distinct allele: an ambiguous base (N, -, X, ?)
    masks the site only when it comes earlier. Any base outside A, C, G, T is strict.
    """
    sizes = alignment.groupBy("block").agg(F.max(F.length("bases")).alias("_w"))
    previous = sizes.alias("a").join(sizes.alias("b"), F.col("b.block") < F.col("a.block"), "left").groupBy("a.block").agg(
        F.coalesce(F.sum("b._w"), F.lit(0)).alias("_offset")
    )
    bases = F.posexplode(F.regexp_extract_all(F.upper("bases"), F.lit("(.)"), 1)).alias("i", "base")
    rows = alignment.select("ord", "block", bases)
    first = rows.groupBy("block", "i", "base").agg(F.min("ord").alias("first"))
    ambiguous = F.col("base").isin("N", "-", "X", "?")
    per = first.groupBy("block", "i").agg(
        F.min(F.when(ambiguous, F.col("first"))).alias("_amb"),
        F.array_sort(F.collect_list(F.when(~ambiguous, F.col("first")))).alias("_called"),
        F.max(~F.col("base").isin("A", "C", "G", "T")).alias("strict"),
    )
    third = F.try_element_at("_called", F.lit(3))
    masked = F.col("_amb").isNotNull() & (third.isNull() | (F.col("_amb") < third))
    return per.join(previous, "block").select((F.col("_offset") + F.col("i") + 1).alias("pos"), masked.alias("masked"), "strict")


def genome_profile(intervals: DataFrame, masks: DataFrame, length: int, bins: int) -> DataFrame:
    """Per equal genome bin: imported, incomplete-only and retained sites and percentages."""
    bins = min(max(1, bins), length)
    edges = masks.sparkSession.range(bins).select(
        (F.col("id") + 1).cast("int").alias("bin"), bin_edge(F.col("id"), length, bins).alias("lo"), bin_edge(F.col("id") + 1, length, bins).alias("hi")
    )
    islands = covered_islands(intervals)
    pieces = islands.withColumn("_a", F.floor((F.col("start") - 1) * F.lit(bins) / length) - 1).withColumn("_b", F.floor((F.col("end") - 1) * F.lit(bins) / length) + 2)
    pieces = pieces.withColumn("bin", F.explode(F.sequence(F.greatest("_a", F.lit(1)).cast("int"), F.least("_b", F.lit(bins)).cast("int"))))
    overlap = F.greatest(F.lit(0), F.least("end", F.col("hi")) - F.greatest(F.col("start") - 1, F.col("lo")))
    imported = pieces.join(edges, "bin").groupBy("bin").agg(F.sum(overlap).alias("imported"))
    covered = islands.select(F.explode(F.sequence("start", "end")).alias("pos"))
    lonely = masks.filter("masked").join(covered, "pos", "left_anti")
    guess = F.floor((F.col("pos") - 1) * F.lit(bins) / length)
    place = F.when(bin_edge(guess + 1, length, bins) <= F.col("pos") - 1, guess + 2).when(bin_edge(guess, length, bins) > F.col("pos") - 1, guess).otherwise(guess + 1)
    incomplete = lonely.groupBy(place.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("incomplete"))
    zero = lambda c: F.coalesce(c, F.lit(0))
    width = F.col("hi") - F.col("lo")
    return edges.join(imported, "bin", "left").join(incomplete, "bin", "left").select(
        "bin", (F.col("lo") + 1).alias("start"), F.col("hi").alias("end"), zero("imported").alias("imported_sites"), zero("incomplete").alias("incomplete_only_sites"),
        (width - zero("imported") - zero("incomplete")).alias("retained_sites"), (100.0 * zero("imported") / width).alias("imported_percent"),
        (100.0 * zero("incomplete") / width).alias("incomplete_only_percent"),
    )


def import_summary(intervals: DataFrame, records: DataFrame) -> DataFrame:
    """One row: intervals, branches, merged sites, intervals over a record boundary, the ten longest."""
    islands = covered_islands(intervals).agg(F.coalesce(F.sum(F.col("end") - F.col("start") + 1), F.lit(0)).alias("merged_sites"))
    counts = intervals.agg(F.count(F.lit(1)).alias("intervals"), F.countDistinct("node").alias("branches"), F.max(F.col("end") - F.col("start") + 1).alias("longest"))
    touched = interval_segments(intervals, records).groupBy("start", "end").agg(F.count(F.lit(1)).alias("n"), F.max("copies").alias("copies"))
    crossing = touched.filter("n > 1").agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("boundary_crossing"))
    text = F.concat_ws(":", "node", "start", "length")
    ten = longest_intervals(intervals).agg(F.array_sort(F.collect_list(F.struct((-F.col("length")).alias("l"), "node", "start", text.alias("text")))).alias("_ten"))
    return counts.crossJoin(islands).crossJoin(crossing).crossJoin(ten.select(F.array_join("_ten.text", ",").alias("longest_ten")))


def longest_intervals(intervals: DataFrame, n: int = 10) -> DataFrame:
    return intervals.withColumn("length", F.col("end") - F.col("start") + 1).orderBy(F.desc("length"), "node", "start").limit(n)


def contig_blocks(contigs: DataFrame, size: int = 250_000, minimum: int = 1_000) -> DataFrame:
    """Bounded half-open blocks per contig; short tails are left out."""
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(size).cast("bigint"))).alias("block_start")
    blocks = contigs.filter("length > 0").select("contig", "length", start)
    end = F.least("length", F.col("block_start") + size)
    return blocks.select("contig", "block_start", end.alias("block_end")).filter(F.col("block_end") - F.col("block_start") >= minimum)


def significant_blocks(profile: DataFrame, threshold: float = 0.01) -> DataFrame:
    """Blocks with a valid p-value below the threshold, their smallest p and number of hits."""
    return profile.filter((F.col("p_value") >= 0) & (F.col("p_value") < threshold)).groupBy("block").agg(
        F.min("p_value").alias("min_p_value"), F.count(F.lit(1)).alias("positions")
    )


def node_date_widths(nodes: DataFrame) -> DataFrame:
    """Root and spread of internal node-date intervals per tree.

    ``nodes(tree_id, ord, node, numeric_date, lower_bound, upper_bound)``. The root is the
    first internal node of the file; the median is the upper middle one.
    """
    internal = nodes.filter(F.col("node").startswith("NODE_")).withColumn("width", F.col("upper_bound") - F.col("lower_bound"))
    return internal.groupBy("tree_id").agg(
        F.min(F.struct("ord", "node", "numeric_date")).alias("r"), F.count(F.lit(1)).alias("internal_nodes"),
        F.expr("percentile_disc(0.5) WITHIN GROUP (ORDER BY width DESC)").alias("median_width"), F.max("width").alias("max_width"),
    ).select("tree_id", F.col("r.node").alias("root_node"), F.col("r.numeric_date").alias("root_date"), "internal_nodes", "median_width", "max_width")
