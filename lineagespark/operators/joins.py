"""Identity, typing and coordinate joins that keep conflicts visible.

Groups are judged by partial aggregates (count, min, max), never by collecting their rows, so a
record or accession shared by a third of all rows still combines map-side.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.lineage import normalise_assignment, parse_code
from lineagespark.functions.scopes import hashes_agree
from lineagespark.functions.text import blank_to_null, clean


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


# -- identity ---------------------------------------------------------------------------


def join_accessions(requests: DataFrame, aliases: DataFrame) -> DataFrame:
    """Each requested ``accession`` with its number of records and, when exactly one, the id.

    ``aliases(source_genome_id, value)`` may repeat rows.
    """
    found = requests.join(aliases, F.col("accession") == F.col("value"), "left")
    lo, hi = F.min("source_genome_id"), F.max("source_genome_id")
    return found.groupBy("accession").agg(
        F.countDistinct("source_genome_id").alias("matches"), F.when(lo == hi, lo).alias("source_genome_id")
    ).withColumn("status", F.when(F.col("matches") == 1, "matched").when(F.col("matches") == 0, "missing").otherwise("ambiguous"))


def apply_overrides(rows: DataFrame, overrides: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Overridden rows and the audit of replaced non-empty values.

    ``overrides(sample_id, <fields>)`` holds one row per sample. A new collection date drops
    the old date precision.
    """
    renamed = overrides.select("sample_id", F.lit(True).alias("_has"), *[blank_to_null(f).alias(f"_new_{f}") for f in fields])
    joined = rows.join(renamed, "sample_id", "left")
    old_new = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("source_value"), F.col(f"_new_{f}").alias("manual_value")) for f in fields]))
    audit = (
        joined.filter("_has").select("sample_id", old_new.alias("x")).select("sample_id", "x.*")
        .filter((clean("source_value") != "") & F.col("manual_value").isNotNull() & (F.col("source_value") != F.col("manual_value")))
    )
    updated = joined
    if "collection_date" in fields:
        for column in ("date_precision", "date_start", "date_end"):
            if column in rows.columns:
                updated = updated.withColumn(column, F.when(F.col("_new_collection_date").isNull(), F.col(column)))
    for f in fields:
        updated = updated.withColumn(f, F.coalesce(f"_new_{f}", f))
    result = updated.withColumn("manual_metadata_override", F.coalesce("_has", F.lit(False))).select(*rows.columns, "manual_metadata_override")
    return result, audit


def exclude_known(context: DataFrame, context_aliases: DataFrame, input_aliases: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Context that shares no alias with an input, and the excluded rest with its reason."""
    known = context_aliases.join(input_aliases.select("alias").distinct(), "alias", "left_semi").select(key).distinct()
    kept = context.join(known, key, "left_anti")
    excluded = context.join(known, key, "left_semi").withColumn("reason", F.lit("already_present_exact_identity"))
    return kept, excluded


# -- lineage and typing annotation ---------------------------------------------------------


def lineage_signature() -> Column:
    """Text that differs whenever two assignments differ."""
    code = F.concat_ws("_", F.col("cglin_prefix").cast("array<string>"))
    return F.concat_ws("|", code, "cglin_code_status", "cgst", F.col("cglin_provisional").cast("string"), "cglin_scheme", "cglin_scheme_version")


def annotate_lineage(units: DataFrame, unit_ids: DataFrame, assignments: DataFrame, unit: str = "unit", depths=C.LIN_DEPTHS) -> DataFrame:
    """Left join units to lineage assignments through every source id of the unit.

    ``unit_ids(unit, source_genome_id)``. Rows whose signatures disagree leave the unit in
    conflict with no group key; agreeing repeats count but change nothing.
    """
    kept = ["cglin_status", "cglin_code_status", "cglin_resolved_depth", "cglin_scheme", "cglin_scheme_version"]
    kept += [f"cglin_{part}_{d}" for d in depths for part in ("group", "status")]
    rows = normalise_assignment(assignments, depths=depths).withColumn("_signature", lineage_signature())
    merged = unit_ids.join(rows, "source_genome_id").groupBy(unit).agg(
        F.count(F.lit(1)).alias("export_records"),
        F.min("_signature").alias("_lo"),
        F.max("_signature").alias("_hi"),
        F.min(F.struct("_signature", *kept)).alias("_first"),
    )
    joined = units.join(merged, unit, "left")
    matched, conflict = F.col("_first").isNotNull(), F.coalesce(F.col("_lo") != F.col("_hi"), F.lit(False))
    defaults = {"cglin_status": "missing", "cglin_code_status": "missing", "cglin_resolved_depth": 0,
                "cglin_scheme": C.LIN_SCHEME, "cglin_scheme_version": "unknown"}

    def value(name):
        if name in ("cglin_scheme", "cglin_scheme_version"):
            return F.when(matched, F.col(f"_first.{name}")).otherwise(F.lit(defaults[name]))
        cleared = 0 if name == "cglin_resolved_depth" else "" if "_group_" in name else "conflict"
        absent = "" if "_group_" in name else defaults.get(name, "missing")
        return F.when(conflict, F.lit(cleared)).when(matched, F.col(f"_first.{name}")).otherwise(F.lit(absent))

    return joined.select(
        *units.columns, F.coalesce("export_records", F.lit(0)).alias("export_records"), *[value(n).alias(n) for n in kept]
    )


def replace_lineage(units: DataFrame, unit_ids: DataFrame, frozen: DataFrame, unit: str = "unit") -> DataFrame:
    """A frozen export as the only lineage namespace; earlier codes never leak into the gaps."""
    bare = units.select(*[c for c in units.columns if not c.startswith("cglin_") and c != "cgst"])
    out = annotate_lineage(bare, unit_ids, frozen, unit)
    return out.withColumn("cglin_scope_source", F.lit("user_frozen_export")).withColumn(
        "cglin_database_version_status",
        F.when(F.col("cglin_scheme_version") == "unknown", "unavailable").otherwise("user_declared"),
    )


def annotate_typing(units: DataFrame, unit_ids: DataFrame, assignments: DataFrame, own: DataFrame, unit: str = "unit") -> DataFrame:
    """One row per unit and typing kind found in the export, with its value or a conflict.

    ``assignments(source_genome_id, kind, signature, value, status)``; ``own(unit, kind,
    signature, value, status)`` are values the units already hold, compared but never a source.
    """
    imported = unit_ids.join(assignments, "source_genome_id").select(unit, "kind", "signature", "value", "status", F.lit(1).alias("_imported"))
    both = imported.unionByName(own.select(unit, "kind", "signature", "value", "status", F.lit(0).alias("_imported")))
    merged = both.groupBy(unit, "kind").agg(
        F.sum("_imported").alias("records"),
        F.min("signature").alias("_lo"),
        F.max("signature").alias("_hi"),
        F.max(F.when(F.col("status") == "conflict", 1).otherwise(0)).alias("_flagged"),
        F.min(F.when(F.col("_imported") == 1, F.struct("signature", "value", "status"))).alias("_first"),
    ).filter("records > 0")
    conflict = (F.col("_lo") != F.col("_hi")) | (F.col("_flagged") == 1)
    return merged.join(units.select(unit), unit, "left_semi").select(
        unit, "kind", "records",
        F.when(conflict, "conflict").otherwise(F.col("_first.status")).alias("status"),
        F.when(~conflict, F.col("_first.value")).alias("value"),
    )


def resolve_focal(
    focal: DataFrame, focal_accessions: DataFrame, catalogue: DataFrame, catalogue_accessions: DataFrame, crosswalk: DataFrame
) -> DataFrame:
    """Resolve focal samples to catalogue ids and audit how.

    ``focal(sample_id, direct_id, own_raw, own_scheme, own_version, own_has_provenance)``,
    ``catalogue(source_genome_id, cglin_raw, cglin_scheme, cglin_scheme_version)`` with unique
    ids, ``*_accessions(id, accession)``, ``crosswalk(sample_id, source_genome_id)``. Explicit links win over accessions; a direct id
    joins either. Set comparisons are counts of flagged candidates.
    """
    explicit = crosswalk.select("sample_id", "source_genome_id").distinct().withColumn("kind", F.lit("explicit"))
    by_accession = (
        focal_accessions.join(catalogue_accessions, "accession").select("sample_id", "source_genome_id").distinct()
        .withColumn("kind", F.lit("accession"))
    )
    direct = focal.filter(clean("direct_id") != "").select("sample_id", F.col("direct_id").alias("source_genome_id"), F.lit("direct").alias("kind"))
    flag = lambda k: F.max(F.when(F.col("kind") == k, 1).otherwise(0))
    candidates = union_all(explicit, by_accession, direct).groupBy("sample_id", "source_genome_id").agg(
        flag("explicit").alias("e"), flag("accession").alias("a"), flag("direct").alias("d")
    )
    known = candidates.join(catalogue.select("source_genome_id", F.lit(1).alias("known")), "source_genome_id", "left")
    by_link = (F.col("e") == 1) | (F.col("d") == 1)
    by_acc = (F.col("a") == 1) | (F.col("d") == 1)
    ident = F.col("source_genome_id")
    sums = known.groupBy("sample_id").agg(
        F.sum("e").alias("n_e"), F.sum("a").alias("n_a"), F.sum("d").alias("n_d"),
        F.sum(F.when(F.col("e") != F.col("a"), 1).otherwise(0)).alias("n_ea_differ"),
        F.sum(F.when((F.col("d") == 1) & (F.col("a") == 0), 1).otherwise(0)).alias("n_d_not_a"),
        F.count(F.when(by_link, 1)).alias("n_link"), F.count(F.when(by_acc, 1)).alias("n_acc"),
        F.min(F.when(by_link, ident)).alias("id_link"), F.min(F.when(by_acc, ident)).alias("id_acc"),
        F.count(F.when(by_link & F.col("known").isNull(), 1)).alias("unknown_link"),
        F.count(F.when(by_acc & F.col("known").isNull(), 1)).alias("unknown_acc"),
    )
    linked = F.col("n_e") > 0
    n = F.coalesce(F.when(linked, F.col("n_link")).otherwise(F.col("n_acc")), F.lit(0))
    unknown = F.when(linked, F.col("unknown_link")).otherwise(F.col("unknown_acc"))
    clash = (linked & (F.col("n_a") > 0) & (F.col("n_ea_differ") > 0)) | ((F.col("n_a") > 0) & (F.col("n_d_not_a") > 0))
    status = (
        F.when(F.coalesce(clash, F.lit(False)), "conflict").when(n == 0, "missing").when(n > 1, "ambiguous")
        .when(unknown > 0, "unavailable").otherwise("matched")
    )
    joined = focal.join(sums, "sample_id", "left").withColumn("_status", status).withColumn("candidates", n)
    joined = joined.withColumn("_match", F.when(F.col("_status") == "matched", F.when(linked, F.col("id_link")).otherwise(F.col("id_acc"))))
    target = catalogue.select(
        F.col("source_genome_id").alias("_match"), parse_code("cglin_raw")["prefix"].alias("_theirs"),
        F.col("cglin_scheme").alias("_scheme"), F.col("cglin_scheme_version").alias("_version"),
    )
    joined = joined.join(target, "_match", "left").withColumn("_own", parse_code("own_raw"))
    own_valid = F.col("_own.status").isin("complete", "partial") & F.col("own_has_provenance") & (F.col("own_scheme") == C.LIN_SCHEME)
    overlap = F.least(F.size("_own.prefix"), F.size("_theirs"))
    head = lambda c: F.when(overlap > 0, F.slice(c, 1, overlap)).otherwise(F.array().cast("array<bigint>"))
    differs = (
        (F.col("own_scheme") != F.col("_scheme")) | (F.col("own_version") != F.col("_version"))
        | (head(F.col("_own.prefix")) != head(F.col("_theirs")))
    )
    final = F.when((F.col("_status") == "matched") & own_valid & differs, "conflict").otherwise(F.col("_status"))
    return joined.select(
        "sample_id", final.alias("status"), "candidates",
        F.when(final == "matched", F.col("_match")).otherwise("").alias("matched_source_genome_id"),
        own_valid.alias("retained_focal_assignment"),
    )


def copy_matched_typing(resolved: DataFrame, typing: DataFrame, own: DataFrame) -> DataFrame:
    """Typing of focal samples, only through an identity that is already matched.

    ``resolved(sample_id, matched_source_genome_id)``, ``typing`` as in :func:`annotate_typing`.
    """
    matched = resolved.filter(clean("matched_source_genome_id") != "")
    ids = matched.select("sample_id", F.col("matched_source_genome_id").alias("source_genome_id"))
    return annotate_typing(resolved.select("sample_id"), ids, typing.filter("kind <> 'cglin'"), own.filter("kind <> 'cglin'"), "sample_id")


def match_lineage_groups(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates in the lineage group of some query with compatible fingerprints.

    Both sides hold ``(id, group_key, database_sha256)``. Queries shrink to their distinct
    (key, fingerprint) first. Equality covers equal fingerprints; a blank on either side is a
    wildcard, so the rest are two more equi-joins and no theta join is needed.
    """
    wanted = queries.filter("group_key <> ''").select("group_key", F.lower(clean("database_sha256")).alias("_h")).distinct()
    keyed = candidates.filter("group_key <> ''").withColumn("_h", F.lower(clean("database_sha256")))
    any_hash = wanted.select("group_key").distinct()
    open_key = wanted.filter("_h = ''").select("group_key").distinct()
    blank = keyed.filter("_h = ''").join(any_hash, "group_key", "left_semi")
    filled = keyed.filter("_h <> ''")
    free = filled.join(open_key, "group_key", "left_semi")
    exact = filled.join(open_key, "group_key", "left_anti").join(wanted, ["group_key", "_h"], "left_semi")
    return blank.unionByName(free).unionByName(exact).drop("_h")


def level_match_counts(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Candidates matched at each lineage level; both sides ``(id, depth, group_key)``."""
    keys = queries.filter("group_key <> ''").select("depth", "group_key").distinct()
    return candidates.join(keys, ["depth", "group_key"], "left_semi").groupBy("depth").agg(F.count(F.lit(1)).alias("matched"))


# -- coordinates ---------------------------------------------------------------------------


def record_bounds(lengths: DataFrame, width_of_chunk: int = 1 << 20) -> DataFrame:
    """``(ord, name, length)`` to closed cumulative bounds.

    Offsets are summed per chunk of the order first, so no single task walks all records.
    """
    from pyspark.sql import Window

    chunked = lengths.withColumn("_chunk", F.floor(F.col("ord") / width_of_chunk))
    totals = chunked.groupBy("_chunk").agg(F.sum("length").alias("_total"))
    before = totals.alias("a").join(totals.alias("b"), F.col("b._chunk") < F.col("a._chunk"), "left").groupBy("a._chunk").agg(
        F.coalesce(F.sum("b._total"), F.lit(0)).alias("_offset")
    )
    running = F.sum("length").over(Window.partitionBy("_chunk").orderBy("ord"))
    return chunked.join(before, "_chunk").withColumn("end", F.col("_offset") + running).select(
        "name", (F.col("end") - F.col("length") + 1).alias("start"), "end"
    )


def _nested_bins(rows: DataFrame, start: str, end: str, others: DataFrame) -> DataFrame:
    """Rows in the bins of their own level and of the coarser levels in ``others(_level)``."""
    coarser = F.broadcast(others.agg(F.collect_set("_level").alias("_others")))  # one row, at most 64 numbers
    levels = F.array_union(F.array("_level"), F.filter("_others", lambda x: x > F.col("_level")))
    at = rows.crossJoin(coarser).withColumn("_at", F.explode(levels)).drop("_others")
    return at.withColumn("_bin", F.explode(F.expr(f"sequence(shiftright({start} - 1, _at), shiftright({end} - 1, _at))")))


def interval_segments(intervals: DataFrame, records: DataFrame) -> DataFrame:
    """Local coordinates of each interval on each record it touches.

    Range join as an equi-join on nested bins: an interval belongs to bins of the smallest power of
    two above its length, at most two of them. A pair meets at the coarser level of the two, in the
    bin where its overlap starts, so nothing repeats. Equal intervals are joined once; intervals that
    end before they start touch nothing.
    """
    def sized(rows, start, end):
        return rows.filter(F.col(start) <= F.col(end)).withColumn("_level", F.length(F.bin(F.col(end) - F.col(start))))

    spans = sized(intervals.groupBy(F.col("start").cast("bigint").alias("start"), F.col("end").cast("bigint").alias("end")).agg(F.count(F.lit(1)).alias("copies")), "start", "end")
    targets = sized(records.select("name", F.col("start").cast("bigint").alias("_rs"), F.col("end").cast("bigint").alias("_re")), "_rs", "_re")
    left = _nested_bins(spans, "start", "end", targets)
    right = _nested_bins(targets, "_rs", "_re", spans).withColumnRenamed("_level", "_other")
    low, high = F.greatest("start", "_rs"), F.least("end", "_re")
    joined = left.join(right, ["_at", "_bin"]).withColumn("_low", low).filter(
        (F.col("_low") <= high) & (F.col("_at") == F.greatest("_level", "_other")) & (F.expr("shiftright(_low - 1, _at)") == F.col("_bin"))
    )
    return joined.select("start", "end", "copies", "name", (F.col("_low") - F.col("_rs") + 1).alias("local_start"), (high - F.col("_rs") + 1).alias("local_end"))


def annotate_intervals(intervals: DataFrame, records: DataFrame) -> DataFrame:
    """Intervals with the number of records they touch and whether they cross a boundary."""
    touched = interval_segments(intervals, records).groupBy("start", "end").agg(F.count(F.lit(1)).alias("segments"))
    return intervals.join(touched, ["start", "end"], "left").select(
        "node", "start", "end", (F.col("end") - F.col("start") + 1).alias("length"),
        F.coalesce("segments", F.lit(0)).alias("segments"), (F.coalesce("segments", F.lit(0)) > 1).alias("crosses_boundary"),
    )


def bin_edge(index: Column, length, bins: Column | int) -> Column:
    """Left edge (0-based) of equal bins: whole part of index * length / bins."""
    return F.floor(index * length / bins).cast("bigint")


def branches_per_bin(intervals: DataFrame, length: int, bins: int) -> DataFrame:
    """Distinct branches whose interval touches each of ``bins`` equal genome bins (1-based)."""
    bins = min(max(1, bins), length)

    def of(position):
        guess = F.least(F.floor(position * F.lit(bins) / length), F.lit(bins - 1))
        up = F.when((guess + 1 < bins) & (bin_edge(guess + 1, length, bins) <= position), guess + 1)
        down = F.when(bin_edge(guess, length, bins) > position, guess - 1)
        return F.coalesce(up, down, guess).cast("int")

    spans = intervals.select("node", of(F.col("start") - 1).alias("_a"), of(F.col("end") - 1).alias("_b")).distinct()
    hits = spans.select("node", F.explode(F.sequence("_a", "_b")).alias("_bin"))
    return hits.groupBy((F.col("_bin") + 1).alias("bin")).agg(F.countDistinct("node").alias("branches"))


# -- metadata and integrity -------------------------------------------------------------------


def fill_from_linked(samples: DataFrame, links: DataFrame, linked: DataFrame, fields: list[str]) -> tuple[DataFrame, DataFrame]:
    """Fill missing fields from linked records only when all of them agree.

    ``links(sample_id, accession)``, ``linked(accession, <fields>)``. The second result lists
    (sample_id, field, values, value, action) with action filled, conflict or kept.
    """
    values = links.join(linked, "accession").unpivot("sample_id", fields, "field", "value").filter(clean("value") != "")
    merged = values.groupBy("sample_id", "field").agg(
        F.countDistinct("value").alias("values"), F.min("value").alias("value")
    )
    own = samples.select("sample_id", *[F.col(f).cast("string").alias(f) for f in fields]).unpivot("sample_id", fields, "field", "own")
    judged = merged.join(own, ["sample_id", "field"])
    lacking = (clean("own") == "") | (clean("own") == "Unknown")
    action = (
        F.when(F.col("values") > 1, "conflict").when(lacking, "filled")
        .when(F.col("own") != F.col("value"), "conflict").otherwise("kept")
    )
    audit = judged.withColumn("action", action)
    pick = lambda f: F.max(F.when((F.col("field") == f) & (F.col("action") == "filled"), F.col("value")))
    filled = audit.groupBy("sample_id").agg(*[pick(f).alias(f"_{f}") for f in fields])
    out = samples.join(filled, "sample_id", "left")
    for f in fields:
        out = out.withColumn(f, F.coalesce(f"_{f}", f)).drop(f"_{f}")
    return out.select(*samples.columns), audit.select("sample_id", "field", "values", "value", "action")


def mapping_problems(mapping: DataFrame, calls: DataFrame, records: DataFrame, loci: DataFrame) -> DataFrame:
    """Violations of a (sample_id, locus, record_id) mapping, one row per problem.

    ``calls(sample_id, locus, allele)``, ``records(record_id, protein_id)``, ``loci(locus)``.
    """
    cell = ["sample_id", "locus"]
    row = lambda df, reason, detail: df.select("sample_id", "locus", F.lit(reason).alias("reason"), detail.alias("detail"))
    unknown_sample = mapping.join(calls.select("sample_id").distinct(), "sample_id", "left_anti")
    unknown_locus = mapping.join(loci, "locus", "left_anti")
    unknown_record = mapping.join(records, "record_id", "left_anti")
    repeated = mapping.groupBy(*cell).count().filter("count > 1")
    called = mapping.join(calls, cell)
    uncalled = called.filter("allele IS NULL")
    proteins = called.filter("allele IS NOT NULL").join(records, "record_id").groupBy("locus", "allele").agg(
        F.min("protein_id").alias("lo"), F.max("protein_id").alias("hi")
    ).filter("lo <> hi")
    return union_all(
        row(unknown_sample, "unknown_sample", F.col("record_id")),
        row(unknown_locus, "unknown_locus", F.col("record_id")),
        row(unknown_record, "unknown_record", F.col("record_id")),
        row(repeated, "duplicate_cell", F.col("count").cast("string")),
        row(uncalled, "uncalled_cell", F.col("record_id")),
        row(proteins.withColumn("sample_id", F.lit("")), "inconsistent_protein", F.col("allele")),
    )


def map_alleles(calls: DataFrame, catalogue: DataFrame, translate) -> DataFrame:
    """Status of every sample/locus cell against an allele-to-DNA catalogue.

    Each distinct (locus, allele) is looked up and translated once.
    """
    alleles = calls.filter("allele IS NOT NULL").select("locus", "allele").distinct()
    looked = alleles.join(catalogue, ["locus", "allele"], "left").withColumn("_t", translate("dna"))
    status = F.when(F.col("dna").isNull(), "missing_sequence").when(F.col("_t.reason").isNotNull(), "invalid_cds").otherwise("mapped")
    record = looked.select(
        "locus", "allele", status.alias("_status"),
        F.when(F.col("dna").isNull(), "allele_not_in_frozen_catalogue").otherwise(F.col("_t.reason")).alias("_reason"),
        F.when(status == "mapped", F.sha2("_t.protein", 256)).alias("protein_id"),
    )
    return calls.join(record, ["locus", "allele"], "left").select(
        "sample_id", "locus", "allele",
        F.when(F.col("allele").isNull(), "missing_call").otherwise(F.col("_status")).alias("status"),
        F.when(F.col("allele").isNull(), "no_allele_call").otherwise(F.col("_reason")).alias("reason"), "protein_id",
    )


def selection_problems(decisions: DataFrame, pool: DataFrame, inputs: DataFrame) -> DataFrame:
    """Violations of saved selections: ``decisions(selection_id, sample_id, ord, reason, mandatory)``.

    Order must run from one without gaps; mandatory members must be in every selection.
    """
    row = lambda df, reason, sample="sample_id": df.select("selection_id", F.col(sample).alias("sample_id"), F.lit(reason).alias("problem"))
    outside = decisions.join(pool, "sample_id", "left_anti")
    is_input = decisions.join(inputs, "sample_id", "left_semi")
    repeated = decisions.groupBy("selection_id", "sample_id").count().filter("count > 1")
    unexplained = decisions.filter(clean("reason") == "")
    order = decisions.groupBy("selection_id").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("ord").alias("d"), F.min("ord").alias("lo"), F.max("ord").alias("hi")
    ).filter("lo <> 1 OR hi <> n OR d <> n").withColumn("sample_id", F.lit(""))
    selections = decisions.select("selection_id").distinct().agg(F.count(F.lit(1)).alias("total"))
    partial = decisions.filter("mandatory").groupBy("sample_id").agg(F.countDistinct("selection_id").alias("n")).join(
        F.broadcast(selections), F.col("n") < F.col("total")
    ).withColumn("selection_id", F.lit(""))
    return union_all(
        row(outside, "outside_pool"), row(is_input, "input_listed_as_context"), row(repeated, "repeated_member"),
        row(unexplained, "no_reason"), row(order, "broken_order"), row(partial, "mandatory_not_in_every_selection"),
    )


def match_tips(tips: DataFrame, metadata: DataFrame) -> DataFrame:
    """Full outer status of tree tips against metadata.

    ``tips(sample_id, state)``, ``metadata(sample_id, observed)``.
    """
    from lineagespark.functions.geo import known_state

    joined = tips.withColumn("_t", F.lit(1)).join(metadata.withColumn("_m", F.lit(1)), "sample_id", "full_outer")
    status = (
        F.when(F.col("_t").isNull(), "Absent from reconstruction tree")
        .when(F.col("_m").isNull(), "No exact metadata match")
        .when(~known_state("observed"), "Missing observed location")
        .when(F.col("state") != F.col("observed"), "disagrees")
        .otherwise("matched")
    )
    return joined.select("sample_id", status.alias("status"))


def nearest_place_connections(nearest: DataFrame, places: DataFrame) -> DataFrame:
    """Query place to context place with distinct members and the range of differences.

    ``nearest(query_id, context_id, allele_differences, shared_called_loci)``,
    ``places(sample_id, place)`` with null for unknown.
    """
    once = nearest.groupBy("query_id", "context_id").agg(
        F.min("allele_differences").alias("d"), F.min("shared_called_loci").alias("s")
    )
    q = places.select(F.col("sample_id").alias("query_id"), F.coalesce("place", F.lit("Unknown")).alias("source"))
    c = places.select(F.col("sample_id").alias("context_id"), F.coalesce("place", F.lit("Unknown")).alias("target"))
    return once.join(q, "query_id").join(c, "context_id", "left").withColumn("target", F.coalesce("target", F.lit("Unknown"))).groupBy("source", "target").agg(
        F.countDistinct("query_id").alias("query_count"), F.countDistinct("context_id").alias("context_count"),
        F.count(F.lit(1)).alias("comparison_count"), F.min("d").alias("min_differences"), F.max("d").alias("max_differences"),
        F.min("s").alias("min_shared"), F.max("s").alias("max_shared"),
    )


def match_catalogues(records: DataFrame, catalogues: DataFrame) -> DataFrame:
    """Each profile record with its one compatible catalogue, or the reason there is none.

    ``records(sample_id, scheme, version, database_version, database_sha256, has_profile)``,
    ``catalogues(catalogue_id, scheme, version, database_version, database_sha256)``.
    Fingerprints must be equal with null equal to null; database versions only if both exist.
    """
    digest = lambda c: F.lower(blank_to_null(c))
    left = records.withColumn("_h", F.coalesce(digest("database_sha256"), F.lit("")))
    right = catalogues.select(
        "catalogue_id", "scheme", "version", F.coalesce(digest("database_sha256"), F.lit("")).alias("_h"),
        F.col("database_version").alias("_v"),
    )
    joined = left.join(right, ["scheme", "version", "_h"], "left")
    fits = F.col("_v").isNull() | F.col("database_version").isNull() | (F.col("_v") == F.col("database_version"))
    chosen = F.when(fits, F.col("catalogue_id"))
    return joined.groupBy("sample_id").agg(
        F.count(chosen).alias("catalogues"), F.min(chosen).alias("catalogue_id"), F.max("has_profile").alias("has_profile")
    ).select(
        "sample_id", "catalogues", F.when(F.col("catalogues") == 1, F.col("catalogue_id")).alias("catalogue_id"),
        F.when(F.col("catalogues") == 1, "matched").when(F.col("catalogues") > 1, "multiple_catalogues")
        .when(F.col("has_profile"), "no_compatible_catalogue").otherwise("no_profile").alias("status"),
    )


def reconcile_batches(requested: DataFrame, returned: DataFrame) -> DataFrame:
    """Requested against returned ids per batch: returned, missing, duplicate, unrequested."""
    back = returned.groupBy("batch", "source_genome_id").agg(F.count(F.lit(1)).alias("copies"))
    asked = requested.select("batch", "source_genome_id").distinct().withColumn("_asked", F.lit(1))
    joined = asked.join(back, ["batch", "source_genome_id"], "full_outer")
    status = (
        F.when(F.col("_asked").isNull(), "unrequested").when(F.col("copies").isNull(), "missing")
        .when(F.col("copies") > 1, "duplicate").otherwise("returned")
    )
    return joined.select("batch", "source_genome_id", F.coalesce("copies", F.lit(0)).alias("copies"), status.alias("status"))


def verify_records(claimed: DataFrame, recorded: DataFrame, key: str, species_prefix: str) -> DataFrame:
    """Field-by-field check of claimed rows against linked records: pass, review or fail."""
    joined = claimed.join(recorded.select(key, *[F.col(c).alias(f"_{c}") for c in ("organism", "strain", "collection_date", "country")]), key)
    plain = lambda c: F.regexp_replace(F.lower(clean(c)), "[^a-z0-9]", "")
    check = lambda ok: F.when(F.coalesce(ok, F.lit(False)), "pass").otherwise("review")
    return joined.select(
        key,
        F.when(F.col("_organism").startswith(species_prefix), "pass").otherwise("fail").alias("species_check"),
        check(plain("strain") == plain("_strain")).alias("strain_name_check"),
        check(F.nullif(F.regexp_extract(clean("_collection_date"), r"((?:19|20)\d{2})", 1), F.lit("")) == clean("year")).alias("year_check"),
        check(F.lower(F.trim(F.substring_index(clean("_country"), ":", 1))) == F.lower(clean("country"))).alias("country_check"),
    )
