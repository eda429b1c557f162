"""Row filters, eligibility gates and readiness reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineagespark import constants as C
from lineagespark.functions.dates import add_date_interval, bounds, date_is_accepted
from lineagespark.functions.text import _col, blank_to_null, clean, is_one_of


def filter_candidates(
    df: DataFrame, countries=(), year_from=None, year_to=None, host=None, isolation_source=None
) -> DataFrame:
    """Country prefixes, year range and substrings, all without case."""
    tests: list[Column] = []
    if countries:
        tests.append(reduce(lambda a, b: a | b, [F.lower(clean("country")).startswith(c.lower()) for c in countries]))
    year = F.substring(clean("collection_date"), 1, 4).try_cast("int")
    if year_from is not None:
        tests.append(year >= year_from)
    if year_to is not None:
        tests.append(year <= year_to)
    if host:
        tests.append(F.lower(clean("host")).contains(host.lower()))
    if isolation_source:
        tests.append(F.lower(clean("isolation_source")).contains(isolation_source.lower()))
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def qc_eligible(df: DataFrame) -> Column:
    """Explicit pass only, from the first QC field the table has; unknown is not a pass."""
    if "qc_pass" in df.columns:
        return F.coalesce(F.col("qc_pass"), F.lit(False))
    if "qc_passed" in df.columns:
        return F.coalesce(F.col("qc_passed"), F.lit(False))
    return is_one_of("qc_status", ["pass", "passed"])


def usable_date(column, as_of: str) -> Column:
    """An accepted plain date whose earliest possible day is not after ``as_of``.

    Forms that are not ``YYYY``, ``YYYY-MM`` or ``YYYY-MM-DD`` cannot be placed and are left out.
    """
    start = bounds(column)["start"]
    return date_is_accepted(column) & F.coalesce(start <= F.lit(as_of).cast("date"), F.lit(False))


def dated_cohorts(df: DataFrame, cohort: list[str], as_of: str, minimum: int = 3) -> DataFrame:
    """Per cohort: usable dates, distinct dates, and whether both reach the minimum."""
    dated = usable_date("collection_date", as_of)
    return df.groupBy(*cohort).agg(
        F.count(F.lit(1)).alias("members"),
        F.count_if(dated).alias("dated"),
        F.countDistinct(F.when(dated, clean("collection_date"))).alias("distinct_dates"),
    ).withColumn("sufficient", (F.col("dated") >= minimum) & (F.col("distinct_dates") >= minimum))


def future_dates(df: DataFrame, as_of: str) -> DataFrame:
    """Audit of dates after ``as_of``, with the raw value kept."""
    dated = add_date_interval(df, "_i", "collection_date", None)
    return dated.filter(F.col("_i.start") > F.lit(as_of).cast("date")).select("sample_id", "collection_date", F.lit("future_collection_date").alias("reason"))


def self_eligible(calls: DataFrame, catalogue: DataFrame, min_overlap: float) -> DataFrame:
    """Whether a profile passes its own overlap test; else a reason."""
    called = calls.groupBy("scope_id", "sample_id").agg(F.count("allele").alias("called"))
    loci = catalogue.groupBy("scope_id").agg(F.countDistinct("locus").alias("loci"))
    share = F.col("called") / F.col("loci")
    return called.join(loci, "scope_id").select(
        "scope_id", "sample_id", "called", "loci",
        F.when(F.col("called") == 0, "profile_unavailable").when(share < min_overlap, "insufficient_called_overlap").alias("reason"),
    )


def readiness(samples: DataFrame, profile_counts: DataFrame, lineage_ready: DataFrame, metadata_fields: list[str]) -> DataFrame:
    """Reasons a sample is not ready and the metadata it lacks.

    ``profile_counts(sample_id, called_loci, catalogue_complete)`` and
    ``lineage_ready(sample_id, lineage_ready)`` hold at most one row per sample.
    """
    joined = samples.join(profile_counts, "sample_id", "left").join(lineage_ready, "sample_id", "left")
    has_profile = F.coalesce(F.col("called_loci"), F.lit(0)) > 0
    has_lineage = F.coalesce(F.col("lineage_ready"), F.lit(False))
    reasons = F.array_compact(
        F.array(
            F.when(~has_profile, "cgMLST profile unavailable; no profile calling was performed"),
            F.when(F.col("catalogue_complete") == F.lit(False), "Locus catalogue is explicitly incomplete"),
            F.when(~has_lineage, "Resolved cglin assignment with a known scope is unavailable"),
        )
    )
    lacking = F.array_compact(
        F.array(
            *[F.when(blank_to_null(f).isNull(), f) for f in metadata_fields],
            F.when(F.coalesce(F.col("date_precision"), F.lit("missing")).isin("missing", "invalid"), "collection_date"),
        )
    )
    return joined.select(
        "sample_id", "role", has_profile.alias("profile_ready"), has_lineage.alias("lineage_ready"),
        reasons.alias("reasons"), lacking.alias("missing_metadata"),
        F.when(F.size(reasons) == 0, "ready").otherwise("incomplete").alias("readiness"),
    )


def lineage_is_ready(status, provisional, scope, assignment) -> Column:
    return (
        _col(status).isin("resolved", "complete")
        & ~is_one_of(provisional, ["true", "1", "yes"])
        & scope.isNotNull()
        & (clean(assignment) != "")
    )


def evidence_number(column) -> Column:
    """A finite non-negative number, else null."""
    value = _col(column).try_cast("double")
    return F.when(~F.isnan(value) & (value >= 0) & (value < float("inf")), value)
