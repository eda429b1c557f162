"""Regressions, permutation gates and the evidence rules."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lineagespark.functions.text import clean
from lineagespark.session import durable


# -- date and distance ---------------------------------------------------------------------------


def date_regression(points: DataFrame, cohort: list[str], x: str = "midpoint_year", y: str = "distance") -> DataFrame:
    """Least squares of distance on date midpoint per cohort, from ``(cohort, x, y)``.

    Points with a null date or a distance that is not finite are left out and counted. Three
    points with three distinct dates are required. A constant distance has slope zero and no
    correlation. One pass of partial aggregates.
    """
    usable = F.col(x).isNotNull() & F.col(y).isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf"))
    px, py = F.when(usable, F.col(x)), F.when(usable, F.col(y))
    stats = points.groupBy(*cohort).agg(
        F.count(px).alias("n_points"), F.countDistinct(px).alias("n_distinct_dates"), F.count_if(~usable).alias("excluded"),
        F.regr_slope(py, px).alias("_slope"), F.avg(px).alias("reference_year"), F.avg(py).alias("centered_intercept"),
        # The guarded R² never divides by a zero variance, which ANSI mode would raise on.
        (F.signum(F.regr_slope(py, px)) * F.sqrt(F.regr_r2(py, px))).alias("_r"),
        (F.min(py) == F.max(py)).alias("_flat"),
    )
    fitted = (F.col("n_points") >= 3) & (F.col("n_distinct_dates") >= 3)
    slope = F.when(F.col("_flat"), 0.0).otherwise(F.col("_slope"))
    r = F.when(~F.col("_flat"), F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("_r"))))
    out = stats.select(
        *cohort, F.when(fitted, "fitted").otherwise("insufficient_data").alias("status"),
        F.when(~fitted, "fewer_than_three_distinct_dated_points").alias("reason"), "n_points", "n_distinct_dates", "excluded",
        F.when(fitted, slope).alias("slope"), F.when(fitted, F.col("centered_intercept") - slope * F.col("reference_year")).alias("intercept"),
        F.when(fitted, F.col("centered_intercept")).alias("centered_intercept"), F.when(fitted, F.col("reference_year")).alias("reference_year"),
        F.when(fitted, r).alias("pearson_r"), F.when(fitted, r * r).alias("r_squared"),
    )
    return out


def regression_residuals(points: DataFrame, fits: DataFrame, cohort: list[str], x: str = "midpoint_year", y: str = "distance") -> DataFrame:
    """Predicted value and residual of every dated point of a fitted cohort."""
    df = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).join(fits.filter("status = 'fitted'").select(*cohort, "slope", "centered_intercept", "reference_year"), cohort)
    predicted = F.col("centered_intercept") + F.col("slope") * (F.col(x) - F.col("reference_year"))
    return df.select(*points.columns, predicted.alias("predicted"), (F.col(y) - predicted).alias("residual"))


def in_allele_units(fits: DataFrame, loci) -> DataFrame:
    """A fraction regression in allele units: a change of scale, with the fraction slope kept."""
    loci = F.col(loci) if isinstance(loci, str) else F.lit(loci)
    out = fits.withColumn("fraction_slope", F.col("slope")).withColumn("normalization_loci", loci)
    for c in ("slope", "intercept", "centered_intercept"):
        out = out.withColumn(c, F.col(c) * loci)
    return out


def root_to_tip(depths: DataFrame, samples: DataFrame, panels: DataFrame, cohort: list[str]) -> DataFrame:
    """Root-to-tip regressions per cohort with the reasons a cohort has none.

    ``depths(sample_id, depth)`` from a supplied rooted tree, ``samples(sample_id, <cohort>,
    midpoint_year)``, ``panels(<cohort>, callable_loci)``.
    """
    joined = samples.join(depths, "sample_id", "left")
    sizes = joined.groupBy(*cohort).agg(F.count(F.lit(1)).alias("profiles"), F.count("depth").alias("in_tree"))
    fits = date_regression(joined.withColumnRenamed("depth", "distance"), cohort)
    df = sizes.join(panels, cohort, "left").join(fits.withColumnRenamed("status", "_fit").drop("reason"), cohort)
    loci = F.coalesce("callable_loci", F.lit(0))
    reason = (
        F.when(F.col("profiles") < 2, "fewer_than_two_profiles").when(loci == 0, "no_common_callable_loci").when(F.col("in_tree") < F.col("profiles"), "tree_lacks_samples")
        .when(F.col("_fit") != "fitted", "fewer_than_three_distinct_dated_points")
    )
    return df.select(
        *cohort, "profiles", loci.alias("callable_loci"), F.when(reason.isNull(), "available").otherwise("unavailable").alias("status"), reason.alias("reason"),
        F.when(reason.isNull(), F.col("slope")).alias("slope"), F.when(reason.isNull(), F.col("slope") * loci).alias("allele_slope"), F.when(reason.isNull(), F.col("r_squared")).alias("r_squared"),
    )


# -- permutations ------------------------------------------------------------------------------------


def global_rank(df: DataFrame, key: list[str], hashed: Column, ident: str, per_bucket: int = 200_000) -> DataFrame:
    """Rank (from one) inside each key by a hash, without sorting a key in one task.

    Rows fall into hash-ordered buckets; a bucket is ranked alone and shifted by the sizes of
    the buckets before it.
    """
    sizes = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    h = df.withColumn("_h", hashed)
    lead = F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint")
    bucketed = h.join(sizes, key).withColumn("_b", F.floor(lead * F.ceil(F.col("_n") / per_bucket) / F.lit(1 << 32)))
    counts = bucketed.groupBy(*key, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = counts.withColumn("_off", F.sum("_c").over(Window.partitionBy(*key).orderBy("_b")) - F.col("_c")).drop("_c")
    inside = F.row_number().over(Window.partitionBy(*key, "_b").orderBy("_h", ident))
    return bucketed.withColumn("_r", inside).join(before, [*key, "_b"]).withColumn("rank", F.col("_r") + F.col("_off")).drop("_h", "_n", "_b", "_r", "_off")


def permute_dates(points: DataFrame, replicates: int, seed: int, ident: str = "sample_id") -> DataFrame:
    """Every replicate gives each point the date of another, by two hash orders of the points.

    ``points(ident, date, ...)``; returns ``(replicate, ident, ..., date)``. The date multiset is kept.
    """
    own = F.struct(*[c for c in points.columns if c != "date"])
    copies = points.withColumn("replicate", F.explode(F.sequence(F.lit(1), F.lit(replicates))))
    order = lambda side: F.sha2(F.concat_ws(":", F.lit(f"{seed}{side}"), "replicate", ident), 256)
    places = global_rank(copies, ["replicate"], order("a"), ident).select("replicate", "rank", own.alias("own"), F.lit(None).cast(points.schema["date"].dataType).alias("date"))
    values = global_rank(copies, ["replicate"], order("b"), ident).select("replicate", "rank", F.lit(None).cast(places.schema["own"].dataType).alias("own"), "date")
    # Grouped, not joined: the planner takes the copies for as few as the points and would broadcast them.
    met = places.unionByName(values).groupBy("replicate", "rank").agg(F.max("own").alias("own"), F.max("date").alias("date"))
    return met.select("replicate", "own.*", "date")


def _fit(points: DataFrame, key: list[str]) -> DataFrame:
    return points.groupBy(*key).agg(F.regr_slope("distance", "date").alias("rate"), F.coalesce(F.regr_r2("distance", "date"), F.lit(0.0)).alias("r_squared"))


def permutation_test(points: DataFrame, replicates: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Date permutation of a root-to-tip regression on one fixed root.

    ``points(sample_id, date, distance)``. Returns the metrics of the observed fit
    (replicate 0) and every permutation, and one row with p = (exceeding + 1) / (n + 1).
    """
    base = points.filter("date IS NOT NULL AND distance IS NOT NULL")
    return _gate_table(base, permute_dates(base.select("sample_id", "date", "distance"), replicates, seed))


def _gate_table(base: DataFrame, permuted: DataFrame) -> tuple[DataFrame, DataFrame]:
    observed = base.select(F.lit(0).alias("replicate"), "sample_id", "date", "distance")
    metrics = durable(_fit(permuted.select("replicate", "sample_id", "date", "distance").unionByName(observed), ["replicate"]), "metrics")
    truth = metrics.filter("replicate = 0").select(F.col("r_squared").alias("_o"), F.col("rate").alias("observed_rate"))
    # One observed row meets each replicate row.
    joined = metrics.filter("replicate > 0").crossJoin(F.broadcast(truth))
    p = (F.count_if(F.col("r_squared") >= F.col("_o")) + 1) / (F.count(F.lit(1)) + 1)
    summary = joined.agg(
        F.max("_o").alias("observed_r_squared"), F.max("observed_rate").alias("observed_rate"), F.count(F.lit(1)).alias("randomisations"), p.alias("p_value_r_squared")
    ).withColumn("root_policy", F.lit("fixed_root"))
    return metrics, summary


def clustered_permutation_test(points: DataFrame, clusters: DataFrame, replicates: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """As :func:`permutation_test`, but dates move between whole date clusters.

    ``clusters(cluster, sample_id, date)`` with numeric dates.
    """
    units = clusters.groupBy("cluster").agg(F.max("date").alias("date"))
    moved = permute_dates(units, replicates, seed, "cluster")
    base = points.join(clusters.select("sample_id", "cluster", "date"), "sample_id").filter("distance IS NOT NULL")
    permuted = base.select("sample_id", "cluster", "distance").join(moved, "cluster").select("replicate", "sample_id", "date", "distance")
    metrics, summary = _gate_table(base.select("sample_id", "date", "distance"), permuted)
    counts = units.agg(F.count(F.lit(1)).alias("clusters"), F.countDistinct("date").alias("cluster_dates"))
    enough = (F.col("clusters") >= 3) & (F.col("cluster_dates") >= 3)
    return metrics, summary.crossJoin(counts).withColumn("assessable", enough)


def rate_overlaps(metrics: DataFrame, key: list[str]) -> DataFrame:
    """Null rate intervals that cover the observed rate (CR1) or touch its interval (CR2).

    ``metrics(<key>, permutation, rate, rate_lower, rate_upper)``; a null permutation is the
    observed fit.
    """
    observed = metrics.filter("permutation IS NULL").groupBy(*key).agg(F.max(F.struct("rate", "rate_lower", "rate_upper")).alias("o"))
    df = metrics.filter("permutation IS NOT NULL").join(observed, key)
    cr1 = (F.col("rate_lower") <= F.col("o.rate")) & (F.col("o.rate") <= F.col("rate_upper"))
    cr2 = F.greatest("rate_lower", F.col("o.rate_lower")) <= F.least("rate_upper", F.col("o.rate_upper"))
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("successful"), F.count_if(cr1).alias("cr1_overlaps"), F.count_if(cr2).alias("cr2_overlaps")).withColumn(
        "cr1_passed", F.col("cr1_overlaps") == 0
    ).withColumn("cr2_passed", F.col("cr2_overlaps") == 0)


def signal_gate(rows: DataFrame, p_threshold: float) -> DataFrame:
    """Stop-or-proceed verdict of a dating screen, with its reason.

    ``rows(method, rate, requested, successful, p_value, cr2_passed, cr2_overlaps, ...)``.
    """
    none, partial = F.col("requested") == 0, F.col("successful") != F.col("requested")
    full = F.col("method") == "full_tree"
    code = (
        F.when(none | partial, "not_assessed").when(F.col("rate") <= 0, "not_supported")
        .when(full, F.when(F.coalesce("cr2_passed", F.lit(False)), "supported").otherwise("not_supported"))
        .when(F.col("p_value") > p_threshold, "not_supported").otherwise("supported")
    )
    reason = (
        F.when(none, "no_randomisations_requested").when(partial, "randomisations_incomplete").when(F.col("rate") <= 0, "rate_not_positive")
        .when(full & (code == "not_supported"), "rate_interval_overlaps_randomised_intervals").when(full, "rate_interval_separate_from_randomised_intervals")
        .when(code == "not_supported", "fit_not_stronger_than_randomised_dates").otherwise("fit_stronger_than_randomised_dates")
    )
    return rows.withColumn("code", code).withColumn("reason", reason).withColumn("supported", F.col("code") == "supported")


def permutation_table(metrics: DataFrame, key: list[str]) -> DataFrame:
    """Tidy observed and permuted rows with flags against the observed fit."""
    observed = metrics.filter("permutation IS NULL").groupBy(*key).agg(F.max(F.struct("r_squared", "rate_lower", "rate_upper")).alias("o"))
    df = metrics.join(observed, key, "left")
    null = F.col("permutation").isNotNull()
    overlap = F.greatest("rate_lower", F.col("o.rate_lower")) <= F.least("rate_upper", F.col("o.rate_upper"))
    return df.select(
        *metrics.columns, F.when(null, "date_randomisation").otherwise("observed").alias("row_kind"),
        F.when(null, F.col("r_squared") >= F.col("o.r_squared")).alias("exceeds_observed"), F.when(null, overlap).alias("overlaps_observed"),
    )


def histogram(rows: DataFrame, value: str, key: list[str], low: float, high: float, bins: int) -> DataFrame:
    """Equal-width counts; values outside fall into bins 0 and bins + 1."""
    return rows.groupBy(*key, F.width_bucket(value, F.lit(low), F.lit(high), F.lit(bins)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def spread(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """Assessable runs, extremes and range of a value."""
    return rows.groupBy(*key).agg(F.count(value).alias("assessable_runs"), F.min(value).alias("minimum"), F.max(value).alias("maximum")).withColumn("range", F.col("maximum") - F.col("minimum"))


def pair_agreement(rows: DataFrame) -> DataFrame:
    """Runs in which a target pair could be judged and in which it grouped: ``(run, sample_a, sample_b, together)``."""
    return rows.groupBy("sample_a", "sample_b").agg(F.count("together").alias("assessable_runs"), F.count_if("together").alias("co_clustered_runs"))


# -- scenario ------------------------------------------------------------------------------------------


def scenario(samples: DataFrame, groups: DataFrame, signal: DataFrame, key: list[str]) -> DataFrame:
    """Working scenario per lineage by fixed rules.

    ``samples(<key>, sample_id, origin, collection_date, patient_id)``, ``groups(<key>, clade,
    sample_count, spans_periods)``, ``signal(<key>, supported)``.
    """
    context = F.lower("origin") == "context"
    s = samples.groupBy(*key).agg(
        F.count_if(~context).alias("focal"), F.count_if(context).alias("contexts"), F.countDistinct(F.when(~context, F.col("collection_date"))).alias("focal_dates"),
        F.count_if(~context & (clean("patient_id") == "")).alias("_uncoded"),
    )
    g = groups.groupBy(*key).agg(F.count(F.lit(1)).alias("groups"), F.count_if(F.col("spans_periods") & (F.col("sample_count") >= 2)).alias("spanning_groups"))
    df = s.join(g, key, "left").join(signal, key, "left").na.fill(0, ["groups", "spanning_groups"])
    code = (
        F.when((F.col("focal") < 2) | (F.col("contexts") == 0) | (F.col("focal_dates") < 2), "indeterminate")
        .when((F.col("groups") == 1) & (F.col("spanning_groups") > 0), "persistent_local_lineage")
        .when((F.col("groups") >= 2) & (F.col("spanning_groups") > 0), "mixed")
        .when(F.col("groups") >= 2, "multiple_introductions").otherwise("indeterminate")
    )
    available = lambda test: F.when(test, "supported").otherwise("unavailable")
    return df.select(
        *key, code.alias("code"), F.when((code != "indeterminate") & (F.col("contexts") >= 3), "moderate").otherwise("low").alias("confidence"),
        "focal", "contexts", "focal_dates", "groups", "spanning_groups", available(F.col("focal_dates") >= 2).alias("longitudinal_span"),
        F.when(F.col("contexts") > 0, "suggestive").otherwise("unavailable").alias("context"), available((F.col("focal") > 0) & (F.col("_uncoded") == 0)).alias("patient_sensitivity"),
        available(F.coalesce("supported", F.lit(False))).alias("temporal_signal"),
    )
