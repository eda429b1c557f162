"""Set operations with their audits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def combine_pool(inputs: DataFrame, context: DataFrame, ident: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """Inputs and context as one pool, and the ids that break disjointness or repeat."""
    pool = inputs.withColumn("pool", F.lit("input")).unionByName(context.withColumn("pool", F.lit("context")), allowMissingColumns=True)
    seen = pool.groupBy(ident).agg(F.count(F.lit(1)).alias("rows"), F.min("pool").alias("_a"), F.max("pool").alias("_b")).filter("rows > 1")
    problem = F.when(F.col("_a") != F.col("_b"), "input_and_context").otherwise("repeated_id")
    return pool, seen.select(ident, "rows", problem.alias("problem"))


def compare_sets(expected: DataFrame, found: DataFrame, ident: str) -> DataFrame:
    """Ids only expected (missing) or only found (extra)."""
    missing = expected.select(ident).distinct().join(found, ident, "left_anti").withColumn("status", F.lit("missing"))
    return missing.unionByName(found.select(ident).distinct().join(expected, ident, "left_anti").withColumn("status", F.lit("extra")))


def shared_panel(mapped: DataFrame, panel: DataFrame | None = None) -> DataFrame:
    """Loci mapped in every sample that has any, or those of an explicit panel, with coverage.

    ``mapped(sample_id, locus)`` may repeat rows.
    """
    samples = mapped.agg(F.countDistinct("sample_id").alias("samples"))
    counts = mapped.groupBy("locus").agg(F.countDistinct("sample_id").alias("mapped"))
    # One row: the number of mapped samples.
    whole = counts.crossJoin(F.broadcast(samples))
    if panel is not None:
        return panel.select("locus").distinct().join(whole, "locus", "left").select("locus", F.coalesce("mapped", F.lit(0)).alias("mapped"))
    return whole.filter("mapped = samples").select("locus", "mapped")


def content_duplicates(rows: DataFrame, content: str, ident: str) -> tuple[DataFrame, DataFrame]:
    """Unique contents under their SHA-256, and ``(ident, content_id)`` for every row."""
    hashed = rows.withColumn("content_id", F.sha2(content, 256))
    unique = hashed.groupBy("content_id").agg(F.min(ident).alias("first"), F.count(F.lit(1)).alias("copies"))
    return unique, hashed.select(ident, "content_id")


def ordered(rows: DataFrame, columns: list, ident: str) -> DataFrame:
    """A total order: ties end at the id."""
    return rows.orderBy(*columns, ident)


def head(rows: DataFrame, columns: list, ident: str, n: int) -> DataFrame:
    """First n rows of the total order, found by per-partition tops."""
    return ordered(rows, columns, ident).limit(n)
