"""Sinks: Parquet bundles with manifests that are checked again on load, and text exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lineagespark.functions.text import table_fingerprint
from lineagespark.operators.joins import selection_problems

MANIFEST = "_manifest"


def write_dataset(tables: dict[str, DataFrame], path: str, keys: dict[str, str] | None = None) -> DataFrame:
    """Write every table once (never over an old one) and a manifest of rows and fingerprints.

    ``keys`` names tables whose column must exist in ``samples``; a stray key stops the write.
    """
    for name, column in (keys or {}).items():
        stray = tables[name].join(tables["samples"].select(F.col("sample_id").alias(column)), column, "left_anti")
        if not stray.isEmpty():
            raise ValueError(f"table {name} names samples that do not exist")
    manifest = None
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{path}/{name}")
        written = df.sparkSession.read.parquet(f"{path}/{name}")
        row = table_fingerprint(written).select(F.lit(name).alias("table"), "rows", "fingerprint")
        manifest = row if manifest is None else manifest.unionByName(row)
    manifest.coalesce(1).write.mode("errorifexists").parquet(f"{path}/{MANIFEST}")
    return manifest.sparkSession.read.parquet(f"{path}/{MANIFEST}")


def dataset_identity(manifest: DataFrame) -> DataFrame:
    """One hash over the manifest in table order; a manifest has one row per table."""
    rows = F.array_sort(F.collect_list(F.struct("table", "rows", "fingerprint")))
    return manifest.agg(F.sha2(F.to_json(rows), 256).alias("dataset_id"))


def load_dataset(spark: SparkSession, path: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tables of a bundle and the list of tables whose rows or fingerprint changed."""
    manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    names = [r[0] for r in manifest.select("table").orderBy("table").collect()]
    tables = {n: spark.read.parquet(f"{path}/{n}") for n in names}
    now = None
    for name, df in tables.items():
        row = table_fingerprint(df).select(F.lit(name).alias("table"), F.col("rows").alias("rows_now"), F.col("fingerprint").alias("fingerprint_now"))
        now = row if now is None else now.unionByName(row)
    joined = manifest.join(now, "table", "full_outer")
    changed = joined.filter("NOT (rows <=> rows_now AND fingerprint <=> fingerprint_now)")
    return tables, changed.select("table", "rows", "rows_now")


def pairs_fingerprint(df: DataFrame) -> DataFrame:
    """Order-independent (rows, fingerprint) of a list of pairs: sums of 64-bit row hashes, which tell nulls apart, in three parts.

    A list of pairs is far longer than any other table, so its rows are not spelt as JSON.
    """
    names = sorted(df.columns)
    h = F.xxhash64(*[F.col(c) for c in names], *[F.col(c).isNull() for c in names])
    parts = [F.sum(F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))) for shift, bits in ((0, 21), (21, 21), (42, 22))]
    return df.agg(F.count(F.lit(1)).alias("rows"), F.concat_ws("-", *[F.coalesce(p, F.lit(0)).cast("string") for p in parts]).alias("fingerprint"))


def write_distances(pairs: DataFrame, path: str, samples: DataFrame, method: str, definition: str) -> DataFrame:
    """Pair evidence by scope with its method, beside the samples it covers."""
    stored = pairs.withColumn("method", F.lit(method)).withColumn("definition", F.lit(definition))
    stored.write.mode("errorifexists").partitionBy("scope_id").parquet(f"{path}/pairs")
    samples.write.mode("errorifexists").parquet(f"{path}/samples")
    written = pairs.sparkSession.read.parquet(f"{path}/pairs")
    manifest = pairs_fingerprint(written.withColumn("scope_id", F.col("scope_id").cast("string"))).select(F.lit("pairs").alias("table"), "rows", "fingerprint")
    manifest.write.mode("errorifexists").parquet(f"{path}/{MANIFEST}")
    return pairs.sparkSession.read.parquet(f"{path}/{MANIFEST}")


def load_distances(spark: SparkSession, path: str, min_overlap: float) -> tuple[DataFrame, DataFrame]:
    """Stored pairs and everything wrong with them: changed content or broken evidence."""
    from lineagespark.operators.distances import audit_evidence

    pairs = spark.read.parquet(f"{path}/pairs").withColumn("scope_id", F.col("scope_id").cast("string"))
    manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    now = pairs_fingerprint(pairs).select(F.col("rows").alias("rows_now"), F.col("fingerprint").alias("fingerprint_now"))
    # Two one-row tables.
    changed = manifest.crossJoin(F.broadcast(now)).filter("rows <> rows_now OR fingerprint <> fingerprint_now")
    broken = audit_evidence(pairs, spark.createDataFrame([], "sample_id string, cohort_id string"), min_overlap)
    unknown = pairs.select(F.explode(F.array("sample_a", "sample_b")).alias("sample_id")).distinct().join(spark.read.parquet(f"{path}/samples"), "sample_id", "left_anti")
    problems = changed.select(F.lit("").alias("sample_a"), F.lit("").alias("sample_b"), F.lit("content_changed").alias("problem")).unionByName(broken).unionByName(
        unknown.select(F.col("sample_id").alias("sample_a"), F.lit("").alias("sample_b"), F.lit("unknown_sample").alias("problem"))
    )
    return pairs, problems


def flatten_for_text(df: DataFrame) -> DataFrame:
    """Nested columns as JSON, so a row fits a CSV."""
    nested = (T.StructType, T.ArrayType, T.MapType)
    return df.select(*[F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema.fields])


def write_csv(df: DataFrame, path: str, delimiter: str = ",") -> None:
    """Audit table as header-bearing text with quoted JSON for nested values."""
    flatten_for_text(df).write.mode("errorifexists").option("header", True).option("sep", delimiter).option("escape", '"').csv(path)


def export_pairs(requested: DataFrame, samples: DataFrame, evidence: DataFrame) -> DataFrame:
    """Exactly the requested pairs, each with its counts and whether its distance is available.

    ``evidence(sample_a, sample_b, allele_differences, shared_called_loci, scheme_loci,
    call_overlap, distance)`` answers the requests; unknown ids are marked.
    """
    known = lambda c, n: samples.select(F.col("sample_id").alias(c), F.lit(True).alias(n))
    joined = requested.join(evidence.distinct(), ["sample_a", "sample_b"], "left").join(known("sample_a", "_ka"), "sample_a", "left").join(known("sample_b", "_kb"), "sample_b", "left")
    status = F.when(F.col("_ka").isNull() | F.col("_kb").isNull(), "unknown_sample").when(F.col("distance").isNull(), "unavailable").otherwise("available")
    return joined.select("sample_a", "sample_b", status.alias("status"), "allele_differences", "shared_called_loci", "scheme_loci", "call_overlap", "distance")


def combined_metadata(inputs: DataFrame, selected: DataFrame) -> DataFrame:
    """Input rows, then selected context rows as context samples, in one sheet."""
    columns = ["sample_id", "assembly", "collection_date", "location", "species", "lineage", "origin", "is_reference", "patient_id"]
    place = F.when(F.coalesce(F.trim("country"), F.lit("")) == "", "Public_context").otherwise(F.col("country"))
    context = selected.withColumn("location", place).withColumn("origin", F.lit("context")).withColumn("is_reference", F.lit(False)).withColumn("patient_id", F.lit(""))
    return inputs.select(*columns, F.lit(0).alias("part")).unionByName(context.select(*columns, F.lit(1).alias("part")))


def write_selections(decisions: DataFrame, pool: DataFrame, inputs: DataFrame, path: str) -> None:
    """Selections with the pool and inputs they were made from."""
    for name, df in (("decisions", decisions), ("pool", pool.select("sample_id")), ("inputs", inputs.select("sample_id"))):
        df.write.mode("errorifexists").parquet(f"{path}/{name}")


def load_selections(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Saved decisions and every rule they break."""
    read = lambda n: spark.read.parquet(f"{path}/{n}")
    decisions = read("decisions")
    return decisions, selection_problems(decisions, read("pool"), read("inputs"))
