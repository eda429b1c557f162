"""Shared pieces: words, table access, scratch tables, two-level ranks."""

from __future__ import annotations

import gc

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lineagespark.session import durable, scratch_path

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
NO_ID = 9223372036854775807


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: cuts the lineage and survives lost executors."""
    return durable(df, name)


def parts(spark: SparkSession) -> int:
    """Shuffle partitions of the session; bucketed tables have as many buckets, so that joins with them agree."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like ``written``, in buckets by ``key``: joins and groupings by it do not shuffle the table again.

    Rows already dealt by ``repartition(parts(spark), key)`` give one file a bucket.
    """
    spark = df.sparkSession
    folder, label = scratch_path(spark, name).rsplit("/", 1)
    label = label.replace("-", "_")
    df.write.option("path", f"{folder}/{label}").bucketBy(parts(spark), key).format("parquet").saveAsTable(label)
    return spark.table(label)


def forget(*frames: DataFrame) -> None:
    """Delete the files of scratch tables that nothing reads any more."""
    for df in frames:
        spark, files = df.sparkSession, df.inputFiles()
        if files:
            jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
            folder = jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            spark.sql(f"DROP TABLE IF EXISTS `{folder.getName().replace('-', '_')}`")
            folder.getFileSystem(conf).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished plans.

    Its cleaner does so when the driver's JVM collects the plans, which it would otherwise do every
    half hour only; a job that shuffles several times its input should not keep all of it until then.
    """
    gc.collect()
    spark._jvm.System.gc()


def running(df: DataFrame, keys: list[str], slice_col: str, order: list[Column], value: Column, out: str, within: str | None = None) -> DataFrame:
    """``out``: the sum of ``value`` over the rows up to and with each row, in the order of
    ``keys``, ``slice_col``, ``order``.

    A slice cuts a large key into parts by a prefix of its order, so no task sorts a whole key:
    a window runs inside each slice and the slice totals, a small table, give the offsets.
    """
    parts = Window.partitionBy(*keys, slice_col).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = df.groupBy(*keys, slice_col).agg(F.sum(value).alias("_slice_sum"))
    before = Window.partitionBy(*keys).orderBy(slice_col).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.withColumn("_before", F.coalesce(F.sum("_slice_sum").over(before), F.lit(0))).drop("_slice_sum")
    return df.withColumn("_within", F.sum(value).over(parts)).join(offsets, [*keys, slice_col]).withColumn(out, F.col("_before") + F.col("_within")).drop("_before", "_within")
