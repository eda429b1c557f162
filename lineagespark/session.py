"""Session helpers: a local session for tests and durable intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cpus: str = "8", memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("lineagespark")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The durable folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may fall back to a machine-local folder; on a cluster an unset
    folder is an error, because executors could not read each other's files.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a shared folder")
    # The setting cannot be changed in a running session, so the folder is kept here, by application.
    key = spark.sparkContext.applicationId
    if key not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[key] = tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("LINEAGESPARK_TMP", "/tmp"))
    return _LOCAL_FOLDERS[key]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage of iterative operators, survives lost executors, and gives the
    planner real sizes, so later joins are only broadcast below Spark's size threshold.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Like ``durable``, in as many buckets by ``key`` as there are shuffle partitions: joins by it leave the table where it is."""
    spark = df.sparkSession
    folder, label = scratch_path(spark, name).rsplit("/", 1)
    label = label.replace("-", "_")
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.repartition(buckets, key).write.option("path", f"{folder}/{label}").bucketBy(buckets, key).format("parquet").saveAsTable(label)
    return spark.table(label)


def forget(*frames: DataFrame) -> None:
    """Delete the files of scratch tables that nothing reads any more."""
    for df in frames:
        spark, files = df.sparkSession, df.inputFiles()
        if files:
            folder = spark._jvm.org.apache.hadoop.fs.Path(files[0].rsplit("/", 1)[0])
            spark.sql(f"DROP TABLE IF EXISTS `{folder.getName().replace('-', '_')}`")
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
