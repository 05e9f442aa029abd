"""Session defaults and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(
    app: str = "petrichor", cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g"
) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Spark's setting for the bytes of a batch that the JVM hands to a Python worker, and what ``small_batches`` sets.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 22


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get their rows a few megabytes at a time, unless the session has a size of its own.

    By Spark's default a batch has up to 64 MB, which a task holds outside the
    heap (growing by doubling) while its worker holds it once more.
    """
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh path for one intermediate table or model.

    On a cluster it lies under ``spark.checkpoint.dir``, which every executor
    can reach. Only a local master may fall back to a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="petrichor-")
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def landed(df: DataFrame, purpose: str = "table", partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    This cuts the lineage, survives lost executors, and gives later passes
    column pruning and true size statistics, so that Catalyst broadcasts the
    table only when its files are below ``autoBroadcastJoinThreshold``.
    Filters on ``partition_by`` then skip the files of the other values.
    """
    spark = df.sparkSession
    path = shared_dir(spark, purpose)
    (df.write.partitionBy(partition_by) if partition_by else df.write).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
