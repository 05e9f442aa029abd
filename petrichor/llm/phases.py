"""Intermediate tables of one job: land them in the shared folder, drop them when a later phase no longer needs them."""

from __future__ import annotations

import gc
import shutil
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_dir


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the Python workers this package, once per application, wherever the driver has it from."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parents[1]
        base = Path(tempfile.mkdtemp(prefix="petrichor-package-")) / package.name
        spark.sparkContext.addPyFile(shutil.make_archive(str(base), "zip", package.parent, package.name))
        _SHIPPED.add(app)


def computed_once(df: DataFrame, column: str) -> DataFrame:
    """``df`` unchanged; filters above on ``column`` don't move below this projection.

    Catalyst would move a filter down and put whole expressions in place of the
    columns, also inside functions that run once for each element of an array.
    It moves nothing past a projection that isn't deterministic; this one is so
    in form only.
    """
    return df.withColumn(column, F.when(F.spark_partition_id() >= 0, F.col(column)))


#: A row's slot: 31 bits of its text's hash above 32 bits for a place in the text.
PLACE = (1 << 32) - 1


def with_tags(docs: DataFrame, phases: "Phases") -> DataFrame:
    """``docs`` (doc_id, text) with ``tag``, which tells rows of one doc_id apart by their texts.

    The tag is a hash, taken with the first seed under which no two different texts
    of one doc_id share it. Only rows whose doc_id repeats are looked at for that.
    """
    tag = lambda seed: F.shiftleft(F.xxhash64("text", F.lit(seed)).bitwiseAND(F.lit((1 << 31) - 1)), 32)
    again = phases.land(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "repeated-ids")
    seed = 0
    if not again.isEmpty():
        rows = phases.land(docs.join(again, "doc_id", "left_semi").select("doc_id", F.sha2("text", 256).alias("h"), *[tag(s).alias(f"t{s}") for s in range(8)]), "repeated-rows")
        clashes = lambda s: not rows.groupBy("doc_id", f"t{s}").agg(F.min("h").alias("a"), F.max("h").alias("b")).where("a <> b").isEmpty()
        seed = next((s for s in range(8) if not clashes(s)), None)
        if seed is None:
            raise ValueError("too many different texts share a doc_id to be told apart")
    return docs.withColumn("tag", tag(seed))


class Phases:
    """Tables that one operator call writes under ``spark.checkpoint.dir``.

    ``land`` writes a DataFrame once as Parquet and reads it back: the lineage
    ends there, so a lost executor costs a reread and not a recomputation.
    ``drop`` deletes landed tables that no later phase reads, and lets Spark's
    cleaner remove the shuffle files of phases that are over.
    """

    def __init__(self, spark: SparkSession, job: str):
        self.spark, self.job = spark, job
        ship(spark)
        self._paths: dict[int, str] = {}

    def land(self, df: DataFrame, name: str) -> DataFrame:
        path = shared_dir(self.spark, f"{self.job}-{name}")
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for table in tables:
            path = jvm.org.apache.hadoop.fs.Path(self._paths.pop(id(table)))
            path.getFileSystem(conf).delete(path, True)
        self.release()

    def release(self) -> None:
        """Shuffle files go once the driver has collected the plans that own them: first Python's handles, then the JVM's."""
        for _ in range(2):
            gc.collect()
            self.spark._jvm.System.gc()
            time.sleep(0.3)
