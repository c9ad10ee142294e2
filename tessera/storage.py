"""Intermediate results in the folder that driver and executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's setting that drops a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where that is unset, a local session (tests) gets a temporary folder; a cluster gets an error.
    """
    said = spark.conf.get("spark.checkpoint.dir", None)
    if said:
        return said
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return f"file://{tempfile.gettempdir()}/checkpoints/tessera"


def stash(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: lineage is cut, files survive executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stash-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)  # None where it is not set
    spark.conf.set(CLEANUP, "true")  # the written files replace the shuffle files, which can go at once
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(spark: SparkSession, rows: int | None, most: int = 1 << 20) -> int:
    """Partitions that hold about ``most`` of ``rows`` each; a core has one at least."""
    return max(spark.sparkContext.defaultParallelism, -(-(rows or 0) // most))


def stash_in(df: DataFrame, parts: int) -> DataFrame:
    """``stash`` with ``parts`` partitions at every shuffle, never merged by the size of what is read: for steps that make
    far more rows than they read, or more than the session's number of partitions can hold in memory."""
    spark = df.sparkSession
    wanted = {"spark.sql.shuffle.partitions": str(parts), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in wanted}
    try:
        for k, v in wanted.items():
            spark.conf.set(k, v)
        return stash(df)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def unstash(df: DataFrame) -> None:
    """Delete the files of a stash that nothing reads any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getName().startswith("stash-"):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished steps; it works from collected garbage."""
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.4)
