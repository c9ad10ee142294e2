"""An incremental mode over event tables (an extension): watermarked windows and sessions, exactly once by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_events(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def window_counts(events: DataFrame, width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """(start, event_type, n, total) of tumbling windows; events later than ``late`` are dropped."""
    by = events.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type")
    return by.agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("window.start").alias("start"), "event_type", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "2 hours") -> DataFrame:
    """(user_id, start, end, n) of sessions that end after ``gap`` without events."""
    by = events.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap))
    return by.agg(F.count(F.lit(1)).alias("n")).select("user_id", F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), "n")


def write_batches(stream: DataFrame, path: str, checkpoint: str):
    """Each micro-batch replaces its own folder, so a batch that runs again leaves the same files."""

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(put).trigger(availableNow=True).start()
