"""Streaming forms of the status log and of idempotent replacement; an extension beside the batch engine."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STATUS = "doi string, status string, seconds double, error string, timestamp_utc timestamp"


def status_stream(spark: SparkSession, path: str) -> DataFrame:
    """The status log as a stream of its files."""
    return spark.readStream.schema(STATUS).json(path)


def status_counts(stream: DataFrame, delay: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Counts and mean seconds by window and status; windows close ``delay`` after their end."""
    w = F.window("timestamp_utc", window)
    return stream.withWatermark("timestamp_utc", delay).groupBy(w.alias("window"), "status").agg(F.count("*").alias("n"), F.avg("seconds").alias("mean_seconds"))


def replace_stream(stream: DataFrame, path: str, by: str, checkpoint: str):
    """Writes each micro-batch over the partitions that it touches, so that a repeated batch changes nothing."""

    def put(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)

    return stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
