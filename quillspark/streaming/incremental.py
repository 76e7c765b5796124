"""Incremental runs: new queue files as a stream, each batch through the same upserts as a full run.  An extension."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.doi import gate_doi


def queue_stream(spark: SparkSession, folder: str, schema: T.StructType, per_trigger: int = 100) -> DataFrame:
    """Rows of queue files as they arrive; DOIs are gated, those that fail go."""
    rows = spark.readStream.option("header", True).option("maxFilesPerTrigger", per_trigger).schema(schema).csv(folder)
    return rows.withColumn("doi", gate_doi(F.col("doi"))).filter("doi <> ''")


def run_available(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """All files present now, then the end; a restart goes on where the checkpoint says."""
    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def event_windows(events: DataFrame, width: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Counts by type in tumbling windows of event time, batch or stream."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", late) if timed.isStreaming else timed
    return timed.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", "total")
