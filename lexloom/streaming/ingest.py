"""Structured Streaming: new bronze files go through the same upsert, at least once with equal keys, so effectively once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.index import Index


def stream_upserts(spark: SparkSession, landing: str, schema: str, index: str, checkpoint: str, keys: list[str], order: list[str], prepare: Callable[[DataFrame], DataFrame] | None = None):
    """Run all files that have landed since the checkpoint, then stop; returns the finished query."""

    def batch(df: DataFrame, _: int) -> None:
        Index(df.sparkSession, index, keys).upsert(prepare(df) if prepare else df, order=order)

    q = spark.readStream.schema(schema).parquet(landing).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def windowed_counts(events: DataFrame, late: str = "10 minutes", size: str = "5 minutes") -> DataFrame:
    """Counts by event-time window and type, with a watermark for late rows."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
