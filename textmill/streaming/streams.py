"""Incremental runs: landing folders, deduplication across runs, counters, event-time windows and health."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def landing(spark: SparkSession, path: str, schema, kind: str = "json", files_per_trigger: int | None = None) -> DataFrame:
    """An append-only folder as a stream; finished inputs are remembered by the query's checkpoint."""
    reader = spark.readStream.schema(schema).format(kind)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def deduplicated(stream: DataFrame, key: Column, event_time: str | None = None, delay: str = "1 day") -> DataFrame:
    """One row for each key over all runs; with an event time, state older than ``delay`` is dropped."""
    rows = stream.withColumn("dedup_key", key)
    if event_time:
        return rows.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["dedup_key"])
    return rows.dropDuplicates(["dedup_key"])


def counters(stream: DataFrame, group: str, size: Column) -> DataFrame:
    """Items and bytes of each group since the first run."""
    return stream.groupBy(group).agg(F.count(F.lit(1)).alias("items"), F.sum(size).alias("bytes"))


def windowed(stream: DataFrame, time: str, key: str, value: str, length: str, delay: str) -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.window(time, length), key).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(value), 6).alias("total"))


def run_once(df: DataFrame, checkpoint: str, batch: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Process what has arrived since the last run, then stop."""
    query = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(batch).start()
    query.awaitTermination()
    return query


def run_for(df: DataFrame, checkpoint: str, path: str, seconds: int, every: str = "15 minutes") -> bool:
    """Collect for a time; True if the query ended by itself."""
    query = df.writeStream.format("json").option("checkpointLocation", checkpoint).option("path", path).trigger(processingTime=every).start()
    try:
        return bool(query.awaitTermination(seconds))
    finally:
        query.stop()


def rates(items: Column, size: Column, seconds: Column) -> tuple[Column, Column]:
    """Items and GB an hour."""
    hours = seconds / 3600
    return F.coalesce(F.try_divide(items, hours), F.lit(0.0)), F.coalesce(F.try_divide(size / 1e9, hours), F.lit(0.0))


def active(newest: Column, now: Column, limit: int = 300) -> Column:
    """Whether the newest file is younger than ``limit`` seconds."""
    return (now.cast("long") - newest.cast("long")) < limit
