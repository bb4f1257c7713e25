"""De-duplication, windowed counts and change events over streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_seen(stream: DataFrame, key: Column, event_time: str, delay: str = "14 days") -> DataFrame:
    """The first row of each key; rows later than ``delay`` behind the watermark are dropped, and keys are forgotten after it."""
    return stream.withColumn("_key", key).withWatermark(event_time, delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def windowed_counts(stream: DataFrame, event_time: str, by: list[str], width: str = "1 day", delay: str = "1 day") -> DataFrame:
    """Counts by tumbling window and keys, final once the watermark has passed."""
    grouped = stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), *by)
    return grouped.agg(F.count("*").alias("rows")).select("window.start", "window.end", *by, "rows")


def each_batch(stream: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs a batch operator on what is there, once for each micro-batch, and ends."""
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
