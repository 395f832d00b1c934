"""Node support kept up over a stream of aligned steps, and windowed counts with late data.

The reference work is batch only; these are extensions with their own semantics: event time is `ts`, steps later than
the watermark are dropped, and support is a running total in update mode.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def node_support(steps: DataFrame) -> DataFrame:
    """A running (node, bases, steps) of streamed or batch steps; associative, so it equals the batch result."""
    return steps.groupBy("node").agg(F.sum("aligned").alias("bases"), F.count("*").alias("steps"))


def windowed(events: DataFrame, size: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """(start, event_type, n) by tumbling windows of event time."""
    e = events.withWatermark("ts", lateness) if events.isStreaming else events
    return e.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), "event_type", "n")


def start(frame: DataFrame, name: str, checkpoint: str, mode: str = "update"):
    """Runs a streaming frame into an in-memory table, with its state under the checkpoint folder."""
    return frame.writeStream.outputMode(mode).format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
