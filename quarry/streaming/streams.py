"""Streams: file sources run to their end, first-wins within a watermark, windows, and state from batches that may come twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 1) -> DataFrame:
    """A Parquet folder as a stream, so many files at a time: the next ones are read when these are done."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_to_end(stream: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Appends all that there is now to a Parquet folder; a run that breaks off goes on from its checkpoint."""
    stream.writeStream.format("parquet").outputMode(mode).option("path", sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def run_batches(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Calls `each` with every micro-batch and its number; a batch may come again after a failure, with the same number."""
    stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def tumbling(events: DataFrame, width: str, delay: str | None = None, keys: tuple[str, ...] = ("event_type",), slide: str | None = None) -> DataFrame:
    """start, keys, n and value sums of windows over event time; works on streams and tables alike."""
    rows = events.withWatermark("ts", delay) if delay else events
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    return rows.groupBy(window.alias("w"), *keys).agg(F.count("*").alias("n"), F.round(F.sum("value"), 6).alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, gap: str, delay: str | None = None, key: str = "user_id") -> DataFrame:
    """start, end, n of each key's sessions: events less than `gap` apart."""
    rows = events.withWatermark("ts", delay) if delay else events
    return rows.groupBy(F.session_window("ts", gap).alias("w"), key).agg(F.count("*").alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def dedup_stream(events: DataFrame, keys: list[str], delay: str) -> DataFrame:
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(keys)
