"""Windowed counts over the event stream: one plan for batch and for Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def windowed(events: DataFrame, width: str) -> DataFrame:
    """start_us, event_type, n, total by tumbling event-time windows."""
    by = events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return by.select(F.unix_micros("w.start").alias("start_us"), "event_type", "n", "total")


def batch(events: DataFrame, width: str) -> DataFrame:
    return windowed(events.withColumn("ts", F.col("ts").cast("timestamp")), width)


def stream(spark: SparkSession, path: str, schema, width: str, late: str = "10 minutes") -> DataFrame:
    """The same over files that arrive in ``path``; state is bounded by the watermark."""
    events = spark.readStream.schema(schema).parquet(path).withColumn("ts", F.col("ts").cast("timestamp"))
    return windowed(events.withWatermark("ts", late), width)


def sliding(events: DataFrame, width: str, step: str) -> DataFrame:
    """start_us, n, total by windows of ``width`` that begin every ``step``; an event is in each that covers it."""
    by = events.groupBy(F.window("ts", width, step).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return by.select(F.unix_micros("w.start").alias("start_us"), "n", "total")


def sessions(events: DataFrame, gap: str) -> DataFrame:
    """user_id, start_us, n: runs of a user's events with less than ``gap`` between neighbours."""
    by = events.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return by.select("user_id", F.unix_micros("w.start").alias("start_us"), "n")


def first_of(events: DataFrame, keys: list[str], late: str = "10 minutes") -> DataFrame:
    """A stream's events without those whose keys came before, as far back as the watermark; the same call
    on a batch drops all repeats."""
    if not events.isStreaming:
        return events.dropDuplicates(keys)
    return events.withWatermark("ts", late).dropDuplicatesWithinWatermark(keys)
