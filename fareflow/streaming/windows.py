"""Event-time aggregations: stream in, stream out. Every one has a watermark.

``watermark`` is how late a row may come; state older than that is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_time(df: DataFrame, ts: str, watermark: str) -> DataFrame:
    """Zone-free times become instants, which watermarks require."""
    return df.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)


def _windowed(df: DataFrame, window: Column, keys: Sequence[str], aggs: dict[str, Column]) -> DataFrame:
    grouped = df.groupBy(window.alias("window"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return grouped.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                          *keys, *aggs)


def _count() -> dict[str, Column]:
    return {"count": F.count(F.lit(1))}


def tumbling(df: DataFrame, ts: str, width: str, keys: Sequence[str], watermark: str,
             aggs: dict[str, Column] | None = None) -> DataFrame:
    return _windowed(event_time(df, ts, watermark), F.window(ts, width), keys, aggs or _count())


def sliding(df: DataFrame, ts: str, width: str, slide: str, keys: Sequence[str], watermark: str,
            aggs: dict[str, Column] | None = None) -> DataFrame:
    return _windowed(event_time(df, ts, watermark), F.window(ts, width, slide), keys, aggs or _count())


def sessions(df: DataFrame, ts: str, gap: str, keys: Sequence[str], watermark: str,
             aggs: dict[str, Column] | None = None) -> DataFrame:
    """Runs of rows with at most ``gap`` between neighbours; a session ends ``gap`` after its last row."""
    return _windowed(event_time(df, ts, watermark), F.session_window(ts, gap), keys, aggs or _count())


def arrival_windows(df: DataFrame, width: str, keys: Sequence[str]) -> DataFrame:
    """Counts by the time rows are processed, not by when they happened."""
    stamped = df.withColumn("arrived", F.current_timestamp()).withWatermark("arrived", "0 seconds")
    return _windowed(stamped, F.window("arrived", width), keys, _count())


def running_count(df: DataFrame, keys: Sequence[str], where: Column | None = None) -> DataFrame:
    """Changelog count per key. The state holds one number per key, so it needs no watermark
    as long as the key set is bounded (zones, vendors, payment types)."""
    return (df.filter(where) if where is not None else df).groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))


def most_popular(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sorted counts; a stream can only emit these in complete mode."""
    return running_count(df, keys).orderBy(F.desc("count"), *keys)
