"""Windowed aggregates over streams, equal to their batch forms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tumbling(
    df: DataFrame, keys: Sequence[str], ts: str, measures: Mapping[str, Column],
    width: str = "1 hour", late: str = "1 hour",
) -> DataFrame:
    """Aggregates per key and window of fixed width; rows later than ``late`` are dropped.

    Works on streams and tables; on a table nothing is late.
    """
    if df.isStreaming:
        df = df.withWatermark(ts, late)
    return (
        df.groupBy(*keys, F.window(ts, width).alias("_w"))
        .agg(*[c.alias(name) for name, c in measures.items()])
        .select(*keys, F.col("_w.start").alias("window_start"), *measures)
    )


def session_counts(
    df: DataFrame, keys: Sequence[str], ts: str, gap: str, late: str = "1 hour"
) -> DataFrame:
    """Rows per session of a key; a session ends after ``gap`` without rows.

    For tables with hot keys ``tarn.operators.aggregates.sessions`` gives the
    same sessions without one task per key.
    """
    if df.isStreaming:
        df = df.withWatermark(ts, late)
    return (
        df.groupBy(*keys, F.session_window(ts, gap).alias("_w"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(*keys, F.col("_w.start").alias("session_start"), F.col("_w.end").alias("session_end"), "n")
    )
