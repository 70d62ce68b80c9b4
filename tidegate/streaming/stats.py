"""Window statistics; the same functions serve batch and streaming frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.scalars import mean_of_units


def sliding_stats(
    df: DataFrame, ts: str, units: Column, size: str, slide: str, delay: str | None = None, keys: Sequence[str] = ()
) -> DataFrame:
    """Count and average money per sliding window. ``units`` is cents.

    ``delay`` is how late a row of a stream may be; None for batch.
    """
    rows = df if delay is None else df.withWatermark(ts, delay)
    return (
        rows.groupBy(F.window(ts, size, slide), *keys)
        .agg(F.count(F.lit(1)).alias("trips"), F.sum(units).alias("_total"), F.count(units).alias("_n"))
        .select(
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
            *keys,
            "trips",
            mean_of_units(F.col("_total"), F.col("_n"), 2, 2).alias("avg_fare"),
        )
    )


def stream_quality(
    checked: DataFrame, ts: str, now: Column, size: str, watched: Sequence[str], delay: str | None = None
) -> DataFrame:
    """Per tumbling window: events, share invalid, NULLs per watched column, lag behind ``now`` in seconds."""
    rows = checked if delay is None else checked.withWatermark(ts, delay)
    invalid = F.count_if(F.col("error").isNotNull())
    grouped = rows.groupBy(F.window(ts, size)).agg(
        F.count(F.lit(1)).alias("events"),
        invalid.alias("invalid"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in watched],
        F.max(ts).alias("newest"),
    )
    lag = F.timestamp_diff("MICROSECOND", F.col("newest"), now) / F.lit(1e6)
    return grouped.select(
        F.col("window.start").alias("window_start"),
        "events",
        "invalid",
        (F.lit(100.0) * F.col("invalid") / F.col("events")).alias("invalid_pct"),
        *[f"null_{c}" for c in watched],
        lag.alias("lag_seconds"),
    )
