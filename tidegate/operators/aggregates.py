"""Aggregations. All are algebraic, so Spark combines them before the shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.scalars import (
    as_column,
    divide_half_up,
    from_units,
    round_avg,
    since,
    unscaled,
)

Averages = Mapping[str, tuple[Column | str, int]]


def own_scale(df: DataFrame, c: Column | str) -> int | None:
    """Decimals that the column's type allows; None for binary numbers."""
    kind = df.select(as_column(c)).schema[0].dataType
    return kind.scale if isinstance(kind, T.DecimalType) else 0 if isinstance(kind, T.IntegralType) else None


def _averages(df: DataFrame, averages: Averages, scale: int | None) -> list[Column]:
    """Averages rounded once; ``scale`` is the decimals that the inputs carry, by default those of their types."""
    return [round_avg(c, dp, own_scale(df, c) if scale is None else scale).alias(name) for name, (c, dp) in averages.items()]


def _rate(flag: Column, dp: int) -> Column:
    """Share of true among known flags, in percent."""
    known = F.count(flag)
    return F.when(known > 0, from_units(divide_half_up(F.count_if(flag) * (100 * 10**dp), known), dp))


def time_rollup(
    df: DataFrame,
    ts: str,
    averages: Averages,
    sums: Mapping[str, str],
    unit: str = "hour",
    keys: Sequence[str] = (),
    count: str = "total_trips",
    scale: int | None = None,
    bucket: str | None = None,
) -> DataFrame:
    """Counts, rounded averages ``{name: (column, places)}`` and sums per time bucket and key."""
    return (
        df.where(F.col(ts).isNotNull())
        .groupBy(F.date_trunc(unit, ts).alias(bucket or unit), *keys)
        .agg(
            F.count(F.lit(1)).alias(count),
            *_averages(df, averages, scale),
            *[F.sum(c).cast("bigint").alias(name) for name, c in sums.items()],
        )
    )


def hourly_rollup(df: DataFrame, ts: str, averages: Averages, sums: Mapping[str, str], scale: int | None = None) -> DataFrame:
    return time_rollup(df, ts, averages, sums, "hour", scale=scale)


def daily_rollup(df: DataFrame, ts: str, keys: Sequence[str], averages: Averages, scale: int | None = None) -> DataFrame:
    """Readings and averages per day and key."""
    return time_rollup(df, ts, averages, {}, "day", keys, count="readings", scale=scale)


def rate_summary(
    df: DataFrame,
    keys: Sequence[str],
    flag: Column | str,
    averages: Averages,
    require: str | None = None,
    count: str = "total_passengers",
    hits: str = "survivors",
    rate: str = "survival_rate_pct",
    dp: int = 2,
    scale: int | None = None,
) -> DataFrame:
    """Per key pair: rows, rows with the flag, rate in percent and averages.

    ``flag`` may be a boolean or a 0/1 column; rows without ``require`` stay out.
    """
    flag = as_column(flag).cast("boolean")
    rows = df if require is None else df.where(F.col(require).isNotNull())
    return rows.groupBy(*keys).agg(
        F.count(F.lit(1)).alias(count),
        F.count_if(flag).alias(hits),
        _rate(flag, dp).alias(rate),
        *_averages(df, averages, scale),
    )


def fact_stats(df: DataFrame, averages: Averages, money: Mapping[str, str], sums: Mapping[str, str]) -> DataFrame:
    """One row: count, averages, money totals at two places, integer totals."""
    return df.agg(
        F.count(F.lit(1)).alias("total_trips"),
        *_averages(df, averages, None),
        *[from_units(F.sum(unscaled(c, 2)), 2).alias(name) for name, c in money.items()],
        *[F.sum(c).cast("bigint").alias(name) for name, c in sums.items()],
    )


def dim_totals(df: DataFrame, flag: Column | str, dp: int = 1) -> DataFrame:
    """One row: count, flagged count, flagged rate."""
    flag = as_column(flag).cast("boolean")
    return df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(flag).alias("survivors"),
        _rate(flag, dp).alias("survival_rate"),
    )


def by_class(df: DataFrame, key: str, flag: Column | str) -> DataFrame:
    flag = as_column(flag).cast("boolean")
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("total"), F.count_if(flag).alias("survivors"))
    return counts.orderBy(key)


def count_rows(df: DataFrame, name: str = "count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def survivors(df: DataFrame, flag: str = "survived") -> DataFrame:
    """Load log figures: rows and flagged rows."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(flag), F.lit(0)).cast("bigint").alias("survivors"))


def max_watermark(df: DataFrame, column: str, name: str = "watermark_value") -> DataFrame:
    return df.agg(F.max(column).alias(name))


def mean_and_share(
    df: DataFrame, keys: Sequence[str], units: Column, share_of: Column, mean: str = "mean", share: str = "share"
) -> DataFrame:
    """Mean of an integer measure and share of rows where a condition holds."""
    known = F.count(share_of)
    return df.groupBy(*keys).agg(
        (F.sum(units).cast("double") / F.count(units)).alias(mean),
        (F.count_if(share_of).cast("double") / known).alias(share),
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "copies") -> DataFrame:
    """Keys that occur more than once; NULL keys do not count as equal."""
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
    return counts.where(F.col(name) > 1)


def histogram(df: DataFrame, column: Column | str, lo: float, hi: float, bins: int) -> DataFrame:
    """Fixed-width bins over values clipped to ``[lo, hi]``; the last bin includes ``hi``.

    Bins without rows are not listed.
    """
    value = as_column(column).cast("double")
    clipped = F.least(F.greatest(value, F.lit(float(lo))), F.lit(float(hi)))
    number = F.least(F.width_bucket(clipped, F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)), F.lit(bins)) - 1
    width = (hi - lo) / bins
    return (
        df.where(value.isNotNull() & ~F.isnan(value))
        .groupBy(number.cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .select(
            "bin",
            (F.lit(float(lo)) + F.col("bin") * F.lit(width)).alias("bin_start"),
            (F.lit(float(lo)) + (F.col("bin") + 1) * F.lit(width)).alias("bin_end"),
            "rows",
        )
    )


def value_range(df: DataFrame, column: str) -> tuple[float, float]:
    """Smallest and largest value, for histograms without a fixed cap."""
    row = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi")).first()
    return row.lo, row.hi


def group_mean(df: DataFrame, keys: Sequence[str], column: Column | str, dp: int = 4, scale: int | None = None) -> DataFrame:
    """Mean per group over known values; groups with no key or no value stay out."""
    rows = df.dropna(subset=list(keys)).where(as_column(column).isNotNull())
    return rows.groupBy(*keys).agg(round_avg(column, dp, own_scale(df, column) if scale is None else scale).alias("mean"))


def top_groups(df: DataFrame, key: str, units: Column, n: int, name: str = "mean") -> DataFrame:
    """The ``n`` groups with the largest mean of an integer measure; ties go to the smaller key."""
    means = df.where(F.col(key).isNotNull()).groupBy(key).agg((F.sum(units).cast("double") / F.count(units)).alias(name))
    return means.orderBy(F.col(name).desc_nulls_last(), key).limit(n)


def city_summary(
    df: DataFrame, keys: Sequence[str], value: Column | str, second: Column | str, dp: int = 1, scale: int = 2
) -> DataFrame:
    """Readings, average, minimum and maximum of one measure and the average of another, per key pair."""
    units = unscaled(value, scale)

    def at_dp(edge: Column) -> Column:
        return from_units(divide_half_up(edge, F.lit(10 ** (scale - dp))), dp)

    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_readings"),
        round_avg(value, dp, scale).alias("avg_value"),
        at_dp(F.min(units)).alias("min_value"),
        at_dp(F.max(units)).alias("max_value"),
        round_avg(second, 0, scale).alias("avg_second"),
    )


def run_trend(
    runs: DataFrame,
    now: Column,
    days: int = 30,
    task: str = "task_id",
    ts: str = "started_at",
    units: Column | None = None,
    failed: Column | None = None,
) -> DataFrame:
    """Per task and day of the trailing window: average and largest duration, runs, failures.

    ``units`` is the duration in whole milliseconds.
    """
    units = unscaled("duration_seconds", 3) if units is None else units
    failed = (F.col("status") == "failed") if failed is None else failed
    return (
        runs.where(since(ts, now, f"{days} days"))
        .groupBy(task, F.date_trunc("day", ts).alias("run_date"))
        .agg(
            (F.sum(units).cast("double") / F.count(units) / 1000).alias("avg_duration_seconds"),
            (F.max(units).cast("double") / 1000).alias("max_duration_seconds"),
            F.count(F.lit(1)).alias("run_count"),
            F.count_if(failed).alias("failure_count"),
        )
    )


def load_counters(events: DataFrame, error: str = "error", inserted: Any = None) -> DataFrame:
    """Processed and invalid events, plus inserted and duplicate ones when ``inserted`` marks them."""
    invalid = F.col(error).isNotNull()
    counters = [F.count(F.lit(1)).alias("processed"), F.count_if(invalid).alias("invalid")]
    if inserted is not None:
        new = as_column(inserted)
        counters += [
            F.count_if(~invalid & new).alias("inserted"),
            F.count_if(~invalid & ~new).alias("duplicates"),
        ]
    return events.agg(*counters)
