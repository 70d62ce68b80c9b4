"""Data quality of a stream, as a stream: windows chained after windows.

Tumbling windows count events, invalid events and NULLs. A sliding window over those small rows then holds each of them
next to the windows before it, so a sudden rise of NULLs shows against its own recent past. Both aggregations
keep their state in the checkpoint and emit a window once, in append mode, when the watermark has passed it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def window_counts(checked: DataFrame, ts: str, size: str, watched: Sequence[str], delay: str | None = None) -> DataFrame:
    """``window, events, invalid, null_<column>`` per tumbling window. ``delay`` is how late a row of a stream may be."""
    rows = checked if delay is None else checked.withWatermark(ts, delay)
    nulls = [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in watched]
    return rows.groupBy(F.window(ts, size)).agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("error").isNotNull()).alias("invalid"), *nulls)


def with_baseline(counts: DataFrame, span: str, size: str, measures: Sequence[str]) -> DataFrame:
    """Each window's counts and, as ``before_<measure>``, their sums over the windows before it within ``span``.

    ``span`` includes the window itself and is a multiple of ``size``. Windows without events have no row.
    """
    own = F.struct(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *measures)
    trailing = counts.groupBy(F.window(F.window_time("window"), span, size).alias("trailing")).agg(
        F.max(own).alias("own"), *[F.sum(m).alias(f"total_{m}") for m in measures]
    )
    # Of the sliding windows that a tumbling window lies in, the one that ends with it.
    return trailing.where(F.col("own.end") == F.col("trailing.end")).select(
        F.col("own.start").alias("window_start"),
        F.col("own.end").alias("window_end"),
        *[F.col(f"own.{m}").alias(m) for m in measures],
        *[(F.col(f"total_{m}") - F.col(f"own.{m}")).alias(f"before_{m}") for m in measures],
    )


def spike(nulls: str, factor: int, least: int) -> Column:
    """More than ``factor`` times the share before, and at least ``least`` NULLs; NULL while there is nothing before."""
    now, before = F.col(f"null_{nulls}"), F.col(f"before_null_{nulls}")
    risen = now * F.col("before_events") > before * factor * F.col("events")
    return F.when(F.col("before_events") > 0, risen & (now >= least))


def null_spikes(
    checked: DataFrame, ts: str, watched: Sequence[str], size: str, span: str, factor: int = 3, least: int = 5, delay: str | None = None
) -> DataFrame:
    """Per window: counts, those of the trailing span before it, and ``spike_<column>`` for every watched column.

    The same function serves batch and streaming frames; a stream has to be written in append mode.
    """
    measures = ["events", "invalid", *[f"null_{c}" for c in watched]]
    found = with_baseline(window_counts(checked, ts, size, watched, delay), span, size, measures)
    return found.withColumns({f"spike_{c}": spike(c, factor, least) for c in watched})
