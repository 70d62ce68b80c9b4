"""Splitting hot groups for operators that need row order inside a group.

A window over ``partitionBy(key)`` sends every row of a key to one task. Where one
key holds a large share of a table, :func:`slice_groups` cuts that key's rows into
consecutive ranges of the order columns. The operators then work per
``(key, slice)`` and carry one small summary row per slice across the cuts, so the
result is the same as over the whole group.

Hot keys are those whose counted rows exceed a slice. Their cut points come from a
sample of those keys' rows, put in order on the executors and landed, so retries see
the same cuts. They only decide where to cut, never what the result is.
"""

from __future__ import annotations

import bisect
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.sources.sinks import land

SLICE = "_slice"
ROWS_PER_SLICE = 2_000_000
#: Slices of a whole table; beyond ``MOST_SLICES * ROWS_PER_SLICE`` rows the slices grow, so the table of cuts doesn't.
MOST_SLICES = 100_000
#: Sampled rows per slice; the cuts are every so many of them.
SAMPLED = 8


@dataclass(frozen=True)
class Sliced:
    """A frame with a slice number per row, and the keys that were cut (None when none was)."""

    frame: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: DataFrame | None

    @property
    def groups(self) -> list[str]:
        return [*self.keys, SLICE]

    def hot_summary(self, *aggregates: Column) -> DataFrame:
        """One row per slice of the cut keys. At most one row per cut point, so it is small."""
        rows = _match(self.frame, self.hot.select(*self.keys), self.keys, "left_semi")
        return rows.groupBy(*self.groups).agg(*aggregates)

    def attach(self, summary: DataFrame) -> DataFrame:
        """Join per-slice values back; the summary is bounded by the cut points, so it is broadcast."""
        return _match(self.frame, summary, self.groups, "left")


def _match(df: DataFrame, small: DataFrame, on: Sequence[str], how: str) -> DataFrame:
    """Broadcast join on keys that may be NULL."""
    renamed = F.broadcast(small.withColumnsRenamed({c: f"_on_{c}" for c in on}))
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return df.join(renamed, same, how).drop(*[f"_on_{c}" for c in on])


def slice_groups(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_slice: int = ROWS_PER_SLICE) -> Sliced:
    """Number the rows of hot keys by consecutive ranges of ``order`` (ascending).

    ``order`` should be a total order (end it with a unique column): rows equal on
    all of it stay in one slice. Keys of up to ``rows_per_slice`` rows are left whole.
    A table no larger than that as a whole costs one row count and nothing else.
    """
    keys, order = tuple(keys), tuple(order)
    table = _cut_table(df, keys, order, rows_per_slice)
    if table is None:
        return Sliced(df.withColumn(SLICE, F.lit(0)), keys, order, None)
    position = F.struct(*[F.col(c) for c in order])
    found = _match(df, table, keys, "left").withColumn("_block", _cuts_passed(F.col("_heads"), position))
    width = F.size(F.element_at("_blocks", 1))
    inside = _cuts_passed(F.element_at("_blocks", F.col("_block")), position)
    number = F.when(F.col("_block") > 0, (F.col("_block") - 1) * width + inside).otherwise(0).cast("int")
    return Sliced(found.withColumn(SLICE, number).drop("_heads", "_blocks", "_block"), keys, order, table)


def _cuts_passed(cuts: Column, position: Column) -> Column:
    """How many of the ascending cut points are at or below the position; NULL cuts count as none."""
    return F.when(cuts.isNotNull(), F.size(F.filter(cuts, lambda cut: cut <= position))).otherwise(0)


def _null_first(values: tuple) -> tuple:
    return tuple((v is not None, v) for v in values)


def _cut_table(df: DataFrame, keys: tuple, order: tuple, rows_per_slice: int) -> DataFrame | None:
    """Cut points of the hot keys, or None if there are none.

    Two levels, so that finding a slice takes about 2*sqrt(n) comparisons. At most
    ``MOST_SLICES`` keys are hot, and about as many cuts are made in all.
    """
    total = df.count()
    if total <= rows_per_slice:
        return None
    rows_per_slice = max(rows_per_slice, total // MOST_SLICES)
    hot, n = land(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_slice).select(*keys), "hot")
    if not n:
        return None
    rate = min(1.0, SAMPLED / rows_per_slice)
    sample = _match(df.select(*keys, F.struct(*order).alias("_at")), hot, keys, "left_semi").where(F.rand(17) < rate)
    every = max(1, round(rows_per_slice * rate))
    points = sample.groupBy(*keys).agg(F.sort_array(F.collect_list("_at")).alias("_at")).where(F.size("_at") > every)
    picked = F.transform(F.sequence(F.lit(every), F.size("_at") - 1, F.lit(every)), lambda i: F.get("_at", i))
    cuts = points.select(*keys, F.array_distinct(picked).alias("_cuts"))
    width = F.ceil(F.sqrt(F.size("_cuts"))).cast("int")
    starts = F.sequence(F.lit(1), F.size("_cuts"), width)
    blocks = cuts.select(*keys, F.transform(starts, lambda i: F.slice("_cuts", i, width)).alias("_blocks"))
    table, n = land(blocks.select(*keys, F.transform("_blocks", lambda b: F.get(b, F.lit(0))).alias("_heads"), "_blocks"), "cuts")
    return table if n else None


def slice_of(points: Sequence[tuple], position: tuple) -> int:
    """Plain statement of the slice rule: how many cut points are at or below the position."""
    return bisect.bisect_right([_null_first(p) for p in points], _null_first(position))
