"""Rollups as mergeable partial states: kept per slice, merged when read.

A state row holds what can be merged without the rows behind it: counts, totals in units, and two
sketches. Any coarser time unit and any subset of the keys is a merge of the same states, so a late
row costs a new state of its slice, not a new rollup.

Counts, sums and averages are exact: the result equals that of a rollup over all rows. Distinct
counts come from HyperLogLog sketches of ``2**LG`` registers (relative standard error about
``1.04 / sqrt(2**LG)``, 0.8 % here) and quantiles from KLL sketches of size ``KLL`` (rank error about 1.3 % at 200).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.scalars import as_column, from_units, mean_of_units, unscaled

LG, KLL = 14, 200


@dataclass(frozen=True)
class Rollup:
    """What is kept of a table.

    ``averages`` are ``{name: (column, scale)}`` with the decimals that the column carries, ``sums`` integer columns,
    ``distinct`` columns to count once each, ``quantiles`` ``{name: (column, scale)}``.
    """

    ts: str
    unit: str = "hour"
    keys: Sequence[str] = ()
    averages: Mapping[str, tuple[Column | str, int]] = field(default_factory=dict)
    sums: Mapping[str, Column | str] = field(default_factory=dict)
    distinct: Mapping[str, Column | str] = field(default_factory=dict)
    quantiles: Mapping[str, tuple[Column | str, int]] = field(default_factory=dict)
    count: str = "total_trips"

    def states(self, df: DataFrame, slice_column: str | None = None) -> DataFrame:
        """One row per slice, time bucket and key; rows without a time stay out."""
        by = [F.date_trunc(self.unit, self.ts).alias("bucket"), *self.keys, *([slice_column] if slice_column else [])]
        kept = [F.count(F.lit(1)).alias("n_rows")]
        for name, (c, scale) in self.averages.items():
            kept += [F.sum(unscaled(c, scale)).alias(f"{name}_units"), F.count(as_column(c)).alias(f"{name}_n")]
        kept += [F.sum(as_column(c)).cast("bigint").alias(f"{name}_sum") for name, c in self.sums.items()]
        kept += [F.hll_sketch_agg(as_column(c), LG).alias(f"{name}_hll") for name, c in self.distinct.items()]
        kept += [F.kll_sketch_agg_bigint(unscaled(c, scale), KLL).alias(f"{name}_kll") for name, (c, scale) in self.quantiles.items()]
        return df.where(F.col(self.ts).isNotNull()).groupBy(*by).agg(*kept)

    def read(self, states: DataFrame, unit: str | None = None, keys: Sequence[str] | None = None, places: int = 2, ranks: Mapping[str, float] | None = None) -> DataFrame:
        """Merge states to ``unit`` (the same or a coarser one) and a subset of the keys.

        ``ranks`` gives the rank of each quantile, by default the median. Groups in which a quantile's column has no
        value get NULL for it.
        """
        unit, keys, ranks = unit or self.unit, self.keys if keys is None else keys, ranks or {}
        sums = [F.sum("n_rows").alias(self.count)]
        for name in self.averages:
            sums += [F.sum(f"{name}_units").alias(f"{name}_units"), F.sum(f"{name}_n").alias(f"{name}_n")]
        sums += [F.sum(f"{name}_sum").alias(name) for name in self.sums]
        sums += [F.hll_sketch_estimate(F.hll_union_agg(f"{name}_hll")).alias(name) for name in self.distinct]
        sums += [F.kll_merge_agg_bigint(f"{name}_kll").alias(f"{name}_kll") for name in self.quantiles]
        merged = states.groupBy(F.date_trunc(unit, "bucket").alias(unit), *keys).agg(*sums)
        middle = {
            name: F.when(F.kll_sketch_get_n_bigint(f"{name}_kll") > 0, from_units(F.kll_sketch_get_quantile_bigint(f"{name}_kll", F.lit(ranks.get(name, 0.5))), scale))
            for name, (_, scale) in self.quantiles.items()
        }
        means = {name: mean_of_units(F.col(f"{name}_units"), F.col(f"{name}_n"), places, scale) for name, (_, scale) in self.averages.items()}
        shown = [unit, *keys, self.count, *self.averages, *self.sums, *self.distinct, *self.quantiles]
        return merged.withColumns(means | middle).select(*shown)
