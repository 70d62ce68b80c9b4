"""Reconciliation of a table with its source, slice by slice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.shape import union_all
from tidegate.sources.sinks import land


def slice_totals(df: DataFrame, by: Column, measures: Mapping[str, Column]) -> DataFrame:
    """Row count and integer totals per slice."""
    return df.groupBy(by.alias("slice")).agg(
        F.count(F.lit(1)).alias("rows"), *[F.sum(c).cast("bigint").alias(m) for m, c in measures.items()]
    )


def reconcile(
    source: DataFrame,
    landed: DataFrame,
    source_slice: Column,
    landed_slice: Column,
    measures: Mapping[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Counts and totals of both sides per slice, with differences and whether they agree.

    Each side is aggregated first, so the join sees one row per slice. Measures are
    integers (cents), which makes the comparison exact.
    """
    measures = measures or {}
    left = slice_totals(source, source_slice, {m: pair[0] for m, pair in measures.items()})
    right = slice_totals(landed, landed_slice, {m: pair[1] for m, pair in measures.items()})
    names = ["rows", *measures]
    left = left.select("slice", *[F.col(c).alias(f"source_{c}") for c in names])
    right = right.select(F.col("slice").alias("_slice"), *[F.col(c).alias(f"landed_{c}") for c in names])
    both = left.join(right, F.col("slice").eqNullSafe(F.col("_slice")), "full_outer")
    filled = both.select(
        F.coalesce("slice", "_slice").alias("slice"),
        *[F.coalesce(f"{side}_{c}", F.lit(0)).cast("bigint").alias(f"{side}_{c}") for c in names for side in ("source", "landed")],
    )
    gaps = {f"{c}_gap": F.col(f"landed_{c}") - F.col(f"source_{c}") for c in names}
    agree = F.lit(True)
    for gap in gaps:
        agree = agree & (F.col(gap) == 0)
    return filled.withColumns(gaps).withColumn("matches", agree)


# --- down to rows -----------------------------------------------------------

#: Parts of a slice whose digests are compared; a differing row brings the rows of its part into the comparison.
PARTS = 1024


def _digests(df: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Order-free digests: rows, sums of both halves of one row hash, and the XOR of another.

    NULLs count by their place. Sums of 32-bit halves don't overflow below two billion rows a group.
    """
    known = [F.col(c).isNull() for c in columns]
    one, other = F.xxhash64(*columns, *known), F.xxhash64(F.lit(1), *columns, *known)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.shiftrightunsigned(one, 32)).alias("high"), F.sum(one.bitwiseAND(F.lit(0xFFFFFFFF))).alias("low"), F.bit_xor(other).alias("mixed")
    )


def _differing(left: DataFrame, right: DataFrame, by: Sequence[str], columns: Sequence[str], label: str) -> DataFrame:
    """Groups whose digests differ or that one side lacks, landed."""
    sides = union_all(_digests(left, by, columns), _digests(right, by, columns))
    same = sides.groupBy(*by, "n", "high", "low", "mixed").agg(F.count(F.lit(1)).alias("_sides")).where("_sides = 1")
    return land(same.select(*by).distinct(), label)[0]


def _inside(df: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    listed = groups.withColumnsRenamed({c: f"_on_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in by]
    return df.join(listed, same, "left_semi")


def differing_rows(source: DataFrame, landed: DataFrame, key: Sequence[str], slice_by: Column, columns: Sequence[str] | None = None, parts: int = PARTS) -> DataFrame:
    """Every key whose rows differ: ``key, status, source_rows, landed_rows, differing``.

    Three steps, each over less: digests by slice; digests by hash part of the key, in slices that differ only;
    rows, in parts that differ only. Digests are combined before the shuffle, so the only rows that are shuffled are those of
    differing parts. ``slice_by`` is an expression on both sides and had better be a partition column. ``status``
    is ``missing`` (not landed), ``extra`` (not in the source) or ``changed``; the row counts are of the
    rows that the other side lacks, so repeated rows count as often as they are too many. ``differing`` lists the columns of a key
    with one such row on each side. NULL keys are a key. ``columns`` (by default all of the source) must be orderable.
    """
    columns = [c for c in columns or source.columns if c not in key]
    every = [*key, *columns]
    sides = [df.select(*every, slice_by.alias("_slice"), F.pmod(F.xxhash64(*key), F.lit(parts)).alias("_part")) for df in (source, landed)]
    slices = _differing(*sides, ["_slice"], every, "slices")
    sides = [_inside(df, slices, ["_slice"]) for df in sides]
    differing = _differing(*sides, ["_slice", "_part"], every, "parts")
    left, right = (_inside(df, differing, ["_slice", "_part"]).select(*every, F.lit(sign).alias("_side")) for df, sign in zip(sides, (1, -1), strict=True))
    # The two sides cancel out; what is left over differs. A row whose slice moved is the same row.
    excess = union_all(left, right).groupBy(*every).agg(F.sum("_side").alias("_excess")).where("_excess <> 0")
    row = F.struct(*columns)
    mine, theirs = F.col("_excess") > 0, F.col("_excess") < 0
    grouped = excess.groupBy(*key).agg(
        F.coalesce(F.sum(F.when(mine, F.col("_excess"))), F.lit(0)).alias("source_rows"),
        F.coalesce(F.sum(F.when(theirs, -F.col("_excess"))), F.lit(0)).alias("landed_rows"),
        F.max(F.when(mine, row)).alias("_source"),
        F.max(F.when(theirs, row)).alias("_landed"),
    )
    single = (F.col("source_rows") == 1) & (F.col("landed_rows") == 1)
    unlike = F.array_compact(F.array(*[F.when(~F.col(f"_source.{c}").eqNullSafe(F.col(f"_landed.{c}")), F.lit(c)) for c in columns]))
    status = F.when(F.col("landed_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra").otherwise("changed")
    return grouped.select(*key, status.alias("status"), "source_rows", "landed_rows", F.when(single, unlike).alias("differing"))
