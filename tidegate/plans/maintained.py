"""Rollup tables kept up to date slice by slice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.operators.rollups import Rollup
from tidegate.plans.loads import merge_slices
from tidegate.sources import sinks


def build(spark: SparkSession, source: str, states: str, rollup: Rollup, slice_column: str) -> None:
    """States of a whole partitioned table."""
    sinks.append(rollup.states(spark.read.parquet(source), slice_column), states, [slice_column])


def refresh(spark: SparkSession, source: str, states: str, rollup: Rollup, slice_column: str, touched: DataFrame) -> None:
    """Make the states of the ``touched`` slices anew; no other slice of the table or of the states is read or written.

    Slices that the table no longer has lose their states. Running it again changes nothing.
    """
    table = spark.read.parquet(source)
    fresh = rollup.states(sinks.in_slices(table, touched, slice_column), slice_column)
    sinks.remove(spark, sinks.replace_slices(fresh, states, slice_column, touched))


def merge_and_refresh(df: DataFrame, source: str, states: str, key: Sequence[str], rollup: Rollup, slice_column: str, **merge) -> None:
    """Upsert rows into a partitioned table, late ones included, and bring its rollup up to date.

    Should the driver be lost in between, :func:`stale_slices` names the slices that are left to refresh.
    """
    touched = merge_slices(df, source, key, slice_column, **merge)
    refresh(df.sparkSession, source, states, rollup, slice_column, touched)


def stale_slices(spark: SparkSession, source: str, states: str, slice_column: str) -> DataFrame:
    """Slices whose files are newer than those of their states, or that only one side has.

    Looks at file times alone: no column of the rows is read.
    """
    sides = []
    for path, name in ((source, "_source"), (states, "_state")):
        rows = spark.read.parquet(path).select(slice_column, F.col("_metadata.file_modification_time").alias("_at"))
        sides.append(rows.groupBy(F.col(slice_column).alias(name + "_slice")).agg(F.max("_at").alias(name)))
    both = sides[0].join(sides[1], F.col("_source_slice").eqNullSafe(F.col("_state_slice")), "full_outer")
    old = F.col("_source").isNull() | F.col("_state").isNull() | (F.col("_source") > F.col("_state"))
    return sinks.land(both.where(old).select(F.coalesce("_source_slice", "_state_slice").alias(slice_column)), "stale")[0]
