"""Window operators whose hot groups are cut into slices.

``order`` columns are ascending and should end with a unique column; results are
then fully determined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.operators.skew import ROWS_PER_SLICE, SLICE, slice_groups


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key.

    The rank filter is applied before the shuffle as well, so each task sends at
    most one row per key however many rows a key has.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    return df.withColumn("_rank", F.row_number().over(newest)).where(F.col("_rank") == 1).drop("_rank")


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Row number within each key, as BIGINT."""
    sliced = slice_groups(df, keys, order, rows_per_slice)
    local = F.row_number().over(Window.partitionBy(*sliced.groups).orderBy(*order)).cast("bigint")
    if sliced.hot is None:
        return sliced.frame.withColumn(name, local).drop(SLICE)
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sliced.hot_summary(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(*sliced.groups, F.sum("_n").over(earlier).alias("_start"))
    return (
        sliced.attach(starts)
        .withColumn(name, local + F.coalesce("_start", F.lit(0)))
        .select(*df.columns, name)
    )


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Value of the row before, per key: ``{new column: source column}``."""
    sliced = slice_groups(df, keys, order, rows_per_slice)
    window = Window.partitionBy(*sliced.groups).orderBy(*order)
    if sliced.hot is None:
        return sliced.frame.withColumns({n: F.lag(c).over(window) for n, c in columns.items()}).drop(SLICE)
    last = F.max_by(F.struct(*[F.col(c).alias(n) for n, c in columns.items()]), F.struct(*order)).alias("_last")
    by_slice = Window.partitionBy(*keys).orderBy(SLICE)
    carried = sliced.hot_summary(last).withColumn("_carry", F.lag("_last").over(by_slice)).drop("_last")
    first = F.row_number().over(window) == 1
    frame = sliced.attach(carried).withColumn("_first", first)
    previous = {
        n: F.when(F.col("_first"), F.col(f"_carry.{n}")).otherwise(F.lag(c).over(window)) for n, c in columns.items()
    }
    return frame.withColumns(previous).select(*df.columns, *columns)


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, str],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Value of the row after, per key: ``{new column: source column}``."""
    sliced = slice_groups(df, keys, order, rows_per_slice)
    window = Window.partitionBy(*sliced.groups).orderBy(*order)
    if sliced.hot is None:
        return sliced.frame.withColumns({n: F.lead(c).over(window) for n, c in columns.items()}).drop(SLICE)
    first = F.min_by(F.struct(*[F.col(c).alias(n) for n, c in columns.items()]), F.struct(*order)).alias("_first")
    by_slice = Window.partitionBy(*keys).orderBy(SLICE)
    carried = sliced.hot_summary(first).withColumn("_carry", F.lead("_first").over(by_slice)).drop("_first")
    frame = sliced.attach(carried).withColumn("_last", F.lead(F.lit(1)).over(window).isNull())
    following = {
        n: F.when(F.col("_last"), F.col(f"_carry.{n}")).otherwise(F.lead(c).over(window)) for n, c in columns.items()
    }
    return frame.withColumns(following).select(*df.columns, *columns)


def with_delta(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    column: str,
    previous: str = "previous_value",
    delta: str = "delta",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Value of the row before and the difference to it."""
    out = with_previous(df, keys, order, {previous: column}, rows_per_slice)
    return out.withColumn(delta, F.col(column) - F.col(previous))


def last_known(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Most recent non-NULL ``value`` at or before each row, per key."""
    sliced = slice_groups(df, keys, order, rows_per_slice)
    window = Window.partitionBy(*sliced.groups).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = F.last(value, ignorenulls=True).over(window)
    if sliced.hot is None:
        return sliced.frame.withColumn(name, local).drop(SLICE)
    newest = F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_newest")
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = sliced.hot_summary(newest).withColumn(
        "_carry", F.last("_newest", ignorenulls=True).over(earlier)
    )
    return (
        sliced.attach(carried.drop("_newest"))
        .withColumn(name, F.coalesce(local, "_carry"))
        .select(*df.columns, name)
    )


def trailing_mean(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    units: Column,
    days: int = 7,
    name: str = "trailing",
) -> DataFrame:
    """Per key and day: this day's count and total, and those of the ``days`` days before it.

    ``units`` is an integer measure. Rows are first reduced to one per key and day,
    so the window only ever sees as many rows per key as there are days.
    """
    daily = df.groupBy(*keys, F.date_trunc("day", ts).alias("day")).agg(
        F.count(units).alias("n"), F.sum(units).alias("total")
    )
    before = (
        Window.partitionBy(*keys)
        .orderBy(F.datediff(F.col("day"), F.lit("1970-01-01").cast("date")))
        .rangeBetween(-days, -1)
    )
    return daily.withColumns({f"{name}_n": F.sum("n").over(before), f"{name}_total": F.sum("total").over(before)})


def assign_ids(
    df: DataFrame, order: Sequence[str], name: str = "id", start: int = 1, rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Consecutive ids over the whole table in ``order``.

    The table is one group cut into slices, so no task numbers more than a slice.
    """
    ids = numbered(df.withColumn("_all", F.lit(0)), ["_all"], order, name, rows_per_slice)
    return ids.withColumn(name, F.col(name) + (start - 1)).drop("_all")
