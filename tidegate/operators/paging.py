"""Sorting, limits and pages."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.operators.aggregates import count_rows
from tidegate.operators.filters import filter_where
from tidegate.operators.ordering import ascending
from tidegate.operators.windows import assign_ids

SHALLOW_ROWS = 100_000
PARTS = 4096


def sort_by(df: DataFrame, *order: str) -> DataFrame:
    """Multi-column sort; a leading ``-`` means descending."""
    return df.orderBy(*[F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order])


def top_recent(df: DataFrame, ts: str, tie: str, n: int, **filters: Any) -> DataFrame:
    """The newest ``n`` rows that pass the filters."""
    return sort_by(filter_where(df, **filters), f"-{ts}", tie).limit(n)


def page(
    df: DataFrame,
    order: Sequence[str],
    limit: int = 20,
    offset: int = 0,
    columns: Sequence[str] | None = None,
    shallow_rows: int = SHALLOW_ROWS,
    **filters: Any,
) -> tuple[DataFrame, DataFrame]:
    """One page and the total of the same filter: ``(rows, total)``.

    ``order`` must be a total order. The two frames are separate queries; skip the
    second when the caller does not need a total. A shallow page keeps ``offset +
    limit`` rows per task; for a deep one the rows are numbered in slices instead, in any
    mix of directions, so that no task holds all the rows before the page.
    """
    rows = filter_where(df, **filters)
    total = count_rows(rows, "total")
    names = [c.removeprefix("-") for c in order]
    columns = list(columns or df.columns)
    rows = rows.select(*dict.fromkeys([*columns, *names]))
    if offset + limit <= shallow_rows:
        return sort_by(rows, *order).offset(offset).limit(limit).select(*columns), total
    keys = ascending(rows, order)
    numbered = assign_ids(rows.withColumns(keys), list(keys), "_number", 0)
    inside = numbered.where(F.col("_number").between(offset, offset + limit - 1))
    return inside.orderBy("_number").select(*columns), total


def page_after(df: DataFrame, key: str, last: Any | None, limit: int, descending: bool = False) -> DataFrame:
    """The page that follows the row with key ``last``: no skipped rows are sorted or moved."""
    if last is not None:
        df = df.where(F.col(key) < F.lit(last)) if descending else df.where(F.col(key) > F.lit(last))
    return sort_by(df, f"-{key}" if descending else key).limit(limit)


def deep_page(
    df: DataFrame, key: str, limit: int, offset: int, descending: bool = False, shallow_rows: int = SHALLOW_ROWS
) -> DataFrame:
    """Page at any offset over a unique integer key; NULL keys have no place in it and are refused.

    Beyond ``shallow_rows`` the key near the offset is found by counting: a range of
    keys is split into equal parts, rows per part are counted, and the part that
    holds the offset is split again. Only the part counts reach the driver.
    """
    position = -F.col(key) if descending else F.col(key)
    lo, hi, unplaced = df.agg(F.min(position), F.max(position), F.count_if(F.col(key).isNull())).first()
    if unplaced:
        raise ValueError(f"{unplaced} rows have no {key}; page over another key")
    remaining = offset
    while lo is not None and lo < hi and remaining > shallow_rows:
        width = (hi - lo) // PARTS + 1
        part = F.call_function("div", position - F.lit(lo), F.lit(width)).cast("bigint")
        inside = df.where(_key_range(key, lo, hi, descending))
        for number, rows in inside.groupBy(part.alias("part")).count().orderBy("part").collect():
            if rows > remaining:
                break
            remaining -= rows
        else:
            return df.limit(0)
        lo, hi = lo + number * width, min(hi, lo + (number + 1) * width - 1)
    if lo is not None:
        df = df.where(F.col(key) <= -lo) if descending else df.where(F.col(key) >= lo)
    return sort_by(df, f"-{key}" if descending else key).offset(remaining).limit(limit)


def _key_range(key: str, lo: int, hi: int, descending: bool) -> Column:
    return F.col(key).between(-hi, -lo) if descending else F.col(key).between(lo, hi)


def head_buckets(df: DataFrame, bucket: str, n: int) -> DataFrame:
    """The first ``n`` time buckets, oldest first."""
    return df.orderBy(bucket).limit(n)
