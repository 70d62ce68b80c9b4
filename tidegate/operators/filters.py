"""Filters and predicates."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

COMPARISONS = {"eq": operator.eq, "gte": operator.ge, "lte": operator.le, "gt": operator.gt, "lt": operator.lt}


def _holds(df: DataFrame, column: str, rule: str) -> Column:
    """The rule as a two-valued predicate; NULL and NaN do not satisfy it."""
    kept = F.expr(rule)
    if dict(df.dtypes)[column] in ("double", "float"):
        kept = kept & ~F.isnan(column)
    return kept


def _present(df: DataFrame, rules: Mapping[str, str]) -> dict[str, Column]:
    return {c: _holds(df, c, rule) for c, rule in rules.items() if c in df.columns}


def clean(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows that satisfy every rule; a rule whose column is absent is skipped."""
    return reduce(lambda out, rule: out.where(rule), _present(df, rules).values(), df)


def rejected(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows :func:`clean` drops, with the names of the rules each one breaks."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(c)) for c, ok in _present(df, rules).items()]
    if not broken:
        return df.withColumn("failed_rules", F.array().cast("array<string>")).where(F.lit(False))
    return df.withColumn("failed_rules", F.array_compact(F.array(*broken))).where(F.size("failed_rules") > 0)


def clean_report(df: DataFrame, rules: Mapping[str, str]) -> DataFrame:
    """Rows read and rows broken per rule, in one pass: ``(rule, total_rows, failed_rows)``."""
    present = _present(df, rules)
    counts = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(~F.coalesce(ok, F.lit(False))).alias(c) for c, ok in present.items()],
    )
    pairs = [F.struct(F.lit(c).alias("rule"), F.col(c).alias("failed_rows")) for c in present]
    return counts.select("total_rows", F.inline(F.array(*pairs))).select("rule", "total_rows", "failed_rows")


def filter_incremental(df: DataFrame, column: str, watermark: Any | None, lookback: str | None = None) -> DataFrame:
    """Rows strictly above the mark, or all rows when there is none.

    ``lookback`` (an interval) reads that far below the mark again; the keyed
    upsert behind it makes the repeat harmless.
    """
    if watermark is None:
        return df
    return df.where(F.col(column) > _mark(df, column, watermark, lookback))


def late_rows(df: DataFrame, column: str, watermark: Any | None) -> DataFrame:
    """Rows at or below the mark, which the incremental filter leaves out."""
    if watermark is None:
        return df.where(F.lit(False))
    return df.where(F.col(column) <= _mark(df, column, watermark))


def _mark(df: DataFrame, column: str, watermark: Any, lookback: str | None = None) -> Column:
    """The mark as a literal of the column's own type, so the predicate reaches the scan."""
    mark = (watermark if isinstance(watermark, Column) else F.lit(watermark)).cast(df.schema[column].dataType)
    return mark if lookback is None else mark - F.expr(f"interval {lookback}")


def filter_where(df: DataFrame, **options: Any) -> DataFrame:
    """Conjunction of the given options; None or empty text adds no predicate.

    ``filter_where(df, sex="male", fare__gte=5, fare__lte=None)``
    """
    for option, value in options.items():
        if value is not None and value != "":
            column, _, comparison = option.partition("__")
            df = df.where(COMPARISONS[comparison or "eq"](F.col(column), F.lit(value)))
    return df


def by_key(df: DataFrame, key: str, value: Any) -> DataFrame:
    return df.where(F.col(key) == F.lit(value))


def in_values(df: DataFrame, column: str, values: Sequence[Any]) -> DataFrame:
    """Membership in a short list; use :func:`in_table` for a set held as a table."""
    return df.where(F.col(column).isin(list(values)))


def in_table(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_semi").select(*df.columns)


def not_in_table(df: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> DataFrame:
    return df.join(keys, on, "left_anti").select(*df.columns)


def between(df: DataFrame, column: str, lo: Any | None, hi: Any | None) -> DataFrame:
    """Inclusive range; applies only when both ends are given."""
    return df if lo is None or hi is None else df.where(F.col(column).between(lo, hi))


def like(df: DataFrame, column: str, pattern: str) -> DataFrame:
    return df.where(F.col(column).like(pattern))


def require(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with no NULL (or NaN) in the listed columns."""
    return df.dropna(how="any", subset=list(columns))
