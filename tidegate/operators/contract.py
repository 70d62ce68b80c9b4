"""Table contracts: columns a table promises, and what changed against the promise."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.quality import Check, run_suite

LISTING = "column_name string, data_type string, is_nullable string, column_default string, ordinal_position int"


class MissingColumns(Exception):
    """A table lacks a column that a model needs."""


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The frame itself, or an error before any job starts."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return df


def column_listing(df: DataFrame) -> DataFrame:
    """Columns in order with type, nullability and default."""
    rows = [
        (f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO", f.metadata.get("CURRENT_DEFAULT"), i)
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return df.sparkSession.createDataFrame(rows, LISTING)


def contract_diff(df: DataFrame, stable: Mapping[str, str]) -> DataFrame:
    """Columns that differ from the contract and whether consumers break."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    rows = []
    for name, kind in stable.items():
        if name not in actual:
            rows.append((name, "removed", kind, None, True))
        elif actual[name] != kind:
            rows.append((name, "type changed", kind, actual[name], True))
    rows += [(name, "added", None, kind, False) for name, kind in actual.items() if name not in stable]
    return df.sparkSession.createDataFrame(
        rows, "column string, change string, promised string, actual string, breaking boolean"
    )


def contract_check(df: DataFrame, name: str, stable: Mapping[str, str], guarantees: Sequence[Check]) -> DataFrame:
    """Schema differences and guarantee results as rows ``(item, problem, breaking, violations)``."""
    changes = contract_diff(df, stable).select(
        F.col("column").alias("item"), F.col("change").alias("problem"), "breaking", F.lit(0).cast("bigint").alias("violations")
    )
    present = [c for c in guarantees if c.column is None or c.column in df.columns]
    if not present:
        return changes
    checks = run_suite(df, name, present).select(
        F.coalesce("column", F.lit("")).alias("item"),
        F.col("check").alias("problem"),
        (~F.col("success")).alias("breaking"),
        F.coalesce("unexpected_count", F.lit(0)).alias("violations"),
    )
    return changes.unionByName(checks)
