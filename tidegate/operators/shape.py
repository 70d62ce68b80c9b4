"""Projections and schema shaping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidegate.functions.scalars import whole

WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def keep(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed columns that exist, in list order."""
    return df.select(*[c for c in columns if c in df.columns])


def align(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """All columns of ``layout`` in order; absent ones are typed NULLs."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(None).cast(t).alias(c) for c, t in layout.items()])


def _typed(df: DataFrame, column: str, kind: str) -> Column:
    """The column in its new type; text such as ``2.0`` is a whole number."""
    from_text = isinstance(df.schema[column].dataType, T.StringType) and kind in WHOLE_TYPES
    return whole(column, kind) if from_text else F.col(column).try_cast(kind)


def conform(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """Align and cast; a value that does not fit its type becomes NULL, and :func:`conform_rejects` has its row."""
    aligned = align(df, layout)
    return aligned.select(*[_typed(aligned, c, t).alias(c) for c, t in layout.items()])


def misfits(df: DataFrame, layout: Mapping[str, str]) -> Column:
    """Names of the columns whose value does not fit the type that ``layout`` gives it."""
    lost = [F.when(F.col(c).isNotNull() & _typed(df, c, t).isNull(), F.lit(c)) for c, t in layout.items() if c in df.columns]
    return F.array_compact(F.array(*lost))


def conform_rejects(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """The rows of which :func:`conform` would make a value NULL, as they came, with ``misfits``."""
    return compute_once(df, {"misfits": misfits(df, layout)}).where(F.size("misfits") > 0)


def ensure_columns(df: DataFrame, layout: Mapping[str, str]) -> DataFrame:
    """Add the columns of ``layout`` that ``df`` lacks, as NULLs."""
    return df.withColumns({c: F.lit(None).cast(t) for c, t in layout.items() if c not in df.columns})


def duplicate(df: DataFrame, copies: Mapping[str, str]) -> DataFrame:
    """Copy columns under second names: ``{new: existing}``."""
    return df.withColumns({new: F.col(old) for new, old in copies.items()})


def fill(df: DataFrame, defaults: Mapping[str, Any]) -> DataFrame:
    """Defaults for NULL or absent fields."""
    return df.withColumns(
        {c: F.coalesce(F.col(c), F.lit(v)) if c in df.columns else F.lit(v) for c, v in defaults.items()}
    )


def with_audit(df: DataFrame, now: Column, columns: Sequence[str] = ("loaded_at",)) -> DataFrame:
    """Load stamps; ``now`` is passed in so that reruns give equal rows."""
    return df.withColumns({c: now for c in columns})


def compute_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add costly columns so that they are evaluated once per row.

    A filter on a projected column is moved below the projection and takes a copy of
    its expression along for every use. A generator with one output row stops that.
    """
    values = F.struct(*[c.alias(name) for name, c in columns.items()])
    return df.select("*", F.inline(F.array(values)))


def label_cols(df: DataFrame, name: str, prefix: str, parts: Sequence[str]) -> DataFrame:
    """Chart label such as ``Class 1 female``."""
    return df.withColumn(name, F.concat_ws(" ", F.lit(prefix), *[F.col(p).cast("string") for p in parts]))


def hour_label(ts: str) -> Column:
    """Hour of day as ``07h``."""
    return F.concat(F.date_format(ts, "HH"), F.lit("h"))


def union_all(left: DataFrame, right: DataFrame) -> DataFrame:
    return left.unionByName(right, allowMissingColumns=True)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    first, *rest = frames
    for frame in rest:
        first = union_all(first, frame)
    return first
