"""Table mutation as pure functions: ``(target, change) -> new target``.

Parquet tables take no MERGE, UPDATE or DELETE, so each change is a query over the
old table; :mod:`tidegate.sources.sinks` writes the result. The target is always the
left side of a left, semi or anti join: a small change set is broadcast by Spark and
the target is not shuffled; with a large one a hot key on the target side can be split.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.operators.shape import union_all
from tidegate.operators.windows import latest_per_key

MATCHED = "_matched"


def dedup(df: DataFrame, key: Sequence[str], order: Sequence[str] | None = None) -> DataFrame:
    """One row per key; the last by ``order`` when given, any otherwise.

    Rows with a NULL in the key are all kept, as in a unique index: they pass by the grouping, so nothing
    depends on how rows are numbered or in which order they come.
    """
    key = list(key)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    keyed = df.where(known)
    once = keyed.dropDuplicates(key) if order is None else latest_per_key(keyed, key, order)
    return once.unionByName(df.where(~known))


def new_rows(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """Source rows, one per key, whose key the target lacks: what an insert-only load appends."""
    return dedup(source, key).join(target.select(*key), list(key), "left_anti").select(*source.columns)


def upsert(
    target: DataFrame,
    source: DataFrame,
    key: Sequence[str],
    on_match: str = "update",
    order: Sequence[str] | None = None,
) -> DataFrame:
    """Insert new keys; for known keys take the source's values or keep the row.

    The result has the target's columns. Those the source lacks keep their value on
    update and are NULL on insert.
    ``order`` decides which of several source rows per key counts (the last).

    The source is read three times: one that is costly to compute should be landed
    first (:func:`tidegate.sources.sinks.land`).
    """
    key = list(key)
    source = dedup(source, key, order)
    missing = source.join(_known_keys(target, source, key), key, "left_anti")
    unmatched = missing.select(*[c for c in target.columns if c in source.columns])
    if on_match == "ignore":
        return union_all(target, unmatched)
    if on_match != "update":
        raise ValueError(f"on_match must be 'update' or 'ignore', not {on_match!r}")
    taken = [c for c in source.columns if c in target.columns and c not in key]
    change = source.select(*key, *[F.col(c).alias(f"_new_{c}") for c in taken], F.lit(True).alias(MATCHED))
    updated = target.join(change, key, "left").select(
        *[F.when(F.col(MATCHED), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in taken else F.col(c)
          for c in target.columns]
    )
    return union_all(updated, unmatched)


def _known_keys(target: DataFrame, source: DataFrame, key: list[str]) -> DataFrame:
    """Target keys that the source touches: no more than the source has, so a small source stays small."""
    return target.select(*key).join(source.select(*key), key, "left_semi")


def upsert_counts(target: DataFrame, source: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: source rows, keys inserted, keys matched, repeats inside the source."""
    key = list(key)
    single = dedup(source, key)
    hits = _known_keys(target, single, key).dropDuplicates(key).withColumn(MATCHED, F.lit(True))
    counts = single.join(hits, key, "left").agg(
        F.count(F.lit(1)).alias("keys"), F.count(MATCHED).alias("matched")
    )
    read = source.agg(F.count(F.lit(1)).alias("source_rows"))
    return read.join(F.broadcast(counts), F.lit(True)).select(
        "source_rows",
        (F.col("keys") - F.col("matched")).alias("inserted"),
        "matched",
        (F.col("source_rows") - F.col("keys")).alias("repeats"),
    )


def patch(target: DataFrame, changes: DataFrame, key: str, columns: Sequence[str], set_cols: str = "set_cols") -> DataFrame:
    """Partial update: only the columns a change names are written, an explicit NULL included.

    ``changes`` has one row per key and an array of column names; other columns and
    names outside ``columns`` are ignored.
    """
    columns = [c for c in columns if c in changes.columns]
    change = changes.select(
        key, F.col(set_cols).alias("_set"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    named = {c: F.coalesce(F.array_contains("_set", c), F.lit(False)) for c in columns}
    return target.join(change, key, "left").select(
        *[F.when(named[c], F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in named else F.col(c)
          for c in target.columns]
    )


def fold_patches(changes: DataFrame, key: str, columns: Sequence[str], order: str, set_cols: str = "set_cols") -> DataFrame:
    """Several changes per key as one: each column takes its last named value."""
    touched = {c: F.array_contains(set_cols, c) for c in columns}
    folded = changes.groupBy(key).agg(
        *[F.max_by(c, F.when(touched[c], F.col(order))).alias(c) for c in columns],
        *[F.max(F.coalesce(touched[c], F.lit(False))).alias(f"_has_{c}") for c in columns],
    )
    names = F.array_compact(F.array(*[F.when(F.col(f"_has_{c}"), F.lit(c)) for c in columns]))
    return folded.select(key, *columns, names.alias(set_cols))


def delete_keys(target: DataFrame, keys: DataFrame, on: str | Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """``(kept, deleted)`` for a set of keys."""
    kept, deleted = target.join(keys, on, "left_anti"), target.join(keys, on, "left_semi")
    return kept.select(*target.columns), deleted.select(*target.columns)


def delete_where(target: DataFrame, condition: str) -> tuple[DataFrame, DataFrame]:
    """``(kept, deleted)`` for a predicate; rows where it is NULL are kept."""
    hit = F.coalesce(F.expr(condition), F.lit(False))
    return target.where(~hit), target.where(hit)


def seed(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """Add literal rows once, however often it is repeated."""
    return union_all(target, new_rows(target, rows, key))
