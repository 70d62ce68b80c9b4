"""Versioned (type 2) dimensions: merge, reads and point-in-time joins.

A version is valid from ``valid_from`` up to, not including, ``valid_to``; an open
version has a NULL ``valid_to``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.hashing import attr_hash, row_hash
from tidegate.functions.scalars import open_end
from tidegate.operators.skew import ROWS_PER_SLICE
from tidegate.operators.windows import last_known, numbered

# Bookkeeping columns of a versioned table.
VERSION_COLUMNS = {
    "surrogate_key": "string",
    "valid_from": "timestamp",
    "valid_to": "timestamp",
    "is_current": "boolean",
    "change_reason": "string",
    "record_hash": "string",
    "created_at": "timestamp",
    "updated_at": "timestamp",
}
HASHES = {"json": row_hash, "md5_concat": attr_hash}


def _versions(src: DataFrame, key: str, attrs: Sequence[str], start: Column, now: Column, hash_name: str) -> DataFrame:
    """Source rows as open versions starting at ``start``."""
    return src.select(
        F.sha2(F.concat_ws("|", F.col(key).cast("string"), start.cast("string")), 256).alias("surrogate_key"),
        key,
        *attrs,
        start.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.lit(None).cast("string").alias("change_reason"),
        HASHES[hash_name](attrs).alias("record_hash"),
        now.alias("created_at"),
        now.alias("updated_at"),
    )


def scd2_start(
    src: DataFrame, key: str, attrs: Sequence[str], effective_from: Column, now: Column | None = None, hash: str = "json"
) -> DataFrame:
    """First load of a dimension: every source row is an open version."""
    start = effective_from.cast("timestamp")
    return _versions(src, key, attrs, start, start if now is None else now, hash)


def scd2_merge(
    dim: DataFrame,
    src: DataFrame,
    key: str,
    attrs: Sequence[str],
    effective_from: Column,
    now: Column | None = None,
    hash: str = "json",
    reason: str | None = None,
) -> DataFrame:
    """Close changed versions, open new ones, leave the rest alone.

    ``src`` must hold each key once and no NULL key; anything else fails when the result
    is computed, as it would leave a key with two current versions. Keys missing from it
    stay current.

    The dimension is read on the left of one join with the source, so a source small
    enough to broadcast leaves the dimension unshuffled. Each row then yields itself,
    closed if its attributes changed, plus the new version in that case. Keys without
    a current version come from an anti join against the touched keys only.
    """
    start = effective_from.cast("timestamp")
    stamp = start if now is None else now
    incoming = _versions(src, key, attrs, start, stamp, hash)
    if reason is not None:
        incoming = incoming.withColumn("change_reason", F.lit(reason))
    columns = dim.columns
    fresh = incoming.select(key, F.struct(*[_field(incoming, c) for c in columns]).alias("_new"))
    once = fresh.groupBy(key).agg(F.first("_new").alias("_new"), F.count(F.lit(1)).alias("_rows"))
    fine = (F.col("_rows") == 1) & F.col(key).isNotNull()
    fresh = once.select(key, F.when(fine, F.col("_new")).otherwise(F.raise_error(F.lit("source key is NULL or repeated"))).alias("_new"))

    current = F.col("is_current") & (F.col("_key") == F.col(key))
    joined = dim.join(fresh.withColumnRenamed(key, "_key"), current, "left")
    changed = F.coalesce(F.col("record_hash") != F.col("_new.record_hash"), F.lit(False))
    closing = {"valid_to": start, "is_current": F.lit(False), "updated_at": stamp}
    old = F.struct(
        *[F.when(changed, closing[c]).otherwise(F.col(c)).alias(c) if c in closing else F.col(c) for c in columns]
    )
    carried = joined.select(F.inline(F.when(changed, F.array(old, F.col("_new"))).otherwise(F.array(old))))

    touched = dim.where("is_current").select(key).join(src.select(key), key, "left_semi")
    added = fresh.join(touched, key, "left_anti").select("_new.*")
    return carried.unionByName(added)


def _field(incoming: DataFrame, column: str) -> Column:
    return F.col(column) if column in incoming.columns else F.lit(None).alias(column)


def scd2_current(dim: DataFrame) -> DataFrame:
    """Open versions, with the start named ``effective_from``."""
    hidden = ("valid_to", "is_current", "change_reason", "record_hash", "updated_at")
    return dim.where("is_current").drop(*hidden).withColumnRenamed("valid_from", "effective_from")


def scd2_history(dim: DataFrame, key: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """All versions with their number per key and a far-future end for the open one."""
    ordered = numbered(dim, [key], ["valid_from", "surrogate_key"], "version_number", rows_per_slice)
    return ordered.withColumn("valid_until", open_end("valid_to")).drop(
        "valid_to", "record_hash", "created_at", "updated_at"
    )


def scd2_as_of(dim: DataFrame, at: Column) -> DataFrame:
    """The versions valid at a moment."""
    open_or_later = F.col("valid_to").isNull() | (F.col("valid_to") > at)
    return dim.where((F.col("valid_from") <= at) & open_or_later)


def as_of_join(
    fact: DataFrame,
    dim: DataFrame,
    key: tuple[str, str],
    ts: str,
    attrs: Sequence[str],
    fact_id: str,
    short_histories: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Facts with the attributes of the version valid at their time (NULL when there is none).

    ``key`` names the key in the fact and in the dimension; ``fact_id`` is unique in
    the fact. Versions of a key must not overlap.

    Facts and versions are merged by time: each fact takes the last version started at
    or before it, so no fact meets more than one version. A caller who knows that keys
    have few versions may say ``short_histories``: then an equi-join on the key with the
    validity range as a filter does the work, and a small dimension is broadcast. The
    caller chooses; no size is looked at.
    """
    fact_key, dim_key = key
    if short_histories:
        return _range_join(fact, dim, fact_key, dim_key, ts, attrs)
    return _merge_by_time(fact, dim, fact_key, dim_key, ts, attrs, fact_id, rows_per_slice)


def _range_join(fact, dim, fact_key, dim_key, ts, attrs) -> DataFrame:
    versions = dim.select(
        F.col(dim_key).alias("_key"), F.col("valid_from").alias("_from"), F.col("valid_to").alias("_to"), *attrs
    )
    valid = (
        (F.col(fact_key) == F.col("_key"))
        & (F.col("_from") <= F.col(ts))
        & (F.col("_to").isNull() | (F.col("_to") > F.col(ts)))
    )
    return fact.join(versions, valid, "left").drop("_key", "_from", "_to")


def _merge_by_time(fact, dim, fact_key, dim_key, ts, attrs, fact_id, rows_per_slice) -> DataFrame:
    version = F.struct(F.col("valid_to").alias("_to"), *attrs)
    clock = fact.schema[ts].dataType
    versions = dim.select(
        F.col(dim_key).alias("_key"),
        F.col("valid_from").cast(clock).alias("_at"),
        F.lit(0).alias("_kind"),
        F.lit(None).cast(fact.schema[fact_id].dataType).alias("_id"),
        version.alias("_version"),
    )
    facts = fact.select(
        F.col(fact_key).alias("_key"),
        F.col(ts).alias("_at"),
        F.lit(1).alias("_kind"),
        F.col(fact_id).alias("_id"),
        F.struct(*fact.columns).alias("_fact"),
    )
    both = versions.unionByName(facts, allowMissingColumns=True)
    found = last_known(both, ["_key"], ["_at", "_kind", "_id"], "_version", "_last", rows_per_slice)
    valid = F.col("_key").isNotNull() & (F.col("_last._to").isNull() | (F.col("_last._to") > F.col("_at")))
    return found.where(F.col("_kind") == 1).select(
        "_fact.*", *[F.when(valid, F.col(f"_last.{c}")).alias(c) for c in attrs]
    )


def lookup(df: DataFrame, code: str, table: DataFrame, table_code: str, columns: Sequence[str]) -> DataFrame:
    """Labels from a lookup table; Spark broadcasts the table while its size allows."""
    labels = table.select(F.col(table_code).alias("_code"), *columns)
    return df.join(labels, F.col(code) == F.col("_code"), "left").drop("_code")
