"""Versioned dimensions from a change log: any number of changes per key, in any order of arrival.

The log keeps every change with its time; the versions of a key are a fold of its part of the log. So a
load may hold several changes of a key, or late ones that fall between or before existing versions: they cut
the version they fall into at their start, and ends are chained anew. Because changes that
repeat the state of their time stay in the log, the versions do not depend on how the changes were
divided into loads or in which order these came.

Of changes of one key at one time the largest ``seq`` counts (then deletion, then the row hash). A
deletion ends the version and opens none.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.functions.hashing import row_hash
from tidegate.operators.history import HASHES
from tidegate.operators.shape import union_all
from tidegate.operators.skew import ROWS_PER_SLICE, slice_groups
from tidegate.operators.windows import with_next, with_previous
from tidegate.sources.sinks import land

#: Sequence number of the changes that stand for a dimension's existing versions: any other change at their time wins.
BASE_SEQ = -1
#: Touched keys that a broadcast holds. With more of them the other keys are listed as well, and joins take the shorter list.
FEW_KEYS = 500_000
LOG_COLUMNS = ("effective_at", "seq", "deleted", "change_hash")


@dataclass(frozen=True)
class Applied:
    """The new dimension, the rows to append to the log, and changes without a key or a time."""

    dim: DataFrame
    added: DataFrame
    refused: DataFrame


def to_log(src: DataFrame, key: str, attrs: Sequence[str], effective_at: Column, seq: Column, deleted: Column | None = None) -> DataFrame:
    """Changes as log rows; ``seq`` is 0 or more and orders changes of one key at one time."""
    gone = F.lit(False) if deleted is None else F.coalesce(deleted, F.lit(False))
    fields = src.withColumns({"_gone": gone, "_at": effective_at.cast("timestamp"), "_seq": seq.cast("bigint")})
    rows = fields.select(
        key, *[F.when(~F.col("_gone"), F.col(a)).alias(a) for a in attrs], F.col("_at").alias("effective_at"), F.col("_seq").alias("seq"), F.col("_gone").alias("deleted")
    )
    return rows.withColumn("change_hash", row_hash([key, *attrs, "effective_at", "seq", "deleted"]))


def log_of(dim: DataFrame, key: str, attrs: Sequence[str]) -> DataFrame:
    """The log that gives an existing dimension: its starts, and its ends that no version follows."""
    starts = to_log(dim, key, attrs, F.col("valid_from"), F.lit(BASE_SEQ))
    follows = dim.select(F.col(key).alias("_key"), F.col("valid_from").alias("_from"))
    ends = dim.where("valid_to IS NOT NULL").join(follows, (F.col(key) == F.col("_key")) & (F.col("valid_to") == F.col("_from")), "left_anti")
    return union_all(starts, to_log(ends, key, attrs, F.col("valid_to"), F.lit(BASE_SEQ), F.lit(True)))


def versions_from(log: DataFrame, key: str, attrs: Sequence[str], hash: str = "json", rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """``key, attrs, valid_from, valid_to, record_hash`` of a whole log.

    Hot keys are cut into time ranges, so no task holds all changes of a key.
    """
    hashed = log.withColumn("record_hash", F.when(~F.col("deleted"), HASHES[hash](attrs)))
    # Rows with one JSON hash have the same attributes, so nothing is left for the change hash to decide, and it isn't shuffled.
    ties = [] if hash == "json" else ["change_hash"]
    last = F.max(F.struct("seq", "deleted", "record_hash", *ties, *attrs)).alias("_last")
    one = hashed.groupBy(key, "effective_at").agg(last).select(key, "effective_at", "_last.deleted", "_last.record_hash", *[f"_last.{a}" for a in attrs])
    stated = land(one.withColumn("_state", F.coalesce("record_hash", F.lit(""))), "changes")[0]
    unlike = F.col("_state") != F.coalesce("_before", F.lit(""))
    if slice_groups(stated, [key], ["effective_at"], rows_per_slice).hot is None:
        # No key is cut, so both windows share one shuffle.
        times = Window.partitionBy(key).orderBy("effective_at")
        moved = stated.withColumn("_before", F.lag("_state").over(times)).where(unlike).drop("_before", "_state")
        chained = moved.withColumn("valid_to", F.lead("effective_at").over(times))
    else:
        before = with_previous(stated, [key], ["effective_at"], {"_before": "_state"}, rows_per_slice)
        moved = land(before.where(unlike).drop("_before", "_state"), "moves")[0]
        chained = with_next(moved, [key], ["effective_at"], {"valid_to": "effective_at"}, rows_per_slice)
    return chained.where(~F.col("deleted")).select(key, *attrs, F.col("effective_at").alias("valid_from"), "valid_to", "record_hash")


def _split(key: str, touched: DataFrame, others: DataFrame | None) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], DataFrame]]:
    """Rows of touched keys and rows of all other keys, NULL among the latter, by whichever list of keys is given last."""
    listed = (touched if others is None else others).withColumnRenamed(key, "_key")
    same = F.col(key) == F.col("_key") if others is None else F.col(key).eqNullSafe(F.col("_key"))
    inside, outside = ("left_semi", "left_anti") if others is None else ("left_anti", "left_semi")
    return lambda df: df.join(listed, same, inside), lambda df: df.join(listed, same, outside)


def apply_changes(
    dim: DataFrame,
    log: DataFrame,
    changes: DataFrame,
    key: str,
    attrs: Sequence[str],
    now: Column,
    hash: str = "json",
    reason: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
    few_keys: int = FEW_KEYS,
) -> Applied:
    """Apply log rows (see :func:`to_log`) to a dimension whose history ``log`` holds.

    Only keys among the changes are rebuilt; all other versions pass by untouched, on the left of an anti
    join with the touched keys or, when a load of more than ``few_keys`` touches most of them, of a semi-join with the other keys. Versions that stay as they are keep their bookkeeping; those cut or extended
    get ``now`` as their update time. Changes that the log has already are left out, so a load may be repeated.
    """
    placed = F.col(key).isNotNull() & F.col("effective_at").isNotNull()
    fresh = changes.where(placed)
    touched, n = land(fresh.select(key).distinct(), "touched")
    others = None
    if n > few_keys:
        others, m = land(log.select(key).union(dim.select(key)).distinct().join(touched, key, "left_anti"), "others")
        others = others if m < n else None
    inside, outside = _split(key, touched, others)
    known = inside(log)
    # Most of the log, if most keys are touched: then it needn't be narrowed down first. Repeats within the load go after the join, whose shuffle serves both.
    near = known if others is None else log
    unknown = fresh.join(near.select("change_hash"), "change_hash", "left_anti").dropDuplicates(["change_hash"])
    added = land(unknown.select(*log.columns), "added")[0]
    rebuilt = versions_from(union_all(known, added), key, attrs, hash, rows_per_slice)

    old = inside(dim)
    same = [F.col(f"n.{c}") == F.col(f"o.{c}") for c in (key, "valid_from", "record_hash")]
    both = rebuilt.alias("n").join(old.alias("o"), same, "left")
    stood, unmoved = F.col("o.valid_from").isNotNull(), F.col("o.valid_to").eqNullSafe(F.col("n.valid_to"))
    made = {
        "surrogate_key": F.sha2(F.concat_ws("|", F.col(f"n.{key}").cast("string"), F.col("n.valid_from").cast("string")), 256),
        "valid_from": F.col("n.valid_from"),
        "valid_to": F.col("n.valid_to"),
        "is_current": F.col("n.valid_to").isNull(),
        "change_reason": F.when(stood, F.col("o.change_reason")).otherwise(F.lit(reason).cast("string")),
        "record_hash": F.col("n.record_hash"),
        "created_at": F.when(stood, F.col("o.created_at")).otherwise(now),
        "updated_at": F.when(stood & unmoved, F.col("o.updated_at")).otherwise(now),
    }
    own = {c: F.col(f"n.{c}") for c in (key, *attrs)}
    columns = [(made | own).get(c, F.col(f"o.{c}")).alias(c) for c in dim.columns]
    kept = outside(dim).select(*dim.columns)
    return Applied(union_all(kept, both.select(*columns)), added, changes.where(~placed))
