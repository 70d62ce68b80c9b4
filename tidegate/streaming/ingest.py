"""Stream to table: parse, validate, split, deduplicate, write.

A micro-batch may be run again after a failure, so every write is repeatable. The rows a
batch adds are staged in a folder of the batch before they are appended; a repeat appends
those of them that the table still lacks and counts the staged rows, so its counters are
those of the first run. Counters are written last: a batch that has them is done. Rejected
rows live in one folder per batch that a repeat overwrites.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.operators.validate import validate_events
from tidegate.operators.mutate import dedup, new_rows
from tidegate.operators.shape import misfits
from tidegate.schemas import EVENT_PAYLOAD
from tidegate.sources import sinks
from tidegate.streaming.events import event_to_row, parse_events

Prepare = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Paths:
    """Where an ingest writes: table, rejected events, counters, checkpoint and the rows of unfinished batches."""

    table: str
    rejected: str
    counters: str
    checkpoint: str
    pending: str

    @classmethod
    def under(cls, root: str) -> Paths:
        return cls(*[f"{root.rstrip('/')}/{name}" for name in ("table", "rejected", "counters", "checkpoint", "pending")])


def route(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(valid, invalid)`` by the error column."""
    return checked.where(F.col("error").isNull()), checked.where(F.col("error").isNotNull())


def check_trip_events(raw: DataFrame) -> DataFrame:
    """Every event that passes is held by the table's types; the others are rejected, so no value is lost on the way."""
    parsed = parse_events(raw)
    return validate_events(parsed, misfit=misfits(parsed, EVENT_PAYLOAD))


def ingest_batch(
    raw: DataFrame,
    batch_id: int,
    paths: Paths,
    check: Prepare = check_trip_events,
    to_row: Prepare = event_to_row,
    slice_ts: str | None = "pickup_datetime",
    slice_column: str = "pickup_date",
) -> None:
    """One micro-batch. The parsed batch is kept while its outputs are written."""
    spark, key = raw.sparkSession, ["source_row_hash"]
    counted, pending = f"{paths.counters}/batch_id={batch_id}", f"{paths.pending}/batch_id={batch_id}"
    if sinks.is_complete(spark, counted):
        sinks.remove(spark, pending)
        return
    checked = check(raw).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        seen = Observation()
        valid, _ = route(checked)
        # Counted by the write of the rejected rows, which passes over the whole batch anyway.
        watched = checked.observe(seen, F.count(F.lit(1)).alias("processed"), F.count_if(F.col("error").isNotNull()).alias("invalid"))
        rejected = route(watched)[1].select("raw", F.col("error").alias("reason"))
        rejected.write.mode("overwrite").parquet(f"{paths.rejected}/batch_id={batch_id}")
        rows = to_row(valid)
        if slice_ts is not None:
            rows = rows.withColumn(slice_column, F.to_date(slice_ts))
        sliced = slice_column if slice_ts is not None else None
        repeated = sinks.is_complete(spark, pending)
        if not repeated:
            held = sinks.read_slices(rows, paths.table, sliced)
            (dedup(rows, key) if held is None else new_rows(held, rows, key)).write.mode("overwrite").parquet(pending)
        staged = spark.read.schema(rows.schema).parquet(pending)
        held = sinks.read_slices(staged, paths.table, sliced) if repeated else None
        sinks.append(staged if held is None else new_rows(held, staged, key), paths.table, [sliced] if sliced else [])
        inserted, (processed, invalid) = staged.count(), sinks.observed(seen, "processed", "invalid")
        counters = spark.range(1).select(
            *[F.lit(n).cast("bigint").alias(c) for c, n in (("processed", processed), ("inserted", inserted), ("duplicates", processed - invalid - inserted), ("invalid", invalid))]
        )
        counters.write.mode("overwrite").parquet(counted)
        sinks.remove(spark, pending)
    finally:
        checked.unpersist()


def ingest_stream(events: DataFrame, paths: Paths, bounded: bool = True, **options) -> StreamingQuery:
    """Start the ingest. ``bounded`` takes what is there now and stops; batch size is set on the source.

    Progress is in the checkpoint and moves only after a batch is written in full.
    """
    writer = events.writeStream.option("checkpointLocation", paths.checkpoint).foreachBatch(
        lambda batch, batch_id: ingest_batch(batch, batch_id, paths, **options)
    )
    return (writer.trigger(availableNow=True) if bounded else writer).start()


def dedup_stream(rows: DataFrame, ts: str, delay: str, key: str = "source_row_hash") -> DataFrame:
    """Deduplicate in state instead of against the table, for repeats within ``delay``.

    A NULL key would match other NULL keys, so such rows are left out here;
    :func:`unkeyed` has them, for the rejected output.
    """
    return rows.where(F.col(key).isNotNull()).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def unkeyed(rows: DataFrame, key: str = "source_row_hash") -> DataFrame:
    """The rows that :func:`dedup_stream` leaves out."""
    return rows.where(F.col(key).isNull())


def total_counters(counters: DataFrame) -> DataFrame:
    """Counters of all batches together."""
    return counters.agg(*[F.sum(c).cast("bigint").alias(c) for c in ("processed", "inserted", "duplicates", "invalid")])
