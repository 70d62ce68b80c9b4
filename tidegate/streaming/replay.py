"""Replay of a table as a stream of events.

Two ways: through files of event lines, or at a set rate straight from a numbered copy of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidegate.operators.windows import assign_ids
from tidegate.sources import sinks
from tidegate.sources.topics import keyed_messages
from tidegate.streaming.events import to_events


def replay_to_files(df: DataFrame, path: str, now: Column, rows_per_file: int | None = None, **envelope) -> None:
    """Write rows as JSON event lines. ``rows_per_file`` sets the step at which a reader may take them."""
    lines = keyed_messages(to_events(df, now, **envelope), None).select("value")
    writer = lines.write.mode("append")
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.text(path)


def read_replay(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """The replay as a stream of ``value`` lines, at most ``files_per_batch`` files at a time."""
    reader = spark.readStream.format("text")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("value"))


# --- at a set rate -----------------------------------------------------------

SEQ, CHUNK = "replay_seq", "replay_chunk"
CHUNK_ROWS = 1_000_000


def number_for_replay(df: DataFrame, order: Sequence[str], path: str, chunk_rows: int = CHUNK_ROWS) -> int:
    """Write a numbered copy of a table, partitioned by chunks of the number; returns how many rows it has.

    ``order`` must be a total order: it is the order of the replay.
    """
    numbered = assign_ids(df, order, SEQ, 0)
    chunk = F.call_function("div", F.col(SEQ), F.lit(chunk_rows)).alias(CHUNK)
    return sinks.append_counted(numbered.select("*", chunk), path, [CHUNK])


def replay_at_rate(
    spark: SparkSession,
    path: str,
    rows_per_batch: int,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    seconds: float = 1,
    chunk_rows: int = CHUNK_ROWS,
) -> StreamingQuery:
    """Hand ``rows_per_batch`` rows of a numbered copy to ``sink(rows, batch_id)`` every ``seconds``, in order.

    A source that counts so many numbers a batch sets the pace, and its offsets, which the checkpoint keeps, are the
    position in the table: a restart goes on with the rows that follow. Every batch reads the chunks of its numbers only. Past the
    end batches are empty; stop the query with :func:`tidegate.streaming.running.run_until`. As with any
    ``foreachBatch``, a batch may come again after a failure, with the same rows and id.
    """
    # The clock of this source is not used; it only has to be the same in every run.
    counted = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", rows_per_batch).option("startTimestamp", 0).load()
    table = spark.read.parquet(path)

    def hand_over(batch: DataFrame, batch_id: int) -> None:
        first, last = batch.agg(F.min("value"), F.max("value")).first()
        if first is None:
            return
        chunks = F.col(CHUNK).between(first // chunk_rows, last // chunk_rows)
        sink(table.where(chunks & F.col(SEQ).between(first, last)).drop(CHUNK), batch_id)

    return counted.writeStream.option("checkpointLocation", checkpoint).foreachBatch(hand_over).trigger(processingTime=f"{seconds} seconds").start()
