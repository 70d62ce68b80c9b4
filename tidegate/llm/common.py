"""Helpers shared by the operators of this package."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Blanks as most contracts name them: space and U+0009 to U+000D.
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(columns: Sequence[str], name: str) -> str:
    """The name, lengthened until no column has it."""
    while name in columns:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay as they are."""
    return F.translate(text, UPPER, LOWER)


def blankless(text: Column) -> Column:
    """The text without blanks; NULL counts as empty."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def raw_texts(column: pa.Array) -> list[bytes]:
    """UTF-8 of every text, NULL as empty."""
    return [x or b"" for x in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def texts_of(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def pieces(raw: bytes, gap: re.Pattern, size: int = 1 << 20) -> Iterator[bytes]:
    """A long text in pieces of about ``size`` bytes, cut at (and without) a gap."""
    at = 0
    while len(raw) - at > size and (cut := gap.search(raw, at + size)):
        yield raw[at : cut.start()]
        at = cut.end()
    yield raw[at:] if at else raw


def in_chunks(raws: list[bytes], gap: re.Pattern, size: int = 1 << 20) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts in groups of about ``size`` bytes: row numbers and pieces. Long texts are spread over several groups."""
    rows: list[int] = []
    group: list[bytes] = []
    held = 0
    for row, raw in enumerate(raws):
        for piece in pieces(raw, gap, size):
            rows.append(row)
            group.append(piece)
            held += len(piece)
            if held >= size:
                yield rows, group
                rows, group, held = [], [], 0
    if rows:
        yield rows, group


Batches = Iterator[pa.RecordBatch]
#: Rows that a task turns into Python objects at once.
ROWS_AT_ONCE = 500


def small_batches(batches: Batches) -> Batches:
    """The same rows in short batches; at the end, what the Arrow pool holds unused goes back to the system."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(at, ROWS_AT_ONCE)
    pa.default_memory_pool().release_unused()


def per_batch(make: Callable[[], Callable[[pa.RecordBatch], dict]], schema: str) -> Callable[[Batches], Batches]:
    """For ``mapInArrow``: ``make()`` runs once in a task and returns what turns a batch into columns.

    Columns that ``make`` leaves out are passed on from the batch.
    """
    names = [part.split()[0].strip("`") for part in schema.split(",")]

    def run(batches: Batches) -> Batches:
        work = make()
        for batch in small_batches(batches):
            out = work(batch)
            yield pa.RecordBatch.from_arrays([pa.array(out[n]) if n in out and not isinstance(out[n], pa.Array) else out[n] if n in out else batch.column(n) for n in names], names)

    return run
