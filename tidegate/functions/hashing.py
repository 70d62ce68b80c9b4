"""Row identity: hashes over named columns.

Spark's ``hash`` and ``xxhash64`` skip NULLs, so they cannot tell rows apart that
differ only in where a NULL stands. The hashes here keep column names or NULL marks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

JSON_OPTIONS = {
    "timeZone": "UTC",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def row_hash(columns: Sequence[str]) -> Column:
    """SHA-256 of the key-sorted JSON of the columns.

    JSON drops NULL fields but keeps names, so an absent field equals a NULL one
    and the column order does not matter. Timestamps keep their microseconds.
    """
    return F.sha2(F.to_json(F.struct(*sorted(columns)), JSON_OPTIONS), 256)


def attr_hash(columns: Sequence[str]) -> Column:
    """MD5 of the columns as text in the given order, NULL written as ``NULL``.

    Kept for parity with stores that already hold this form; a value that contains
    the separator can collide, so :func:`row_hash` is the default elsewhere.
    """
    return F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NULL")) for c in columns]))


def event_hash(payload: Sequence[str]) -> Column:
    """Hash of an event's payload; delivery fields must not be among ``payload``."""
    return row_hash([c for c in payload if c not in ("event_type", "event_time", "source_row_hash")])


def with_row_hash(df: DataFrame, columns: Sequence[str] | None = None, name: str = "source_row_hash") -> DataFrame:
    """Add the hash of the listed (or all) columns; ``-0.0`` counts as ``0.0``.

    The column is declared free of NULLs, which it is: a step that treats NULL keys apart then needs no second pass over the rows.
    """
    columns = list(columns or [c for c in df.columns if c != name])
    binary = {c for c, t in df.dtypes if t in ("double", "float")}
    fields = [(F.col(c) + F.lit(0.0)).alias(c) if c in binary else F.col(c) for c in sorted(columns)]
    return df.withColumn(name, F.coalesce(F.sha2(F.to_json(F.struct(*fields), JSON_OPTIONS), 256), F.lit("")))


def shared_key_hash(df: DataFrame, columns: Sequence[str], name: str = "shared_hash") -> DataFrame:
    """Hash over the columns two feeds have in common, for deduplication across them."""
    return df.withColumn(name, row_hash(columns))


def spread_key(columns: Sequence[str], buckets: int) -> Column:
    """Even bucket number from a low-cardinality key plus a stable row identifier."""
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")
