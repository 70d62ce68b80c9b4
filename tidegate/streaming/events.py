"""Events as JSON text and back."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.hashing import event_hash
from tidegate.operators.shape import align, compute_once, conform
from tidegate.schemas import EVENT_ENVELOPE, EVENT_PAYLOAD, EVENT_TYPE, TRIP_COLUMNS

BAD_JSON = "malformed JSON"


def parse_events(df: DataFrame, fields: Sequence[str] = (*EVENT_ENVELOPE, *EVENT_PAYLOAD), raw: str = "value") -> DataFrame:
    """JSON text to text columns, plus ``raw`` and ``error``.

    Fields stay text so that a wrong type is reported by validation and not lost.
    Anything but a JSON object gets the error ``malformed JSON``.
    """
    layout = ", ".join([*(f"`{f}` string" for f in fields), "_bad string"])
    parsed = F.from_json("raw", layout, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    out = compute_once(df.select(F.col(raw).alias("raw")), {"_event": parsed})
    bad = F.col("_event._bad").isNotNull() | F.col("raw").isNull() | (F.trim("raw") == "")
    return out.select("raw", *[F.col(f"_event.{f}").alias(f) for f in fields], F.when(bad, BAD_JSON).alias("error"))


def event_to_row(
    df: DataFrame, payload: Mapping[str, str] = EVENT_PAYLOAD, layout: Mapping[str, str] = TRIP_COLUMNS
) -> DataFrame:
    """Valid events to table rows; fields the event lacks are NULL. Delivery fields are not hashed.

    The hash is taken over the whole table layout, so a batch row with the same
    values has the same hash.
    """
    typed = align(conform(df, payload), layout)
    return typed.withColumn("source_row_hash", event_hash(list(layout)))


def to_events(
    df: DataFrame,
    now: Column,
    payload: Mapping[str, str] = EVENT_PAYLOAD,
    event_type: str = EVENT_TYPE,
    defaults: Mapping[str, int] | None = None,
) -> DataFrame:
    """Rows to event columns: type, time, payload; ``now`` is passed in."""
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in (defaults or {}).items() if c in df.columns}
    stamp = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    fields = [(filled.get(c, F.col(c)) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in payload.items()]
    return df.select(F.lit(event_type).alias("event_type"), stamp.alias("event_time"), *fields)
