"""Events joined to a changing dimension, both as streams.

An event belongs to the version of its key that started last at or before the event's time. While either stream may still
bring something older, the event waits in state; once the watermark has passed its time no version can come in between, and it is
emitted once, with the attributes it then has for good. So the result is that of the batch as-of join,
whatever the order of arrival within the delay.

This is a stateful operator that Spark has no built-in for; its state holds, per key, the versions that some event may still need, and the
events that wait. Both go as the watermark moves on: of the versions behind it only the last one stays. A state is of one key or, since
each call costs as much as a few hundred rows, of a bucket of keys.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import StructType

#: Kinds of rows, and the places of their lists in what is held of a key.
VERSION, EVENT = 0, 1


def as_of_stream(
    events: DataFrame,
    versions: DataFrame,
    key: tuple[str, str],
    ts: str,
    attrs: Sequence[str],
    delay: str,
    valid_from: str = "valid_from",
    buckets: int | None = None,
) -> DataFrame:
    """Events of a stream with the attributes of the version valid at their time, in append mode.

    ``versions`` is the stream of version starts; a version ends where the next one of its key starts, and a start with
    all attributes NULL ends the one before. ``delay`` is how late rows of either stream may be. Events before the first version, or
    of a key without versions, get NULLs. Of several starts at one time the one that sorts last by its attributes counts. NULL
    keys and NULL times never match, so such events are left out; route them before. Later than the watermark, rows are dropped as in any
    stream operator with one.

    With ``buckets`` keys share that many states, each written anew whenever one of its keys has rows. That is for batches that touch most
    keys; take so many buckets that a state stays at some MB. Without it every key has its own, for small batches. The number belongs to the checkpoint.
    """
    fields = StructType([events.schema[c] for c in events.columns])
    event_row = F.to_json(F.struct(*events.columns)).alias("row")
    version_row = F.to_json(F.struct(*attrs), {"ignoreNullFields": "false"}).alias("row")
    placed = [
        versions.select(F.col(key[1]).cast("string").alias("key"), F.col(valid_from).cast("timestamp").alias("at"), F.lit(VERSION).alias("kind"), version_row),
        events.select(F.col(key[0]).cast("string").alias("key"), F.col(ts).cast("timestamp").alias("at"), F.lit(EVENT).alias("kind"), event_row),
    ]
    both = placed[0].unionByName(placed[1]).where("key IS NOT NULL AND at IS NOT NULL").withWatermark("at", delay)
    group = F.col("key") if buckets is None else F.pmod(F.xxhash64("key"), F.lit(buckets))
    micros = both.withColumns({"micros": F.unix_micros("at"), "bucket": group})

    def step(_: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        for part in parts:
            for name, at, kind, row in zip(part["key"].tolist(), part["micros"].tolist(), part["kind"].tolist(), part["row"].tolist(), strict=True):
                held.setdefault(name, ([], []))[kind].append((at, row))
        # A start or an event at the watermark's own time can still come.
        passed = state.getCurrentWatermarkMs() * 1000
        out, left, due = [], {}, []
        for name, (starts, waiting) in held.items():
            starts = sorted(map(tuple, starts))
            n = 0
            for at, row in sorted(tuple(e) for e in waiting if e[0] < passed):
                while n < len(starts) and starts[n][0] <= at:
                    n += 1
                out.append((row, starts[n - 1][1] if n else None))
            waiting = [e for e in waiting if e[0] >= passed]
            behind = sum(at < passed for at, _ in starts)
            starts = starts[max(0, behind - 1) :]
            if starts or waiting:
                left[name] = (starts, waiting)
            due += [min(e[0] for e in waiting)] if waiting else []
        if left:
            state.update((json.dumps(left),))
        elif state.exists:
            state.remove()
        if due:
            state.setTimeoutTimestamp(max(min(due) // 1000 + 1, state.getCurrentWatermarkMs() + 1))
        if out:
            yield pd.DataFrame(out, columns=["event", "version"], dtype="object")

    joined = micros.groupBy("bucket").applyInPandasWithState(step, "event string, version string", "held string", "append", GroupStateTimeout.EventTimeTimeout)
    version = F.from_json("version", StructType([versions.schema[a] for a in attrs])).alias("version")
    return joined.select(F.from_json("event", fields).alias("event"), version).select("event.*", *[f"version.{a}" for a in attrs])
