"""Removal of repeated passages, found by anchors at difference-cover positions.

Words are runs of non-blanks. A window is ``window`` consecutive words of one document. Every word
covered by a window whose words also start earlier (at a smaller id, or earlier in the document)
is removed; windows are judged on the input.

**Anchors.** ``COVER`` is a difference cover modulo ``PERIOD``: any two positions have a common
shift, shorter than the period, that brings both to positions in the cover. So if the windows at i
and j are equal, some anchor of ``window - PERIOD + 1`` words that starts at a cover position lies at
the same place in both. Only anchors at cover positions (4 of 13) are hashed. Anchors that occur
twice mark every window that could repeat.

**Extension.** Each window around a repeated anchor is hashed as a whole, and of equal ones the
earliest place is found; the others are repeats.

Both steps deal hashes over buckets, as arrays: a row holds the hashes that one stretch of a task's documents has in one
bucket. The number of buckets follows the number of words, so a bucket is of bounded size. Within a
stretch each hash is sent once, whatever its number of copies: the others
are answered on the spot. So a passage that a third of all documents share gives one entry a
stretch. Anchors keep 32 bits within a bucket, as a chance hit only costs a comparison; windows keep
80 bits within a bucket. Texts are shuffled twice, the second time only those that have repeated anchors.

A document is known by its id and a 64-bit hash of id and text. Rows that share an id are ordered by that hash. Of rows that agree in both
(repeated rows) one is the first, and in all others every window is a repeat. NULL ids come last.
NULL and empty texts have no words; shorter texts than a window lose nothing; empty tables give
no rows. Other columns are ignored. ``docs`` is read three times and has to give the same rows each time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import Batches, per_batch, pieces, raw_texts, small_batches
from tidegate.session import staging_path
from tidegate.sources.sinks import land, landed

WINDOW = 20
#: Fixed values: {0, 1, 3, 9} has every difference modulo 13.
PERIOD, COVER = 13, (0, 1, 3, 9)
#: Words of a bucket, and hashes that a task keeps before it sends them.
BUCKET_WORDS, STRETCH = 4_000_000, 1_000_000
LEAST_BUCKETS = 64
GAP = re.compile(rb"[\x20\x09-\x0D]")
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def word_hashes(raw: bytes) -> np.ndarray:
    """64-bit hashes of the words; ``bytes.split`` cuts at exactly the six blanks."""
    out = []
    for piece in pieces(raw, GAP):
        words = piece.split()
        out.append(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)))
    return np.concatenate(out) if len(out) > 1 else out[0]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def run_hashes(words: np.ndarray, length: int, base: int = _BASES[0]) -> np.ndarray:
    """Hashes of all runs of ``length`` words; runs of 1, 2, 4, ... words are put together by its binary digits."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    power = _mixed(words ^ np.uint64(base))
    size, out, have = 1, None, 0
    while True:
        if length & size:
            if out is None:
                out, have = power, size
            else:
                m = len(words) - have - size + 1
                out = out[:m] * np.uint64(pow(base | 1, size, 1 << 64)) + power[have : have + m]
                have += size
        if size * 2 > length:
            return _mixed(out[:n])
        m = len(words) - 2 * size + 1
        power = power[:m] * np.uint64(pow(base | 1, size, 1 << 64)) + power[size : size + m]
        size *= 2


def cover_positions(n: int, period: int = PERIOD, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """Positions below n whose remainder is in the cover."""
    inside = np.zeros(period, bool)
    inside[list(cover)] = True
    return np.flatnonzero(np.resize(inside, n))


def _spread(starts: np.ndarray, before: int, after: int, n: int) -> np.ndarray:
    """Which of n positions lie from ``before`` ahead of a start to ``after`` behind it."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, np.clip(starts - before, 0, n), 1)
    np.add.at(edges, np.minimum(starts + after + 1, n), -1)
    return np.cumsum(edges[:n]) > 0


def covered(starts: np.ndarray, window: int, n: int) -> np.ndarray:
    return _spread(starts, 0, window - 1, n)


# --- hashes by bucket -------------------------------------------------------

#: A row is either hashes for a bucket (``high``) or an answer for one document (``starts`` alone).
PARTS = "bucket int, high binary, low binary, starts binary, keys binary, ids binary, known binary, runs binary"
NAMES = [p.split()[0] for p in PARTS.split(", ")]
ARROW = pa.schema([("bucket", pa.int32()), *((n, pa.binary()) for n in NAMES[1:])])


class Stretch:
    """Hashes of consecutive documents of a task, and their places."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.docs: dict[tuple[int, int | None], int] = {}
        self.hashes: list[tuple[np.ndarray, ...]] = []
        self.owners: list[np.ndarray] = []
        self.starts: list[np.ndarray] = []
        self.size = 0

    def add(self, key: int, doc_id: int | None, starts: np.ndarray, *hashes: np.ndarray) -> None:
        """A repeated row is taken once."""
        if (key, doc_id) in self.docs or not len(starts):
            return
        self.owners.append(np.full(len(starts), len(self.docs), np.uint32))
        self.docs[key, doc_id] = len(self.docs)
        self.hashes.append(hashes)
        self.starts.append(starts.astype(np.uint32))
        self.size += len(starts)

    def whole(self) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Hashes, owners, starts, and of each owner: key, id, whether the id is known."""
        keys = np.array([k for k, _ in self.docs], np.int64)
        ids = np.array([i or 0 for _, i in self.docs], np.int64)
        known = np.array([i is not None for _, i in self.docs], bool)
        return [np.concatenate(h) for h in zip(*self.hashes, strict=True)], np.concatenate(self.owners), np.concatenate(self.starts), keys, ids, known


def _ranks(keys: np.ndarray, ids: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Order of documents: id, NULL last, then key; the same document has the same rank."""
    order = np.lexsort((keys, ids, ~known))
    new = np.ones(len(order), bool)
    new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (keys, ids, known)], axis=0)
    out = np.empty(len(order), np.uint64)
    out[order] = np.cumsum(new).astype(np.uint64)
    return out


def _grouped(hashes: list[np.ndarray], places: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """An order that brings equal hashes together, by place inside, and the number of the group at each step."""
    order = np.lexsort((*hashes[::-1],) if places is None else (places, *hashes[::-1]))
    new = np.ones(len(order), bool)
    new[1:] = np.any([h[order][1:] != h[order][:-1] for h in hashes], axis=0)
    return order, np.cumsum(new) - 1


def _repeats(hashes: list[np.ndarray], places: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """``(repeated, first)`` as masks. Without places all of a group of several are repeated, else those behind the least place."""
    order, group = _grouped(hashes, places)
    heads = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]]))
    first, repeated = np.zeros(len(order), bool), np.zeros(len(order), bool)
    first[order[heads]] = True
    if places is None:
        repeated[order] = np.diff(np.append(heads, len(order)))[group] > 1
    else:
        ordered = places[order]
        repeated[order] = ordered != ordered[heads][group]
    return repeated, first


def _binary(values: np.ndarray, cuts: np.ndarray) -> pa.Array:
    """Consecutive parts of an array, as binaries."""
    values = np.ascontiguousarray(values)
    offsets = (cuts * values.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _heads(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal values begins."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return np.flatnonzero(new)


def _by_owner(which: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marked entries in the order of their owners, and where each owner begins (and the end)."""
    at = np.flatnonzero(which)
    at = at[np.argsort(owners[at], kind="stable")]
    return at, np.append(_heads(owners[at]), len(at))


def _sent(stretch: Stretch, dealt: Callable, buckets: int, by_place: bool) -> Batches:
    """What a stretch sends: answers for repeats inside it, and each hash once to its bucket."""
    if not stretch.size:
        return
    hashes, owners, starts, keys, ids, known = stretch.whole()
    places = (_ranks(keys, ids, known)[owners] << np.uint64(32)) | starts if by_place else None
    repeated, first = _repeats(hashes, places)
    if repeated.any():
        at, cuts = _by_owner(repeated, owners)
        own, each = owners[at[cuts[:-1]]], np.arange(len(cuts))
        columns = {"bucket": pa.array((keys[own] % buckets).astype(np.int32)), "starts": _binary(starts[at], cuts), "keys": _binary(keys[own], each), "ids": _binary(ids[own], each), "known": _binary(known[own], each)}
        yield _columns(columns)
    at = np.flatnonzero(first)
    bucket, kept = dealt([h[at] for h in hashes])
    order = np.argsort(bucket, kind="stable")  # inside a bucket by owner, as before
    bucket, at, kept = bucket[order], at[order], [h[order] for h in kept]
    heads, runs = _heads(bucket), _heads(bucket, owners[at])
    cuts, own = np.append(heads, len(at)), owners[at[runs]]
    of_runs = np.searchsorted(runs, cuts)
    columns = {"bucket": pa.array(bucket[heads].astype(np.int32)), "starts": _binary(starts[at], cuts), "runs": _binary(np.diff(np.append(runs, len(at))).astype(np.uint32), of_runs)}
    columns |= {n: _binary(h, cuts) for n, h in zip(("high", "low"), kept, strict=False)}
    columns |= {n: _binary(x[own], of_runs) for n, x in (("keys", keys), ("ids", ids), ("known", known))}
    yield _columns(columns)


def _columns(columns: dict) -> pa.RecordBatch:
    n = len(columns["bucket"])
    return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(n, f.type)) for f in ARROW], schema=ARROW)


ANSWERS = "key long, doc_id long, starts binary"


def _answers(keys: np.ndarray, ids: np.ndarray, known: np.ndarray, starts: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(ids, mask=~known), starts], ["key", "doc_id", "starts"])


def _values(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _compared(kinds: tuple, by_place: bool) -> Callable[[Batches], Batches]:
    """Find the repeats in each bucket, one bucket at a time; answers pass through."""

    def bucketful(parts: list[pa.RecordBatch]) -> Batches:
        whole = pa.Table.from_batches(parts)
        value = lambda name, kind: _values(whole.column(name), kind)
        hashes = [value(n, kind) for n, kind in zip(("high", "low"), kinds, strict=False)]
        starts, keys, ids, known = value("starts", np.uint32), value("keys", np.int64), value("ids", np.int64), value("known", bool)
        owners = np.repeat(np.arange(len(keys), dtype=np.uint32), value("runs", np.uint32))
        places = (_ranks(keys, ids, known)[owners] << np.uint64(32)) | starts if by_place else None
        repeated, _ = _repeats(hashes, places)
        if repeated.any():
            at, cuts = _by_owner(repeated, owners)
            own = owners[at[cuts[:-1]]]
            yield _answers(keys[own], ids[own], known[own], _binary(starts[at], cuts))

    def run(batches: Batches) -> Batches:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            answered = batch.column("high").is_null()
            given = batch.filter(answered)
            if given.num_rows:
                yield _answers(*(_values(given.column(n), kind) for n, kind in (("keys", np.int64), ("ids", np.int64), ("known", bool))), given.column("starts"))
            dealt = batch.filter(pc.invert(answered))
            bucket = dealt.column("bucket").to_numpy()
            for a, b in zip(heads := _heads(bucket) if len(bucket) else [], [*heads[1:], len(bucket)], strict=True):
                if held and held[0].column("bucket")[0].as_py() != bucket[a]:
                    yield from bucketful(held)
                    held = []
                held.append(dealt.slice(a, b - a))
        if held:
            yield from bucketful(held)

    return run


def _matched(texts: DataFrame, send: Callable[[Batches], Batches], kinds: tuple, buckets: int, by_place: bool, label: str) -> DataFrame:
    """Answers of all documents, each ``(document, starts)`` once, landed."""
    spark = texts.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), buckets // 4)
    dealt = texts.mapInArrow(send, PARTS).repartition(parts, "bucket").sortWithinPartitions("bucket")
    return land(dealt.mapInArrow(_compared(kinds, by_place), ANSWERS), label)[0]


# --- the operator -----------------------------------------------------------


def _counted(docs: DataFrame) -> DataFrame:
    """``doc_id, key, n_words, sha`` of every row; ``sha`` is of all words, joined by one space."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            numbers, digests = [], []
            for raw in raw_texts(batch.column("text")):
                n, sha = 0, hashlib.sha256()
                for piece in pieces(raw, GAP):
                    words = piece.split()
                    sha.update((b" " if n and words else b"") + b" ".join(words))
                    n += len(words)
                numbers.append(n)
                digests.append(sha.hexdigest())
            return {"n_words": pa.array(numbers, pa.int64()), "sha": pa.array(digests, pa.string())}

        return work

    schema = "doc_id long, key long, n_words long, sha string"
    return docs.mapInArrow(per_batch(make, schema), schema)


def _anchors(window: int, buckets: int) -> Callable[[Batches], Batches]:
    length = window - PERIOD + 1

    def dealt(hashes: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        return (hashes[0] >> np.uint64(32)) % np.uint64(buckets), [hashes[0].astype(np.uint32)]

    def send(batches: Batches) -> Batches:
        stretch = Stretch()
        for batch in small_batches(batches):
            for key, raw in zip(batch.column("key").to_pylist(), raw_texts(batch.column("text")), strict=True):
                words = word_hashes(raw)
                if len(words) >= window:
                    hashes = run_hashes(words, length)
                    at = cover_positions(len(hashes))
                    stretch.add(key, None, at, hashes[at])
                if stretch.size >= STRETCH:
                    yield from _sent(stretch, dealt, buckets, False)
                    stretch.clear()
        yield from _sent(stretch, dealt, buckets, False)

    return send


def _windows(window: int, buckets: int) -> Callable[[Batches], Batches]:
    def dealt(hashes: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
        # 64 bits of the first hash and 16 of the second; other bits of the second choose the bucket.
        return (hashes[1] >> np.uint64(24)) % np.uint64(buckets), [hashes[0], hashes[1].astype(np.uint16)]

    def send(batches: Batches) -> Batches:
        stretch = Stretch()
        for batch in small_batches(batches):
            for key, doc_id, raw, marks in zip(batch.column("key").to_pylist(), batch.column("doc_id").to_pylist(), raw_texts(batch.column("text")), batch.column("marks").to_pylist(), strict=True):
                words = word_hashes(raw)
                anchors = np.concatenate([np.frombuffer(m, np.uint32) for m in marks]).astype(np.int64)
                at = np.flatnonzero(_spread(anchors, PERIOD - 1, 0, len(words) - window + 1))
                stretch.add(key, doc_id, at, run_hashes(words, window)[at], run_hashes(words, window, _BASES[1])[at])
                if stretch.size >= STRETCH:
                    yield from _sent(stretch, dealt, buckets, True)
                    stretch.clear()
        yield from _sent(stretch, dealt, buckets, True)

    return send


def _cleaned(window: int) -> Callable[[Batches], Batches]:
    """``doc_id, key, n_removed, kept_sha`` of documents with repeats."""

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            removed, digests = [], []
            for raw, marks in zip(raw_texts(batch.column("text")), batch.column("marks").to_pylist(), strict=True):
                starts = np.concatenate([np.frombuffer(m, np.uint32) for m in marks]).astype(np.int64)
                n = int(starts.max()) + window
                gone, at, kept_any, sha = covered(starts, window, n), 0, False, hashlib.sha256()
                for piece in pieces(raw, GAP):
                    words = piece.split()
                    keep = np.ones(len(words), bool)
                    here = gone[at : at + len(words)]
                    keep[: len(here)] = ~here
                    at += len(words)
                    kept = list(compress(words, keep.tolist()))
                    sha.update((b" " if kept_any and kept else b"") + b" ".join(kept))
                    kept_any = kept_any or bool(kept)
                removed.append(int(gone.sum()))
                digests.append(sha.hexdigest())
            return {"n_removed": pa.array(removed, pa.int64()), "kept_sha": pa.array(digests, pa.string())}

        return work

    return per_batch(make, "doc_id long, key long, n_removed long, kept_sha string")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every row; ids are integers, windows have at least ``PERIOD`` words."""
    if window < PERIOD:
        raise ValueError(f"a window has at least {PERIOD} words")
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(id_col).cast("long"), F.coalesce(F.col(text), F.lit(""))).alias("key"), F.col(text).alias("text"))

    counted, _ = land(_counted(texts).withColumn("row", F.monotonically_increasing_id()), "words")
    total = counted.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // BUCKET_WORDS))

    marks = _matched(texts.select("key", "text"), _anchors(window, buckets), (np.uint32,), buckets, False, "anchors")
    marks = marks.select("key", "starts").distinct().groupBy("key").agg(F.collect_list("starts").alias("marks"))
    marked, _ = landed(texts.join(marks, "key").select("doc_id", "key", "text", "marks"), staging_path(spark, "marked"))

    repeats = _matched(marked, _windows(window, buckets), (np.uint64, np.uint16), buckets, True, "repeats")
    repeats = repeats.distinct().groupBy("key", "doc_id").agg(F.collect_list("starts").alias("marks"))
    same = (F.col("m.key") == F.col("r.key")) & F.col("m.doc_id").eqNullSafe(F.col("r.doc_id"))
    changed = marked.drop("marks").alias("m").join(repeats.alias("r"), same).select("m.doc_id", "m.key", "m.text", "r.marks")
    changed = changed.mapInArrow(_cleaned(window), "doc_id long, key long, n_removed long, kept_sha string").distinct()

    same = (F.col("c.key") == F.col("h.key")) & F.col("c.doc_id").eqNullSafe(F.col("h.doc_id"))
    out = counted.alias("c").join(changed.alias("h"), same, "left").select("c.*", "h.n_removed", "h.kept_sha")
    # Of repeated rows all but the first lose every word that a window covers.
    copies, n = land(counted.groupBy("key", "doc_id").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "doc_id", "first"), "copies")
    later = F.lit(False)
    if n:
        same = (F.col("o.key") == F.col("k.key")) & F.col("o.doc_id").eqNullSafe(F.col("k.doc_id"))
        out = out.alias("o").join(copies.alias("k"), same, "left").select("o.*", "k.first")
        later = F.coalesce(F.col("row") != F.col("first"), F.lit(False)) & (F.col("n_words") >= window)
    return out.select(
        "doc_id",
        "n_words",
        F.when(later, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(later, F.lit(_EMPTY_SHA)).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
    )
