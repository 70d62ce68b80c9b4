"""Order MinHash: fingerprints that follow edit distance.

The k-mers of a text are numbered by occurrence (the third ``abc`` differs from the first), and
every numbered k-mer gets one 64-bit hash. Its leading bits deal it into one of ``TUPLES`` parts.
In each part the ``TAKEN`` k-mers of least hash are selected, put back into the order they have in
the text, and hashed as a tuple, so a moved passage changes the tuple as an edit does. The
fingerprint is the row of tuple hashes; the likeness of two is the share of equal ones among the
parts that either fills. (One hash dealt into parts stands for as many hash functions and costs a
``TUPLES``-th of them.)

A text shorter than ``K`` is one k-mer. Parts without a k-mer are marked empty; two texts without
any k-mer (empty texts) have likeness 1. NULL counts as empty. The fingerprint depends on the
text alone.

``with_neighbours`` compares every text with an edited one, made from it and the next document in
descending order of the id (NULL ids last; equal ids by their text). Documents are dealt by ranges of
the id, from cut points of the id column alone, and pass each task in order, so a task holds two
texts at a time; the first document of a range is also sent to the range before it. That is one
shuffle of the texts and no window over the whole table. Repeated rows follow each other; a table
of one row is its own neighbour; an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import small_batches

K, TUPLES, TAKEN = 8, 64, 2
RANGE_ROWS, MOST_RANGES = 4_096, 20_000
LOWEST = -(1 << 63)
_BASE = 0x100000001B3
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def _mixed(x: np.ndarray) -> np.ndarray:
    """A public 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


def _kmers(text: str, k: int) -> np.ndarray:
    """Polynomial hashes of all k-mers (of the whole text, if it is shorter)."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    k = min(k, len(codes))
    done, length, out = 0, 1, None
    # Runs of 1, 2, 4, ... letters, put together by the binary digits of k.
    run = codes
    while k >> done:
        if k >> done & 1:
            if out is None:
                out, have = run, length
            else:
                n = len(codes) - have - length + 1
                out = out[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + run[have : have + n]
                have += length
        if k >> (done + 1):
            n = len(codes) - 2 * length + 1
            run = run[:n] * np.uint64(pow(_BASE, length, 1 << 64)) + run[length : length + n]
            length *= 2
        done += 1
    return _mixed(out + _A)


def _numbered(hashes: np.ndarray) -> np.ndarray:
    """Hashes of (k-mer, how many equal ones came before)."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]]))
    number = np.arange(len(hashes)) - np.repeat(first, np.diff(np.append(first, len(hashes))))
    out = np.empty_like(hashes)
    out[order] = _mixed(ordered + number.astype(np.uint64) * _A)
    return out


def signature(text: str, k: int = K, tuples: int = TUPLES, taken: int = TAKEN) -> np.ndarray:
    """Tuple hashes as unsigned 32-bit numbers; 0 marks a part without a k-mer. ``tuples`` is a power of two."""
    out = np.zeros(tuples, np.uint32)
    if not text:
        return out
    kmers = _kmers(text, k)
    numbered = _numbered(kmers)
    order = np.argsort(numbered)
    shift = np.uint64(65 - tuples.bit_length())
    starts = np.searchsorted(numbered[order], np.arange(tuples, dtype=np.uint64) << shift)
    counts = np.minimum(np.diff(np.append(starts, len(order))), taken)
    picked = starts[:, None] + np.arange(taken)
    there = np.arange(taken) < counts[:, None]
    # Absent members sort to the end and count as a fixed value.
    places = np.sort(np.where(there, order[np.minimum(picked, len(order) - 1)], len(kmers)), axis=1)
    members = np.append(kmers, np.uint64(0))[places]
    total = np.zeros(tuples, np.uint64)
    for column in members.T:
        total = _mixed(total * np.uint64(_BASE) + column + _A)
    out[:] = np.maximum(total >> np.uint64(32), np.uint64(1))
    out[counts == 0] = 0
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    filled = (a != 0) | (b != 0)
    n = int(filled.sum())
    return float((a == b)[filled].sum() / n) if n else 1.0


def fingerprint(text: str) -> str:
    return signature(text).astype(">u4").tobytes().hex()


def edited_text(text: str, following: str) -> str:
    """The last third (rounded down) replaced by as many first letters of the following text, or all it has."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def fingerprinted(docs: DataFrame, text: str = "text", into: str = "fingerprint") -> DataFrame:
    """All columns of ``docs`` and the fingerprint of the text."""
    rest = [c for c in docs.columns if c != into]
    schema = ", ".join([f"`{c}` {dict(docs.dtypes)[c]}" for c in rest] + [f"`{into}` string"])

    def run(batches):
        for batch in batches:
            made = pa.array([fingerprint(t or "") for t in batch.column(text).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [made], [*rest, into])

    return docs.select(*rest).mapInArrow(run, schema)


def _cuts(keys: DataFrame, rows: int) -> list[int]:
    """Cut points between the ranges, from the id column alone."""
    n = max(1, min(MOST_RANGES, rows // RANGE_ROWS))
    if n == 1:
        return []
    return sorted(set(keys.select(F.percentile_approx("key", [i / n for i in range(1, n)], 10 * n)).first()[0]))


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``."""
    kind = dict(docs.dtypes)[id_col]
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)).alias("key"), F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    cuts = np.array(_cuts(keyed.select("key"), docs.count()), np.int64)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        # Range 0 has the largest ids.
        return pd.Series(len(cuts) - np.searchsorted(cuts, keys.to_numpy(), "left"), dtype="int32")

    firsts = {r.range: r.key for r in keyed.select("key", range_of("key").alias("range")).groupBy("range").agg(F.max("key").alias("key")).collect()}
    order = sorted(firsts)
    before = {r: order[i - 1] for i, r in enumerate(order)}  # the range before the first is the last
    # The first key of a range, and the range that it also goes to: at most MOST_RANGES numbers.
    also = {firsts[r]: before[r] for r in order}

    @F.pandas_udf("array<struct<range:int,extra:int>>")
    def places(keys: pd.Series) -> pd.Series:
        own = len(cuts) - np.searchsorted(cuts, keys.to_numpy(), "left")
        return pd.Series([[{"range": int(r), "extra": 0}] + ([{"range": also[k], "extra": 1}] if k in also else []) for k, r in zip(keys.tolist(), own.tolist(), strict=True)])

    dealt = keyed.select("*", F.inline(places("key"))).repartition(max(1, len(order)), "range").sortWithinPartitions("range", "extra", F.desc("key"), "text")
    schema = f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def run(batches):
        held = held_range = None
        out: list = []

        def finish(text, sign, following, next_sign, doc_id):
            edited = edited_text(text, following)
            edited_sign = sign if edited == text else signature(edited)
            out.append((doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), sign.astype(">u4").tobytes().hex(), edited_sign.astype(">u4").tobytes().hex(), likeness(sign, edited_sign), likeness(sign, next_sign)))

        for batch in small_batches(batches):
            for number, extra, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("range", "extra", "doc_id", "text")), strict=True):
                if number != held_range:
                    held, held_range = None, number
                if extra and held is None:
                    continue
                sign = signature(text)
                if held is not None:
                    finish(held[0], held[1], text, sign, held[2])
                held = None if extra else (text, sign, doc_id)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=arrow)
            out.clear()

    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    arrow = pa.schema([("doc_id", pa.int64() if kind == "bigint" else pa.int32()), ("n_chars", pa.int64()), *((n, pa.string()) for n in names[2:5]), *((n, pa.float64()) for n in names[5:])])
    return dealt.select("range", "extra", "doc_id", "text").mapInArrow(run, schema)
