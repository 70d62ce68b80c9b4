"""Importance resampling towards a target distribution, by hashed n-gram counts.

Words are runs of ASCII letters and digits (A-Z lower-cased) and of all letters beyond ASCII. The
features of a text are its runs of 1 to ``longest`` consecutive words joined by one space, repeats
counted; crc32 of a feature modulo ``buckets`` is its bucket. A bucket's gain compares how often it
occurs in the target and in the documents:
``floor(1000 * ln((t + 1) * (S + buckets) / ((s + 1) * (T + buckets))))``. A document's weight is the
floored mean of its features' gains (0 without features); Gumbel noise from a hash of the id turns
weights into scores whose highest ones are a draw without replacement.

Three steps:

* Counts: every task adds up one array of ``buckets`` numbers; the arrays are summed by bucket. That
  is at most ``buckets`` rows a task, whatever the texts are.
* Scores: the gains, one array of ``buckets`` numbers, go to every task, which looks up all features
  of a text at once. Only numbers are landed, no text.
* Draw: how many are drawn, k, is exact. The k-th key of (score descending, id ascending, row) is found
  by distributed quickselect: pivots drawn at random from the keys still in question, and exact counts of the
  keys below, at and above each, narrow the interval until one key is left. The winners alone
  are then sorted by range and numbered; nothing is ordered in one task.

NULL and empty texts have no features: weight 0. A NULL id is hashed as an empty one and comes last
among ties. Rows of equal id and score, repeated rows among them, are each a row: they are told apart
by their place in the landed table, so exactly k rows are drawn. Empty tables give no rows; without
target texts all t are 0. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import per_batch, pieces, raw_texts, small_batches
from tidegate.sources.sinks import land

LONGEST, BUCKETS, PERCENT, LEAST_WORDS, SEED = 2, 10_000, 25, 20, 7
#: Pivots of one round of the selection.
PIVOTS = 32
#: The bytes of a word once A-Z are lower-cased: digits, small letters, all bytes beyond ASCII.
WORD, GAP = re.compile(rb"[0-9a-z\x80-\xff]+"), re.compile(rb"[^0-9a-z\x80-\xff]")
SCORED = "doc_id {kind}, n_words long, n_features long, weight long"


def feature_buckets(raw: bytes, longest: int, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """Words and feature buckets of a text, in pieces of bounded size."""
    crc32 = zlib.crc32
    before: list[bytes] = []
    for piece in pieces(raw.lower(), GAP):  # bytes.lower() changes A-Z only
        words = WORD.findall(piece)
        known, grown = len(before), before + words
        spaced = [b" " + w for w in grown]
        sums = list(map(crc32, grown))
        found = sums[known:]
        for n in range(2, longest + 1):
            # The checksum of "a b" goes on from that of "a". Only runs that end in this piece are new.
            sums = list(map(crc32, spaced[n - 1 :], sums))
            found += sums[max(0, known - n + 1) :]
        yield len(words), np.array(found, np.int64) % buckets
        before = grown[max(0, len(grown) - longest + 1) :]


def bucket_counts(texts: DataFrame, text: str, longest: int, buckets: int) -> DataFrame:
    """``bucket, n``: occurrences over all texts, zeros left out."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in small_batches(batches):
            for raw in raw_texts(batch.column(0)):
                for _, found in feature_buckets(raw, longest, buckets):
                    counts += np.bincount(found, minlength=buckets)
        there = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(counts[there])], ["bucket", "n"])

    return texts.select(text).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str, target_text: str, longest: int, buckets: int) -> np.ndarray:
    """The gain of every bucket; ``buckets`` numbers, whatever the size of the tables."""
    spark = docs.sparkSession
    source, wanted = (bucket_counts(d, t, longest, buckets).withColumnRenamed("n", n) for d, t, n in ((docs, text, "s"), (target, target_text, "t")))
    both = spark.range(buckets).withColumnRenamed("id", "bucket").join(source, "bucket", "left").join(wanted, "bucket", "left").fillna(0, ["s", "t"])
    rows = both.select("bucket", "s", "t").collect()
    out, total_s, total_t = np.zeros(buckets, np.int64), sum(r.s for r in rows), sum(r.t for r in rows)
    ratios = np.array([(r.t + 1.0) * (total_s + buckets) / ((r.s + 1.0) * (total_t + buckets)) for r in rows])
    out[[r.bucket for r in rows]] = np.floor(1000 * np.log(ratios)).astype(np.int64)
    return out


def weighed(docs: DataFrame, gain: np.ndarray, id_col: str, text: str, longest: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    kind, buckets = dict(docs.dtypes)[id_col], len(gain)

    def make():
        def work(batch: pa.RecordBatch) -> dict:
            rows = []
            for raw in raw_texts(batch.column("text")):
                words = features = total = 0
                for n, found in feature_buckets(raw, longest, buckets):
                    words, features, total = words + n, features + len(found), total + int(gain[found].sum())
                rows.append((words, features, total // features if features else 0))
            return {name: pa.array([r[i] for r in rows], pa.int64()) for i, name in enumerate(("n_words", "n_features", "weight"))}

        return work

    schema = SCORED.format(kind=kind)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).mapInArrow(per_batch(make, schema), schema)


def gumbel(id_col: str, seed: int) -> Column:
    """Noise in thousandths, from the first 32 bits of sha256 of ``seed:id``."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))


KEY = ("descending", "unknown", "id", "row")


def select_kth(keys: DataFrame, k: int, pivots: int = PIVOTS, seed: int = SEED) -> tuple:
    """The k-th smallest (from 1) of at least k distinct keys, by distributed quickselect.

    ``keys`` has integer columns only, ordered as a tuple. Each round draws pivots among the keys
    still in question and counts exactly how many keys lie below, at and above each of them.
    Only pivots and counts reach the driver.
    """
    columns = keys.columns
    kinds = dict(keys.dtypes)
    here = F.struct(*columns)

    def literal(values: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(columns, values, strict=True)])

    low = high = None
    passed, turn = 0, 0
    while True:
        inside = keys
        if low is not None:
            inside = inside.where(here > literal(low))
        if high is not None:
            inside = inside.where(here < literal(high))
        drawn = inside.orderBy(F.xxhash64(F.lit(seed + turn), *columns), *columns).limit(pivots).collect()
        points = sorted(tuple(r) for r in drawn)
        # 2 * (pivots below the key), and 1 more if it is one itself.
        place = sum(((here >= literal(p)).cast("int") + (here > literal(p)).cast("int") for p in points), F.lit(0))
        counts = {r.place: r.n for r in inside.groupBy(place.alias("place")).agg(F.count(F.lit(1)).alias("n")).collect()}
        for at in range(2 * len(points) + 1):
            if passed + counts.get(at, 0) >= k:
                break
            passed += counts.get(at, 0)
        else:
            raise ValueError(f"fewer than {k} keys")
        if at % 2:
            return points[at // 2]
        low, high = points[at // 2 - 1] if at else low, points[at // 2] if at // 2 < len(points) else high
        turn += 1


def numbered(winners: DataFrame, order: list[str]) -> DataFrame:
    """``rank`` from 1 in the given order: rows sorted by range, and numbered in a landed copy."""
    spark = winners.sparkSession
    ordered = winners.repartitionByRange(*order).sortWithinPartitions(*order)
    # The number of a row inside its partition is in the low 33 bits.
    placed, _ = land(ordered.withColumns({"__part": F.spark_partition_id(), "__nr": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), "winners")
    offsets, before = [], 0
    for part, n in sorted(tuple(r) for r in placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).collect()):  # one row a partition
        offsets.append((part, before))
        before += n
    starts = F.broadcast(spark.createDataFrame(offsets, "__part int, __before long"))
    return placed.join(starts, "__part").withColumn("rank", F.col("__before") + F.col("__nr") + 1).drop("__part", "__nr", "__before")


def resample(
    docs: DataFrame,
    target: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    target_text: str = "text",
    percent: int = PERCENT,
    least_words: int = LEAST_WORDS,
    longest: int = LONGEST,
    buckets: int = BUCKETS,
    seed: int = SEED,
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document; ids are integers.

    ``rank`` numbers the ``floor(percent * N / 100)`` documents drawn among the N with at least
    ``least_words`` words; it is NULL for all others.
    """
    gain = gains(docs, target, text, target_text, longest, buckets)
    scored = weighed(docs, gain, id_col, text, longest).withColumn("score", F.col("weight") + gumbel("doc_id", seed))
    key = {
        "descending": -F.col("score"),
        "unknown": F.col("doc_id").isNull().cast("int"),
        "id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        "row": F.monotonically_increasing_id(),
    }
    scored, _ = land(scored.withColumns(key), "scored")
    eligible = F.col("n_words") >= least_words
    k = percent * scored.where(eligible).count() // 100
    if k:
        last = select_kth(scored.where(eligible).select(*KEY), k, seed=seed)
        here, kinds = F.struct(*KEY), dict(scored.dtypes)
        won = eligible & (here <= F.struct(*[F.lit(v).cast(kinds[c]).alias(c) for c, v in zip(KEY, last, strict=True)]))
    else:
        won = F.lit(False)
    out = numbered(scored.where(won), list(KEY)).unionByName(scored.where(~won).withColumn("rank", F.lit(None).cast("long")))
    return out.drop(*KEY)
