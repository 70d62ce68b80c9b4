"""Quality classifier by compression.

Dictionaries are built from good and from bad text. A text is cut into blocks of ``BLOCK`` bytes, so that
they matter throughout a long one, and every block is compressed with either dictionary of a pair. The
difference of the two sizes, normalised by their sum, is the only kind of input of the score: that of the whole text, and
of its blocks the least, the greatest, the lower quartile and the spread, as a text is bad where a part of it is. Neither the length of a
text nor its size by itself is an input. A logistic regression turns the differences into a calibrated probability of label 1.

There are two pairs, each from half of the training rows. The rows of a half are measured by the pair that
has not seen them, which gives the calibration honest differences of all rows; other texts get the mean of both pairs.

Training uses at most ``PER_CLASS`` labelled rows of each class and, for a dictionary, at most ``TRAINED_BYTES`` of whole texts in the order of a hash
(documented bounds); no text is used in part. The calibration's weights restore the proportion of all labels.
Scoring reads every byte of every text; labels, language, source and id are no input of it.

NULL counts as empty; an empty text gets the score of no difference. If one class has
no training rows, every score is the share of label 1 (0.5 without labels). Repeated rows
and NULL ids are scored like others; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import per_batch, raw_texts, small_batches, unused
from tidegate.llm.labelled import held_out, training_sample

#: Rows a class; bytes of a block that is scored, and of one that a dictionary is trained on; bytes of texts behind a dictionary.
PER_CLASS, BLOCK, TRAINED_BLOCK, TRAINED_BYTES = 4_000, 128, 1_024, 16 << 20
DICTIONARY_BYTES, LEVEL, THRESHOLD = 32_768, 3, 0.7
Pair = tuple[bytes, bytes]
#: Of the whole text; least, greatest, lower quartile and spread of its blocks.
INPUTS = 5


@dataclass(frozen=True)
class QualityModel:
    """Pairs of dictionaries (good, bad) and the calibration; a few times 32 KB, whatever the corpus."""

    pairs: tuple[Pair, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    share: float

    def score(self, features: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(features), self.share)
        z = np.column_stack([np.ones(len(features)), (features - np.array(self.mean)) / np.array(self.scale)])
        return 1 / (1 + np.exp(-np.clip(z @ np.array(self.weights), -30, 30)))


def blocks(raw: bytes, size: int) -> list[bytes]:
    return [raw[i : i + size] for i in range(0, len(raw), size)]


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary trained on the samples, or their end where there are too few to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def differ(pairs: Sequence[Pair]):
    """Function from a text to the inputs of the calibration, means over the pairs; a text without blocks has no differences."""
    import zstandard

    def compressor(content: bytes):
        made = zstandard.ZstdCompressionDict(content) if content else None
        if made:
            made.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(level=LEVEL, dict_data=made, write_content_size=False, write_dict_id=False, write_checksum=False).compress

    compressors = [(compressor(good), compressor(bad)) for good, bad in pairs]

    def differences(raw: bytes) -> np.ndarray:
        out, parts = np.zeros(INPUTS), blocks(raw, BLOCK)
        for with_good, with_bad in compressors if parts else ():
            g = np.array([len(with_good(part)) for part in parts])
            b = np.array([len(with_bad(part)) for part in parts])
            each = np.sort((b - g) / (b + g))
            out += ((b.sum() - g.sum()) / (b.sum() + g.sum()), each[0], each[-1], each[len(each) // 4], each.std())
        return out / max(1, len(compressors))

    return differences


def calibrate(features: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Weighted logistic regression by Newton steps with a small ridge."""
    mean, scale = features.mean(0), features.std(0) + 1e-6
    z = np.column_stack([np.ones(len(features)), (features - mean) / scale])
    ridge = np.full(z.shape[1], 0.05)
    beta = np.zeros(z.shape[1])
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        step = np.linalg.solve((z * (weights * p * (1 - p))[:, None]).T @ z + np.diag(ridge), z.T @ (weights * (labels - p)) - ridge * beta)
        # Halved steps keep separable data from running away.
        beta += step * min(1.0, 4 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return mean, scale, beta


def train(docs: DataFrame, labels: DataFrame, target: str = "quality", per_class: int = PER_CLASS, id_col: str = "doc_id", text: str = "text") -> QualityModel:
    sample, sizes = training_sample(docs, labels, target, per_class, id_col, text)
    total = sum(sizes.values())
    sample = sample.withColumn("half", F.pmod(F.xxhash64(F.lit("half"), "doc_id"), F.lit(2)).cast("int"))
    share = sizes.get(1, 0) / total if total else 0.5
    unknown = QualityModel((), (), (), (), share)

    def cut(batches):
        for batch in small_batches(batches):
            rows = zip(batch.column("half").to_pylist(), batch.column("label").to_pylist(), raw_texts(batch.column("text")), strict=True)
            parts = [(half, label, b) for half, label, raw in rows for b in blocks(raw, TRAINED_BLOCK)]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in parts], pa.int32()), pa.array([p[1] for p in parts], pa.int32()), pa.array([p[2] for p in parts], pa.binary())], ["half", "label", "block"])

    # Bounded: PER_CLASS rows of a class, TRAINED_BYTES of a dictionary; texts longer than a quarter of that come last.
    length = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    ordered = sample.withColumns({"length": length, "late": length > TRAINED_BYTES // 4, "place": F.xxhash64(F.lit("place"), "doc_id", "text")})
    upto = F.sum("length").over(Window.partitionBy("half", "label").orderBy("late", "place", "doc_id"))
    whole = ordered.withColumn("upto", upto).where(F.col("upto") <= TRAINED_BYTES).select("half", "label", "text")
    taken: dict[tuple[int, int], list[bytes]] = {(half, label): [] for half in (0, 1) for label in (0, 1)}
    for row in whole.mapInArrow(cut, "half int, label int, block binary").orderBy("half", "label", F.xxhash64("block"), "block").toLocalIterator():
        taken[row.half, row.label].append(bytes(row.block))
    if not all(taken.values()):
        return unknown
    pairs = tuple((dictionary(taken[half, 1]), dictionary(taken[half, 0])) for half in (0, 1))

    def measure(batches):
        unseen = [differ([pairs[1 - half]]) for half in (0, 1)]
        for batch in small_batches(batches):
            rows = [unseen[half](raw) for half, raw in zip(batch.column("half").to_pylist(), raw_texts(batch.column("text")), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("label"), pa.array(rows, pa.list_(pa.float64()))], ["label", "x"])

    rows = sample.mapInArrow(measure, "label int, x array<double>").collect()  # a few numbers of 2 * PER_CLASS rows at most
    y = np.array([r.label for r in rows], float)
    x = np.array([r.x for r in rows])
    order = np.lexsort([*x.T, y])
    x, y = x[order], y[order]
    weights = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (len(y) - y.sum())) * len(y) / total
    mean, scale, beta = calibrate(x, y, weights)
    return QualityModel(pairs, tuple(mean), tuple(scale), tuple(beta), share)


def scored(docs: DataFrame, model: QualityModel, text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (a column of that name is replaced)."""
    rest = [c for c in docs.columns if c != into]
    schema = ", ".join([f"`{c}` {dict(docs.dtypes)[c]}" for c in rest] + [f"`{into}` double"])

    def make():
        differences = differ(model.pairs)
        return lambda batch: {into: pa.array(model.score(np.array([differences(raw) for raw in raw_texts(batch.column(text))])), pa.float64())}

    return docs.select(*rest).mapInArrow(per_batch(make, schema), schema)


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, by a model trained on the labels."""
    model = train(docs, labels, per_class=per_class)
    return scored(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, with their own columns."""
    score = unused(docs.columns, "__score")
    return scored(docs, train(docs, labels), into=score).where(F.col(score) >= threshold).drop(score)
