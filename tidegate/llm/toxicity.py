"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features of a text are its distinct words, word pairs, and pairs of words with one or two
words between them, hashed into ``2 ** BITS`` coordinates. FTRL-proximal learns online with
its own rate for each coordinate; the L1 term keeps all but a few hundred weights at zero, so
the model that is broadcast is small (its bound is the number of coordinates).

Training uses at most ``PER_CLASS`` labelled rows of each class (documented bound), in one
task on an executor because the updates are sequential; weights of the rows restore the
proportion of all labels. Their coordinates (4 MB a text at most) lie in a temporary file of the task,
which holds one text's at a time. Scoring reads every word of every text; labels, language, source
and id are no input of it.

NULL counts as empty; an empty text gets the score of the bias alone. Without training rows
of both classes every score is the share of label 1 (0.5 without labels). Repeated rows and
NULL ids are scored like others; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import tempfile
import zlib
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import per_batch, pieces, small_batches, texts_of, unused
from tidegate.llm.labelled import held_out, training_sample

PER_CLASS, BITS, THRESHOLD = 6_000, 20, 0.3
ALPHA, BETA, L1, L2, EPOCHS = 2.0, 1.0, 6.0, 0.0, 6
GAPS = (1, 2, 3)
WORD, BLANK = re.compile(r"\w+"), re.compile(r"\s")
#: Word hashes that a worker remembers.
CACHED = 200_000
SPREAD, PAIR = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class Hasher:
    """Coordinates of the features of a text."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def words(self, text: str) -> np.ndarray:
        words = WORD.findall(text.lower())
        missing = set(words).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > CACHED:
                self.known, missing = {}, set(words)
            self.known.update((w, zlib.crc32(w.encode("utf-8", "surrogatepass"))) for w in missing)
        return np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))

    def coordinates(self, text: str):
        """Arrays of coordinates, repeats included; a long text comes in pieces, whose pairs reach back over the cut."""
        before = np.empty(0, np.uint64)
        for piece in pieces(text, BLANK):
            new = self.words(piece)
            both, old = np.concatenate([before, new]), len(before)
            yield new * SPREAD >> np.uint64(64 - BITS)
            for gap in GAPS:
                if len(both) > max(gap, old):
                    right = both[max(gap, old) :]
                    left = both[max(gap, old) - gap : len(both) - gap]
                    yield (left * PAIR + right + np.uint64(gap << 40)) * SPREAD >> np.uint64(64 - BITS)
            before = both[-max(GAPS) :]

    def distinct(self, text: str) -> np.ndarray:
        return np.unique(np.concatenate([*self.coordinates(text), np.empty(0, np.uint64)])).astype(np.int32)


class Spilled:
    """Arrays of coordinates in a temporary file; each iteration reads them again, one at a time."""

    def __init__(self):
        self.file, self.sizes = tempfile.TemporaryFile(), []

    def add(self, row: np.ndarray):
        self.file.write(row.tobytes())
        self.sizes.append(len(row))

    def __iter__(self):
        self.file.seek(0)
        for n in self.sizes:
            yield np.frombuffer(self.file.read(4 * n), np.int32)


def fit(rows: Iterable[np.ndarray], labels: list[int], weight: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """``(coordinates, weights)`` that are not zero; the last coordinate is the bias, free of L1."""
    bias = 1 << BITS
    z, n = np.zeros(bias + 1), np.zeros(bias + 1)

    def weights(at):
        zs, rate = z[at], (BETA + np.sqrt(n[at])) / ALPHA + L2
        shrunk = np.where(np.abs(zs) <= L1, 0.0, (np.sign(zs) * L1 - zs) / rate)
        return np.where(at == bias, -zs / rate, shrunk)

    for _ in range(EPOCHS):
        for row, label in zip(rows, labels, strict=True):
            at = np.append(row, bias)
            w = weights(at)
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, float(w.sum())))))
            g = (p - label) * weight[label]
            root = np.sqrt(n[at])
            n[at] += g * g
            z[at] += g - (np.sqrt(n[at]) - root) / ALPHA * w
    w = weights(np.arange(bias + 1))
    at = np.flatnonzero(w)
    return at, w[at]


def train(docs: DataFrame, labels: DataFrame, target: str = "toxic", per_class: int = PER_CLASS, id_col: str = "doc_id", text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Coordinates and weights of the model."""
    sample, sizes = training_sample(docs, labels, target, per_class, id_col, text)
    total, bias = sum(sizes.values()), 1 << BITS
    share = sizes.get(1, 0) / total if total else 0.5

    def learn(batches):
        hasher, rows, known = Hasher(), Spilled(), []
        for batch in small_batches(batches):
            for text in texts_of(batch.column("text")):
                rows.add(hasher.distinct(text))
            known += batch.column("label").to_pylist()
        ones = sum(known)
        if 0 < ones < len(known):
            weight = {1: share * len(known) / ones, 0: (1 - share) * len(known) / (len(known) - ones)}
            at, w = fit(rows, known, weight)
        else:
            odds = min(max(share, 1e-6), 1 - 1e-6)
            at, w = np.array([bias]), np.array([math.log(odds / (1 - odds))])
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(w, pa.float64())], ["at", "w"])

    # At most 2 * PER_CLASS rows: the bounded sample, not the corpus, meets in this task.
    ordered = sample.repartition(1).sortWithinPartitions(F.xxhash64(F.lit("order"), "doc_id"), "doc_id", F.xxhash64("text"))
    model = ordered.mapInArrow(learn, "at int, w double").collect()
    if not model:
        model = [(bias, math.log(0.5 / 0.5))]
    return np.array([r[0] for r in model]), np.array([r[1] for r in model])


def scored(docs: DataFrame, model: tuple[np.ndarray, np.ndarray], text: str = "text", into: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score (a column of that name is replaced)."""
    rest = [c for c in docs.columns if c != into]
    schema = ", ".join([f"`{c}` {dict(docs.dtypes)[c]}" for c in rest] + [f"`{into}` double"])
    small = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        at, w = small.value
        dense = np.zeros((1 << BITS) + 1)
        dense[at] = w
        hasher, used = Hasher(), dense != 0

        def one(text: str) -> float:
            hits = [c[used[c]] for c in hasher.coordinates(text)]
            total = dense[-1] + (dense[np.unique(np.concatenate(hits))].sum() if hits else 0.0)
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, float(total)))))

        return lambda batch: {into: pa.array([one(t) for t in texts_of(batch.column(text))], pa.float64())}

    return docs.select(*rest).mapInArrow(per_batch(make, schema), schema)


def judged(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, per_class: int = PER_CLASS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document, by a model trained on the labels."""
    model = train(docs, labels, per_class=per_class)
    return scored(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, with their own columns."""
    score = unused(docs.columns, "__score")
    return scored(docs, train(docs, labels), into=score).where(F.col(score) < threshold).drop(score)
