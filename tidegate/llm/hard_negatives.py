"""Hard negatives of labelled vectors, with angular triangle filtering.

Components become integers (``floor(scale * x)``) and a row's score is its integer inner product with the anchor. Positives of
an anchor are its best rows of the same label; the negatives of a positive are the best rows of other
labels whose score lies in a window below the positive's.

Every row is stored with its norm and its angles to ``REFERENCES`` reference directions (rows of
the table, of least hash). For an anchor a, a row x and a reference r the triangle inequality of
angles gives ``|ar - xr| <= ax <= min(ar + xr, 2 pi - ar - xr)``; the tightest bounds over all references are
an interval of the cosine, which times both norms bounds the score. Bounds are widened by more than
the rounding of angles and products, so they never exclude a row wrongly. Only rows whose interval meets a window that is still open
(at or above the worst of the best so far) are scored, in exact integers. Rows are stored by nearest
reference and angle, so whole blocks of rows fall outside as well.

Anchors are a stated query set: they pass in blocks of about ``ANCHORS``, each against all rows. A task
keeps the best of each anchor and window only, and those of all tasks are merged by a ranked window.
Only one block of anchors, with at most ``positives`` scores each, is in the driver at a time.

Rows with a NULL label, a NULL vector, or any NULL or non-finite component take no part. Components
are held within +-2^26 after scaling. Shorter vectors count as if filled with zeros; empty and zero vectors
score 0. Ties go to the smaller id, NULL ids last. Repeated rows (same id, label and integers) count
once; an anchor's own id is never its positive. Empty tables, and anchors without a positive or without a
row in the window, give no rows. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.llm.common import Batches
from tidegate.session import staging_path
from tidegate.sources.sinks import land

SCALE, POSITIVES, NEGATIVES, LOW, HIGH = 256, 5, 10, 30, 90
REFERENCES, ANCHORS, ROWS = 16, 1_024, 2_048
LARGEST = 1 << 26
#: More than the error of an angle (acos near 1 loses half the digits) and of a product of norms.
ANGLE_SLACK, SCORE_SLACK = 1e-6, 1e-9
NO_ID = (1 << 63) - 1
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _matrix(vectors: list[bytes]) -> np.ndarray:
    """Integer vectors as rows of doubles, filled with zeros."""
    rows = [np.frombuffer(v, np.int32) for v in vectors]
    out = np.zeros((len(rows), max(map(len, rows), default=0)))
    for row, values in zip(out, rows, strict=True):
        row[: len(values)] = values
    return out


def angles_to(references: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Angles of rows to reference directions; a zero vector is at a right angle to all."""
    width = min(rows.shape[1], references.shape[1])
    norms = np.outer(np.linalg.norm(rows, axis=1), np.linalg.norm(references, axis=1))
    return np.arccos(np.clip(np.divide(rows[:, :width] @ references[:, :width].T, norms, out=np.zeros_like(norms), where=norms > 0), -1, 1))


def score_bounds(angle: np.ndarray, norm: float, low: np.ndarray, high: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integers that enclose the scores of one anchor with rows (or blocks of rows).

    ``angle`` are the anchor's angles, ``low`` and ``high`` the range of the rows' angles (equal for
    single rows), ``least`` and ``most`` that of their norms.
    """
    nearest = np.maximum(np.maximum(low - angle, angle - high), 0).max(axis=-1, initial=0)
    farthest = np.minimum(high + angle, 2 * np.pi - low - angle).min(axis=-1, initial=np.pi)
    upper = np.cos(np.maximum(nearest - ANGLE_SLACK, 0))
    lower = np.cos(np.minimum(farthest + ANGLE_SLACK, np.pi))
    slack = SCORE_SLACK * norm * most + 1
    # A negative cosine is largest with the least norm, and the other way round.
    return np.floor(norm * np.minimum(lower * least, lower * most) - slack), np.ceil(norm * np.maximum(upper * least, upper * most) + slack)


def exact_scores(rows: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Integer inner products: in doubles while every partial sum is exact there, else in 64-bit integers."""
    width = min(rows.shape[1], len(anchor))
    rows, anchor = rows[:, :width], anchor[:width]
    if np.abs(rows).max(initial=0) * np.abs(anchor).max(initial=0) * width < 1 << 53:
        return (rows @ anchor).astype(np.int64)
    return rows.astype(np.int64) @ anchor.astype(np.int64)


class Best:
    """The best ``k`` rows so far: highest scores, then smallest ids."""

    def __init__(self, k: int, floor: int):
        self.k, self.floor = k, floor
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        """Scores below this can't get in any more."""
        return self.floor if len(self.scores) < self.k else max(self.floor, int(self.scores[-1]))

    def take(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.concatenate([self.scores, scores]), np.concatenate([self.ids, ids])
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


class Search:
    """A block of anchors, each with its windows ``(least, most)``, against rows as they come."""

    def __init__(self, anchors: list[dict], windows: list[list[tuple[int, int]]], same_label: bool, keep: int):
        self.same_label = same_label
        self.vectors = _matrix([a["vector"] for a in anchors])
        self.angles = [np.frombuffer(a["angles"], np.float64) for a in anchors]
        self.norms = np.linalg.norm(self.vectors, axis=1)
        self.labels, self.ids = [a["label"] for a in anchors], [a["vec_id"] for a in anchors]
        self.windows = windows
        self.best = [[Best(keep, low) for low, _ in w] for w in windows]

    def meet(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, angles: np.ndarray, norms: np.ndarray) -> None:
        low, high, least, most = angles.min(axis=0), angles.max(axis=0), norms.min(), norms.max()
        for i, windows in enumerate(self.windows):
            best = self.best[i]
            if not windows:
                continue
            wanted = min(b.least for b in best), max(top for _, top in windows)
            bottom, top = score_bounds(self.angles[i], self.norms[i], low, high, least, most)
            if top < wanted[0] or bottom > wanted[1]:
                continue
            fits = (labels == self.labels[i]) & (ids != self.ids[i]) if self.same_label else labels != self.labels[i]
            at = np.flatnonzero(fits)
            bottom, top = score_bounds(self.angles[i], self.norms[i], angles[at], angles[at], norms[at], norms[at])
            at = at[(top >= wanted[0]) & (bottom <= wanted[1])]
            if not len(at):
                continue
            scores = exact_scores(vectors[at], self.vectors[i])
            for b, (_, upper) in zip(best, windows, strict=True):
                inside = (scores >= b.least) & (scores <= upper)
                if inside.any():
                    b.take(scores[inside], ids[at[inside]])


SCHEMA = "anchor int, window int, id long, score long"


def _searched(rows: DataFrame, anchors: list[dict], windows: list[list[tuple[int, int]]], same_label: bool, keep: int) -> DataFrame:
    """``anchor, window, id, score, rank``: the best ``keep`` rows of every anchor and window."""

    def run(batches: Batches) -> Batches:
        search = Search(anchors, windows, same_label, keep)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                ids, labels = part.column("vec_id").fill_null(NO_ID).to_numpy(), part.column("label").to_numpy()
                angles = np.frombuffer(b"".join(part.column("angles").to_pylist()), np.float64).reshape(part.num_rows, -1)
                search.meet(ids, labels, _matrix(part.column("vector").to_pylist()), angles, part.column("norm").to_numpy())
        for i, best in enumerate(search.best):
            for w, b in enumerate(best):
                if n := len(b.ids):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, i, np.int32)), pa.array(np.full(n, w, np.int32)), pa.array(b.ids, mask=b.ids == NO_ID), pa.array(b.scores)], ["anchor", "window", "id", "score"])

    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    found = rows.mapInArrow(run, SCHEMA)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def stored(vectors: DataFrame, id_col: str, label: str, vector: str, scale: int = SCALE, references: int = REFERENCES) -> DataFrame:
    """Rows that take part, landed: ``vec_id, label, vector, norm, angles``, by nearest reference and angle."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(F.least(F.greatest(x.cast("double") * scale, F.lit(-float(LARGEST))), F.lit(float(LARGEST)))).cast("int"))
    finite = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    valid = vectors.where(F.col(label).isNotNull() & F.col(vector).isNotNull()).where(finite)
    rows = valid.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), scaled.alias("ints")).distinct()
    chosen = rows.select("ints").distinct().orderBy(F.xxhash64("ints"), "ints").limit(references).collect()
    pillars = _matrix([np.array(r.ints, np.int32).tobytes() for r in chosen])

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ints = [np.array(v, np.int32).tobytes() for v in batch.column("ints").to_pylist()]
            matrix = _matrix(ints)
            angles = angles_to(pillars, matrix)
            nearest = angles.argmin(axis=1) if angles.shape[1] else np.zeros(len(matrix), np.int64)
            columns = [batch.column("vec_id"), batch.column("label"), pa.array(ints, pa.binary()), pa.array(np.linalg.norm(matrix, axis=1)), pa.array([a.tobytes() for a in angles], pa.binary())]
            columns += [pa.array(nearest.astype(np.int32)), pa.array(angles[np.arange(len(matrix)), nearest] if angles.shape[1] else np.zeros(len(matrix)))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "label", "vector", "norm", "angles", "cell", "angle"])

    made = rows.mapInArrow(run, "vec_id long, label long, vector binary, norm double, angles binary, cell int, angle double")
    # The id splits a direction that very many rows share.
    placed = made.repartitionByRange("cell", "angle", "vec_id").sortWithinPartitions("cell", "angle")
    return land(placed.drop("cell", "angle"), "vectors")[0]


def mine(
    vectors: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchor`` is a condition on the id, named ``vec_id``. A negative's score is from ``low`` to
    ``high`` hundredths of the positive's. Ids and labels are integers.
    """
    spark = vectors.sparkSession
    rows = stored(vectors, id_col, label, vector, scale)
    anchors, n = land(rows.where(anchor).select("vec_id", "label", "vector", "angles"), "anchors")
    blocks = -(-n // ANCHORS)
    block = F.pmod(F.xxhash64("vec_id", "label", "vector"), F.lit(max(1, blocks)))
    path = staging_path(spark, "negatives")
    for b in range(blocks):
        held = [r.asDict() for r in anchors.where(block == b).collect()]
        if not held:
            continue
        open_ended = [[(-NO_ID, NO_ID)]] * len(held)
        found = sorted((r.anchor, r["rank"], r.id, r.score) for r in _searched(rows, held, open_ended, True, positives).collect())
        windows: list[list[tuple[int, int]]] = [[] for _ in held]
        for i, _, _, score in found:
            windows[i].append((-(-low * score // 100), high * score // 100))
        known = [(i, rank - 1, held[i]["vec_id"], positive, score) for i, rank, positive, score in found]
        known_rows = spark.createDataFrame(known, "anchor int, window int, anchor_id long, positive_id long, positive_score long")
        best = _searched(rows, held, windows, False, negatives)
        joined = best.join(F.broadcast(known_rows), ["anchor", "window"])
        out = joined.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        out.write.mode("append").parquet(path)
    return spark.read.schema(RESULT).parquet(path) if n else spark.createDataFrame([], RESULT)
