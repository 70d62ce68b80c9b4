"""Hard negatives against brute force, and the bounds against exact scores."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import hard_negatives
from tidegate.llm.hard_negatives import angles_to, exact_scores, mine, score_bounds


def brute(rows, is_anchor, positives=5, negatives=10, low=30, high=90):
    kept = {}
    for vec_id, label, vector in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        kept[vec_id, label, tuple(math.floor(256 * x) for x in vector)] = None
    key = lambda r: (-r[0], r[1] is None, r[1] or 0)
    out = []
    for a, la, va in kept:
        if a is None or not is_anchor(a):
            continue
        scored = [(sum(x * y for x, y in zip(va, v, strict=False)), i, lb == la) for i, lb, v in kept]
        for p, pid, _ in sorted((s for s in scored if s[2] and s[1] != a), key=key)[:positives]:
            fits = sorted((s for s in scored if not s[2] and low * p <= 100 * s[0] <= high * p), key=key)[:negatives]
            out += [(a, pid, n + 1, i, p, s) for n, (s, i, _) in enumerate(fits)]
    return sorted(out, key=repr)


def vectors(n=500, d=12, seed=5):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(d)] for _ in range(6)]
    rows = [(i, i % 4, [c + rng.gauss(0, 0.4) for c in centres[i % 6]]) for i in range(n)]
    rows += [(n, 1, None), (n + 1, None, [1.0] * d), (n + 2, 1, [1.0, None]), (n + 3, 1, [math.nan] * d), (n + 4, 2, [math.inf] + [0.0] * (d - 1))]
    rows += [(n + 5, 2, []), (n + 6, 2, [0.0] * d), (n + 7, 3, [2.0, 1.0]), (None, 0, rows[0][2]), (None, 1, rows[0][2])]
    return rows + [rows[30]] * 5 + [(20, 9, rows[20][2]), (40, 3, [-x for x in rows[40][2]])]


SCHEMA = "vec_id long, label int, embedding array<double>, score string"


@pytest.mark.parametrize("anchors", [1_024, 7])
def test_mine(spark, monkeypatch, anchors):
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    monkeypatch.setattr(hard_negatives, "ROWS", 64)
    rows = vectors()
    frame = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(5)
    got = mine(frame, F.col("vec_id") % 10 == 0)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint", "bigint", "int", "bigint", "bigint", "bigint"]
    want = brute(rows, lambda i: i % 10 == 0)
    assert len(want) > 1_000
    assert sorted(map(tuple, got.collect()), key=repr) == want


def test_bounds_enclose_every_score():
    rng = np.random.default_rng(1)
    for spread in (1e-3, 0.3, 30.0):
        rows = np.floor(rng.normal(size=(300, 24)) * spread * 256 + rng.normal(size=24) * 256)
        rows[0], rows[1] = 0, rows[2]
        references = rows[2:12]
        angles, norms = angles_to(references, rows), np.linalg.norm(rows, axis=1)
        for i in range(0, 300, 7):
            scores = exact_scores(rows, rows[i])
            low, high = score_bounds(angles[i], norms[i], angles, angles, norms, norms)
            assert (low <= scores).all() and (scores <= high).all()
            low, high = score_bounds(angles[i], norms[i], angles.min(0), angles.max(0), norms.min(), norms.max())
            assert low <= scores.min() and scores.max() <= high


def test_filter_leaves_most_rows_of_far_clusters_unscored(monkeypatch):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 32)) * 2_000
    rows = np.floor(centres[np.arange(4_000) % 40] + rng.normal(size=(4_000, 32)) * 60)
    angles = angles_to(np.floor(centres), rows)
    norms, scored = np.linalg.norm(rows, axis=1), []
    monkeypatch.setattr(hard_negatives, "exact_scores", lambda r, a: scored.append(len(r)) or exact_scores(r, a))
    held = [{"vec_id": i, "label": 0, "vector": rows[i].astype(np.int32).tobytes(), "angles": angles[i].tobytes()} for i in range(40)]
    search = hard_negatives.Search(held, [[(-(1 << 60), 1 << 60)]] * 40, True, 5)
    for at in range(0, 4_000, 500):
        part = slice(at, at + 500)
        search.meet(np.arange(4_000)[part], np.zeros(500, np.int64), rows[part], angles[part], norms[part])
    assert sum(scored) < 40 * 4_000 / 3
    for i in range(40):
        want = sorted((-s, j) for j, s in enumerate(exact_scores(rows, rows[i]).tolist()) if j != i)[:5]
        assert [(-s, j) for s, j in zip(search.best[i][0].scores.tolist(), search.best[i][0].ids.tolist(), strict=True)] == want


def test_large_components_stay_exact():
    rows = np.array([[float(1 << 26), 1.0, 3.0], [-float(1 << 26), -1.0, 5.0]])
    assert exact_scores(rows, rows[0]).tolist() == [(1 << 52) + 10, -(1 << 52) + 14]


def test_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mine(empty, F.col("vec_id") % 100 == 0).collect() == []
    alone = spark.createDataFrame([(100, 1, [1.0, 2.0], "x")], SCHEMA)
    assert mine(alone, F.col("vec_id") % 100 == 0).collect() == []
