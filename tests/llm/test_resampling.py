"""Importance resampling against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidegate.llm import importance

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text, longest=2):
    words = WORD.findall((text or "").translate(LOWER))
    return len(words), [" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]


def plain(docs, target, percent=25, least=20, longest=2, buckets=10_000, seed=7):
    """``(doc_id, n_words, n_features, weight, score)`` of every row, and how many are drawn."""
    place = lambda f: zlib.crc32(f.encode()) % buckets
    s = Counter(place(f) for _, text in docs for f in features(text, longest)[1])
    t = Counter(place(f) for text in target for f in features(text, longest)[1])
    big_s, big_t = s.total(), t.total()
    out = []
    for doc_id, text in docs:
        n, found = features(text, longest)
        gains = [math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets)))) for b in map(place, found)]
        weight = sum(gains) // len(gains) if gains else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        out.append((doc_id, n, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    return out, percent * sum(r[1] >= least for r in out) // 100


def corpus(n=400):
    rng = random.Random(3)
    vocabulary = ["Alpha", "beta", "GAMMA", "délta", "x1", "42", "ÄÖ", "eta", "θ", "iota"]
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 5, 19, 20, 21, 60]))) for _ in range(n)]
    texts[:6] = [None, "", " \n\t", "a-b_c.d", "word " * 200_000, " ".join(["glued"] * 30)]
    return [(i, t) for i, t in enumerate(texts)]


def test_resample(spark):
    docs, target = corpus(), ["alpha beta beta", "gamma délta x1", None, ""]
    frame = spark.createDataFrame([(i, t, "kept out") for i, t in docs], "doc_id long, text string, score string").repartition(5)
    got = importance.resample(frame, spark.createDataFrame([(t,) for t in target], "text string"))
    assert got.columns == ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    want, k = plain(docs, target)
    order = sorted((-r[4], r[0]) for r in want if r[1] >= 20)[:k]
    ranks = {i: n + 1 for n, (_, i) in enumerate(order)}
    assert k > 20
    assert sorted(map(tuple, got.collect())) == sorted((*r, ranks.get(r[0])) for r in want)


def test_longer_runs_across_pieces(monkeypatch):
    text = "one two three four five six seven eight nine ten"
    for longest in (1, 2, 3, 4):
        want = Counter(zlib.crc32(f.encode()) % 997 for f in features(text, longest)[1])
        for size in (1, 7, 16, 1000):
            monkeypatch.setattr(importance, "pieces", lambda raw, gap, size=size: _cut(raw, gap, size))
            parts = list(importance.feature_buckets(text.encode(), longest, 997))
            assert Counter(np.concatenate([p[1] for p in parts]).tolist()) == want
            assert sum(p[0] for p in parts) == 10


def _cut(raw, gap, size):
    from tidegate.llm.common import pieces

    return pieces(raw, gap, size)


def test_repeated_rows_null_ids_and_ties(spark):
    text = "same text " * 15
    rows = [(None, text)] * 40 + [(7, text)] * 40 + [(8, text)] * 3 + [(9, "short")]
    got = importance.resample(spark.createDataFrame(rows, "doc_id int, text string"), spark.createDataFrame([("same text",)], "text string"))
    drawn = got.where("rank is not null").collect()
    assert got.count() == len(rows)
    assert sorted(r["rank"] for r in drawn) == list(range(1, 25 * 83 // 100 + 1))
    order = sorted(drawn, key=lambda r: r["rank"])
    assert [(-r.score, r.doc_id is None, r.doc_id or 0) for r in order] == sorted((-r.score, r.doc_id is None, r.doc_id or 0) for r in drawn)
    assert min(r.score for r in drawn) >= max((r.score for r in got.where("rank is null and n_words >= 20").collect()), default=-(10**9))


@pytest.mark.parametrize("docs", [[], [(1, None)], [(1, "few words")]])
def test_nothing_to_draw(spark, docs):
    empty = spark.createDataFrame([], "text string")
    got = importance.resample(spark.createDataFrame(docs, "doc_id long, text string"), empty)
    assert [(r.doc_id, r["rank"]) for r in got.collect()] == [(d[0], None) for d in docs]


def test_select_kth(spark):
    keys = spark.range(0, 3_000, 1, 7).select((F.col("id") * 7919 % 97).alias("a"), F.col("id").alias("b"))
    ordered = sorted(map(tuple, keys.collect()))
    for k in (1, 2, 1_500, 2_999, 3_000):
        assert importance.select_kth(keys, k, pivots=5) == ordered[k - 1]
    with pytest.raises(ValueError):
        importance.select_kth(keys, 3_001)
