"""The quality score against a plain one: compressed sizes, their normalised differences, one logistic formula."""

import math

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from tidegate.llm import quality

GOOD = [f"the quick brown fox number {i} jumps over a lazy dog and rests in the shade" for i in range(400)]
BAD = [f"$$$ win {i} !!! click %%% here &&& now {i * 7919 % 1000}" for i in range(400)]


def plain_inputs(text, pairs):
    raw, rows = text.encode(), []
    for good, bad in pairs:
        sizes = []
        for i in range(0, len(raw), quality.BLOCK):
            block = raw[i : i + quality.BLOCK]
            both = []
            for content in (good, bad):
                packer = zstandard.ZstdCompressor(level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(content), write_content_size=False, write_dict_id=False, write_checksum=False)
                both.append(len(packer.compress(block)))
            sizes.append(both)
        g, b = sum(s[0] for s in sizes), sum(s[1] for s in sizes)
        each = sorted((y - x) / (x + y) for x, y in sizes)
        middle = sum(each) / len(each)
        rows.append(((b - g) / (b + g), each[0], each[-1], each[len(each) // 4], math.sqrt(sum((e - middle) ** 2 for e in each) / len(each))))
    return [sum(column) / len(rows) for column in zip(*rows, strict=True)]


@pytest.fixture(scope="module")
def trained(spark):
    rows = [(i, t) for i, t in enumerate(GOOD + BAD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, int(i < len(GOOD))) for i, _ in rows], "doc_id long, quality int")
    return docs, labels, quality.train(docs, labels)


def test_scores_equal_the_plain_formula(trained):
    docs, _, model = trained
    assert len(model.pairs) == 2
    for row in quality.scored(docs.where("doc_id % 37 = 0"), model).collect():
        x = plain_inputs(row.text, model.pairs)
        z = model.weights[0] + sum(w * (v - m) / s for w, v, m, s in zip(model.weights[1:], x, model.mean, model.scale, strict=True))
        assert row.score == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))), abs=1e-9)


def test_length_alone_changes_nothing(trained):
    """A text whose blocks are all alike has the same differences however often they are repeated."""
    _, _, model = trained
    block = (GOOD[3] * 3)[: quality.BLOCK].encode()
    differences = quality.differ(model.pairs)
    once, often = differences(block), differences(block * 50)
    assert np.allclose(once, often)
    assert (differences(b"") == 0).all()


def test_texts_behind_a_dictionary_are_whole_and_bounded(trained, monkeypatch):
    docs, labels, _ = trained
    seen = []
    monkeypatch.setattr(quality, "TRAINED_BYTES", 5_000)
    monkeypatch.setattr(quality, "dictionary", lambda samples: seen.append(samples) or b"".join(samples)[-2_000:])
    long_one = docs.limit(1).withColumns({"doc_id": F.lit(10_000).cast("long"), "text": F.repeat(F.lit("all of it "), 10_000)})
    more = labels.limit(1).withColumns({"doc_id": F.lit(10_000).cast("long"), "quality": F.lit(1)})
    quality.train(docs.unionByName(long_one), labels.unionByName(more))
    texts = {t.encode() for t in GOOD + BAD}
    assert len(seen) == 4
    for samples in seen:
        assert 3_000 < sum(map(len, samples)) <= 5_000
        assert set(samples) <= texts
