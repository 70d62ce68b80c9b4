"""Held-out accuracy of the classifiers, and the queries and the pipeline on the small tables."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.oracle_check import compare, connect
from tidegate.llm import common, exact_dedup, quality, queries, simhash, toxicity
from tidegate.llm.labelled import held_out

FOLDER = "/root/testdata/sf0.001"
LARGER = "/root/testdata/sf0.01"


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def corpus(spark, n=500):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(5)) for _ in range(300)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randint(20, 120))]
        good, toxic = i % 3 > 0, i % 5 == 0
        if not good:
            text = [w + rng.choice(["%%%", "$$$", "&&&"]) for w in text]
        if toxic:
            text[len(text) // 2 : len(text) // 2] = [rng.choice(["nasty", "vile"]), rng.choice(words), "thing"]
        docs.append((i, " ".join(text), "kept"))
        labels.append((i, int(good), int(toxic)))
    docs += [(None, None, "kept"), (n, "", "kept"), (n + 1, "long text " * 20_000, "kept"), (0, docs[0][1], "kept")]
    labels += [(None, 1, 0), (n, None, None), (7, None, None)]
    return spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(4), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("module", "target", "share"), [(quality, "quality", 0.98), (toxicity, "toxic", 0.95)])
def test_held_out_accuracy(spark, module, target, share):
    docs, labels = corpus(spark)
    rows = module.judged(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in rows)
    truth = {r.doc_id: r[target] for r in labels.collect() if r[target] is not None}
    tested = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert len(tested) > 50 and sum(p == t for p, t in tested) >= share * len(tested)
    again = {(r.doc_id, r.score) for r in module.judged(docs.repartition(7), labels).collect()}
    assert again == {(r.doc_id, r.score) for r in rows}


@pytest.mark.parametrize("module", [quality, toxicity])
def test_few_or_no_labels(spark, module):
    docs, labels = corpus(spark, 30)
    none = labels.limit(0)
    assert {r.score for r in module.judged(docs, none).collect()} == {0.5}
    one = module.judged(docs, labels.where("quality = 1 AND toxic = 0")).collect()
    assert len({round(r.score, 6) for r in one}) == 1
    assert module.judged(docs.limit(0), labels).count() == 0


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = corpus(spark)
    turned = labels.withColumn("quality", 1 - labels.quality).where(held_out()).unionByName(labels.where(~held_out()))
    scores = [sorted((r.doc_id or 0, r.score) for r in quality.judged(docs, x).collect()) for x in (labels, turned)]
    assert scores[0] == scores[1]


def test_skip_grams_reach_over_pieces(monkeypatch):
    text = " ".join(f"w{i % 17}" for i in range(300))
    want = toxicity.Hasher().distinct(text).tolist()
    pieces = common.pieces
    monkeypatch.setattr(toxicity, "pieces", lambda t, gap: pieces(t, gap, 7))
    assert toxicity.Hasher().distinct(text).tolist() == want


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, con, name):
    assert compare(spark, con, FOLDER, name, queries.QUERIES[name], queries.SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_rows(spark, name):
    found = entry.queries()[name](spark, FOLDER)
    key = "page_id" if "page_id" in found.columns else "doc_id"
    source = common.table(spark, FOLDER, "pages" if key == "page_id" else "documents")
    assert Counter(r[0] for r in found.select(key).distinct().collect()) == Counter(r[0] for r in source.select(key).collect())


def test_coordinates_are_held_one_text_at_a_time():
    import tracemalloc

    rng = np.random.default_rng(1)
    made = [np.unique(rng.integers(0, 1 << toxicity.BITS, n)).astype(np.int32) for n in (0, 5, 2_000, *[1_000] * 40)]
    labels = [i % 2 for i in range(len(made))]
    rows = toxicity.Spilled()
    for row in made:
        rows.add(row)
    for want, got in zip(toxicity.fit(made, labels, {0: 1.0, 1: 1.0}), toxicity.fit(rows, labels, {0: 1.0, 1: 1.0}), strict=True):
        assert (want == got).all()
    big = np.arange(1 << 18, dtype=np.int32)
    tracemalloc.start()
    for _ in range(40):
        rows.add(big)
    assert sum(len(row) for row in rows) == sum(map(len, made)) + 40 * len(big)
    assert tracemalloc.get_traced_memory()[1] < 6 * big.nbytes
    tracemalloc.stop()


def test_stages(spark):
    """Each stage keeps what a plain version of it keeps of its own input."""
    docs = common.table(spark, LARGER, "documents")
    labels = common.table(spark, LARGER, "labels")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "toxicity", "exact_dedup", "near_dedup", "packing"]

    good = stages["quality"](spark, docs, LARGER)
    assert good.columns == docs.columns
    rejected = {r.doc_id for r in quality.judged(docs, labels).where("predicted = 0").collect()}
    assert {r.doc_id for r in good.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - rejected

    clean = stages["toxicity"](spark, docs, LARGER)
    toxic = {r.doc_id for r in toxicity.judged(docs, labels).where("predicted = 1").collect()}
    assert toxic and {r.doc_id for r in clean.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()} - toxic

    once = stages["exact_dedup"](spark, docs, LARGER)
    texts = {}
    for r in docs.collect():
        plain = "".join(c for c in r.text if c not in common.BLANKS)
        texts[plain] = min(texts.get(plain, (0, 1 << 60)), (-len(r.text), r.doc_id))
    assert {r.doc_id for r in once.select("doc_id").collect()} == {i for _, i in texts.values()}

    apart = stages["near_dedup"](spark, docs, LARGER)
    firsts = {r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r.doc_id for r in apart.select("doc_id").collect()) == sorted(firsts)


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, FOLDER).collect()
    assert rows and {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"} <= set(rows[0].asDict())
    docs = common.table(spark, FOLDER, "documents")
    kept = exact_dedup.keep_one(toxicity.drop_toxic(quality.keep_good(docs, common.table(spark, FOLDER, "labels")), common.table(spark, FOLDER, "labels")))
    assert {r.doc_id for r in rows} <= {r.doc_id for r in kept.select("doc_id").collect()}
