"""Exact and near duplicates against brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from tidegate.llm import bloom, exact_dedup, simhash

BLANK = re.compile(r"[\x20\x09-\x0D]")
TEXTS = [None, "", " \t\n", "a b", "ab", "a  b ", "A b", "long " * 20_000, "other", "other ", "x\u00a0y", "x y", "é", "e\u0301"]


def documents(spark):
    rows = [(i, TEXTS[i % len(TEXTS)], "k") for i in range(60)] + [(None, "ab", "k"), (None, "lonely", "k"), (200, "other ", "k"), (200, "other ", "k"), (201, "single", "k")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, keep_id string").repartition(5)


def wanted(rows):
    groups = {}
    for doc_id, text, _ in rows:
        groups.setdefault(BLANK.sub("", text or ""), []).append((-len(text or ""), doc_id is None, doc_id or 0))
    out = Counter()
    for doc_id, text, _ in rows:
        plain = BLANK.sub("", text or "")
        best = min(groups[plain])
        out[(doc_id, None if best[1] else best[2], len(groups[plain]), (-len(text or ""), doc_id is None, doc_id or 0) == best, hashlib.sha256(plain.encode()).hexdigest())] += 1
    return out


def test_exact(spark):
    rows, docs = documents(spark)
    want = wanted(rows)
    # Rows that agree in id and length: one of them stays.
    for key, n in [*want.items()]:
        if n > 1 and key[3]:
            want[key] = 1
            want[(*key[:3], False, key[4])] += n - 1
    got = Counter(tuple(r) for r in exact_dedup.marked(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())
    assert got == want
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert kept.count() == len({BLANK.sub("", t or "") for _, t, _ in rows})


def test_full_filter_only_moves_more_rows(spark, monkeypatch):
    monkeypatch.setattr(bloom, "MIN_WORDS", 1024)
    monkeypatch.setattr(bloom, "MAX_WORDS", 1024)
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 19_000).cast("string")).alias("text"))
    found = exact_dedup.marked(docs)
    assert found.where("kept").count() == 19_000
    assert found.where("group_size = 2").count() == 2_000


def test_repeated_rows_meet_in_no_window(spark):
    docs = spark.range(0, 3_000, 1, 6).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.lit("same").alias("text"), F.col("id").alias("n"))
    docs = docs.unionByName(docs.withColumns({"doc_id": F.lit(None).cast("long"), "text": F.lit("no id")}))
    found = exact_dedup.marked(docs)
    assert "Window" not in found._jdf.queryExecution().toString()
    assert found.groupBy("text").agg(F.count(F.lit(1)), F.sum(F.col("kept").cast("int")), F.min("keep_id"), F.min("group_size")).sort("text").collect() == [("no id", 3_000, 1, None, 3_000), ("same", 3_000, 1, 0, 3_000)]
    assert found.select("text", "n").distinct().count() == 6_000


def test_exact_empty(spark):
    assert exact_dedup.marked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def plain_fingerprint(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    words = [w for w in BLANK.sub(" ", lowered).split(" ") if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(monkeypatch):
    texts = [*TEXTS, "one", "one two", "one two three", "a b c a b c a b c d", "Ä ä A a \x1c b"]
    want = [plain_fingerprint(t) for t in texts]
    assert simhash.fingerprints([(t or "").encode() for t in texts]) == want
    chunks = simhash.in_chunks
    monkeypatch.setattr(simhash, "in_chunks", lambda raws, gap: chunks(raws, gap, 11))
    assert simhash.fingerprints([(t or "").encode() for t in texts]) == want


def components_by_hand(values):
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(parent)
    for i, a in enumerate(ordered):
        for b in ordered[i + 1 :]:
            if (a ^ b).bit_count() <= simhash.RADIUS:
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {v: root(v) for v in ordered}


def clusters(n=1_200):
    rng = random.Random(3)
    values = {0, (1 << 64) - 1}
    centres = [rng.getrandbits(64) for _ in range(4)]
    while len(values) < n:
        v = rng.choice(centres)
        for _ in range(rng.randint(0, 6)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    # A chain: every member is near the next one only.
    v = rng.getrandbits(64)
    for b in range(0, 40, 2):
        v ^= 3 << b
        values.add(v)
    return sorted(values)


@pytest.mark.parametrize("shard", [1_024, 20])
def test_links_keep_every_component(spark, shard):
    values = clusters()
    distinct = spark.createDataFrame([(simhash.signed(v),) for v in values], "fp long").repartition(4)
    found = simhash.links(distinct, shard)
    assert len(found) == 1 if shard > 1_000 else len(found) > 1
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    stars = {r.a & simhash.LOW64: r.b & simhash.LOW64 for r in simhash.components(edges).collect()}
    groups = {}
    for v in values:
        groups.setdefault(stars.get(v, v), set()).add(v)
    want = {}
    for v, r in components_by_hand(values).items():
        want.setdefault(r, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_tree_finds_all_neighbours():
    tree, seen = simhash.Tree(), []
    for v in clusters(500):
        assert sorted(tree.values[i] for i in tree.add_and_find(v)) == sorted(u for u in seen if (u ^ v).bit_count() <= 2)
        seen.append(v)


def test_stated_limit_of_a_shard():
    free = max(64 - mask.bit_count() for mask in simhash.BLOCKS[-1])
    assert f"no shard can exceed {1 << free:,}." in " ".join(simhash.__doc__.split())


def test_near_duplicates(spark):
    base = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(5, base), (3, base.upper()), (9, base + " "), (7, None), (8, ""), (None, " \n"), (1, "quite another text of its own"), (None, base), (2, "x" * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")).withColumn("tie", F.lit(1))
    got = {(r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    first = {}
    for doc_id, text in rows:
        v = plain_fingerprint(text)
        first[v] = min(first.get(v, 1 << 60), 1 << 60 if doc_id is None else doc_id)
    assert got == {(i, f"{plain_fingerprint(t):016x}", first[plain_fingerprint(t)]) for i, t in rows}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 3, 7]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
