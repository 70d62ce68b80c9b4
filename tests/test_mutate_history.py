from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import one, values
from tidegate.operators import history as H
from tidegate.operators import mutate as M

TARGET = "k int, v string, kept int"
SOURCE = "k int, v string, seq int"


def ts(text):
    return F.lit(text).cast("timestamp")


def test_upsert_update_keeps_target_only_columns(rows):
    target = rows([(1, "a", 10), (2, "b", 20)], TARGET)
    source = rows([(2, "old", 1), (2, "new", 2), (3, "c", 1)], SOURCE)
    out = M.upsert(target, source, ["k"], order=["seq"])
    assert out.columns == target.columns
    assert values(out) == [(1, "a", 10), (2, "new", 20), (3, "c", None)]
    again = M.upsert(out, source.drop("seq").where("v <> 'old'"), ["k"])
    assert values(again.select("k", "v", "kept")) == values(out)


def test_upsert_writes_explicit_nulls(rows):
    out = M.upsert(rows([(1, "a", 1)], TARGET), rows([(1, None)], "k int, v string"), ["k"])
    assert values(out) == [(1, None, 1)]


def test_upsert_ignore_and_counts(rows):
    target = rows([(1, "a", 10)], TARGET)
    source = rows([(1, "x", 1), (2, "b", 1), (2, "b", 1)], SOURCE)
    out = M.upsert(target, source, ["k"], on_match="ignore")
    assert values(out, "k", "v") == [(1, "a"), (2, "b")]
    assert one(M.upsert_counts(target, source, ["k"])) == {"source_rows": 3, "inserted": 1, "matched": 1, "repeats": 1}
    with pytest.raises(ValueError, match="on_match"):
        M.upsert(target, source, ["k"], on_match="replace")


def test_null_keys_never_match_and_are_all_kept(rows):
    source = rows([(None, "x", 1), (None, "x", 1)], SOURCE)
    out = M.upsert(rows([(None, "a", 1)], TARGET), source, ["k"])
    assert out.count() == 3
    assert M.dedup(source, ["k"], ["seq"]).count() == 2


def test_empty_inputs(rows):
    none = rows([], SOURCE)
    target = rows([(1, "a", 10)], TARGET)
    assert values(M.upsert(target, none, ["k"]), "k", "v") == [(1, "a")]
    assert M.upsert(rows([], TARGET), rows([(1, "a", 1)], SOURCE), ["k"]).count() == 1
    assert M.new_rows(target, none, ["k"]).count() == 0


def test_patch_only_named_fields(rows):
    target = rows([(1, "a", 10), (2, "b", 20)], TARGET)
    changes = rows([(1, None, 99, ["v"]), (7, "z", 1, ["v"])], "k int, v string, kept int, set_cols array<string>")
    assert values(M.patch(target, changes, "k", ["v", "kept"])) == [(1, None, 10), (2, "b", 20)]
    assert values(M.patch(target, changes, "k", ["kept"])) == values(target)


def test_folded_patches_take_the_last_named_value(rows):
    changes = rows(
        [(1, 1, "a", 5, ["v", "w"]), (1, 2, None, 6, ["v"]), (2, 1, "q", 7, ["w"])],
        "k int, seq int, v string, w int, set_cols array<string>",
    )
    folded = {r.k: r for r in M.fold_patches(changes, "k", ["v", "w"], "seq").collect()}
    assert (folded[1].v, folded[1].w, folded[1].set_cols) == (None, 5, ["v", "w"])
    assert (folded[2].w, folded[2].set_cols) == (7, ["w"])


def test_delete_returns_what_it_removed(rows):
    target = rows([(1, "a", 1), (2, "b", 2)], TARGET)
    kept, deleted = M.delete_keys(target, rows([(2,), (9,), (2,)], "k int"), "k")
    assert (values(kept, "k"), values(deleted, "k")) == ([(1,)], [(2,)])
    kept, deleted = M.delete_where(rows([(1,), (None,)], "k int"), "k = 1")
    assert (values(kept), values(deleted)) == ([(None,)], [(1,)])


def test_seed_is_repeatable(rows):
    seeds = rows([(1, "a", 1)], TARGET)
    once = M.seed(rows([], TARGET), seeds, ["k"])
    assert values(M.seed(once, seeds, ["k"])) == values(once) == [(1, "a", 1)]


# --- versions -------------------------------------------------------------

ATTRS = ["a", "b"]
SRC = "k int, a string, b int"


def start(rows, data, at="2020-01-01", hash="json"):
    return H.scd2_start(rows(data, SRC), "k", ATTRS, ts(at), hash=hash)


@pytest.mark.parametrize("hash", ["json", "md5_concat"])
def test_merge_closes_changed_opens_new_keeps_rest(rows, hash):
    dim = start(rows, [(1, "x", 1), (2, "y", None), (3, "z", 3)], hash=hash)
    merged = H.scd2_merge(dim, rows([(1, "x", 2), (2, "y", None), (4, "w", 4)], SRC), "k", ATTRS, ts("2021-01-01"), hash=hash)
    day = datetime(2021, 1, 1)
    assert values(merged, "k", "b", "valid_to", "is_current") == sorted(
        [(1, 1, day, False), (1, 2, None, True), (2, None, None, True), (3, 3, None, True), (4, 4, None, True)], key=repr
    )
    assert merged.select("surrogate_key").distinct().count() == 5
    assert merged.columns == dim.columns


def test_merge_twice_is_merge_once(rows):
    dim = start(rows, [(1, "x", 1)])
    src = rows([(1, "x", 2), (2, "y", 1)], SRC)
    once = H.scd2_merge(dim, src, "k", ATTRS, ts("2021-01-01"))
    assert values(H.scd2_merge(once, src, "k", ATTRS, ts("2022-01-01"))) == values(once)


def test_key_changed_twice_and_back(rows):
    dim = start(rows, [(1, "x", 1)])
    dim = H.scd2_merge(dim, rows([(1, "x", 2)], SRC), "k", ATTRS, ts("2021-01-01"), reason="fix")
    dim = H.scd2_merge(dim, rows([(1, "x", 1)], SRC), "k", ATTRS, ts("2022-01-01"))
    history = H.scd2_history(dim, "k").orderBy("version_number").collect()
    assert [(r.version_number, r.b, r.is_current, r.change_reason) for r in history] == [
        (1, 1, False, None), (2, 2, False, "fix"), (3, 1, True, None),
    ]
    assert all(a.valid_until == b.valid_from for a, b in zip(history, history[1:], strict=False))
    assert history[-1].valid_until.year == 9999
    assert dim.where("is_current").groupBy("k").count().where("count > 1").count() == 0


def test_null_attribute_change_is_seen(rows):
    dim = start(rows, [(1, None, 1)])
    merged = H.scd2_merge(dim, rows([(1, "now", 1)], SRC), "k", ATTRS, ts("2021-01-01"))
    assert merged.count() == 2


def test_as_of_is_half_open(rows):
    dim = H.scd2_merge(start(rows, [(1, "x", 1)]), rows([(1, "x", 2)], SRC), "k", ATTRS, ts("2021-01-01"))
    at = {d: values(H.scd2_as_of(dim, ts(d)), "b") for d in ("2019-12-31", "2020-01-01", "2020-12-31", "2021-01-01")}
    assert at == {"2019-12-31": [], "2020-01-01": [(1,)], "2020-12-31": [(1,)], "2021-01-01": [(2,)]}
    assert H.scd2_current(dim).columns == ["surrogate_key", "k", "a", "b", "effective_from", "created_at"]


@pytest.mark.parametrize(("small", "size"), [(32, 10**9), (0, 10**9), (0, 20)])
def test_as_of_join_paths_agree_with_brute_force(spark, small, size):
    versions = [(k, f"2020-01-{d:02d}", f"2020-01-{d + 2:02d}" if d % 4 else None, f"{k}-{d}") for k in (1, 2) for d in (3, 6, 9, 12)]
    closed = [(k, a, b or f"2020-01-{int(a[-2:]) + 3:02d}", v) for k, a, b, v in versions]
    dim = spark.createDataFrame(closed, "k int, a string, b string, v string").selectExpr(
        "k", "CAST(a AS timestamp) AS valid_from", "CAST(b AS timestamp) AS valid_to", "v"
    )
    facts = [(i, 1 if i % 5 else (None if i % 2 else 3), f"2020-01-{1 + i % 17:02d}") for i in range(150)]
    fact = spark.createDataFrame(facts, "id int, fk int, at string").withColumn("at", F.to_timestamp("at"))
    out = H.as_of_join(fact, dim, ("fk", "k"), "at", ["v"], "id", short_histories=small > 0, rows_per_slice=size)
    want = []
    for i, k, at in facts:
        match = [v for key, a, b, v in closed if key == k and a <= at < b]
        want.append((i, match[0] if match else None))
    assert values(out, "id", "v") == sorted(want, key=repr)


def test_lookup_keeps_unmatched_codes(rows):
    labels = rows([(1, "one")], "code int, label string")
    assert values(H.lookup(rows([(1,), (2,), (None,)], "c int"), "c", labels, "code", ["label"])) == sorted(
        [(1, "one"), (2, None), (None, None)], key=repr
    )
