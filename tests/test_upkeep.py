"""Dimensions from change logs, rollups kept up to date, reconciliation down to rows, overlapping versions, drift."""

import math
import random
from collections import defaultdict
from datetime import datetime, timedelta
from itertools import pairwise

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidegate.operators import changelog, intervals, ordering, paging, reconcile
from tidegate.operators.history import scd2_merge, scd2_start
from tidegate.operators.rollups import Rollup
from tidegate.operators.shape import union_all
from tidegate.plans import drift, maintained
from tidegate.session import staging_path
from tidegate.sources import compaction, sinks

DAY = datetime(2024, 1, 1)
LOG = "k int, a string, b int, at timestamp, n long, gone boolean"


def now():
    return F.lit("2024-06-01").cast("timestamp")


def at(days):
    return DAY + timedelta(days=days)


# --- change logs -------------------------------------------------------------


def plain_versions(changes):
    """Versions of ``(key, a, b, time, seq, gone)`` by one pass over the ordered changes of each key."""
    by_key = defaultdict(dict)
    for k, a, b, t, n, gone in sorted(changes, key=lambda c: (c[3], c[4])):
        by_key[k][t] = None if gone else (a, b)
    out = []
    for k, states in by_key.items():
        kept, last = [], None
        for t, state in sorted(states.items()):
            if state != last:
                kept.append((t, state))
            last = state
        ends = [t for t, _ in kept[1:]] + [None]
        out += [(k, *state, t, end) for (t, state), end in zip(kept, ends, strict=True) if state]
    return sorted(out, key=repr)


def random_changes(n, keys=5, seed=1):
    rng = random.Random(seed)
    return [(rng.randrange(keys), rng.choice("xyz"), rng.choice([1, None]), at(rng.randrange(40)), i, rng.random() < 0.15) for i in range(n)]


def as_log(spark, changes):
    frame = spark.createDataFrame(changes, LOG)
    return changelog.to_log(frame, "k", ["a", "b"], F.col("at"), F.col("n"), F.col("gone"))


def shown(dim):
    return values(dim, "k", "a", "b", "valid_from", "valid_to")


def empty_dimension(spark):
    return scd2_start(spark.createDataFrame([], LOG), "k", ["a", "b"], F.col("at"))


@pytest.mark.parametrize("loads", [1, 3])
def test_changes_in_any_order(spark, loads):
    changes = random_changes(160)
    random.Random(loads).shuffle(changes)
    dim, log = empty_dimension(spark), as_log(spark, [])
    for part in range(loads):
        done = changelog.apply_changes(dim, log, as_log(spark, changes[part::loads]), "k", ["a", "b"], now())
        dim, log = sinks.land(done.dim)[0], union_all(log, done.added)
    assert shown(dim) == plain_versions(changes)
    assert dim.where("is_current <> (valid_to IS NULL)").count() == 0
    assert dim.select("surrogate_key").distinct().count() == dim.count()


def test_one_by_one_equals_all_at_once(spark):
    changes = random_changes(7, keys=1, seed=4)
    dim, log = empty_dimension(spark), as_log(spark, [])
    for change in changes:
        done = changelog.apply_changes(dim, log, as_log(spark, [change]), "k", ["a", "b"], now())
        dim, log = sinks.land(done.dim)[0], union_all(log, done.added)
    assert shown(dim) == shown(changelog.apply_changes(empty_dimension(spark), as_log(spark, []), as_log(spark, changes), "k", ["a", "b"], now()).dim) == plain_versions(changes)


def test_a_repeat_that_was_no_change_counts_once_a_late_one_comes(spark):
    """x, x again on day 10, then a late y on day 5: x returns on day 10."""
    dim, log = empty_dimension(spark), as_log(spark, [])
    for change in [(1, "x", 1, at(0), 0, False), (1, "x", 1, at(10), 1, False), (1, "y", 1, at(5), 2, False)]:
        done = changelog.apply_changes(dim, log, as_log(spark, [change]), "k", ["a", "b"], now())
        dim, log = sinks.land(done.dim)[0], union_all(log, done.added)
    assert [(r[1], r[3], r[4]) for r in shown(dim)] == [("x", at(0), at(5)), ("x", at(10), None), ("y", at(5), at(10))]


def test_existing_dimension_and_repeated_load(spark, rows):
    first = scd2_start(rows([(1, "x", 1), (2, "y", 2), (3, "z", 3)], "k int, a string, b int"), "k", ["a", "b"], F.lit(at(0)))
    dim = sinks.land(scd2_merge(first, rows([(1, "w", 1)], "k int, a string, b int"), "k", ["a", "b"], F.lit(at(20)), reason="load"))[0]
    log = sinks.land(changelog.log_of(dim, "k", ["a", "b"]))[0]
    assert values(changelog.versions_from(log, "k", ["a", "b"]), "k", "a", "b", "valid_from", "valid_to") == shown(dim)
    late = as_log(spark, [(1, "v", 1, at(10), 0, False), (4, "n", None, at(3), 1, False), (3, None, None, at(8), 2, True), (None, "q", 1, at(1), 3, False), (5, "q", 1, None, 4, False)])
    done = changelog.apply_changes(dim, log, late, "k", ["a", "b"], now(), reason="late")
    assert values(done.refused, "k", "a") == sorted([(None, "q"), (5, "q")], key=repr)
    want = [(1, "x", at(0), at(10), False), (1, "v", at(10), at(20), True), (1, "w", at(20), None, False), (2, "y", at(0), None, False), (3, "z", at(0), at(8), False), (4, "n", at(3), None, True)]
    got = done.dim.select("k", "a", "valid_from", "valid_to", F.coalesce(F.col("change_reason") == "late", F.lit(False)).alias("new"))
    assert values(got) == sorted(want, key=repr)
    assert {r.a for r in done.dim.where(F.col("updated_at") == now()).collect()} == {"x", "v", "z", "n"}
    assert done.dim.columns == dim.columns
    again = changelog.apply_changes(sinks.land(done.dim)[0], union_all(log, done.added), late, "k", ["a", "b"], F.lit(at(300)))
    assert again.added.count() == 0
    assert values(again.dim) == values(done.dim)


def test_hot_key_is_cut(spark):
    changes = [(i % 50 and 1, f"s{i * 7919 % 1000 // 2}", None, at(0) + timedelta(minutes=i * 7919 % 1000), i, False) for i in range(1000)]
    got = changelog.versions_from(as_log(spark, changes), "k", ["a", "b"], rows_per_slice=60)
    assert values(got, "k", "a", "b", "valid_from", "valid_to") == plain_versions(changes)


# --- rollups -----------------------------------------------------------------

TRIPS = Rollup("ts", "hour", ["zone"], {"avg_fare": ("fare", 2)}, {"riders": "n"}, {"cars": "car"}, {"mid_fare": ("fare", 2)})


def trips(spark, n=3_000, days=6, seed=3, first=0):
    rng = random.Random(seed)
    rows = [(first + i, rng.choice([at(rng.random() * days), None]) if i % 50 == 0 else at(rng.random() * days), rng.choice("ab"), None if i % 9 == 0 else rng.randrange(10_000) / 100, rng.randrange(5), rng.randrange(700)) for i in range(n)]
    return spark.createDataFrame(rows, "id int, ts timestamp, zone string, fare double, n int, car int").withColumn("day", F.to_date("ts"))


def full(df, unit, keys):
    cents = F.round(F.col("fare") * 100).cast("bigint")
    out = df.where("ts IS NOT NULL").groupBy(F.date_trunc(unit, "ts").alias(unit), *keys).agg(F.count(F.lit(1)).alias("t"), F.sum(cents).alias("c"), F.count("fare").alias("m"), F.sum("n").alias("r"))
    return sorted([(*[r[k] for k in (unit, *keys)], r.t, float(f"{(2 * r.c + r.m) // (2 * r.m) / 100:.2f}"), r.r) for r in out.collect()])


def read(states, unit, keys):
    got = TRIPS.read(states, unit, keys)
    return sorted((*[r[k] for k in (unit, *keys)], r.total_trips, float(r.avg_fare), r.riders) for r in got.collect())


def files(path):
    import os

    return {f"{folder}/{f}" for folder, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize("few_keys", [0, changelog.FEW_KEYS])
def test_touched_and_other_keys(spark, few_keys):
    old, new = random_changes(120, keys=12, seed=3), [(k, a, b, t, n + 1000, gone) for k, a, b, t, n, gone in random_changes(60, keys=8, seed=4)]
    first = changelog.apply_changes(empty_dimension(spark), as_log(spark, []), as_log(spark, old), "k", ["a", "b"], now(), few_keys=few_keys)
    dim, log = sinks.land(first.dim)[0], first.added
    # A version without a key isn't in the log; it stays.
    keyless = dim.limit(1).withColumn("k", F.lit(None).cast("int"))
    done = changelog.apply_changes(union_all(dim, keyless), log, as_log(spark, new + new + old[:5]), "k", ["a", "b"], F.lit(at(300)), few_keys=few_keys)
    assert shown(done.dim.where("k IS NOT NULL")) == plain_versions(old + new)
    assert done.dim.where("k IS NULL").count() == 1
    assert done.added.count() == len(new)
    assert done.dim.where("k >= 8 AND updated_at > TIMESTAMP '2024-07-01'").count() == 0


def test_load_lands_its_changes_once(spark, monkeypatch):
    seen = {}
    monkeypatch.setattr(changelog, "land", lambda df, label: seen.update({label: df.columns}) or sinks.land(df, label))
    changelog.apply_changes(empty_dimension(spark), as_log(spark, []), as_log(spark, random_changes(40)), "k", ["a", "b"], now())
    assert list(seen) == ["touched", "added", "changes"]
    assert seen["touched"] == ["k"] and "change_hash" not in seen["changes"]


def test_rollup_follows_late_rows_and_touches_only_their_slices(spark):
    root = staging_path(spark, "rollup")
    source, states = f"{root}/trips", f"{root}/states"
    sinks.append(trips(spark), source, ["day"])
    maintained.build(spark, source, states, TRIPS, "day")
    before = files(states)
    late = trips(spark, 40, 1, seed=9, first=10**6).where("day IS NOT NULL").withColumn("fare", F.lit(77.0))
    maintained.merge_and_refresh(late, source, states, ["id"], TRIPS, "day", slices_move=False)
    table, kept = spark.read.parquet(source), spark.read.parquet(states)
    for unit, keys in (("hour", ["zone"]), ("day", []), ("month", ["zone"])):
        assert read(kept, unit, keys) == full(table, unit, keys)
    assert {f for f in before if "day=2024-01-01" not in f} <= files(states)
    assert not any(f in files(states) for f in before if "day=2024-01-01" in f)
    assert maintained.stale_slices(spark, source, states, "day").where("day IS NOT NULL").count() == 0


def test_stale_slices_are_found_and_mended(spark):
    import shutil

    root = staging_path(spark, "stale")
    source, states = f"{root}/trips", f"{root}/states"
    sinks.append(trips(spark, 500, 4).where("ts IS NOT NULL"), source, ["day"])
    maintained.build(spark, source, states, TRIPS, "day")
    # A load whose refresh never came, and a day that was removed.
    sinks.append(trips(spark, 30, 1, seed=5, first=10**6).where("ts IS NOT NULL"), source, ["day"])
    shutil.rmtree(f"{source}/day=2024-01-03")
    spark.catalog.refreshByPath(source)
    stale = maintained.stale_slices(spark, source, states, "day")
    assert sorted(str(r.day) for r in stale.collect()) == ["2024-01-01", "2024-01-03"]
    maintained.refresh(spark, source, states, TRIPS, "day", stale)
    assert read(spark.read.parquet(states), "day", ["zone"]) == full(spark.read.parquet(source), "day", ["zone"])


def test_sketch_errors(spark):
    df = spark.range(200_000).select(F.timestamp_micros(F.lit(0) + (F.col("id") % 48) * 3_600_000_000).alias("ts"), F.lit("a").alias("zone"), (F.col("id") * 7919 % 100_000 / 100).alias("fare"), F.lit(1).alias("n"), (F.col("id") * 31 % 60_000).alias("car"))
    one = TRIPS.read(TRIPS.states(df), "month", []).first()
    assert abs(one.cars - 60_000) < 0.04 * 60_000
    assert abs(float(one.mid_fare) - 500) < 20
    high = TRIPS.read(TRIPS.states(df), "month", [], ranks={"mid_fare": 0.9}).first()
    assert abs(float(high.mid_fare) - 900) < 20
    nothing = TRIPS.read(TRIPS.states(df.withColumn("fare", F.lit(None).cast("double"))), "month", []).first()
    assert (nothing.avg_fare, nothing.mid_fare) == (None, None)


# --- reconciliation ------------------------------------------------------------

PAIR = "k int, day int, v string, w int"


def test_differing_rows(spark, rows):
    base = [(i, i % 5, f"v{i}", None if i % 3 else i) for i in range(400)]
    other = [r for r in base if r[0] not in (7, 8)]
    other = [(k, d, "new" if k == 20 else v, 5 if k in (20, 21) else w) for k, d, v, w in other]
    other += [(1000, 1, "more", 1), (30, 0, "v30", 30), (None, 2, "no key", 0)]
    other = [(k, 4 if k == 40 else d, v, w) for k, d, v, w in other]
    got = reconcile.differing_rows(rows(base, PAIR), rows(other, PAIR), ["k"], F.col("day"), parts=16)
    want = [
        (7, "missing", 1, 0, None), (8, "missing", 1, 0, None), (1000, "extra", 0, 1, None), (30, "extra", 0, 1, None), (None, "extra", 0, 1, None),
        (20, "changed", 1, 1, ["v", "w"]), (21, "changed", 1, 1, ["w"]), (40, "changed", 1, 1, ["day"]),
    ]
    assert values(got) == sorted(want, key=repr)
    assert reconcile.differing_rows(rows(base, PAIR), rows(base[::-1], PAIR), ["k"], F.col("day")).count() == 0
    empty = rows([], PAIR)
    assert reconcile.differing_rows(empty, empty, ["k"], F.col("day")).count() == 0
    assert reconcile.differing_rows(rows(base, PAIR), empty, ["k"], F.col("day")).where("status = 'missing'").count() == 400


def test_null_and_value_swapped_between_columns_differ(rows):
    schema = "k int, a string, b string"
    got = reconcile.differing_rows(rows([(1, "x", None)], schema), rows([(1, None, "x")], schema), ["k"], F.lit(0))
    assert values(got) == [(1, "changed", 1, 1, ["a", "b"])]


def test_only_rows_of_differing_parts_are_compared(spark, monkeypatch):
    seen = []
    inside = reconcile._inside
    monkeypatch.setattr(reconcile, "_inside", lambda df, groups, by: seen.append((by, inside(df, groups, by))) or seen[-1][1])
    left = spark.range(50_000).select("id", (F.col("id") % 10).alias("day"), F.lit("v").alias("v"))
    right = left.withColumn("v", F.when(F.col("id") == 77, "w").otherwise("v"))
    assert values(reconcile.differing_rows(left, right, ["id"], F.col("day")), "id", "status") == [(77, "changed")]
    parts = [df for by, df in seen if len(by) == 2]
    assert len(parts) == 2 and all(df.count() < 60 for df in parts)


# --- overlapping versions ---------------------------------------------------------


def test_valid_versions(rows):
    rng = random.Random(8)
    dim = []
    for i in range(500):
        start = DAY + timedelta(seconds=rng.randrange(10**7))
        length = timedelta(seconds=rng.choice([0, 1, 30, 3_600, 86_400, 10**6, 10**8, -5]))
        dim.append((rng.choice([1, 2, None]), i, start, None if i % 11 == 0 else start + length))
    dim += [(1, 900, None, DAY), (1, 901, datetime(1900, 1, 1), datetime(2400, 1, 1)), (2, 902, datetime(1700, 1, 1), None)]
    fact = [(j, rng.choice([1, 2, 3, None]), None if j % 40 == 0 else DAY + timedelta(seconds=rng.randrange(10**7))) for j in range(300)]
    fact += [(1000 + i, d[0], d[2]) for i, d in enumerate(dim[:60])] + [(2000 + i, d[0], d[3]) for i, d in enumerate(dim[:60])]
    want = [(j, i) for j, k, t in fact for dk, i, a, b in dim if k is not None and k == dk and t is not None and a is not None and a <= t and (b is None or b > t)]
    got = intervals.valid_versions(rows(fact, "j int, k int, t timestamp"), rows(dim, "k int, i int, valid_from timestamp, valid_to timestamp"), ("k", "k"), "t", ["i"])
    assert got.columns == ["j", "k", "t", "i"]
    assert values(got, "j", "i") == sorted(want, key=repr)
    assert len(want) > 1_000


def test_no_versions(rows):
    dim = rows([], "k int, i int, valid_from timestamp, valid_to timestamp")
    assert intervals.valid_versions(rows([(1, 1, DAY)], "j int, k int, t timestamp"), dim, ("k", "k"), "t", ["i"]).count() == 0


def test_short_intervals_meet_few_moments_of_their_key(spark):
    """10,000 moments and 10,000 one-minute versions of one key: pairs that the join looks at stay near the result."""
    minute = F.timestamp_micros(F.col("id") * 60_000_000)
    fact = spark.range(10_000).select("id", F.lit(1).alias("k"), minute.alias("t"))
    dim = spark.range(10_000).select(F.lit(1).alias("k"), F.col("id").alias("i"), minute.alias("valid_from"), F.timestamp_micros((F.col("id") + 1) * 60_000_000).alias("valid_to"))
    got = intervals.valid_versions(fact, dim, ("k", "k"), "t", ["i"])
    assert got.where("id = i").count() == got.count() == 10_000


# --- drift ------------------------------------------------------------------------


def test_drift(spark, rows):
    path = f"{staging_path(spark, 'drift')}/profiles"
    runs = {"a": [1, 1, 2, 9], "b": [1, 1, 2, 9], "c": [9, 9, 9, 9, 9]}
    for i, (run, numbers) in enumerate(runs.items()):
        sinks.append(drift.profile(rows([(float(v),) for v in numbers] + [(None,)], "v double"), "v", 0, 10, 5, run, F.lit(at(i))), path)
    counts = {r: [sum(min(int(v / 2), 4) == b for v in n) for b in range(5)] for r, n in runs.items()}

    def psi(one, other):
        p, q = ([(c + 0.5) / (sum(counts[r]) + 2.5) for c in counts[r]] for r in (one, other))
        return round(sum((x - y) * math.log(x / y) for x, y in zip(p, q, strict=True)), 6)

    history = spark.read.parquet(path)
    got = {r.run_id: (r.against, r.psi) for r in drift.drift(history).collect()}
    assert got == {"a": (None, None), **{one: (other, pytest.approx(psi(one, other), abs=2e-6)) for other, one in pairwise("abc")}}
    assert {r.run_id: r.psi for r in drift.drift(history, base_run="a").collect()} == {"a": None, "b": 0.0, "c": pytest.approx(psi("c", "a"), abs=2e-6)}


def test_check_trend(rows):
    results = rows([("s", "between", "v", float(o), o == 0, f"r{i}", at(i)) for i, o in enumerate([0, 3, 5, 0, 2])], "suite string, check string, column string, observed double, success boolean, run_id string, checked_at timestamp")
    got = values(drift.check_trend(results), "run_id", "observed_before", "change", "failures_in_a_row")
    assert got == [("r0", None, None, 0), ("r1", 0.0, 3.0, 1), ("r2", 3.0, 2.0, 2), ("r3", 5.0, -5.0, 0), ("r4", 0.0, 2.0, 1)]


# --- orders and pages ---------------------------------------------------------------


def odd_rows(spark):
    rng = random.Random(6)
    texts = ["", "a", "ab", "abc", "b", "é", "\x00", "a\x00", "zz", None]
    doubles = [math.nan, math.inf, -math.inf, -0.5, 0.0, 1.5, None]
    rows = [
        (i, rng.choice(texts), rng.choice(doubles), rng.choice([-(1 << 63), (1 << 63) - 1, 0, 5, None]), rng.choice([True, False, None]), rng.choice([at(0), at(-30_000), at(9), None]))
        for i in range(400)
    ]
    frame = spark.createDataFrame(rows, "id int, s string, d double, n long, b boolean, t timestamp")
    return frame.withColumns({"m": F.expr("CAST(n % 7 AS DECIMAL(10,2))"), "day": F.to_date("t"), "ntz": F.col("t").cast("timestamp_ntz"), "bin": F.encode("s", "utf-8")})


@pytest.mark.parametrize("order", [["-s", "id"], ["-d", "s", "-id"], ["n", "-b", "-t", "id"], ["-n", "-bin", "id"], ["-m", "-day", "ntz", "-id"], ["-ntz", "d", "id"]])
def test_ascending_keys_are_the_order(spark, order):
    df = odd_rows(spark)
    keys = ordering.ascending(df, order)
    want = [r.id for r in paging.sort_by(df, *order).collect()]
    assert [r.id for r in df.withColumns(keys).orderBy(*keys).collect()] == want
    assert [r.id for r in paging.page(df, order, 25, 130, shallow_rows=0)[0].collect()] == want[130:155]


def test_no_descending_key_for_maps(spark):
    with pytest.raises(TypeError):
        ordering.ascending(spark.range(1).select(F.create_map("id", "id").alias("m")), ["-m"])


# --- compaction -----------------------------------------------------------------------


def test_compact(spark):
    import pyarrow.parquet as pq

    path = f"{staging_path(spark, 'files')}/t"
    n = 40_000
    rows = spark.range(n).select("id", (F.col("id") * 7919 % n).alias("a"), (F.col("id") * 104_729 % n).alias("b"), F.when(F.col("id") % 10 > 0, (F.col("id") % 2).cast("string")).alias("part"))
    for load in range(8):
        sinks.append(rows.where(F.pmod(F.xxhash64("id"), F.lit(8)) == load), path, ["part"])
    alone = rows.where("id < 10").withColumn("part", F.lit("alone")).coalesce(1)
    sinks.append(alone, path, ["part"])
    untouched = {f for f in files(path) if "part=alone" in f}
    size = sum(r.bytes for r in compaction.file_sizes(spark, path, "part").where("folder = '0'").collect())

    def read(low, high):
        """Files whose ranges meet both conditions."""
        found = 0
        for f in files(path) - untouched:
            group = pq.ParquetFile(f).metadata.row_group(0)
            stats = {group.column(i).path_in_schema: group.column(i).statistics for i in range(group.num_columns)}
            found += all(stats[c].min <= high and stats[c].max >= low for c in ("a", "b"))
        return found

    before = read(0, 2_000)
    assert compaction.compact(spark, path, "part", ["a", "b"], file_bytes=size // 4) == 3
    spark.catalog.refreshByPath(path)
    assert values(spark.read.parquet(path)) == values(rows.unionByName(alone))
    assert untouched <= files(path)
    assert len(files(path)) <= 1 + 11 + 3 < 24  # the files asked for, and one more where a range crosses slices
    assert read(0, 2_000) < before / 2
    assert compaction.compact(spark, path, "part", ["a", "b"], file_bytes=1) == 0


def test_interleaved_bits(spark):
    pairs = [(0, 0), (1, 0), (0, 1), (0b1011, 0b0110), (65_535, 65_535)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    got = frame.select("a", "b", compaction.interleaved([F.col("a"), F.col("b")]).alias("z")).collect()
    assert [r.z for r in got] == [sum(((r.a >> i & 1) << (2 * i + 1)) | ((r.b >> i & 1) << (2 * i)) for i in range(16)) for r in got]
