"""Streams that run on: chained windows, paced replay, stopping and counters."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import values
from tidegate.session import staging_path
from tidegate.streaming.monitor import null_spikes
from tidegate.streaming.replay import number_for_replay, replay_at_rate
from tidegate.streaming.running import run_until
from tidegate.streaming.versions import as_of_stream

START = datetime(2024, 1, 1)


def checked_rows(n=2_000, hours=60, seed=2):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        at = START + timedelta(hours=rng.random() * hours)
        hour = int((at - START).total_seconds() // 3600)
        share = 0.6 if hour in (20, 45) else 0.1
        if 30 <= hour < 33:
            continue
        out.append((at, None if rng.random() < share else 1, "bad" if rng.random() < 0.05 else None))
    return out


def plain(rows, span=6, factor=3, least=5):
    hours = {}
    for at, user, error in rows:
        h = hours.setdefault(int((at - START).total_seconds() // 3600), [0, 0, 0])
        h[0], h[1], h[2] = h[0] + 1, h[1] + (error is not None), h[2] + (user is None)
    out = []
    for h, own in sorted(hours.items()):
        before = [sum(hours[b][i] for b in range(h - span + 1, h) if b in hours) for i in range(3)]
        spike = own[2] * before[0] > before[2] * factor * own[0] and own[2] >= least if before[0] else None
        out.append((START + timedelta(hours=h), *own, *before, spike))
    return out


COLUMNS = ["window_start", "events", "invalid", "null_user", "before_events", "before_invalid", "before_null_user", "spike_user"]
SCHEMA = "at timestamp, user int, error string"


def test_null_spikes(spark):
    rows = checked_rows()
    got = null_spikes(spark.createDataFrame(rows, SCHEMA), "at", ["user"], "1 hour", "6 hours")
    want = plain(rows)
    assert [tuple(r) for r in got.select(*COLUMNS).orderBy("window_start").collect()] == want
    assert {r[0].hour + 24 * (r[0].day - 1) for r in want if r[-1]} >= {20, 45}


def test_null_spikes_as_a_stream_that_is_restarted(spark):
    root = staging_path(spark, "monitor")
    rows = sorted(checked_rows())
    late = [START + timedelta(days=400)]
    parts = [rows[:700], rows[700:1_200], rows[1_200:], [(late[0], 1, None)]]
    for part in parts:
        # Rows of a batch in any order; each part is a run of its own on one checkpoint.
        random.Random(1).shuffle(part)
        spark.createDataFrame(part, SCHEMA).repartition(3).write.mode("append").parquet(f"{root}/source")
        stream = null_spikes(spark.readStream.schema(SCHEMA).parquet(f"{root}/source"), "at", ["user"], "1 hour", "6 hours", delay="1 hour")
        writer = stream.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
        writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{root}/table").where(F.col("window_start") < late[0])
    assert [tuple(r) for r in got.select(*COLUMNS).orderBy("window_start").collect()] == plain(rows)


def test_paced_replay_goes_on_after_a_stop(spark):
    root = staging_path(spark, "paced")
    total = number_for_replay(spark.range(0, 230).select((F.col("id") * 37 % 230).alias("id")), ["id"], f"{root}/numbered", chunk_rows=50)
    sizes, seen = {}, {}

    def take(rows, batch_id):
        ids = [r.id for r in rows.orderBy("replay_seq").collect()]
        assert seen.get(batch_id, ids) == ids
        seen[batch_id], sizes[batch_id] = ids, len(ids)

    for limit in (60, 90, total):
        query = replay_at_rate(spark, f"{root}/numbered", 30, f"{root}/checkpoint", take, chunk_rows=50)
        done = run_until(query, rows=limit)
        assert done.rows >= limit - 30
    assert [i for b in sorted(seen) for i in seen[b]] == list(range(230))
    assert all(n == 30 for b, n in sizes.items() if n and b * 30 + 30 <= 230)


def file_stream(spark, root, n=400, files=4):
    spark.range(n).select(F.col("id"), F.when(F.col("id") % 10 == 0, "bad").alias("error")).repartition(files).write.parquet(f"{root}/source")
    return spark.readStream.schema("id long, error string").option("maxFilesPerTrigger", 1).parquet(f"{root}/source")


def test_idle_stop_and_live_counters(spark):
    root = staging_path(spark, "idle")
    stream = file_stream(spark, root).observe("seen", F.count(F.lit(1)).alias("processed"), F.count_if(F.col("error").isNotNull()).alias("invalid"))
    writer = stream.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint")
    progress = run_until(writer.start(), idle_seconds=3, metrics="seen")
    assert progress.counters == {"processed": 400, "invalid": 40}
    assert spark.read.parquet(f"{root}/table").count() == 400


def test_stop_after_rows_loses_nothing(spark):
    root = staging_path(spark, "limited")
    stream = file_stream(spark, root, 1_000, 5)

    def start():
        return stream.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint").start()

    run_until(start(), rows=200)
    assert 200 <= spark.read.parquet(f"{root}/table").count() <= 1_000
    run_until(start(), idle_seconds=2)
    assert values(spark.read.parquet(f"{root}/table"), "id") == [(i,) for i in range(1_000)] or spark.read.parquet(f"{root}/table").select("id").distinct().count() == spark.read.parquet(f"{root}/table").count() == 1_000


def test_failures_are_raised(spark):
    root = staging_path(spark, "failing")

    def fail(batch, batch_id):
        raise RuntimeError("no sink")

    query = file_stream(spark, root).writeStream.foreachBatch(fail).option("checkpointLocation", f"{root}/checkpoint").start()
    with pytest.raises(Exception, match="no sink"):
        run_until(query, idle_seconds=20)


def test_events_wait_for_their_versions(spark):
    """Both streams in shuffled order within the delay, in four runs of one checkpoint."""
    root = staging_path(spark, "waiting")
    rng = random.Random(9)
    starts = [(rng.choice(["a", "b"]), START + timedelta(minutes=rng.randrange(600)), rng.choice([i, i, None]), f"t{i}") for i in range(60)]
    facts = [(i, rng.choice(["a", "b", "c"]), START + timedelta(minutes=rng.randrange(600))) for i in range(300)]
    facts += [(1_000 + i, s[0], s[1]) for i, s in enumerate(starts[:20])] + [(2_000, None, START), (2_001, "a", None)]
    best = {}
    for k, at, n, x in starts:
        text = f'{{"n":{"null" if n is None else n},"x":"{x}"}}'
        best[k, at] = max(best.get((k, at), ("", None)), (text, (n, x)))
    want = []
    for i, k, at in facts:
        if k is not None and at is not None:
            before = [a for kk, a in best if kk == k and a <= at]
            want.append((i, *(best[k, max(before)][1] if before else (None, None))))
    fact_schema, start_schema = "i int, k string, at timestamp", "k string, valid_from timestamp, n int, x string"
    rng.shuffle(facts)
    far = START + timedelta(days=30)
    for part in range(4):
        fresh = facts[part::3] if part < 3 else [(-1, "z", far)]
        late = starts[(part + 1) % 3 :: 3] if part < 3 else []
        spark.createDataFrame(fresh, fact_schema).repartition(2).write.mode("append").parquet(f"{root}/facts")
        spark.createDataFrame(late, start_schema).repartition(2).write.mode("append").parquet(f"{root}/starts")
        events, versions = spark.readStream.schema(fact_schema).parquet(f"{root}/facts"), spark.readStream.schema(start_schema).parquet(f"{root}/starts")
        joined = as_of_stream(events, versions, ("k", "k"), "at", ["n", "x"], "12 hours")
        writer = joined.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
        writer.trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{root}/table").where("i >= 0")
    assert got.columns == ["i", "k", "at", "n", "x"]
    assert values(got, "i", "n", "x") == sorted(want, key=repr)


@pytest.mark.parametrize("buckets", [None, 3])
def test_keys_share_a_state(spark, buckets):
    """Far fewer states than keys; some keys have events only, some versions only, and one run brings rows for few keys."""
    root = staging_path(spark, "buckets")
    rng = random.Random(11)
    starts = [(k, START + timedelta(minutes=7 * k + 100 * i), 10 * k + i) for k in range(20) for i in range(k % 4)]
    facts = [(i, rng.randrange(5, 25), START + timedelta(minutes=rng.randrange(600))) for i in range(200)]
    want = [(i, max(((a, n) for kk, a, n in starts if kk == k and a <= at), default=(None, None))[1]) for i, k, at in facts]
    far = START + timedelta(days=30)
    fact_schema, start_schema = "i int, k int, at timestamp", "k int, valid_from timestamp, n int"
    for fresh, late in ((facts[:150], []), (facts[150:], starts[:3]), ([], starts[3:]), ([(-1, 99, far)], [])):
        spark.createDataFrame(fresh, fact_schema).repartition(2).write.mode("append").parquet(f"{root}/facts")
        spark.createDataFrame(late, start_schema).repartition(2).write.mode("append").parquet(f"{root}/starts")
        events, versions = spark.readStream.schema(fact_schema).parquet(f"{root}/facts"), spark.readStream.schema(start_schema).parquet(f"{root}/starts")
        joined = as_of_stream(events, versions, ("k", "k"), "at", ["n"], "12 hours", buckets=buckets)
        writer = joined.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
        writer.trigger(availableNow=True).start().awaitTermination()
    assert values(spark.read.parquet(f"{root}/table").where("i >= 0"), "i", "n") == sorted(want, key=repr)
    states = spark.read.format("statestore").load(f"{root}/checkpoint").count()
    assert states <= 3 if buckets else states > 3
