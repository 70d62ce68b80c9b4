import json
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import one, values
from tidegate import schemas as S
from tidegate.bindings import Tables, published
from tidegate.operators.mutate import dedup
from tidegate.operators.quality import GateClosed, check_row_count
from tidegate.plans import loads as L
from tidegate.plans import models as M
from tidegate.plans import runs as R
from tidegate.session import LEAN_SETTINGS, lean_on_disk, staging_path
from tidegate.sources import jdbc, sinks, topics
from tidegate.sources.files import read_csv_by_name
from tidegate.streaming import ingest as I
from tidegate.streaming.events import event_to_row, parse_events, to_events
from tidegate.streaming.replay import read_replay, replay_to_files
from tidegate.streaming.stats import sliding_stats, stream_quality

SCHEMA = "k int, day string, v int"


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "table")
    rows = spark.createDataFrame([(1, "2024-01-01", 1), (2, "2024-01-02", 2), (3, "2024-01-02", 3), (4, None, 4)], SCHEMA)
    sinks.append(rows.withColumn("day", F.col("day").cast("date")), path, ["day"])
    return path


def dated(spark, data):
    return spark.createDataFrame(data, SCHEMA).withColumn("day", F.col("day").cast("date"))


def contents(spark, path):
    return values(spark.read.parquet(path).selectExpr("k", "CAST(day AS string) AS day", "v"))


def test_append_new_is_repeatable(spark, table, tmp_path):
    more = dated(spark, [(3, "2024-01-02", 3), (5, "2024-01-03", 5), (5, "2024-01-03", 5)])
    assert L.append_new(more, table, ["k"], "day") == 1
    assert L.append_new(more, table, ["k"], "day") == 0
    assert L.append_new(dated(spark, [(4, None, 4), (6, None, 6)]), table, ["k"], "day") == 1
    assert [r[0] for r in contents(spark, table)] == [1, 2, 3, 4, 5, 6]
    fresh = str(tmp_path / "fresh")
    assert L.append_new(more, fresh, ["k"]) == 2 and L.append_new(more, fresh, ["k"]) == 0


def test_merge_slices_moves_rows_and_leaves_other_slices(spark, table):
    before = os.listdir(f"{table}/day=2024-01-02")
    L.merge_slices(dated(spark, [(1, "2024-01-05", 10), (7, "2024-01-06", 7), (4, "2024-01-05", 40)]), table, ["k"], "day")
    expected = [(1, "2024-01-05", 10), (2, "2024-01-02", 2), (3, "2024-01-02", 3), (4, "2024-01-05", 40), (7, "2024-01-06", 7)]
    assert contents(spark, table) == expected
    assert before == os.listdir(f"{table}/day=2024-01-02") and not os.path.exists(f"{table}/day=2024-01-01")
    L.merge_slices(dated(spark, [(2, "2024-01-02", 20)]), table, ["k"], "day", slices_move=False)
    assert (2, "2024-01-02", 20) in contents(spark, table)


def test_reload_slices_replaces_only_those_present(spark, table):
    fix = dated(spark, [(9, "2024-01-02", 9)])
    for _ in range(2):
        sinks.reload_slices(fix, table, "day")
    assert contents(spark, table) == [(1, "2024-01-01", 1), (4, None, 4), (9, "2024-01-02", 9)]


def test_exactly_the_slices_listed_are_read(spark, table):
    both = sinks.read_slices(dated(spark, [(1, "2024-01-01", 1), (1, "2024-01-02", 1)]), table, "day")
    assert values(both, "k") == [(1,), (2,), (3,)]
    holes = sinks.read_slices(dated(spark, [(1, "2024-01-01", 1), (1, None, 1)]), table, "day")
    assert values(holes, "k") == [(1,), (4,)]
    none = sinks.read_slices(dated(spark, []), table, "day")
    assert none.count() == 0
    listed = sinks.read_slices(dated(spark, [(1, "2024-01-02", 1)]), table, "day")
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert listed.count() == 2 and "dynamicpruning" in plan
    assert "PartitionFilters: [isnotnull(day" in plan or "PartitionFilters: [day" in plan


def test_many_slices_are_merged_one_by_one(spark, tmp_path):
    path = str(tmp_path / "many")
    sinks.append(spark.range(300).selectExpr("id", "id AS v", "id AS slice"), path, ["slice"])
    before = {d: os.listdir(f"{path}/{d}") for d in os.listdir(path) if "=" in d}
    L.merge_slices(spark.range(0, 300, 3).selectExpr("id", "-id AS v", "id AS slice"), path, ["id"], "slice", slices_move=False)
    assert values(spark.read.parquet(path), "id", "v") == sorted([(i, i if i % 3 else -i) for i in range(300)], key=repr)
    assert all((os.listdir(f"{path}/slice={i}") == before[f"slice={i}"]) == bool(i % 3) for i in range(300))


def test_incremental_append_writes_only_new_rows(spark, tmp_path):
    path, now = str(tmp_path / "t"), F.lit("2024-02-01").cast("timestamp")
    marks = spark.createDataFrame([], S.ddl(S.WATERMARK_COLUMNS))

    def load(marks, *data, lookback=None):
        rows = spark.createDataFrame([(k, datetime(2024, 1, d)) for k, d in data], "k string, ts timestamp")
        return L.incremental_append(path, rows, marks, "d", "ts", ["k"], "r", now, lookback=lookback)

    first = load(marks, ("b", 1), ("a", 2), ("a", 2))
    files = sorted(f for f in os.listdir(path) if f.endswith(".parquet"))
    second = load(first.marks, ("a", 2), ("c", 3), ("d", 1), lookback="2 days")
    assert (first.rows_loaded, first.rows_added, second.rows_loaded, second.rows_added, second.late.count()) == (2, 2, 3, 2, 2)
    assert set(files) < set(os.listdir(path))
    assert values(spark.read.parquet(path), "id", "k") == [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
    again = load(second.marks, ("a", 2))
    assert (again.rows_loaded, again.rows_added) == (0, 0) and values(again.marks) == values(second.marks)


def test_old_generations_go(spark, tmp_path):
    for n in range(4):
        L.full_refresh(spark.range(n), "generations", str(tmp_path), keep=2)
    assert len(os.listdir(tmp_path / "generations")) == 2 and spark.table("generations").count() == 3


def test_partitioned_write(spark, tmp_path):
    path = str(tmp_path / "trips")
    df = spark.createDataFrame([(1, "2024-01-01 10:00:00"), (2, "2024-01-02 10:00:00")], "k int, t string").withColumn("t", F.to_timestamp("t"))
    sinks.write_partitioned(df, "t", path)
    sinks.write_partitioned(df.where("k = 2").withColumn("k", F.lit(5)), "t", path, mode="overwrite")
    assert values(spark.read.parquet(path), "k") == [(1,), (5,)]


def test_full_refresh_and_gate(spark, tmp_path):
    root = str(tmp_path)
    L.full_refresh(spark.range(3), "refreshed", root)
    L.checked_publish(spark.range(5), "s", [check_row_count(1, 10)], "refreshed", root)
    assert spark.table("refreshed").count() == 5
    with pytest.raises(GateClosed):
        L.checked_publish(spark.range(50), "s", [check_row_count(1, 10)], "refreshed", root)
    assert spark.table("refreshed").count() == 5
    L.full_refresh(spark.table("refreshed").where("id < 2"), "refreshed", root)
    assert spark.table("refreshed").count() == 2


def test_incremental_load(spark):
    target = spark.createDataFrame([], "id bigint, k int, ts timestamp, v int")
    marks = spark.createDataFrame([], S.ddl(S.WATERMARK_COLUMNS))
    now = F.lit("2024-02-01").cast("timestamp")

    def arrived(*data):
        return spark.createDataFrame([(k, datetime(2024, 1, d), v) for k, d, v in data], "k int, ts timestamp, v int")

    args = ("trips", "ts", ["k"])
    first = L.incremental_load(target, arrived((1, 1, 1), (2, 2, 2), (2, 2, 2)), marks, *args, "r1", now)
    assert first.rows_loaded == 2 and R.get_watermark(first.marks, "trips") == datetime(2024, 1, 2)
    second = L.incremental_load(first.target, arrived((1, 1, 9), (2, 2, 9), (3, 3, 3)), first.marks, *args, "r2", now)
    assert values(second.target, "k", "v") == [(1, 1), (2, 2), (3, 3)] and second.late.count() == 2
    third = L.incremental_load(second.target, arrived((1, 1, 9)), second.marks, *args, "r3", now)
    assert third.rows_loaded == 0 and values(third.marks) == values(second.marks)
    back = L.incremental_load(second.target, arrived((2, 2, 7)), second.marks, *args, "r4", now, lookback="2 days", monotonic=True)
    assert values(back.target, "k", "v") == [(1, 1), (2, 7), (3, 3)] and R.get_watermark(back.marks, "trips") == datetime(2024, 1, 3)


def test_staging_path_uses_the_named_folder(spark, monkeypatch):
    named = spark.conf.get("spark.checkpoint.dir", None)
    path = staging_path(spark, "x")
    assert path != staging_path(spark, "x") and (not named or path.startswith(named))


# --- streams --------------------------------------------------------------

EVENT = {
    "event_type": "trip_completed", "event_time": "2015-01-15T10:00:00", "vendor_id": 1, "pickup_datetime": "2015-01-15 09:32:00",
    "dropoff_datetime": "2015-01-15 09:45:00", "passenger_count": 2, "trip_distance": 3.5, "fare_amount": 14.5, "tip_amount": 2.0,
    "total_amount": 17.5,
}


def lines(*events):
    return [json.dumps(e) if isinstance(e, dict) else e for e in events]


def to_rows(spark, *events):
    return event_to_row(parse_events(spark.createDataFrame([(e,) for e in lines(*events)], "value string")))


def test_event_rows(spark):
    got = one(to_rows(spark, {k: v for k, v in EVENT.items() if k != "tip_amount"}))
    assert got["tip_amount"] is None and got["pickup_longitude"] is None and got["vendor_id"] == 1
    assert list(got) == [*S.TRIP_COLUMNS, "source_row_hash"]
    hashes = [r[0] for r in to_rows(
        spark, EVENT, {**EVENT, "event_time": "later"}, dict(reversed(EVENT.items())), {**EVENT, "fare_amount": 14.50}, {**EVENT, "fare_amount": 25.0},
    ).select("source_row_hash").collect()]
    assert len(set(hashes[:4])) == 1 and hashes[4] != hashes[0]


def test_event_and_batch_row_share_the_hash(spark):
    raw = spark.createDataFrame([tuple(str(v) for k, v in EVENT.items() if k not in S.EVENT_ENVELOPE)], ", ".join(f"{c} string" for c in S.EVENT_PAYLOAD))
    assert one(M.land_trips(raw))["source_row_hash"] == one(to_rows(spark, EVENT))["source_row_hash"]


def write_lines(path, name, *events):
    path.mkdir(exist_ok=True)
    (path / name).write_text("\n".join(lines(*events)) + "\n")


def run_ingest(spark, tmp_path, **options):
    paths = I.Paths.under(str(tmp_path / "out"))
    stream = topics.read_events(spark, "text", {"maxFilesPerTrigger": "1"}, str(tmp_path / "in"))
    I.ingest_stream(stream, paths, **options).awaitTermination()
    return paths


def test_ingest_restart_duplicates_and_rejects(spark, tmp_path):
    source = tmp_path / "in"
    other = {**EVENT, "fare_amount": 20.0, "pickup_datetime": "2015-01-16 00:00:00"}
    write_lines(source, "1.json", EVENT, {**EVENT, "event_time": "again"}, "oops", {**EVENT, "fare_amount": 0})
    paths = run_ingest(spark, tmp_path)
    write_lines(source, "2.json", other, EVENT)
    write_lines(source, "3.json", '["no object"]')
    paths = run_ingest(spark, tmp_path)
    table = spark.read.parquet(paths.table)
    assert values(table, "fare_amount").__len__() == 2 and set(table.columns) == {*S.TRIP_COLUMNS, "source_row_hash", "pickup_date"}
    rejected = spark.read.parquet(paths.rejected)
    assert [r[0] for r in values(rejected, "raw")][0] in ('["no object"]', "oops") and rejected.count() == 3
    totals = one(I.total_counters(spark.read.parquet(paths.counters)))
    assert totals == {"processed": 7, "inserted": 2, "duplicates": 2, "invalid": 3}
    run_ingest(spark, tmp_path)
    assert spark.read.parquet(paths.table).count() == 2


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    paths = I.Paths.under(str(tmp_path / "out"))
    batch = spark.createDataFrame([(e,) for e in lines(EVENT, "oops", {**EVENT, "fare_amount": 3.0})], "value string")
    for _ in range(2):
        I.ingest_batch(batch, 7, paths)
    assert spark.read.parquet(paths.table).count() == 2 and spark.read.parquet(paths.rejected).count() == 1
    assert one(spark.read.parquet(paths.counters).drop("batch_id"))["processed"] == 3


def test_stream_equals_batch(spark, tmp_path):
    source = tmp_path / "in"
    events = [{**EVENT, "fare_amount": 1.0 + i % 5} for i in range(20)]
    for part in range(4):
        write_lines(source, f"{part}.json", *events[part * 5 : part * 5 + 5])
    paths = run_ingest(spark, tmp_path, slice_ts=None)
    batch = to_rows(spark, *events).dropDuplicates(["source_row_hash"])
    assert values(spark.read.parquet(paths.table)) == values(batch)


def test_stateful_dedup_drops_null_keys(spark, tmp_path):
    source = tmp_path / "in"
    write_lines(source, "1.json", EVENT, EVENT, {**EVENT, "fare_amount": 2.0})
    write_lines(source, "2.json", EVENT)
    rows = event_to_row(parse_events(topics.read_events(spark, "text", {"maxFilesPerTrigger": "1"}, str(source))))
    with_null = rows.withColumn("source_row_hash", F.when(F.col("fare_amount") != 2, F.col("source_row_hash")))
    query = (
        I.dedup_stream(with_null, "pickup_datetime", "1 day").writeStream.format("parquet").option("path", str(tmp_path / "t"))
        .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "t")).count() == 1


def test_replay_round_trip(spark, tmp_path):
    now = F.lit("2024-01-01").cast("timestamp")
    trips = spark.createDataFrame([(1, "2015-01-15 09:32:00", None, 14.5)], "vendor_id int, pickup_datetime string, passenger_count int, fare_amount double")
    envelope = one(to_events(trips, now, defaults={"passenger_count": 1}))
    assert envelope["event_type"] == "trip_completed" and envelope["passenger_count"] == 1 and envelope["tip_amount"] is None
    replay_to_files(trips, str(tmp_path / "r"), now, rows_per_file=10)
    stream = read_replay(spark, str(tmp_path / "r"), 1)
    assert stream.isStreaming and stream.columns == ["value"]
    sent = json.loads(spark.read.text(str(tmp_path / "r")).first()[0])
    assert sent["fare_amount"] == 14.5 and sent["total_amount"] is None


def test_message_keys_and_options(spark):
    df = spark.createDataFrame([(1, "a"), (0, "b"), (None, "c")], "vendor_id int, v string")
    assert [r.key for r in topics.keyed_messages(df, "vendor_id").collect()] == ["1", None, None]
    assert [r.key for r in topics.keyed_messages(df, None).collect()] == [None] * 3
    options = topics.topic_options("host:9092", "trips", 100)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "100"


def test_jdbc_options():
    split = jdbc.read_options("jdbc:x", "t", ("id", 0, 100, 4), driver="d")
    assert split == {"url": "jdbc:x", "dbtable": "t", "driver": "d", "partitionColumn": "id", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    assert jdbc.write_options("jdbc:x", "t", 500)["batchsize"] == "500"


def test_window_statistics(spark):
    data = [("2024-01-01 00:10:00", 1.0, None), ("2024-01-01 00:40:00", 2.0, "bad"), ("2024-01-01 01:10:00", None, None)]
    df = spark.createDataFrame(data, "t string, v double, error string").withColumn("ts", F.to_timestamp("t"))
    cents = F.round(F.col("v") * 100).cast("bigint")
    out = values(sliding_stats(df, "ts", cents, "1 hour", "30 minutes"), "window_start", "trips")
    assert [n for _, n in out] == [1, 2, 2, 1]
    now = F.lit("2024-01-01 02:00:00").cast("timestamp")
    quality = values(stream_quality(df, "ts", now, "1 hour", ["v"]), "events", "invalid", "invalid_pct", "null_v", "lag_seconds")
    assert quality == [(1, 0, 0.0, 1, 3000.0), (2, 1, 50.0, 0, 4800.0)]


def test_hashed_rows_are_read_once(spark, tmp_path):
    path = str(tmp_path / "trips.csv")
    spark.createDataFrame([("1", "2024-01-01 10:00:00", "1")] * 3 + [("1.0", "2024-01-01 10:00:00", "1")], "vendor_id string, pickup_datetime string, passenger_count string").write.csv(path, header=True)
    once = dedup(M.land_trips(read_csv_by_name(spark, path)), ["source_row_hash"])
    assert once._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1
    assert once.count() == 1


def test_file_is_written_once_and_equal_lines_typed_once(spark, monkeypatch):
    written = []
    monkeypatch.setattr(published, "raw_trips", lambda t, make=published.raw_trips: written.append(make(t)) or written[-1])
    assert values(published.reconciled_load(Tables(spark, "/root/testdata/sf0.001")), "matches") == [(True,)] * 7
    assert len(written) == 1
    plan = published.file_trips(spark, written[0])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("sha2") < plan.index("Aggregate [")


def test_lean_settings_hold_inside_only(spark, tmp_path):
    keys = list(LEAN_SETTINGS)
    before = [spark.conf.get(k, None) for k in keys]
    with pytest.raises(ZeroDivisionError), lean_on_disk(spark):
        assert {k: spark.conf.get(k) for k in keys} == LEAN_SETTINGS
        spark.range(3).write.parquet(str(tmp_path / "t"))
        raise ZeroDivisionError
    assert [spark.conf.get(k, None) for k in keys] == before
    assert [f for f in os.listdir(tmp_path / "t") if f.endswith(".zstd.parquet")]


def trip_tables(spark, folder, repeats):
    """Orders 1 to 40 with two lines each, all of it ``repeats`` times under other order keys."""
    many = spark.range(40 * repeats).selectExpr("id AS o_orderkey", "id % 40 AS n").selectExpr("*", "timestampadd(DAY, cast(40 * n AS INT), TIMESTAMP '1993-01-01') AS o_orderdate")
    many.drop("n").write.parquet(f"{folder}/orders.parquet")
    many.selectExpr(
        "o_orderkey AS l_orderkey", "6 + n AS l_partkey", "12 + n AS l_suppkey", "explode(array(1, 7, 2)) AS l_linenumber", "5.0D AS l_quantity", "(900 + n) / 1.0D AS l_extendedprice",
        "0.02D AS l_tax", "'O' AS l_linestatus", "timestampadd(DAY, 9, o_orderdate) AS l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")
    return Tables(spark, str(folder))


@pytest.mark.parametrize("name", ["gate_outcome", "published_trips", "reconciled_load"])
def test_raw_file_is_small_and_goes_once_landed(spark, tmp_path, monkeypatch, name):
    written, lands, seen = [], [], []
    monkeypatch.setattr(published, "raw_trips", lambda t, make=published.raw_trips: written.append(make(t)) or seen.extend(os.listdir(written[-1])) or written[-1])
    monkeypatch.setattr(sinks, "landed", lambda df, path, go=sinks.landed: lands.append(path.rsplit("/", 1)[1].split("-")[0]) or go(df, path))
    monkeypatch.setattr(published, "LINES_PER_FILE", 50)
    found = getattr(published, name)(trip_tables(spark, tmp_path, 2))
    parts = [f for f in seen if f.startswith("part-")]
    assert len(parts) >= 5 and all(f.endswith(".csv.gz") for f in parts)
    assert os.path.exists(written[0]) == (name == "reconciled_load")
    assert lands.count("load") == 2 and "added" not in lands
    if name == "gate_outcome":
        assert values(found.where("check = 'row_count'"), "success", "observed", "gate") == [(False, 80.0, "closed")]
    elif name == "published_trips":
        assert found.count() == 80 and found.distinct().count() == 80
    else:
        assert found.agg(F.sum("source_rows"), F.sum("landed_rows"), F.bool_and("matches")).first() == (80, 80, True)


def test_append_marks_known_rows_in_one_copy(spark, tmp_path):
    path, now = str(tmp_path / "t"), F.lit("2024-02-01").cast("timestamp")
    marks = spark.createDataFrame([], S.ddl(S.WATERMARK_COLUMNS))

    def load(*data):
        rows = spark.createDataFrame([(k, s, datetime(2024, 1, 1)) for k, s in data], "k string, s int, ts timestamp")
        return L.incremental_append(path, rows, marks, "d", "ts", ["k"], "r", now, slice_column="s")

    first, second, third = load(("a", 1), (None, 2)), load(("a", 1), ("b", 1), ("b", 1), (None, 2)), load(("a", 1))
    assert [(x.rows_loaded, x.rows_added) for x in (first, second, third)] == [(2, 2), (3, 2), (1, 0)]
    stored = spark.read.parquet(path)
    assert values(stored, "k", "s") == sorted([("a", 1), (None, 2), ("b", 1), (None, 2)], key=repr)
    assert "_matched" not in stored.columns and values(stored, "id") == [(1,), (2,), (3,), (4,)]
