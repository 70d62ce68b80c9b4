"""Cases in which NULL, repeated or text keys once gave other results."""

import time

import pytest
from pyspark.sql import functions as F

from tests.conftest import values
from tidegate import schemas as S
from tidegate.operators import history, paging, shape
from tidegate.operators.ranks import exact_median
from tidegate.plans import loads
from tidegate.plans.adhoc import NotReadOnly, adhoc
from tidegate.sources import sinks
from tidegate.streaming import ingest


@pytest.mark.parametrize("levels", [0, 1, 2])
def test_median_keeps_the_group_of_null_keys(rows, levels):
    data = [(1 if i % 2 else None, float(i) if i % 7 else None) for i in range(100)] + [(2, float("nan")), (3, 5.0), (3, 5.0)]
    df = rows(data, "k int, v double")
    got = dict(values(exact_median(df, "v", ["k"], levels=levels)))
    for key in (1, None, 3):
        known = sorted(v for k, v in data if k == key and v is not None)
        n = len(known)
        assert got[key] == (known[(n - 1) // 2] + known[n // 2]) / 2
    assert set(got) == {1, None, 3}


def test_text_slices_stay_text(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    sinks.append(rows([(1, "a", "01"), (2, "b", "02")], "id int, v string, mon string"), path, ["mon"])
    loads.merge_slices(rows([(1, "c", "01"), (3, "d", None)], "id int, v string, mon string"), path, ["id"], "mon")
    stored = spark.read.schema("id int, v string, mon string").parquet(path)
    assert values(stored) == [(1, "c", "01"), (2, "b", "02"), (3, "d", None)]


@pytest.mark.parametrize("bad", [[(1, "x"), (1, "y")], [(None, "x")]])
def test_merge_refuses_keys_it_can_not_place(rows, bad):
    start = F.lit("2024-01-01").cast("timestamp")
    dim = history.scd2_start(rows([(1, "a")], "id int, name string"), "id", ["name"], start)
    with pytest.raises(Exception, match="NULL or repeated"):
        history.scd2_merge(dim, rows(bad, "id int, name string"), "id", ["name"], start).collect()


def test_deep_page_refuses_null_keys(rows):
    with pytest.raises(ValueError, match="no id"):
        paging.deep_page(rows([(1,), (None,), (2,)], "id long"), "id", 10, 0)


def test_marks_do_not_move_with_the_drivers_time_zone(spark, monkeypatch):
    """A load of three rows and a second one of one row, under a driver outside UTC."""
    marks = spark.createDataFrame([], S.ddl(S.WATERMARK_COLUMNS))
    now = F.lit("2024-02-01").cast("timestamp")

    def arrived(*hours):
        times = spark.createDataFrame([(h, f"2024-01-01 {h:02d}:00:00") for h in hours], "k int, t string")
        return times.select("k", F.col("t").cast("timestamp_ntz").alias("ts"))

    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        target = spark.createDataFrame([], "k int, ts timestamp_ntz")
        first = loads.incremental_load(target, arrived(1, 2, 3), marks, "d", "ts", ["k"], "r1", now)
        second = loads.incremental_load(first.target, arrived(3, 4, 5, 9), first.marks, "d", "ts", ["k"], "r2", now)
        assert (first.rows_loaded, second.rows_loaded, second.target.count(), second.late.count()) == (3, 3, 6, 1)
        assert second.marks.select(F.col("watermark_value").cast("string")).first()[0] == "2024-01-01 09:00:00"
    finally:
        monkeypatch.undo()
        time.tzset()


def test_whole_numbers_from_text(rows):
    df = rows([("2.0",), ("2.5",), ("70000",), ("5d",), ("NaN",), (" 3 ",), (None,)], "n string")
    assert [r[0] for r in shape.conform(df, {"n": "smallint"}).collect()] == [2, None, None, None, None, 3, None]
    assert values(shape.conform_rejects(df, {"n": "smallint"}), "n") == [("2.5",), ("5d",), ("70000",), ("NaN",)]


def test_a_batch_that_broke_off_counts_like_one_that_did_not(spark, rows, tmp_path, monkeypatch):
    paths = ingest.Paths.under(str(tmp_path))
    event = '{"event_type": "trip_completed", "event_time": "x", "pickup_datetime": "2024-01-01 00:00:00", "passenger_count": %s}'
    batch = rows([(event % n,) for n in ("1.0", "1", "2", "9", "2.5")] + [("oops",)], "value string")
    append = ingest.sinks.append

    def breaks(*args):
        append(*args)
        raise OSError("lost")

    monkeypatch.setattr(ingest.sinks, "append", breaks)
    with pytest.raises(OSError, match="lost"):
        ingest.ingest_batch(batch, 1, paths)
    monkeypatch.undo()
    for _ in range(2):
        ingest.ingest_batch(batch, 1, paths)
        assert spark.read.parquet(paths.table).count() == 2
        totals = ingest.total_counters(spark.read.parquet(paths.counters)).first().asDict()
        assert totals == {"processed": 6, "inserted": 2, "duplicates": 1, "invalid": 3}


@pytest.mark.parametrize("text", ["SELECT java_method('java.lang.System', 'getProperty', 'user.dir')", "SELECT `reflect` ('a', 'b')", "SELECT * FROM parquet.`/tmp/x`", "SELECT * FROM `csv` . `/etc/hosts`"])
def test_adhoc_stays_inside(spark, text):
    with pytest.raises(NotReadOnly):
        adhoc(spark, text)
