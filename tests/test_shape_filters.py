from datetime import datetime

from pyspark.sql import functions as F

from tests.conftest import one, values
from tidegate.operators import filters as P
from tidegate.operators import shape as S
from tidegate.schemas import TRIP_RULES

TRIP = "fare_amount double, trip_distance double, passenger_count int"
GOOD = (14.5, 3.5, 2)


def trips(rows, *data):
    return rows(list(data), TRIP)


def test_clean_boundaries(rows):
    for fare, distance, count, kept in [
        (14.5, 3.5, 2, True), (0.0, 3.5, 2, False), (-5.0, 3.5, 2, False), (14.5, 0.0, 2, False), (14.5, 3.5, 0, False),
        (14.5, 3.5, 7, False), (14.5, 3.5, 6, True), (14.5, 3.5, 1, True), (float("nan"), 3.5, 2, False), (None, 3.5, 2, False),
    ]:
        assert P.clean(trips(rows, (fare, distance, count)), TRIP_RULES).count() == int(kept), (fare, distance, count)


def test_clean_mixed_batch_and_report(rows):
    df = trips(rows, GOOD, (0.0, 3.5, 2), (14.5, 0.0, 2), (14.5, 3.5, 9))
    assert P.clean(df, TRIP_RULES).count() == 1
    assert P.rejected(df, TRIP_RULES).count() == 3
    report = values(P.clean_report(df, TRIP_RULES))
    assert report == [("fare_amount", 4, 1), ("passenger_count", 4, 1), ("trip_distance", 4, 1)]


def test_clean_skips_rules_of_absent_columns(rows):
    df = rows([(0.0,), (5.0,)], "fare_amount double")
    assert values(P.clean(df, TRIP_RULES)) == [(5.0,)]
    other = rows([(1,)], "x int")
    assert P.clean(other, TRIP_RULES).count() == 1 and P.rejected(other, TRIP_RULES).count() == 0


def test_rejected_names_every_broken_rule(rows):
    broken = one(P.rejected(trips(rows, (0.0, None, 2)), TRIP_RULES))
    assert broken["failed_rules"] == ["fare_amount", "trip_distance"]


def test_incremental_and_late_rows_split_at_the_mark(rows):
    df = rows([(datetime(2024, 1, d),) for d in (1, 2, 3)], "ts timestamp")
    mark = datetime(2024, 1, 2)
    assert P.filter_incremental(df, "ts", mark).count() == 1
    assert P.late_rows(df, "ts", mark).count() == 2
    assert P.filter_incremental(df, "ts", None).count() == 3 and P.late_rows(df, "ts", None).count() == 0
    assert P.filter_incremental(df, "ts", mark, lookback="1 day").count() == 2


def test_optional_filters(rows):
    df = rows([(1, "a", 5), (2, "b", 9), (2, "a", 7)], "k int, s string, v int")
    assert P.filter_where(df, k=2, s=None, v__gte=None).count() == 2
    assert P.filter_where(df, k=2, s="a", v__lte=7).count() == 1
    assert P.filter_where(df, s="").count() == 3
    assert P.between(df, "v", 5, 7).count() == 2 and P.between(df, "v", None, 7).count() == 3


def test_membership_and_patterns(rows):
    df = rows([("ingest_trips",), ("ingestXtrips",), ("load",)], "task string")
    assert P.like(df, "task", "ingest_%").count() == 2
    assert P.in_values(df, "task", ["load"]).count() == 1
    keys = rows([("load",)], "task string")
    assert P.in_table(df, keys, "task").count() == 1 and P.not_in_table(df, keys, "task").count() == 2
    assert P.require(rows([(1, None), (1, 2)], "a int, b int"), ["a", "b"]).count() == 1


def test_shaping(rows):
    df = rows([("1", "x")], "a string, b string")
    assert S.keep(df, ["b", "missing", "a"]).columns == ["b", "a"]
    aligned = S.align(S.rename(df, {"a": "id"}), {"id": "string", "n": "int", "b": "string"})
    assert aligned.columns == ["id", "n", "b"] and one(aligned)["n"] is None
    typed = S.conform(rows([("1", "oops", "12345")], "a string, b string, c string"), {"a": "int", "b": "int", "c": "decimal(4,2)"})
    assert one(typed) == {"a": 1, "b": None, "c": None}
    assert S.ensure_columns(df, {"a": "int", "z": "date"}).dtypes == [("a", "string"), ("b", "string"), ("z", "date")]
    assert one(S.duplicate(df, {"c": "a"}))["c"] == "1"
    assert one(S.fill(rows([(None,)], "n int"), {"n": 1, "m": 2})) == {"n": 1, "m": 2}
    stamp = F.lit("2024-01-01").cast("timestamp")
    assert one(S.with_audit(df, stamp))["loaded_at"] == datetime(2024, 1, 1)
    both = S.concat([df, rows([("2",)], "a string"), rows([("q",)], "b string")])
    assert both.count() == 3 and both.columns == ["a", "b"]


def test_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    fresh = P.filter_incremental(events, "ts", datetime(2024, 1, 15)).select("event_id")
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(ts" in plan and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in plan
