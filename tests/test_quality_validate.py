import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import one, values
from tidegate.operators import contract as C
from tidegate.operators import quality as Q
from tidegate.operators import validate as V
from tidegate.plans.suites import PASSENGER_FORM, PASSENGER_SUITE, TRIP_FORM, TRIP_SUITE
from tidegate.streaming.events import parse_events

EVENT = {
    "event_type": "trip_completed", "event_time": "2015-01-15T10:00:00", "vendor_id": 1, "pickup_datetime": "2015-01-15 09:32:00",
    "dropoff_datetime": "2015-01-15 09:45:00", "passenger_count": 2, "trip_distance": 3.5, "fare_amount": 14.5, "tip_amount": 2.0,
    "total_amount": 17.5,
}


def result(df, *checks):
    return {(r["check"], r["column"]): r for r in Q.run_suite(df, "s", checks).collect()}


def test_suite_ignores_nulls_except_in_not_null(rows):
    df = rows([(1, 1.0), (None, 2.0), (7, float("nan")), (7, None)], "p int, v double")
    out = result(
        df, Q.check_not_null("p"), Q.check_between("p", 1, 6), Q.check_in_set("p", [1, 7]), Q.check_unique("p"),
        Q.check_between("v", 0, strict_min=True), Q.check_row_count(1, 4), Q.check_mean("p", 1, 5), Q.check_share("p", 7, 0.6, 0.7),
    )
    got = {k[0] + ":" + str(k[1]): (r.success, r.unexpected_count) for k, r in out.items()}
    assert got == {
        "not_null:p": (False, 1), "between:p": (False, 1 + 1), "in_set:p": (True, 0), "unique:p": (False, 2), "between:v": (False, 1),
        "row_count:None": (True, None), "mean:p": (True, None), "share=7:p": (True, None),
    }


def test_strict_minimum(rows):
    df = rows([(0.0,), (1.0,)], "v double")
    assert not result(df, Q.check_between("v", 0, strict_min=True))["between", "v"].success
    assert result(df, Q.check_between("v", 0))["between", "v"].success


def test_empty_table_fails_bounds_not_rows(rows):
    out = result(rows([], "v int"), Q.check_row_count(1), Q.check_not_null("v"), Q.check_mean("v", 0, 1), Q.check_unique("v"), Q.check_median("v", 0, 1))
    assert [out[k].success for k in [("row_count", None), ("not_null", "v"), ("mean", "v"), ("unique", "v"), ("median", "v")]] == [
        False, True, False, True, False,
    ]


def test_gate(rows):
    df = rows([(1,), (1,)], "v int")
    Q.gate(Q.run_suite(df, "s", [Q.check_not_null("v")]))
    with pytest.raises(Q.GateClosed, match="unique"):
        Q.gate(Q.run_suite(df, "s", [Q.check_not_null("v"), Q.check_unique("v")]))
    stamped = Q.record_results(Q.run_suite(df, "s", [Q.check_not_null("v")]), "r1", F.lit("2024-01-01").cast("timestamp"))
    assert one(stamped)["run_id"] == "r1"


def test_dataset_suites(rows):
    trips = rows([(datetime(2015, 1, 1), str(i), 1 + i % 6, 10.0, 1.0) for i in range(1000)],
                 "pickup_datetime timestamp, source_row_hash string, passenger_count int, fare_amount double, trip_distance double")
    assert Q.run_suite(trips, "trips", TRIP_SUITE).where("success").count() == len(TRIP_SUITE)
    passengers = rows(
        [(i, int(i < 342), 1 if i < 216 else 2 if i < 400 else 3, 1.0, datetime(2024, 1, 1)) for i in range(891)],
        "passenger_id int, survived int, pclass int, fare double, loaded_at timestamp",
    )
    failed = Q.run_suite(passengers, "p", PASSENGER_SUITE).where("NOT success").select("check")
    assert values(failed) == [("share=1",), ("share=2",), ("share=3",)]


@pytest.mark.parametrize(("hours", "status"), [(24, "ok"), (25, "warn"), (48, "warn"), (49, "error")])
def test_freshness(rows, hours, status):
    df = rows([(datetime(2024, 1, 1),)], "ts timestamp")
    now = F.lit("2024-01-01").cast("timestamp") + F.expr(f"INTERVAL {hours} HOURS")
    assert one(Q.freshness(df, "ts", now))["status"] == status
    assert one(Q.freshness(df.where("false"), "ts", now))["status"] == "error"


# --- events ---------------------------------------------------------------


def error_of(rows, **changes):
    event = {k: v for k, v in {**EVENT, **changes}.items() if v != "absent"}
    raw = rows([(json.dumps(event),)], "value string")
    return one(V.validate_events(parse_events(raw)))["error"]


@pytest.mark.parametrize(
    ("field", "value", "part"),
    [
        ("pickup_datetime", "absent", "pickup_datetime"), ("event_time", None, "event_time"), ("event_type", "trip_started", "trip_started"),
        ("fare_amount", 0, "> 0"), ("fare_amount", -5, "> 0"), ("fare_amount", "not_a_number", "numeric"), ("trip_distance", 0, "> 0"),
        ("total_amount", float("nan"), "numeric"), ("passenger_count", 0, "between"), ("passenger_count", 7, "between"),
        ("passenger_count", 2.9, "integer"), ("passenger_count", "two", "integer"), ("pickup_datetime", "nan", "timestamp"),
        ("pickup_datetime", "", "timestamp"),
    ],
)
def test_invalid_events_name_the_field(rows, field, value, part):
    error = error_of(rows, **{field: value})
    assert error is not None and part in error


def test_valid_events(rows):
    assert error_of(rows) is None
    assert error_of(rows, passenger_count=6) is None
    assert error_of(rows, tip_amount="absent", total_amount="absent") is None
    assert error_of(rows, passenger_count=None, fare_amount=None) is None


@pytest.mark.parametrize("raw", ["oops", '{"a":', '[{"event_type":"trip_completed"}]', '"text"', "", None])
def test_malformed_json_is_quarantined(rows, raw):
    got = one(V.validate_events(parse_events(rows([(raw,)], "value string"))))
    assert got["error"] == "malformed JSON" and got["raw"] == raw


# --- payloads -------------------------------------------------------------

PASSENGER = {"survived": 1, "pclass": 2, "name": "A", "sex": "female"}


def payload_errors(rows, body, form):
    text = body if isinstance(body, str) else json.dumps(body)
    checked = V.validate_payloads(rows([(text,)], "body string"), "body", form)
    return {(e.path, e.message) for e in one(checked)["errors"]}


def test_passenger_payloads(rows):
    assert payload_errors(rows, PASSENGER, PASSENGER_FORM) == set()
    assert payload_errors(rows, {**PASSENGER, "survived": "yes"}, PASSENGER_FORM) == {("survived", "must be a number")}
    assert payload_errors(rows, {**PASSENGER, "survived": 0.5}, PASSENGER_FORM) == {("survived", "must be an integer")}
    assert payload_errors(rows, {"survived": 1, "pclass": 1}, PASSENGER_FORM) == {("name", "is required"), ("sex", "is required")}
    assert payload_errors(rows, {**PASSENGER, "age": None}, PASSENGER_FORM) == set()
    assert payload_errors(rows, {**PASSENGER, "name": None}, PASSENGER_FORM) == {("name", "must not be null")}
    assert payload_errors(rows, {**PASSENGER, "fare": "1"}, PASSENGER_FORM) == {("fare", "must be a number")}
    assert payload_errors(rows, "[1]", PASSENGER_FORM) == {("", "must be a JSON object")}
    assert payload_errors(rows, "{bad", PASSENGER_FORM) == {("", "must be a JSON object")}


def test_trip_and_update_payloads(rows):
    assert payload_errors(rows, {}, TRIP_FORM) == set()
    assert payload_errors(rows, {}, V.partial(PASSENGER_FORM)) == set()
    assert payload_errors(rows, {"fare_amount": -5}, TRIP_FORM) == {("fare_amount", "must be at least 0")}
    assert payload_errors(rows, {"passenger_count": "two"}, TRIP_FORM) == {("passenger_count", "must be a number")}
    assert payload_errors(rows, {"passenger_count": None, "fare_amount": 1e3}, TRIP_FORM) == set()


def test_insert_applies_defaults_and_returns_rejects(rows):
    target = rows([], "survived smallint, pclass smallint, name string, sex string, sib_sp smallint, ticket string, fare double, age double")
    bodies = rows([(json.dumps(PASSENGER),), (json.dumps({"survived": "yes"}),)], "body string")
    out, rejected = V.insert_validated(target, bodies, "body", PASSENGER_FORM)
    got = one(out)
    assert (got["name"], got["sib_sp"], got["ticket"], got["fare"], got["age"]) == ("A", 0, "", 0.0, None)
    assert rejected.count() == 1


def test_payload_rows_list_the_named_fields(rows):
    bodies = V.validate_payloads(rows([(1, '{"age": null, "fare": 2.5, "other": 1}')], "id int, body string"), "body", V.partial(PASSENGER_FORM))
    got = one(V.payload_rows(bodies, V.partial(PASSENGER_FORM), ["id"]))
    assert sorted(got["set_cols"]) == ["age", "fare"] and got["fare"] == 2.5 and got["age"] is None


def test_row_validation(rows):
    df = rows([(1, -1.0, None), (2, 5.5, "x")], "id int, n double, s string")
    out = V.validate_rows(df, [V.Field("n", "int", minimum=0), V.Field("s", "string", required=True), V.Field("gone", "string", required=True)])
    errors = {r.id: [(e.path, e.message) for e in r.errors] for r in out.collect()}
    assert errors[1] == [("n", "must be at least 0"), ("s", "is required"), ("gone", "is required")]
    assert errors[2] == [("n", "must be an integer"), ("gone", "is required")]


# --- contracts ------------------------------------------------------------


def test_contract(rows):
    df = rows([(1, "a", -1)], "id int, name string, extra int")
    stable = {"id": "bigint", "name": "string", "fare": "double"}
    assert values(C.contract_diff(df, stable), "column", "change", "breaking") == [
        ("extra", "added", False), ("fare", "removed", True), ("id", "type changed", True),
    ]
    checked = C.contract_check(df, "t", stable, [Q.check_between("extra", 0), Q.check_between("fare", 0)])
    assert ("extra", "between", True, 1) in values(checked)
    with pytest.raises(C.MissingColumns, match="source_row_hash"):
        C.require_columns(df, ["id", "source_row_hash"])
    assert values(C.column_listing(df), "column_name", "data_type", "ordinal_position")[0] == ("extra", "int", 3)
