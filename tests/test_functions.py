from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import one, values
from tidegate.functions import hashing as H
from tidegate.functions import scalars as X
from tidegate.schemas import CITY_BOX, PAYMENT_METHODS, PORT_NAMES


def apply(rows, schema, data, column):
    return [r[0] for r in rows(data, schema).select(column).collect()]


def test_labels_default_to_null_or_unknown(rows):
    assert apply(rows, "c int", [(1,), (6,), (9,), (None,)], X.code_label("c", PAYMENT_METHODS)) == [
        "Credit Card", "Voided Trip", None, None,
    ]
    assert apply(rows, "c string", [("Q",), ("X",), (None,)], X.code_label("c", PORT_NAMES, "Unknown")) == [
        "Queenstown", "Unknown", "Unknown",
    ]


def test_flags_and_codes(rows):
    assert apply(rows, "c int", [(1,), (0,), (2,), (None,)], X.flag_to_bool("c")) == [True, False, None, None]
    assert apply(rows, "c string", [("C",), ("Z",)], X.whitelist("c", ["C", "Q", "S"])) == ["C", None]
    assert apply(rows, "c int", [(1,), (None,)], X.is_unknown("c")) == [False, True]


def test_text(rows):
    assert apply(rows, "c string", [(" a ",), ("  ",), ("",), (None,)], X.blank_to_null("c")) == ["a", None, None, None]
    assert apply(rows, "c string", [("London",), ("Rome",)], X.same_text("c", "LONDON")) == [True, False]
    assert apply(rows, "c string", [(" Ab ",)], X.lower(X.trim("c"))) == ["ab"]


def test_numbers(rows):
    assert apply(rows, "c string", [("2.5",), ("x",), ("",), (None,)], X.to_numeric("c")) == [2.5, None, None, None]
    assert apply(rows, "c double", [(float("nan"),), (1.0,), (None,)], X.nan_to_null("c")) == [None, 1.0, None]
    assert apply(rows, "c decimal(8,2)", [(Decimal("-5"),), (None,), (Decimal("3"),)], X.floor_zero("c")) == [
        Decimal("0.00"), Decimal("0.00"), Decimal("3.00"),
    ]
    assert apply(rows, "c double", [(-1.0,), (130.0,), (50.0,), (None,)], X.clip("c", 0.0, 100.0)) == [0.0, 100.0, 50.0, None]
    assert apply(rows, "c double", [(2.345,), (-2.345,), (1.005,)], X.round_half_up("c", 2)) == [
        Decimal("2.35"), Decimal("-2.35"), Decimal("1.01"),
    ]
    assert apply(rows, "n bigint", [(0,), (1,), (20,), (21,)], X.pages("n", 20)) == [0, 1, 1, 2]


@pytest.mark.parametrize(
    ("tip", "fare", "expected"),
    [("2.00", "14.50", "13.8"), ("1.00", "0", "0.0"), ("1.00", None, "0.0"), (None, "10", None), ("0.05", "100", "0.1"), ("-0.05", "100", "-0.1")],
)
def test_tip_percent(rows, tip, fare, expected):
    data = [(tip and Decimal(tip), fare and Decimal(fare))]
    (pct,) = apply(rows, "t decimal(8,2), f decimal(8,2)", data, X.ratio_pct("t", "f"))
    assert pct == (expected and Decimal(expected))


def test_average_rounds_half_away_from_zero(rows):
    df = rows([(Decimal("0.01"),), (Decimal("0.02"),), (None,)], "c decimal(8,2)")
    assert one(df.agg(X.round_avg("c", 2).alias("a")))["a"] == Decimal("0.02")
    negative = rows([(Decimal("-0.01"),), (Decimal("-0.02"),)], "c decimal(8,2)")
    assert one(negative.agg(X.round_avg("c", 2).alias("a")))["a"] == Decimal("-0.02")
    assert one(df.where("false").agg(X.round_avg("c", 2).alias("a")))["a"] is None
    assert one(df.agg(X.round_avg("c", 4).alias("a")))["a"] == Decimal("0.0150")
    assert one(df.agg(X.round_avg("c", 0).alias("a")))["a"] == Decimal("0")
    fine = df.sparkSession.createDataFrame([(0.044,), (0.064,)], "c double")
    assert one(fine.agg(X.round_avg("c", 3).alias("a")))["a"] == Decimal("0.054")


def test_durations(rows):
    a = datetime(2015, 1, 15, 9, 32)
    data = [(a, datetime(2015, 1, 15, 9, 45)), (a, a), (a, datetime(2015, 1, 15, 9)), (a, None), (a, datetime(2015, 1, 15, 9, 32, 10))]
    got = apply(rows, "s timestamp, e timestamp", data, X.duration_minutes("s", "e"))
    assert got == [Decimal("13.00"), None, None, None, Decimal("0.17")]
    assert apply(rows, "s timestamp, e timestamp", data[:1], X.elapsed("s", "e", "hour")) == [13 / 60]


def test_time_text(rows):
    assert apply(rows, "c string", [("2015-01-15 09:32:00",), ("2015-01-15T09:32:00",), ("nan",), ("",)], X.parse_ts("c")) == [
        datetime(2015, 1, 15, 9, 32), datetime(2015, 1, 15, 9, 32), None, None,
    ]
    ends = apply(rows, "c timestamp", [(None,), (datetime(2020, 1, 1),)], X.open_end("c"))
    assert ends == [datetime(9999, 12, 31, 23, 59, 59, 999999), datetime(2020, 1, 1)]
    assert apply(rows, "c timestamp", [(datetime(2020, 1, 1, 7, 5),), (None,)], X.fmt_ts("c")) == ["2020-01-01T07:05", "N/A"]
    assert apply(rows, "c double", [(1234.5,), (None,)], X.fmt_money("c", "$")) == ["$1234.50", "—"]


@pytest.mark.parametrize(
    ("lon", "lat", "inside"),
    [("-74.3", "40.5", True), ("-73.7", "40.9", True), ("-74.300001", "40.7", False), ("-74", "40.900001", False), (None, "40.7", False)],
)
def test_geofence_edges(rows, lon, lat, inside):
    point = rows([(lon and Decimal(lon), Decimal(lat))], "lon decimal(11,6), lat decimal(11,6)")
    a, b = X.geofence("lon", "lat", CITY_BOX)
    got = one(point.select(a.alias("a"), b.alias("b")))
    assert (got["a"] is not None, got["b"] is not None) == (inside, inside)


def test_json_number_checks(rows):
    data = [("2.9",), ("3",), ("3.0",), ("nan",), ("abc",), (None,)]
    assert apply(rows, "c string", data, X.numeric_ok("c")) == [True, True, True, False, False, False]
    assert apply(rows, "c string", data, X.int_ok("c")) == [False, True, True, False, False, False]


def test_size_units(rows):
    data = [(10239,), (10240,), (10240 * 1024 - 513,), (10240 * 1024,), (5 * 1024**4,), (20000 * 1024**5,)]
    assert apply(rows, "n bigint", data[:5], X.size_pretty("n")) == ["10239 bytes", "10 kB", "10239 kB", "10 MB", "5120 GB"]


def test_row_hash(rows):
    df = rows([(1, None, 2), (None, 1, 2), (1, None, 2)], "a int, b int, c int")
    hashes = [r[0] for r in df.select(H.row_hash(["a", "b", "c"])).collect()]
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2] and None not in hashes
    assert hashes == [r[0] for r in df.select(H.row_hash(["c", "b", "a"])).collect()]


def test_row_hash_sees_fares_and_microseconds(rows):
    fares = rows([(Decimal("14.50"),), (Decimal("25.00"),)], "fare decimal(8,2)")
    assert len({r[0] for r in fares.select(H.row_hash(["fare"])).collect()}) == 2
    times = rows([(datetime(2020, 1, 1, 0, 0, 0, 1),), (datetime(2020, 1, 1, 0, 0, 0, 2),)], "t timestamp")
    assert len({r[0] for r in times.select(H.row_hash(["t"])).collect()}) == 2
    zeros = rows([(0.0,), (-0.0,)], "v double")
    assert len(set(values(H.with_row_hash(zeros), "source_row_hash"))) == 1


def test_event_hash_ignores_delivery_fields(rows):
    df = rows([("t1", 1), ("t2", 1)], "event_time string, fare int")
    assert df.select(H.event_hash(["event_time", "fare"])).distinct().count() == 1


def test_attribute_hash_text_form(rows):
    df = rows([("a", None, 3)], "x string, y string, z int")
    assert one(df.select((H.attr_hash(["x", "y", "z"]) == F.md5(F.lit("a|NULL|3"))).alias("same")))["same"]


def test_spread_key_fills_buckets(rows):
    df = rows([(1, i) for i in range(400)], "vendor int, id int")
    assert df.select(H.spread_key(["vendor", "id"], 8).alias("b")).distinct().count() == 8
    assert H.shared_key_hash(df, ["vendor"]).select("shared_hash").distinct().count() == 1
