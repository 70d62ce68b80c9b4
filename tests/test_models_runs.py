from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import one, values
from tidegate import schemas as S
from tidegate.operators.contract import MissingColumns
from tidegate.plans import models as M
from tidegate.plans import runs as R
from tidegate.plans.adhoc import NotReadOnly, adhoc
from tidegate.plans.suites import HOURLY_TESTS, STAGED_PASSENGER_TESTS, STAGED_TRIP_TESTS, SURVIVAL_SUMMARY_TESTS
from tidegate.operators.quality import run_suite
from tidegate.sources import catalog as C
from tidegate.sources.files import literal_rows, read_csv, read_csv_by_name, read_table

RAW = {
    "vendor_id": "1", "pickup_datetime": "2015-01-15 09:32:00", "dropoff_datetime": "2015-01-15 09:45:00", "passenger_count": "2",
    "trip_distance": "3.5", "pickup_longitude": "-73.985", "pickup_latitude": "40.758", "rate_code": "1", "store_and_fwd_flag": "N",
    "dropoff_longitude": "-73.990", "dropoff_latitude": "41.5", "payment_type": "1", "fare_amount": "14.50", "extra": "0.50",
    "mta_tax": "0.50", "tip_amount": "2.00", "tolls_amount": "-1.00", "total_amount": "17.50",
}
# Hand-made sample passengers.
SAMPLE = [
    (1, 0, 3, "Braund, Mr. Owen Harris", "male", 22, 1, 0, "A/5 21171", 7.25, None, "S"),
    (2, 1, 1, "Cumings, Mrs. John Bradley", "female", 38, 1, 0, "PC 17599", 71.2833, "C85", "C"),
    (3, 1, 3, "Heikkinen, Miss. Laina", "female", 26, 0, 0, "STON/O2", 7.925, None, "S"),
    (4, 1, 1, "Futrelle, Mrs. Jacques Heath", "female", 35, 1, 0, "113803", 53.1, "C123", "S"),
    (5, 0, 3, "Allen, Mr. William Henry", "male", 35, 0, 0, "373450", 8.05, None, "S"),
]


def raw_trips(spark, *changes):
    data = [tuple({**RAW, **c}.values()) for c in (changes or ({},))]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in RAW))


def landed(spark, *changes):
    stamp = F.lit("2024-01-01").cast("timestamp")
    return M.land_trips(raw_trips(spark, *changes)).withColumns({"id": F.lit(1).cast("bigint"), "loaded_at": stamp})


def test_csv_to_landed_trips(spark, tmp_path):
    path = tmp_path / "trips.csv"
    path.write_text(",".join(RAW) + "\n" + ",".join(RAW.values()) + "\n" + ",".join({**RAW, "fare_amount": "0"}.values()) + "\n")
    assert read_csv_by_name(spark, str(path)).count() == 2 and read_csv_by_name(spark, str(path), 1).count() == 1
    out = M.land_trips(read_csv_by_name(spark, str(path)))
    got = one(out)
    assert out.columns == [*S.TRIP_COLUMNS, "source_row_hash"] and got["rate_code_id"] == 1 and got["source_row_hash"]
    typed = read_csv(spark, str(path), {c: "string" for c in RAW})
    assert one(M.land_trips(typed))["source_row_hash"] == got["source_row_hash"]


def test_landed_trips_fill_absent_columns(spark):
    short = raw_trips(spark).drop("extra", "pickup_longitude", "trip_distance")
    got = one(M.land_trips(short))
    assert got["extra"] is None and got["trip_distance"] is None and got["fare_amount"] == Decimal("14.50")


def test_staged_trip(spark):
    got = one(M.stage_trips(landed(spark)))
    assert got["vendor_name"] == "Creative Mobile Technologies" and got["rate_type"] == "Standard Rate"
    assert got["payment_method"] == "Credit Card" and got["trip_duration_minutes"] == Decimal("13.00")
    assert got["pickup_longitude"] is not None and got["dropoff_longitude"] is None and got["dropoff_latitude"] is None
    assert got["tolls_amount_usd"] == Decimal("0.00") and got["tip_pct"] == Decimal("13.8")
    assert run_suite(M.stage_trips(landed(spark)), "s", STAGED_TRIP_TESTS).where("NOT success").count() == 0
    with pytest.raises(MissingColumns):
        M.stage_trips(landed(spark).drop("source_row_hash"))


def test_hourly_raw_and_staged(spark):
    df = landed(spark, {}, {"pickup_datetime": "2015-01-15 09:59:59", "total_amount": "18.51"}, {"pickup_datetime": "2015-01-15 10:00:00"})
    hours = M.trips_hourly(M.stage_trips(df))
    assert values(hours, "hour", "total_trips", "avg_fare_usd", "total_passengers") == [
        (datetime(2015, 1, 15, 10), 1, Decimal("17.50"), 2), (datetime(2015, 1, 15, 9), 2, Decimal("18.01"), 4),
    ]
    assert values(M.trips_hourly_raw(df)) == values(hours)
    assert run_suite(hours, "h", HOURLY_TESTS).where("NOT success").count() == 0
    assert one(M.trip_stats(df))["total_revenue"] == Decimal("53.51")
    assert values(M.fare_histogram(df), "bin", "rows") == [(9, 3)] and M.distance_histogram(df).count() == 1


def test_passengers(spark):
    text = [tuple(None if v is None else str(v) for v in row) for row in SAMPLE] + [("6", "2", "9", " X ", "MALE", "old", "1", None, " t ", "-3", " ", "")]
    names = list(S.PASSENGER_RENAMES)
    land = M.land_passengers(spark.createDataFrame(text, ", ".join(f"{n} string" for n in names)))
    assert land.columns == list(S.PASSENGER_COLUMNS)
    staged = M.stage_passengers(land.withColumns({"id": F.col("passenger_id").cast("bigint"), "loaded_at": F.lit("2024-01-01").cast("timestamp")}))
    odd = one(staged.where("source_passenger_id = 6"))
    assert (odd["did_survive"], odd["passenger_class_name"], odd["passenger_class_num"]) == (None, "Unknown", None)
    assert (odd["age_years"], odd["is_age_unknown"], odd["family_size"], odd["fare_gbp"]) == (None, True, None, Decimal("0.0000"))
    assert (odd["full_name"], odd["sex"], odd["cabin_number"], odd["embarkation_port"], odd["embarkation_code"]) == ("X", "male", None, "Unknown", None)
    summary = M.survival_summary(staged)
    assert values(summary) == [
        (1, "female", 2, 2, Decimal("100.00"), Decimal("36.5"), Decimal("62.19")),
        (3, "female", 1, 1, Decimal("100.00"), Decimal("26.0"), Decimal("7.93")),
        (3, "male", 2, 0, Decimal("0.00"), Decimal("28.5"), Decimal("7.65")),
    ]
    assert values(M.survival_summary_raw(land)) == values(summary)
    assert run_suite(staged, "p", STAGED_PASSENGER_TESTS).where("NOT success").count() == 0
    assert run_suite(summary, "p", SURVIVAL_SUMMARY_TESTS).where("NOT success").count() == 0
    assert M.survival_by_class(land).count() == 3 and one(M.survival_totals(land))["survivors"] >= 3
    assert values(M.survival_rate_bars(land.where("passenger_id < 6")), "pclass", "sex", "mean")[0] == (1, "female", Decimal("1.0000"))
    ages = values(M.age_histogram(land), "bin", "rows")
    assert sum(n for _, n in ages) == 5 and ages[0][0] == 0


def test_seed_rows(spark):
    assert literal_rows(spark, [(1, "a")], {"k": "int", "v": "string"}).dtypes == [("k", "int"), ("v", "string")]


# --- runs -----------------------------------------------------------------


def log(spark, *data):
    schema = "dag_id string, task_id string, run_id string, status string, s string, e string, d string, n bigint, m string"
    return spark.createDataFrame([("dag", *r) for r in data], schema).selectExpr(
        "dag_id", "task_id", "run_id", "status", "CAST(s AS timestamp) AS started_at", "CAST(e AS timestamp) AS ended_at",
        "CAST(d AS decimal(12,3)) AS duration_seconds", "n AS rows_ingested", "m AS error_message", "CAST(s AS timestamp) AS created_at",
        "CAST(s AS timestamp) AS updated_at",
    )


NOW = "2024-01-10 00:00:00"


def at(text=NOW):
    return F.lit(text).cast("timestamp")


def test_run_log_start_finish_restart(spark):
    empty = log(spark, ("t", "r", "x", None, None, None, None, None)).where("false")
    key = spark.createDataFrame([("dag", "t", "r1")], "dag_id string, task_id string, run_id string")
    started = R.mark_running(empty, key, at("2024-01-01 00:00:00"))
    assert one(started.select("status", "rows_ingested")) == {"status": "running", "rows_ingested": None}
    ends = key.select("*", F.lit("failed").alias("status"), at("2024-01-01 00:01:30").alias("ended_at"), F.lit("boom").alias("error_message"), F.lit(5).cast("bigint").alias("rows_ingested"))
    done = R.mark_finished(started, ends)
    assert one(done.select("status", "duration_seconds", "error_message", "rows_ingested")) == {
        "status": "failed", "duration_seconds": Decimal("90.000"), "error_message": "boom", "rows_ingested": 5,
    }
    again = one(R.mark_running(done, key, at("2024-01-02 00:00:00")))
    assert (again["started_at"], again["ended_at"], again["duration_seconds"], again["error_message"]) == (datetime(2024, 1, 1), None, None, None)
    other = ends.withColumn("run_id", F.lit("unknown"))
    assert values(R.mark_finished(done, other)) == values(done)


def test_watermarks(spark):
    marks = spark.createDataFrame([], S.ddl(S.WATERMARK_COLUMNS))
    assert R.get_watermark(marks, "trips") is None
    one_mark = R.update_watermark(marks, "trips", datetime(2024, 1, 5), 10, "r1", at(), source=("staging", "trips", "pickup"))
    assert R.get_watermark(one_mark, "trips") == datetime(2024, 1, 5)
    got = one(one_mark)
    assert (got["last_successful_run"], got["last_rows_loaded"], got["source_table"]) == ("r1", 10, "trips")
    back = R.update_watermark(one_mark, "trips", datetime(2024, 1, 1), 1, "r2", at("2024-01-11"))
    assert R.get_watermark(back, "trips") == datetime(2024, 1, 1)
    kept = one(R.update_watermark(one_mark, "trips", datetime(2024, 1, 1), 1, "r2", at("2024-01-11"), monotonic=True))
    assert (kept["watermark_value"], kept["source_table"], kept["created_at"]) == (datetime(2024, 1, 5), "trips", datetime(2024, 1, 10))
    assert one(R.mark_age(one_mark, at("2024-01-11")))["hours_since_update"] == 24.0


def test_run_questions(spark):
    runs = log(
        spark,
        ("ingest_a", "1", "success", "2024-01-01", "2024-01-01 01:00:00", "3600", 100, None),
        ("ingest_a", "2", "success", "2024-01-02", "2024-01-02 01:00:00", "3600", 70, None),
        ("ingest_b", "1", "failed", "2024-01-03", "2024-01-03 00:10:00", "600", None, "boom"),
        ("load", "1", "success", "2024-01-09", "2024-01-09 12:00:00", "10", 1, None),
    )
    assert values(R.latest_runs(runs), "task_id", "run_id") == [("ingest_a", "2"), ("ingest_b", "1"), ("load", "1")]
    assert values(R.hours_since_success(runs, at()), "task_id", "hours_since_completion") == [("ingest_a", 191.0), ("load", 12.0)]
    assert values(R.recent_failures(runs), "task_id", "error_message") == [("ingest_b", "boom")]
    assert values(R.ingest_deltas(runs), "run_id", "row_delta") == [("1", None), ("2", -30)]


def test_alerts(spark):
    steady = [("t", str(d), "success", f"2024-01-0{d}", f"2024-01-0{d} 00:00:10", "10", 5, None) for d in range(1, 9)]
    runs = log(
        spark, *steady,
        ("t", "slow", "success", "2024-01-09 20:00:00", "2024-01-09 20:00:30", "30", 5, None),
        ("ingest_x", "1", "success", "2024-01-08", "2024-01-08 00:10:00", "600", 100, None),
        ("ingest_x", "2", "success", "2024-01-09", "2024-01-09 00:10:00", "600", 79, None),
        ("ingest_y", "1", "failed", "2024-01-09", None, None, None, "boom"),
    )
    marks = spark.createDataFrame([("old", datetime(2024, 1, 8)), ("fresh", datetime(2024, 1, 9, 12))], "dataset_name string, updated_at timestamp")
    found = values(R.alerts(runs, marks, at()), "rule", "subject")
    assert found == [
        ("failed run", "dag/ingest_y/1"), ("no recent success", "dag/ingest_y"), ("row drop", "ingest_x/2"), ("slow run", "dag/t/2024-01-09"),
        ("stale data", "old"),
    ]


# --- ad hoc and catalog ---------------------------------------------------


def test_adhoc_takes_queries_only(spark):
    C.register_view(spark.range(10), "numbers")
    assert adhoc(spark, "SELECT count(*) AS n FROM numbers;").first().n == 10
    assert adhoc(spark, "WITH a AS (SELECT id FROM numbers) SELECT * FROM a WHERE id < :top ORDER BY id DESC", {"top": 3}).count() == 3
    assert adhoc(spark, "SELECT * FROM numbers", limit=4).count() == 4
    for text in ["", "DROP TABLE numbers", "SELECT 1 -- x", "INSERT INTO numbers VALUES (1)", "SHOW TABLES"]:
        with pytest.raises(NotReadOnly):
            adhoc(spark, text)
    for text in ["SELECT 1; DROP VIEW numbers", "WITH d AS (DELETE FROM numbers) SELECT * FROM d", "SELECT 1) x; DROP VIEW numbers; SELECT (1"]:
        with pytest.raises(Exception, match="PARSE"):
            adhoc(spark, text)
    assert spark.table("numbers").count() == 10


def test_catalog_names_views_by_layer(spark):
    catalog = C.Catalog(spark)
    catalog.add_source("staging", "trips", lambda: landed(spark))
    catalog.add_model("stg_trips", "staging", lambda c: M.stage_trips(c.source("staging", "trips")))
    catalog.add_model("hourly", "analytics", lambda c: M.trips_hourly(c.ref("stg_trips")))
    assert catalog.ref("hourly").count() == 1
    assert read_table(spark, "analytics__hourly").count() == read_table(spark, C.view_name("trips")).count() == 1
    assert catalog.names() == [("analytics", "hourly"), ("staging", "stg_trips"), ("staging", "trips")]
    profile = C.table_profile([("staging", "b", "table", spark.range(3)), ("analytics", "a", "view", spark.range(2))])
    assert [tuple(r) for r in profile.collect()] == [("analytics", "a", "view", 2), ("staging", "b", "table", 3)]
    assert values(C.layer_listing(spark)) == [("default",)]


def test_cleaning_reaches_the_scan_of_a_stored_table(spark, tmp_path):
    path = str(tmp_path / "trips")
    landed(spark).write.parquet(path)
    hourly = M.trips_hourly(M.stage_trips(spark.read.parquet(path)))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = hourly._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    for pushed in ("GreaterThan(fare_amount,0.00)", "GreaterThan(trip_distance,0.00)", "LessThanOrEqual(passenger_count,6)"):
        assert pushed in plan
    read = plan.split("ReadSchema: ")[1]
    assert "pickup_longitude" not in read and "source_row_hash" not in read
    assert plan.count("Exchange") == 1
