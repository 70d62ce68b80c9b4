from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from tests.conftest import one, values
from tidegate.functions.scalars import unscaled
from tidegate.operators import aggregates as A
from tidegate.operators import paging as G
from tidegate.operators.reconcile import reconcile


def test_hourly_rollup_drops_null_times(rows):
    data = [("2024-01-01 10:05:00", "1.00", 2), ("2024-01-01 10:59:59", "2.01", 1), (None, "9.00", 1)]
    df = rows(data, "ts string, fare string, pax int").selectExpr("CAST(ts AS timestamp) AS ts", "CAST(fare AS decimal(8,2)) AS fare", "pax")
    out = one(A.hourly_rollup(df, "ts", {"avg_fare": ("fare", 2)}, {"pax": "pax"}))
    assert out == {"hour": datetime(2024, 1, 1, 10), "total_trips": 2, "avg_fare": Decimal("1.51"), "pax": 3}


def test_rate_summary_with_unknown_flags(rows):
    df = rows([(1, "f", 1, 30.0), (1, "f", 0, 31.0), (1, "f", None, 32.0), (1, "f", 1, None)], "c int, s string, flag int, age double")
    out = one(A.rate_summary(df, ["c", "s"], "flag", {"avg_age": ("age", 1)}, require="age"))
    assert (out["total_passengers"], out["survivors"], out["survival_rate_pct"]) == (3, 1, Decimal("50.00"))
    assert out["avg_age"] == Decimal("31.0")


def test_totals_of_an_empty_table(rows):
    df = rows([], "survived int, pclass int")
    assert one(A.dim_totals(df, "survived")) == {"total": 0, "survivors": 0, "survival_rate": None}
    assert A.by_class(df, "pclass", "survived").count() == 0
    assert one(A.survivors(df)) == {"rows": 0, "survivors": 0}
    assert one(A.max_watermark(df, "pclass"))["watermark_value"] is None


def test_documented_totals(rows):
    df = rows([(1, 1)] * 342 + [(3, 0)] * 549, "pclass int, survived int")
    assert one(A.dim_totals(df, "survived")) == {"total": 891, "survivors": 342, "survival_rate": Decimal("38.4")}


def test_histogram_folds_both_ends(rows):
    df = rows([(v,) for v in (-5.0, 0.0, 1.49, 1.5, 60.0, 999.0)] + [(None,), (float("nan"),)], "v double")
    assert values(A.histogram(df, "v", 0, 60, 40), "bin", "rows") == [(0, 3), (1, 1), (39, 2)]


def test_duplicates_shares_and_top(rows):
    df = rows([("a", 1), ("a", 3), ("b", 2), (None, 9), (None, 9)], "k string, v int")
    assert values(A.duplicate_keys(df, ["k"])) == [("a", 2)]
    assert [r.k for r in A.top_groups(df, "k", F.col("v"), 5).collect()] == ["a", "b"]
    shares = values(A.mean_and_share(df.where("k IS NOT NULL"), ["k"], F.col("v"), F.col("v") > 1))
    assert shares == [("a", 2.0, 0.5), ("b", 2.0, 1.0)]
    assert values(A.group_mean(df, ["k"], "v", 1, 0)) == [("a", Decimal("2.0")), ("b", Decimal("2.0"))]


def test_run_trend_window_is_strict(rows):
    data = [("t", "2024-01-01 00:00:00", "1.500", "failed"), ("t", "2024-01-02 00:00:00", "2.500", "success")]
    runs = rows(data, "task_id string, s string, d string, status string").selectExpr(
        "task_id", "CAST(s AS timestamp) AS started_at", "CAST(d AS decimal(12,3)) AS duration_seconds", "status"
    )
    out = A.run_trend(runs, F.lit("2024-01-31").cast("timestamp"), 30)
    assert values(out, "run_count", "failure_count", "avg_duration_seconds") == [(1, 0, 2.5)]


def test_city_summary_and_counters(rows):
    df = rows([("x", "y", 1.25, 40), ("x", "y", 2.25, 41)], "city string, country string, t double, h int")
    out = one(A.city_summary(df, ["city", "country"], "t", "h"))
    assert [out[c] for c in ("total_readings", "avg_value", "min_value", "max_value", "avg_second")] == [
        2, Decimal("1.8"), Decimal("1.3"), Decimal("2.3"), Decimal("41"),
    ]
    events = rows([(None, True), (None, False), ("bad", None)], "error string, fresh boolean")
    assert one(A.load_counters(events, inserted="fresh")) == {"processed": 3, "invalid": 1, "inserted": 1, "duplicates": 1}


def test_pages_cover_the_sorted_table(spark):
    df = spark.range(57).selectExpr("id", "id % 3 AS g")
    seen = []
    for offset in range(0, 60, 20):
        found, total = G.page(df, ["-id"], 20, offset, g=None)
        seen += [r.id for r in found.collect()]
    assert seen == list(range(56, -1, -1)) and one(total)["total"] == 57
    for order in (["id"], ["-id"], ["g", "id"], ["-g", "-id"]):
        for offset in (0, 30, 50, 56, 80):
            near = G.page(df, order, 7, offset)[0].collect()
            assert G.page(df, order, 7, offset, shallow_rows=0)[0].collect() == near
    found, total = G.page(df, ["id"], 5, 5, columns=["g"], g=1)
    assert found.columns == ["g"] and one(total)["total"] == 19 and found.count() == 5


def test_keyset_and_deep_pages(spark):
    df = spark.range(0, 50000, 7).withColumn("v", F.col("id") * 2)
    ids = sorted(r.id for r in df.collect())
    assert [r.id for r in G.page_after(df, "id", 70, 3).collect()] == [77, 84, 91]
    assert [r.id for r in G.page_after(df, "id", 70, 2, descending=True).collect()] == [63, 56]
    for offset in (0, 100, 3000, 7140, 9000):
        assert [r.id for r in G.deep_page(df, "id", 10, offset, shallow_rows=50).collect()] == ids[offset : offset + 10]
        down = ids[::-1][offset : offset + 10]
        assert [r.id for r in G.deep_page(df, "id", 10, offset, True, 50).collect()] == down
    assert G.deep_page(df.where("id < 0"), "id", 5, 5).count() == 0


def test_top_recent(rows):
    df = rows([(1, 10, 5.0), (2, 30, 1.0), (3, 20, 9.0)], "id int, ts int, fare double")
    assert [r.id for r in G.top_recent(df, "ts", "id", 2, fare__gte=2).collect()] == [3, 1]
    plan = G.top_recent(df, "ts", "id", 2)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_reconcile_reports_slices_of_either_side(rows):
    left = rows([("a", 1.0), ("a", 2.0), ("b", 1.0)], "s string, v double")
    right = rows([("a", 3.0), ("c", 1.0), (None, 1.0)], "s string, v double")
    cents = unscaled("v", 2)
    out = {r.slice: r for r in reconcile(left, right, F.col("s"), F.col("s"), {"cents": (cents, cents)}).collect()}
    assert set(out) == {"a", "b", "c", None} and not any(r.matches for r in out.values())
    assert (out["a"].rows_gap, out["a"].cents_gap, out["b"].rows_gap, out["c"].rows_gap) == (-1, 0, -1, 1)
    assert one(reconcile(left, left, F.col("s"), F.col("s")).agg(F.min("matches").alias("ok")))["ok"]
