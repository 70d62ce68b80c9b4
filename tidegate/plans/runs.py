"""Run log, watermarks, and the queries and alerts over them.

Both tables are changed by pure functions and are small next to the data they
describe, but nothing here relies on that.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.functions.scalars import elapsed, micros_between, mean_of_units, unscaled
from tidegate.operators.aggregates import run_trend
from tidegate.operators.mutate import upsert
from tidegate.operators.paging import top_recent
from tidegate.operators.shape import align, concat
from tidegate.operators.windows import latest_per_key, trailing_mean, with_delta
from tidegate.schemas import RUN_COLUMNS, RUN_KEY, WATERMARK_COLUMNS

__all__ = ["run_trend"]

TASK = ["dag_id", "task_id"]


# --- run log --------------------------------------------------------------


def mark_running(log: DataFrame, starts: DataFrame, now: Column) -> DataFrame:
    """Open runs: a known run keeps its first start and loses its end, duration and error.

    ``starts`` holds the run key columns.
    """
    starts = starts.select(*RUN_KEY).dropDuplicates()
    first = log.select(*RUN_KEY, F.col("started_at").alias("_first"), F.col("created_at").alias("_made"), F.col("rows_ingested").alias("_rows"))
    opened = starts.join(first, RUN_KEY, "left").select(
        *RUN_KEY,
        F.lit("running").alias("status"),
        F.coalesce("_first", now).alias("started_at"),
        F.lit(None).cast("timestamp").alias("ended_at"),
        F.lit(None).cast("decimal(12,3)").alias("duration_seconds"),
        F.col("_rows").alias("rows_ingested"),
        F.lit(None).cast("string").alias("error_message"),
        F.coalesce("_made", now).alias("created_at"),
        now.alias("updated_at"),
    )
    return upsert(log, align(opened, RUN_COLUMNS), RUN_KEY)


def mark_finished(log: DataFrame, ends: DataFrame) -> DataFrame:
    """Close runs. ``ends``: run key, ``status``, ``ended_at``, ``error_message``, ``rows_ingested``.

    Keys the log does not hold are ignored.
    """
    names = ["status", "ended_at", "error_message", "rows_ingested"]
    change = ends.select(*RUN_KEY, *[F.col(c).alias(f"_{c}") for c in names], F.lit(True).alias("_hit"))
    joined = log.join(change, RUN_KEY, "left")
    duration = (micros_between("started_at", "_ended_at").cast("decimal(20,0)") / 1000000).cast("decimal(12,3)")
    new = {
        "status": F.col("_status"),
        "ended_at": F.col("_ended_at"),
        "duration_seconds": duration,
        "rows_ingested": F.coalesce("_rows_ingested", "rows_ingested"),
        "error_message": F.col("_error_message"),
        "updated_at": F.col("_ended_at"),
    }
    return joined.select(
        *[F.when(F.col("_hit"), new[c]).otherwise(F.col(c)).alias(c) if c in new else F.col(c) for c in log.columns]
    )


# --- watermarks -----------------------------------------------------------


def micros(at: int | None) -> Column | None:
    """A moment in microseconds since the epoch as a constant; it means the same in every time zone."""
    return None if at is None else F.timestamp_micros(F.lit(at))


def get_watermark(marks: DataFrame, dataset: str) -> datetime | None:
    """The stored mark to show, or None. Loads use :func:`mark_of`, as a datetime here is in the driver's zone."""
    row = marks.where(F.col("dataset_name") == dataset).select("watermark_value").first()
    return row.watermark_value if row else None


def mark_of(marks: DataFrame, dataset: str) -> Column | None:
    """The stored mark as a constant column, or None. Reads one row; the driver's time zone plays no part."""
    row = marks.where(F.col("dataset_name") == dataset).select(F.unix_micros("watermark_value").alias("at")).first()
    return micros(row.at) if row else None


def update_watermark(
    marks: DataFrame,
    dataset: str,
    value: Column | datetime,
    rows_loaded: int,
    run_id: str,
    now: Column,
    monotonic: bool = False,
    source: tuple[str, str, str] = ("", "", ""),
) -> DataFrame:
    """Store a load's mark, adding the dataset when it is new.

    ``monotonic`` keeps the larger of the old and the new mark. A naive datetime is read in the session's time zone.
    """
    spark = marks.sparkSession
    schema, table, column = source
    one = spark.createDataFrame([(dataset,)], "dataset_name string")
    old = marks.select(
        "dataset_name",
        *[F.col(c).alias(f"_{c}") for c in ("source_schema", "source_table", "watermark_column", "watermark_value", "created_at")],
    )
    mark = (F.lit(str(value)) if isinstance(value, datetime) else value).cast("timestamp")
    row = one.join(old, "dataset_name", "left").select(
        "dataset_name",
        F.coalesce("_source_schema", F.lit(schema)).alias("source_schema"),
        F.coalesce("_source_table", F.lit(table)).alias("source_table"),
        F.coalesce("_watermark_column", F.lit(column)).alias("watermark_column"),
        (F.greatest("_watermark_value", mark) if monotonic else mark).alias("watermark_value"),
        F.lit(run_id).alias("last_successful_run"),
        F.lit(rows_loaded).cast("bigint").alias("last_rows_loaded"),
        F.coalesce("_created_at", now).alias("created_at"),
        now.alias("updated_at"),
    )
    return upsert(marks, align(row, WATERMARK_COLUMNS), ["dataset_name"])


# --- questions ------------------------------------------------------------


def latest_runs(runs: DataFrame) -> DataFrame:
    """Most recent run of each task."""
    return latest_per_key(runs, TASK, ["started_at", "run_id"])


def hours_since_success(runs: DataFrame, now: Column) -> DataFrame:
    """Tasks whose latest run succeeded, with the hours since it ended."""
    healthy = latest_runs(runs).where("status = 'success'")
    return healthy.select(
        *TASK, "status", "ended_at", "rows_ingested", elapsed("ended_at", now, "hour").alias("hours_since_completion")
    )


def mark_age(marks: DataFrame, now: Column) -> DataFrame:
    return marks.select(
        "dataset_name",
        "watermark_value",
        "last_rows_loaded",
        "updated_at",
        elapsed("updated_at", now, "hour").alias("hours_since_update"),
    )


def recent_failures(runs: DataFrame, n: int = 20) -> DataFrame:
    columns = [*RUN_KEY, "status", "started_at", "ended_at", "duration_seconds", "error_message"]
    return top_recent(runs.where("status = 'failed'").select(*columns), "started_at", "run_id", n)


def ingest_deltas(runs: DataFrame, n: int | None = 30) -> DataFrame:
    """Row counts of successful ingest runs against the run before; ``n`` rows of report, None for all."""
    ingest = runs.where("status = 'success'").where(F.col("task_id").like("ingest_%"))
    deltas = with_delta(
        ingest.select("task_id", "started_at", "run_id", "rows_ingested"),
        ["task_id"],
        ["started_at", "run_id"],
        "rows_ingested",
        "previous_rows_ingested",
        "row_delta",
    )
    if n is None:
        return deltas
    return deltas.orderBy("task_id", F.col("started_at").desc(), "run_id").limit(n)


# --- alerts ---------------------------------------------------------------


def alerts(
    runs: DataFrame,
    marks: DataFrame,
    now: Column,
    schedule_hours: float = 24,
    stale_factor: float = 1.5,
    lag_hours: float = 24,
    slow_factor: float = 2,
    drop_pct: float = 20,
) -> DataFrame:
    """Rows ``(rule, subject, observed, threshold)`` for everything that needs attention."""
    failed = runs.where("status = 'failed'").select(
        F.lit("failed run").alias("rule"),
        F.concat_ws("/", *RUN_KEY).alias("subject"),
        F.lit(1.0).alias("observed"),
        F.lit(0.0).alias("threshold"),
    )
    success = runs.groupBy(*TASK).agg(F.max(F.when(F.col("status") == "success", F.col("ended_at"))).alias("last"))
    stale = _over(
        success, "no recent success", F.concat_ws("/", *TASK), elapsed("last", now, "hour"), stale_factor * schedule_hours, True
    )
    lag = _over(marks, "stale data", F.col("dataset_name"), elapsed("updated_at", now, "hour"), lag_hours)
    return concat([failed, stale, lag, slow_days(runs, slow_factor), row_drops(runs, drop_pct)])


def _over(df: DataFrame, rule: str, subject: Column, observed: Column, threshold: float, never: bool = False) -> DataFrame:
    """Subjects above the threshold; with ``never`` also those without a value."""
    rows = df.select(
        F.lit(rule).alias("rule"),
        subject.alias("subject"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
    )
    over = F.col("observed") > threshold
    return rows.where((over | F.col("observed").isNull()) if never else over)


def slow_days(runs: DataFrame, factor: float = 2) -> DataFrame:
    """Days whose mean duration is above ``factor`` times the mean of the seven days before."""
    ended = runs.where(F.col("duration_seconds").isNotNull())
    daily = trailing_mean(ended, TASK, "started_at", unscaled("duration_seconds", 3))
    mean = mean_of_units(F.col("total"), F.col("n"), 3, 3).cast("double")
    usual = mean_of_units(F.col("trailing_total"), F.col("trailing_n"), 3, 3).cast("double")
    return daily.where(mean > usual * factor).select(
        F.lit("slow run").alias("rule"),
        F.concat_ws("/", *TASK, F.date_format("day", "yyyy-MM-dd")).alias("subject"),
        mean.alias("observed"),
        (usual * factor).alias("threshold"),
    )


def row_drops(runs: DataFrame, pct: float = 20) -> DataFrame:
    """Ingest runs that loaded over ``pct`` percent fewer rows than the run before."""
    fewer = ingest_deltas(runs, None).where(F.col("row_delta") * 100 < -pct * F.col("previous_rows_ingested"))
    return fewer.select(
        F.lit("row drop").alias("rule"),
        F.concat_ws("/", "task_id", "run_id").alias("subject"),
        (F.lit(-100.0) * F.col("row_delta") / F.col("previous_rows_ingested")).alias("observed"),
        F.lit(float(pct)).alias("threshold"),
    )
