"""Run log, watermarks, and the questions and alerts over them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.bindings import Tables, query
from tidegate.bindings.shapes import NOW, RUNS_SQL, marks, now, runs
from tidegate.plans import runs as R
from tidegate.plans.loads import incremental_load

LATEST_SQL = "SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY task_id ORDER BY started_at DESC, run_id DESC) = 1"
MARKS_SQL = "marks AS (SELECT event_type AS dataset_name, max(ts) AS newest, count(*) AS n FROM events GROUP BY 1)"
HOURS = "CAST(date_diff('microsecond', {}, TIMESTAMP '" + NOW + "') AS DOUBLE) / 3600000000"


@query(f"WITH {RUNS_SQL} SELECT dag_id, task_id, run_id, status, started_at, ended_at, rows_ingested, error_message FROM ({LATEST_SQL})")
def latest_runs(t: Tables) -> DataFrame:
    return R.latest_runs(runs(t)).drop("duration_seconds", "created_at", "updated_at")


@query(f"""WITH {RUNS_SQL}
SELECT dag_id, task_id, status, ended_at, rows_ingested, {HOURS.format("ended_at")} AS hours_since_completion
FROM ({LATEST_SQL}) WHERE status = 'success'""")
def hours_since_success(t: Tables) -> DataFrame:
    return R.hours_since_success(runs(t), now())


@query(f"""WITH {RUNS_SQL}
SELECT dag_id, task_id, run_id, status, started_at, ended_at, CAST(duration_ms AS DOUBLE) / 1000 AS duration_seconds, error_message
FROM runs WHERE status = 'failed' ORDER BY started_at DESC, run_id LIMIT 20""")
def recent_failures(t: Tables) -> DataFrame:
    return R.recent_failures(runs(t))


@query(f"""WITH {RUNS_SQL}
SELECT task_id, started_at, run_id, rows_ingested, lag(rows_ingested) OVER w AS previous_rows_ingested,
       rows_ingested - lag(rows_ingested) OVER w AS row_delta
FROM runs WHERE status = 'success' AND task_id LIKE 'ingest_%' WINDOW w AS (PARTITION BY task_id ORDER BY started_at, run_id)""")
def ingest_deltas(t: Tables) -> DataFrame:
    return R.ingest_deltas(runs(t), None)


@query(f"""WITH {RUNS_SQL}
SELECT task_id, started_at, run_id, rows_ingested, lag(rows_ingested) OVER w AS previous_rows_ingested,
       rows_ingested - lag(rows_ingested) OVER w AS row_delta
FROM runs WHERE status = 'success' AND task_id LIKE 'ingest_%' WINDOW w AS (PARTITION BY task_id ORDER BY started_at, run_id)
ORDER BY task_id, started_at DESC, run_id LIMIT 30""")
def ingest_delta_report(t: Tables) -> DataFrame:
    return R.ingest_deltas(runs(t))


@query(f"""WITH {RUNS_SQL}
SELECT dag_id, task_id, run_id, 'running' AS status, started_at, CAST(NULL AS TIMESTAMP) AS ended_at,
       CAST(NULL AS DOUBLE) AS duration_seconds, rows_ingested, CAST(NULL AS VARCHAR) AS error_message FROM runs WHERE status = 'failed'
UNION ALL SELECT dag_id, task_id, run_id, status, started_at, ended_at, CAST(duration_ms AS DOUBLE) / 1000, rows_ingested, error_message
FROM runs WHERE status <> 'failed'
UNION ALL SELECT 'daily', 'start_' || event_type, '1', 'running', TIMESTAMP '{NOW}', NULL, NULL, NULL, NULL FROM events GROUP BY event_type""")
def run_log_start(t: Tables) -> DataFrame:
    """Failed runs are started again, and one new run per event type is opened."""
    log = runs(t)
    again = log.where("status = 'failed'").select("dag_id", "task_id", "run_id")
    new = t.events.selectExpr("'daily' AS dag_id", "concat('start_', event_type) AS task_id", "'1' AS run_id").distinct()
    return R.mark_running(log, again.unionByName(new), now()).drop("created_at", "updated_at")


@query(f"""WITH {MARKS_SQL}
SELECT dataset_name, newest AS watermark_value, n AS last_rows_loaded, newest AS updated_at,
       {HOURS.format("newest")} AS hours_since_update FROM marks""")
def mark_age(t: Tables) -> DataFrame:
    return R.mark_age(marks(t), now())


@query(f"""WITH {MARKS_SQL}
SELECT dataset_name, CASE dataset_name WHEN 'click' THEN TIMESTAMP '2024-01-05' ELSE newest END AS watermark_value,
       CASE dataset_name WHEN 'click' THEN 5 ELSE n END AS last_rows_loaded FROM marks
UNION ALL SELECT 'trips', TIMESTAMP '2024-01-05', 7""")
def watermark_update(t: Tables) -> DataFrame:
    moved = R.update_watermark(marks(t), "click", datetime(2024, 1, 5), 5, "run", now())
    added = R.update_watermark(moved, "trips", datetime(2024, 1, 5), 7, "run", now())
    return added.select("dataset_name", "watermark_value", "last_rows_loaded")


@query("""
SELECT event_id, ts, user_id, event_type, CASE WHEN ts > TIMESTAMP '2024-01-15' THEN value + 1 ELSE value END AS value, props FROM events""")
def incremental_load_rows(t: Tables) -> DataFrame:
    """All events arrive again with a new value; only those above the mark are taken."""
    half = R.update_watermark(marks(t), "events", datetime(2024, 1, 15), 0, "run 1", now())
    arrived = t.events.withColumn("value", F.col("value") + 1)
    return incremental_load(t.events, arrived, half, "events", "ts", ["event_id"], "run 2", now()).target


@query(f"""WITH {RUNS_SQL}, {MARKS_SQL},
last AS (SELECT dag_id, task_id, max(CASE WHEN status = 'success' THEN ended_at END) AS ok FROM runs GROUP BY 1, 2),
deltas AS (SELECT *, lag(rows_ingested) OVER (PARTITION BY task_id ORDER BY started_at, run_id) AS before FROM runs WHERE status = 'success'),
daily AS (SELECT dag_id, task_id, date_trunc('day', started_at) AS "day", count(*) AS n, CAST(sum(duration_ms) AS BIGINT) AS total
          FROM runs WHERE duration_ms IS NOT NULL GROUP BY 1, 2, 3),
prior AS (SELECT *, CAST(sum(n) OVER p AS BIGINT) AS tn, CAST(sum(total) OVER p AS BIGINT) AS tt FROM daily
  WINDOW p AS (PARTITION BY task_id ORDER BY "day" RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING)),
means AS (SELECT *, CAST((2 * total + n) // (2 * n) AS DOUBLE) / 1000 AS mean, CAST((2 * tt + tn) // (2 * tn) AS DOUBLE) / 1000 AS usual FROM prior)
SELECT 'failed run' AS rule, dag_id || '/' || task_id || '/' || run_id AS subject, 1.0::DOUBLE AS observed, 0.0::DOUBLE AS threshold
FROM runs WHERE status = 'failed'
UNION ALL SELECT 'no recent success', dag_id || '/' || task_id, {HOURS.format("ok")}, 36.0 FROM last WHERE ok IS NULL OR {HOURS.format("ok")} > 36
UNION ALL SELECT 'stale data', dataset_name, {HOURS.format("newest")}, 24.0 FROM marks WHERE {HOURS.format("newest")} > 24
UNION ALL SELECT 'slow run', dag_id || '/' || task_id || '/' || strftime("day", '%Y-%m-%d'), mean, usual * 2 FROM means WHERE mean > usual * 2
UNION ALL SELECT 'row drop', task_id || '/' || run_id, CAST(-100 * (rows_ingested - before) AS DOUBLE) / before, 20.0
FROM deltas WHERE (rows_ingested - before) * 100 < -20 * before""")
def alert_rows(t: Tables) -> DataFrame:
    return R.alerts(runs(t), marks(t), now())
