"""Events as streams. Each stream reads text files written from the table and runs until they are used up."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.bindings import Tables, query
from tidegate.functions.scalars import unscaled
from tidegate.operators.shape import union_all
from tidegate.operators.validate import validate_events
from tidegate.session import staging_path
from tidegate.streaming.events import event_to_row, parse_events, to_events
from tidegate.streaming.ingest import Paths, dedup_stream, ingest_stream, total_counters
from tidegate.streaming.monitor import null_spikes
from tidegate.streaming.replay import number_for_replay, read_replay, replay_at_rate
from tidegate.streaming.running import run_until
from tidegate.streaming.versions import as_of_stream
from tidegate.streaming.stats import sliding_stats, stream_quality
from tidegate.sources.topics import keyed_messages

PAYLOAD = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "kind": "string", "value": "decimal(12,2)"}
FIELDS = ["event_type", "event_time", *PAYLOAD]
RULES = {"required": ["event_type", "event_time", "ts"], "positive": ["value"], "count": ("user_id", 1, 10**9), "timestamps": ["ts"]}


def check(raw: DataFrame) -> DataFrame:
    return validate_events(parse_events(raw, FIELDS), **RULES)


def to_row(valid: DataFrame) -> DataFrame:
    return event_to_row(valid, PAYLOAD, PAYLOAD)


def messages(t: Tables) -> DataFrame:
    """Every event as JSON, twice, and as often again as a cut-off line; user 0 breaks a rule."""
    rows = t.events.withColumnRenamed("event_type", "kind")
    good = to_events(rows, F.lit("2024-02-01").cast("timestamp"), PAYLOAD)
    again = to_events(rows, F.lit("2024-02-02").cast("timestamp"), PAYLOAD)
    lines = keyed_messages(union_all(good, again), None).select("value")
    return union_all(lines, keyed_messages(good, None).select(F.expr("substring(value, 1, length(value) - 1)").alias("value")))


def ingested(t: Tables) -> tuple[DataFrame, Paths]:
    root = staging_path(t.spark, "stream")
    messages(t).write.text(f"{root}/source")
    paths = Paths.under(root)
    options = {"check": check, "to_row": to_row, "slice_ts": "ts", "slice_column": "day"}
    ingest_stream(read_replay(t.spark, f"{root}/source"), paths, **options).awaitTermination()
    return t.spark.read.parquet(paths.table), paths


@query("SELECT event_id, ts, user_id, event_type AS kind, value FROM events WHERE user_id >= 1 AND value > 0")
def stream_ingest(t: Tables) -> DataFrame:
    return ingested(t)[0].drop("source_row_hash", "day")


@query("""
SELECT 3 * count(*) AS processed, count(*) FILTER (user_id >= 1 AND value > 0) AS inserted,
       count(*) FILTER (user_id >= 1 AND value > 0) AS duplicates,
       count(*) + 2 * count(*) FILTER (user_id < 1 OR value <= 0) AS invalid FROM events""")
def stream_counters(t: Tables) -> DataFrame:
    paths = ingested(t)[1]
    return total_counters(t.spark.read.parquet(paths.counters))


@query("""
SELECT 'malformed JSON' AS reason, count(*) AS n FROM events
UNION ALL SELECT 'Field ''value'' must be > 0, got ''0.0''', 2 * count(*) FROM events WHERE value <= 0 HAVING count(*) > 0
UNION ALL SELECT 'user_id must be between 1 and 1000000000, got ''0''', 2 * count(*) FROM events
  WHERE user_id < 1 AND value > 0 HAVING count(*) > 0""")
def stream_rejected(t: Tables) -> DataFrame:
    paths = ingested(t)[1]
    return t.spark.read.parquet(paths.rejected).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, user_id, value FROM events WHERE user_id >= 1 AND value > 0")
def stream_dedup(t: Tables) -> DataFrame:
    """Deduplication in state; the sink is a parquet table."""
    root = staging_path(t.spark, "dedup")
    messages(t).write.text(f"{root}/source")
    rows = to_row(check(read_replay(t.spark, f"{root}/source")).where("error IS NULL"))
    stamped = rows.withColumn("seen", F.col("ts").cast("timestamp"))
    (
        dedup_stream(stamped, "seen", "60 days")
        .writeStream.format("parquet")
        .option("path", f"{root}/table")
        .option("checkpointLocation", f"{root}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return t.spark.read.parquet(f"{root}/table").select("event_id", "user_id", F.col("value").cast("double").alias("value"))


SLIDING_SQL = """
WITH w AS (
  SELECT date_trunc('hour', ts) + to_minutes(30 * CAST(date_part('minute', ts) >= 30 AS INTEGER)) AS a, CAST(round(value * 100) AS BIGINT) AS c FROM events),
b AS (SELECT a AS window_start, c FROM w UNION ALL SELECT a - INTERVAL 30 MINUTE, c FROM w)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, count(*) AS trips,
       CAST((2 * sum(c) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_fare FROM b GROUP BY 1"""


@query(SLIDING_SQL)
def sliding_windows(t: Tables) -> DataFrame:
    return sliding_stats(t.events, "ts", unscaled("value", 2), "1 hour", "30 minutes")


@query(SLIDING_SQL)
def stream_sliding_windows(t: Tables) -> DataFrame:
    """The same over a stream in update mode; the last update of a window is its result."""
    root = staging_path(t.spark, "sliding")
    t.events.select("ts", "value").write.parquet(f"{root}/source")
    stream = t.spark.readStream.schema(t.events.select("ts", "value").schema).parquet(f"{root}/source")
    stats = sliding_stats(stream.withColumn("at", F.col("ts").cast("timestamp")), "at", unscaled("value", 2), "1 hour", "30 minutes", "40 days")

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/table/batch_id={batch_id}")

    query_ = stats.writeStream.outputMode("update").option("checkpointLocation", f"{root}/checkpoint").foreachBatch(save)
    query_.trigger(availableNow=True).start().awaitTermination()
    updates = t.spark.read.parquet(f"{root}/table")
    last = updates.groupBy("window_start", "window_end").agg(
        F.max_by("trips", "batch_id").alias("trips"), F.max_by("avg_fare", "batch_id").alias("avg_fare")
    )
    return last


@query("""
SELECT date_trunc('day', ts) AS window_start, count(*) AS events, count(*) FILTER (event_type = 'error') AS invalid,
       100.0::DOUBLE * count(*) FILTER (event_type = 'error') / count(*) AS invalid_pct,
       count(*) FILTER (user_id = 0) AS null_user_id,
       CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01') AS DOUBLE) / 1000000 AS lag_seconds
FROM events GROUP BY 1""")
def stream_quality_windows(t: Tables) -> DataFrame:
    checked = t.events.select(
        "ts", F.nullif("user_id", F.lit(0)).alias("user_id"), F.when(F.col("event_type") == "error", "bad").alias("error")
    )
    return stream_quality(checked, "ts", F.lit("2024-02-01").cast("timestamp"), "1 day", ["user_id"])


@query("""
SELECT CASE WHEN user_id <> 0 THEN CAST(user_id AS VARCHAR) END AS key,
       '{"event_type":"trip_completed","event_time":"2024-02-01T00:00:00.000000","event_id":' || event_id || ',"user_id":' || user_id || '}' AS value
FROM events""")
def event_messages(t: Tables) -> DataFrame:
    envelope = to_events(t.events, F.lit("2024-02-01").cast("timestamp"), {"event_id": "bigint", "user_id": "bigint"})
    return keyed_messages(envelope, "user_id")


# --- streams that run on --------------------------------------------------------

SPIKES_SQL = """
WITH h AS (
  SELECT date_trunc('hour', ts) AS window_start, count(*) AS events, count(*) FILTER (event_type = 'error') AS invalid,
         count(*) FILTER (user_id % 5 = 0 OR ts >= TIMESTAMP '2024-01-15') AS null_user_id FROM events GROUP BY 1),
b AS (SELECT *, coalesce(sum(events) OVER w, 0)::BIGINT AS before_events, coalesce(sum(invalid) OVER w, 0)::BIGINT AS before_invalid,
             coalesce(sum(null_user_id) OVER w, 0)::BIGINT AS before_null_user_id
      FROM h WINDOW w AS (ORDER BY window_start RANGE BETWEEN INTERVAL 23 HOUR PRECEDING AND INTERVAL 1 HOUR PRECEDING))
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, events, invalid, null_user_id, before_events, before_invalid, before_null_user_id,
       CASE WHEN before_events > 0 THEN null_user_id * before_events > before_null_user_id * 3 * events AND null_user_id >= 5 END AS spike_user_id FROM b"""


def watched_events(rows: DataFrame) -> DataFrame:
    """A fifth of the users is unknown, from the middle of the month on all are; event type ``error`` is invalid."""
    known = F.expr("CASE WHEN user_id % 5 <> 0 AND ts < TIMESTAMP '2024-01-15' THEN user_id END")
    return rows.select(F.col("ts").cast("timestamp").alias("at"), known.alias("user_id"), F.when(F.col("event_type") == "error", "bad").alias("error"))


def spikes(rows: DataFrame, delay: str | None = None) -> DataFrame:
    return null_spikes(watched_events(rows), "at", ["user_id"], "1 hour", "24 hours", delay=delay)


@query(SPIKES_SQL)
def null_spikes_batch(t: Tables) -> DataFrame:
    return spikes(t.events)


@query(SPIKES_SQL)
def stream_null_spikes(t: Tables) -> DataFrame:
    """The same as a stream, in append mode and in three runs of one checkpoint: half the time range, the rest, and events a year later that close all windows."""
    root = staging_path(t.spark, "spikes")
    rows = t.events.select("ts", "user_id", "event_type")
    later = rows.limit(1).withColumn("ts", F.expr("TIMESTAMP_NTZ '2025-01-01'"))
    parts = [rows.where("ts < TIMESTAMP '2024-01-16'"), rows.where("ts >= TIMESTAMP '2024-01-16'"), later]
    for part in parts:
        part.write.mode("append").parquet(f"{root}/source")
        stream = spikes(t.spark.readStream.schema(part.schema).parquet(f"{root}/source"), "2 hours")
        writer = stream.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
        writer.trigger(availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{root}/table").where("window_start < TIMESTAMP '2025-01-01'")


@query("""
WITH n AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) - 1 AS seq FROM events)
SELECT event_id, seq AS replay_seq FROM n""")
def stream_replay(t: Tables) -> DataFrame:
    """All events at a set rate, in two runs: the second goes on where the first was stopped."""
    root = staging_path(t.spark, "replay")
    total = number_for_replay(t.events.select("event_id", "ts"), ["ts", "event_id"], f"{root}/numbered")
    rate = max(1, -(-total // 6))

    def save(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{root}/table/batch_id={batch_id}")

    for limit in (2 * rate, total):
        query_ = replay_at_rate(t.spark, f"{root}/numbered", rate, f"{root}/checkpoint", save)
        run_until(query_, rows=limit)
    return t.spark.read.parquet(f"{root}/table").select("event_id", "replay_seq")


@query("SELECT count(*) AS processed, count(*) FILTER (user_id < 1 OR value <= 0) AS invalid FROM events")
def stream_live_counters(t: Tables) -> DataFrame:
    """Counters reported by the running query itself; it is stopped when nothing has come for a while."""
    root = staging_path(t.spark, "live")
    t.events.repartition(4).write.parquet(f"{root}/source")
    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/source")
    bad = F.count_if((F.col("user_id") < 1) | (F.col("value") <= 0))
    counted = stream.observe("seen", F.count(F.lit(1)).alias("processed"), bad.alias("invalid"))
    writer = counted.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint")
    progress = run_until(writer.start(), idle_seconds=3, metrics="seen")
    return t.spark.createDataFrame([(progress.counters.get("processed", 0), progress.counters.get("invalid", 0))], "processed long, invalid long")


@query("""
WITH v AS (SELECT user_id, ts AS a, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS b, max(event_id) AS signup_id
           FROM events WHERE event_type = 'signup' GROUP BY user_id, ts)
SELECT e.event_id, e.user_id, v.signup_id FROM events e LEFT JOIN v ON e.user_id = v.user_id AND v.a <= e.ts AND (v.b IS NULL OR v.b > e.ts)
WHERE e.event_type <> 'signup'""")
def stream_as_of(t: Tables) -> DataFrame:
    """Two streams: sign-ups open versions of their users, all other events are joined as of their time. Versions come after the events that need them."""
    root = staging_path(t.spark, "as_of")
    facts = t.events.where("event_type <> 'signup'").select("event_id", "user_id", F.col("ts").cast("timestamp").alias("ts"))
    starts = t.events.where("event_type = 'signup'").select("user_id", F.col("ts").cast("timestamp").alias("valid_from"), F.col("event_id").alias("signup_id"))
    end = F.lit("2025-01-01").cast("timestamp")
    facts.write.parquet(f"{root}/facts")

    def run() -> None:
        streams = [t.spark.readStream.schema(df.schema).parquet(f"{root}/{name}") for df, name in ((facts, "facts"), (starts, "starts"))]
        joined = as_of_stream(*streams, ("user_id", "user_id"), "ts", ["signup_id"], "60 days", buckets=1024)
        writer = joined.writeStream.format("parquet").option("path", f"{root}/table").option("checkpointLocation", f"{root}/checkpoint").outputMode("append")
        writer.trigger(availableNow=True).start().awaitTermination()

    starts.limit(0).write.parquet(f"{root}/starts")
    run()
    starts.write.mode("append").parquet(f"{root}/starts")
    run()
    # Rows of a year later move the watermark past all others.
    facts.limit(1).withColumns({"event_id": F.lit(-1).cast("bigint"), "ts": end}).write.mode("append").parquet(f"{root}/facts")
    run()
    return t.spark.read.parquet(f"{root}/table").where("event_id >= 0").select("event_id", "user_id", "signup_id")
