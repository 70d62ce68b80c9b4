"""Dimensions from change logs, rollups kept up to date, reconciliation down to rows, and overlapping versions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.bindings import Tables, query
from tidegate.operators.changelog import apply_changes, log_of, to_log, versions_from
from tidegate.operators.history import scd2_start
from tidegate.operators.intervals import valid_versions
from tidegate.operators.paging import page
from tidegate.operators.quality import Check, record_results, run_suite
from tidegate.operators.reconcile import differing_rows
from tidegate.operators.rollups import Rollup
from tidegate.operators.shape import union_all
from tidegate.plans import maintained
from tidegate.plans.drift import check_trend, drift, profile
from tidegate.session import staging_path
from tidegate.sources import sinks
from tidegate.sources.compaction import compact

CHANGES_SQL = """
log AS (
  SELECT c_custkey, TIMESTAMP '1970-01-01' AS since, c_mktsegment AS segment, false AS gone, -1 AS seq FROM customer
  UNION ALL SELECT o_custkey, o_orderdate, o_orderpriority, o_orderstatus = 'P', o_orderkey FROM orders),
one AS (SELECT *, CASE WHEN gone THEN '' ELSE segment END AS state FROM log QUALIFY row_number() OVER (PARTITION BY c_custkey, since ORDER BY seq DESC) = 1),
moved AS (SELECT * FROM one QUALIFY state <> coalesce(lag(state) OVER (PARTITION BY c_custkey ORDER BY since), '')),
chained AS (SELECT *, lead(since) OVER (PARTITION BY c_custkey ORDER BY since) AS valid_to FROM moved)"""
CHANGED_SQL = "SELECT c_custkey, segment, since AS valid_from, valid_to, valid_to IS NULL AS is_current FROM chained WHERE NOT gone"


def segments(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Customers as a first load, and every order as a change of its customer's segment; pending orders end it."""
    first = scd2_start(t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment")), "c_custkey", ["segment"], F.lit("1970-01-01"))
    orders = t.orders.withColumnsRenamed({"o_custkey": "c_custkey", "o_orderpriority": "segment"})
    return first, to_log(orders, "c_custkey", ["segment"], F.col("o_orderdate"), F.col("o_orderkey"), F.col("o_orderstatus") == "P")


@query(f"WITH {CHANGES_SQL} {CHANGED_SQL}")
def scd2_changes_any_order(t: Tables) -> DataFrame:
    """Three loads, each with several changes per key, all but the first with late ones; one load comes twice."""
    dim, changes = segments(t)
    log = log_of(dim, "c_custkey", ["segment"])
    for load in (2, 0, 2, 1):
        part = changes.where(F.pmod("seq", F.lit(3)) == load)
        done = apply_changes(dim, log, part, "c_custkey", ["segment"], F.lit("2024-01-01").cast("timestamp"))
        dim, log = sinks.land(done.dim, "dim")[0], union_all(log, done.added)
    return dim.select("c_custkey", "segment", "valid_from", "valid_to", "is_current")


@query(f"WITH {CHANGES_SQL} SELECT c_custkey, segment, since AS valid_from, valid_to FROM chained WHERE NOT gone")
def scd2_from_log(t: Tables) -> DataFrame:
    """All versions as one fold of the log."""
    dim, changes = segments(t)
    log = union_all(log_of(dim, "c_custkey", ["segment"]), changes)
    return versions_from(log, "c_custkey", ["segment"]).select("c_custkey", "segment", "valid_from", "valid_to")


# --- rollups kept up to date ------------------------------------------------

READINGS = Rollup(
    "ts", "hour", ["event_type"], {"avg_value": ("value", 2)}, {"ids": "event_id"}, {"users": "user_id"}, {"median_value": ("value", 2)}, count="readings"
)
LATE_SQL = """
late AS (
  SELECT event_id, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN value + 1 ELSE value END AS value, ts, user_id, event_type FROM events
  UNION ALL SELECT event_id + 1000000000, value, ts - INTERVAL 3 DAY, user_id, event_type FROM events WHERE event_id % 50 = 0)"""


def late_events(t: Tables) -> tuple[DataFrame, str]:
    """A table by day with its rollup; then corrections of the later days and rows for earlier ones, new days among them."""
    root = staging_path(t.spark, "readings")
    source, states = f"{root}/events", f"{root}/states"
    events = t.events.select("event_id", "value", "ts", "user_id", "event_type").withColumn("day", F.to_date("ts"))
    sinks.append(events, source, ["day"])
    maintained.build(t.spark, source, states, READINGS, "day")
    fixes = events.where("ts >= TIMESTAMP '2024-01-20'").withColumn("value", F.col("value") + 1)
    old = events.where("event_id % 50 = 0").withColumns({"event_id": F.col("event_id") + 1_000_000_000, "ts": F.expr("ts - INTERVAL 3 DAYS")})
    late = union_all(fixes, old.withColumn("day", F.to_date("ts")))
    maintained.merge_and_refresh(late, source, states, ["event_id"], READINGS, "day", slices_move=False)
    return t.spark.read.parquet(source), states


@query(f"""WITH {LATE_SQL}
SELECT date_trunc('day', ts) AS day, event_type, count(*) AS readings,
       CAST((2 * sum(CAST(round(value * 100) AS BIGINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_value, CAST(sum(event_id) AS BIGINT) AS ids
FROM late GROUP BY 1, 2""")
def maintained_rollup(t: Tables) -> DataFrame:
    """Daily rollup read from hourly states after late rows."""
    _, states = late_events(t)
    return READINGS.read(t.spark.read.parquet(states), "day").select("day", "event_type", "readings", "avg_value", "ids")


@query(f"""WITH {LATE_SQL}
SELECT event_type, count(*) AS readings, count(DISTINCT user_id) AS exact_users, true AS users_near, true AS median_near FROM late GROUP BY 1""")
def maintained_sketches(t: Tables) -> DataFrame:
    """Sketches merged over all hours: distinct users within 4 %, the median's rank within 2 hundredths of the middle."""
    table, states = late_events(t)
    read = READINGS.read(t.spark.read.parquet(states).withColumn("bucket", F.lit("2024-01-01").cast("timestamp")), "day").drop("day")
    medians = read.select("event_type", F.col("median_value").alias("m"))
    exact = (
        table.join(F.broadcast(medians), "event_type")
        .groupBy("event_type")
        .agg(F.count_distinct("user_id").alias("exact_users"), F.avg((F.col("value") < F.col("m")).cast("int")).alias("below"), F.avg((F.col("value") <= F.col("m")).cast("int")).alias("upto"))
    )
    near = F.abs(F.col("users") - F.col("exact_users")) <= F.greatest(F.lit(1.0), 0.04 * F.col("exact_users"))
    middle = (F.col("below") <= 0.52) & (F.col("upto") >= 0.48)
    return read.join(exact, "event_type").select("event_type", "readings", "exact_users", near.alias("users_near"), middle.alias("median_near"))


# --- reconciliation down to rows ---------------------------------------------


@query("""
WITH landed AS (
  SELECT o_orderkey AS k, CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS p,
         CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderpriority END AS q, 1 AS n FROM orders WHERE o_orderkey % 97 <> 0
  UNION ALL SELECT -1 - o_orderkey, o_totalprice, o_orderpriority, 1 FROM orders WHERE o_orderkey % 107 = 0)
SELECT coalesce(k, o_orderkey) AS o_orderkey, CASE WHEN k IS NULL THEN 'missing' WHEN o_orderkey IS NULL THEN 'extra' ELSE 'changed' END AS status,
       (o_orderkey IS NOT NULL)::BIGINT AS source_rows, (k IS NOT NULL)::BIGINT AS landed_rows,
       CASE WHEN k IS NOT NULL AND o_orderkey IS NOT NULL THEN
         concat_ws(',', CASE WHEN p <> o_totalprice THEN 'o_totalprice' END, CASE WHEN q IS DISTINCT FROM o_orderpriority THEN 'o_orderpriority' END) END AS differing
FROM orders FULL JOIN landed ON k = o_orderkey
WHERE k IS NULL OR o_orderkey IS NULL OR p <> o_totalprice OR q IS DISTINCT FROM o_orderpriority""")
def reconcile_rows(t: Tables) -> DataFrame:
    """Orders against a copy with rows missing, changed and added."""
    kept = t.orders.where("o_orderkey % 97 <> 0").withColumns({
        "o_totalprice": F.expr("CASE WHEN o_orderkey % 101 = 0 THEN o_totalprice + 1 ELSE o_totalprice END"),
        "o_orderpriority": F.expr("CASE WHEN o_orderkey % 103 = 0 THEN NULL ELSE o_orderpriority END"),
    })
    extra = t.orders.where("o_orderkey % 107 = 0").withColumn("o_orderkey", -1 - F.col("o_orderkey"))
    found = differing_rows(t.orders, union_all(kept, extra), ["o_orderkey"], F.date_trunc("month", "o_orderdate"))
    return found.withColumn("differing", F.array_join("differing", ","))


# --- overlapping versions ------------------------------------------------------


@query("""
WITH offers AS (
  SELECT o_custkey AS k, o_orderkey AS offer, o_orderdate AS a, CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate + to_days(CAST(o_orderkey % 400 AS INTEGER)) END AS b FROM orders)
SELECT o_orderkey, offer FROM orders JOIN offers ON o_custkey = k AND a <= o_orderdate AND (b IS NULL OR b > o_orderdate)""")
def overlapping_versions(t: Tables) -> DataFrame:
    """Every order opens an offer to its customer, of 0 to 399 days or without an end; all offers valid at each order."""
    lasts = F.when(F.col("o_orderkey") % 7 > 0, F.expr("o_orderdate + make_interval(0, 0, 0, CAST(o_orderkey % 400 AS INT))"))
    offers = t.orders.select("o_custkey", F.col("o_orderkey").alias("offer"), F.col("o_orderdate").alias("valid_from"), lasts.alias("valid_to"))
    return valid_versions(t.orders, offers, ("o_custkey", "o_custkey"), "o_orderdate", ["offer"]).select("o_orderkey", "offer")


# --- history of results ----------------------------------------------------------

RUN_SQL = """
v AS (SELECT 'run ' || (event_id % 3) AS run_id, event_id % 3 AS r, CASE WHEN event_id % 3 = 2 THEN value * 1.5 ELSE value END AS value FROM events)"""


def runs_of_events(t: Tables):
    """Three runs, each over a third of the events; the last one with values half as high again."""
    for r in range(3):
        part = t.events.where(f"event_id % 3 = {r}")
        yield f"run {r}", part.withColumn("value", F.col("value") * (1.5 if r == 2 else 1.0)), F.lit(f"2024-03-0{r + 1}").cast("timestamp")


@query(f"""WITH {RUN_SQL},
h AS (SELECT r, run_id, least(greatest(CAST(floor(value / 20) AS BIGINT), 0), 9) AS bin, count(*) AS n FROM v GROUP BY ALL),
grid AS (SELECT DISTINCT r, run_id, b AS bin FROM v, range(10) AS g(b)),
p AS (SELECT g.r, g.run_id, g.bin, (coalesce(n, 0) + 0.5::DOUBLE) / (sum(coalesce(n, 0)) OVER (PARTITION BY g.r) + 5) AS p FROM grid g LEFT JOIN h USING (r, bin))
SELECT a.run_id, b.run_id AS against, round(sum((a.p - b.p) * ln(a.p / b.p)), 6) AS psi
FROM p a LEFT JOIN p b ON b.r = a.r - 1 AND b.bin = a.bin GROUP BY 1, 2""")
def value_drift(t: Tables) -> DataFrame:
    path = f"{staging_path(t.spark, 'history')}/profiles"
    for run_id, part, now in runs_of_events(t):
        sinks.append(profile(part, "value", 0, 200, 10, run_id, now), path)
    return drift(t.spark.read.parquet(path)).select("run_id", "against", "psi")


@query(f"""WITH {RUN_SQL},
checks AS (SELECT r, run_id, count(*) FILTER (value > 150) AS observed FROM v GROUP BY ALL)
SELECT run_id, observed::DOUBLE AS observed, lag(observed) OVER (ORDER BY r)::DOUBLE AS observed_before,
       (observed - lag(observed) OVER (ORDER BY r))::DOUBLE AS change,
       CASE WHEN observed = 0 THEN 0 ELSE r + 1 - coalesce((SELECT max(c.r) + 1 FROM checks c WHERE c.r < checks.r AND c.observed = 0), 0) END AS failures_in_a_row
FROM checks""")
def result_trend(t: Tables) -> DataFrame:
    path = f"{staging_path(t.spark, 'history')}/results"
    for run_id, part, now in runs_of_events(t):
        sinks.append(record_results(run_suite(part, "events", [Check("between", "value", lo=None, hi=150)]), run_id, now), path)
    columns = ["run_id", *[F.col(c).cast("double").alias(c) for c in ("observed", "observed_before", "change")], "failures_in_a_row"]
    return check_trend(t.spark.read.parquet(path)).select(*columns)


# --- deep pages and compaction ------------------------------------------------------


@query("""
SELECT o_orderkey, o_orderpriority, o_orderdate, row_number() OVER (ORDER BY o_orderpriority DESC, o_orderdate, o_totalprice DESC, o_orderkey DESC) AS place
FROM orders QUALIFY place BETWEEN 1001 AND 1040""")
def page_in_mixed_directions(t: Tables) -> DataFrame:
    """A page in four keys of either direction, by numbers in slices as at any depth."""
    order = ["-o_orderpriority", "o_orderdate", "-o_totalprice", "-o_orderkey"]
    found, _ = page(t.orders, order, 40, 1000, shallow_rows=0)
    rows = [(r.o_orderkey, r.o_orderpriority, r.o_orderdate, 1001 + i) for i, r in enumerate(found.collect())]  # one page
    return t.spark.createDataFrame(rows, "o_orderkey long, o_orderpriority string, o_orderdate timestamp_ntz, place long")


@query("SELECT event_id, ts, user_id, value FROM events")
def compacted_events(t: Tables) -> DataFrame:
    """Six loads leave small files in every day; then two files' worth a day, clustered by user and value."""
    path = staging_path(t.spark, "crowded")
    rows = t.events.select("event_id", "ts", "user_id", "value").withColumn("day", F.to_date("ts"))
    for load in range(6):
        sinks.append(rows.where(F.col("event_id") % 6 == load), path, ["day"])
    compact(t.spark, path, "day", ["user_id", "value"])
    return t.spark.read.parquet(path).drop("day")
