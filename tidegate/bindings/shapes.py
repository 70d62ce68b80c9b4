"""The given tables in the shape of trips, passengers, runs and versions.

Each shape exists twice, as a DataFrame and as the SQL of the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.bindings import Tables
from tidegate.functions.hashing import with_row_hash
from tidegate.operators.history import scd2_merge, scd2_start
from tidegate.operators.mutate import union_all
from tidegate.operators.shape import conform
from tidegate.schemas import PASSENGER_TABLE, RUN_COLUMNS, TRIP_COLUMNS, TRIP_TABLE

NOW = "2024-02-01 00:00:00"


def now():
    return F.lit(NOW).cast("timestamp")


# --- trips: line items with their orders ----------------------------------


def trips(t: Tables) -> DataFrame:
    """Line items as trips, without the row hash and load stamp."""
    items = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    lon = F.expr("(-744 + l_suppkey % 10) / 10")
    lat = F.expr("(404 + l_partkey % 10) / 10")
    columns = {
        "id": F.col("l_orderkey"),
        "vendor_id": F.col("l_linenumber"),
        "pickup_datetime": F.col("o_orderdate"),
        "dropoff_datetime": F.col("l_shipdate"),
        "passenger_count": F.col("l_linenumber"),
        "trip_distance": F.col("l_quantity"),
        "pickup_longitude": lon,
        "pickup_latitude": lat,
        "rate_code_id": F.expr("l_partkey % 8"),
        "store_and_fwd_flag": F.col("l_linestatus"),
        "dropoff_longitude": F.expr("(-744 + l_partkey % 10) / 10"),
        "dropoff_latitude": F.expr("(404 + l_suppkey % 10) / 10"),
        "payment_type": F.expr("l_suppkey % 8"),
        "fare_amount": F.col("l_extendedprice"),
        "extra": F.lit(0.5),
        "mta_tax": F.lit(None).cast("double"),
        "tip_amount": F.expr("round(l_tax * 100000) / 100"),
        "tolls_amount": F.expr("round(l_discount * 10000) / 100"),
        "total_amount": F.col("l_extendedprice"),
    }
    shaped = items.select(*[c.alias(name) for name, c in columns.items()])
    return conform(shaped, {"id": "bigint", **TRIP_COLUMNS})


def landed_trips(t: Tables) -> DataFrame:
    hashed = with_row_hash(trips(t), list(TRIP_COLUMNS)).withColumn("loaded_at", now())
    return hashed.select(*TRIP_TABLE)


TRIPS_SQL = """
trips AS (
  SELECT l_orderkey AS id, l_linenumber AS vendor_id, o_orderdate AS pickup_datetime, l_shipdate AS dropoff_datetime,
         l_linenumber AS passenger_count, CAST(round(l_quantity * 100) AS BIGINT) AS distance_c,
         CAST(-744 + l_suppkey % 10 AS DOUBLE) / 10 AS plon, CAST(404 + l_partkey % 10 AS DOUBLE) / 10 AS plat,
         CAST(-744 + l_partkey % 10 AS DOUBLE) / 10 AS dlon, CAST(404 + l_suppkey % 10 AS DOUBLE) / 10 AS dlat,
         l_partkey % 8 AS rate_code_id, l_suppkey % 8 AS payment_type,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS fare_c,
         CAST(round(l_tax * 100000) AS BIGINT) AS tip_c, CAST(round(l_discount * 10000) AS BIGINT) AS tolls_c
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
staged AS (
  SELECT * FROM trips WHERE fare_c > 0 AND distance_c > 0 AND passenger_count BETWEEN 1 AND 6
)"""


# --- passengers: customers ------------------------------------------------


def passengers(t: Tables) -> DataFrame:
    """Customers as passengers, with missing and out-of-range values by rule."""
    shaped = t.customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_custkey").alias("passenger_id"),
        F.expr("c_nationkey % 3").alias("survived"),
        F.expr("c_nationkey % 4").alias("pclass"),
        F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("name"),
        F.expr("CASE WHEN c_acctbal < 4000 THEN 'Male' ELSE 'FEMALE' END").alias("sex"),
        F.expr("CASE WHEN c_nationkey <> 7 THEN c_custkey % 80 + 0.5 END").alias("age"),
        F.expr("c_custkey % 4").alias("sib_sp"),
        F.expr("CASE WHEN c_nationkey <> 5 THEN c_custkey % 3 END").alias("parch"),
        F.expr("concat(' T', c_custkey, ' ')").alias("ticket"),
        F.col("c_acctbal").alias("fare"),
        F.expr("CASE c_custkey % 3 WHEN 0 THEN '  ' WHEN 1 THEN concat('C', c_nationkey) END").alias("cabin"),
        F.expr("CASE c_custkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'Q' WHEN 2 THEN 'S' ELSE 'X' END").alias("embarked"),
        F.lit("2024-02-01").alias("loaded_at"),
    )
    return conform(shaped, PASSENGER_TABLE)


PASSENGERS_SQL = """
passengers AS (
  SELECT c_custkey AS passenger_id, c_nationkey % 3 AS survived, c_nationkey % 4 AS pclass, c_name AS name,
         CASE WHEN c_acctbal < 4000 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN c_nationkey <> 7 THEN (c_custkey % 80) * 100 + 50 END AS age_c,
         c_custkey % 4 AS sib_sp, CASE WHEN c_nationkey <> 5 THEN c_custkey % 3 END AS parch,
         'T' || c_custkey AS ticket, CAST(round(c_acctbal * 100) AS BIGINT) AS fare_c,
         CASE WHEN c_custkey % 3 = 1 THEN 'C' || c_nationkey END AS cabin,
         CASE c_custkey % 4 WHEN 0 THEN 'C' WHEN 1 THEN 'Q' WHEN 2 THEN 'S' ELSE 'X' END AS embarked
  FROM customer
)"""


# --- runs and marks: events -----------------------------------------------


def runs(t: Tables) -> DataFrame:
    """Every event as a task run whose duration is its value in seconds."""
    shaped = t.events.select(
        F.lit("daily").alias("dag_id"),
        F.expr("concat('ingest_', user_id)").alias("task_id"),
        F.expr("lpad(event_id, 12, '0')").alias("run_id"),
        F.expr("CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END").alias("status"),
        F.col("ts").alias("started_at"),
        F.expr("CASE WHEN event_type <> 'view' THEN timestampadd(MILLISECOND, CAST(round(value * 1000) AS INT), ts) END").alias(
            "ended_at"
        ),
        F.expr("CASE WHEN event_type <> 'view' THEN round(value * 1000) / 1000 END").alias("duration_seconds"),
        F.expr("CAST(get_json_object(props, '$.k') AS BIGINT)").alias("rows_ingested"),
        F.expr("CASE WHEN event_type = 'error' THEN concat('code ', get_json_object(props, '$.k')) END").alias("error_message"),
        F.col("ts").alias("created_at"),
        F.col("ts").alias("updated_at"),
    )
    return conform(shaped, RUN_COLUMNS)


RUNS_SQL = """
runs AS (
  SELECT 'daily' AS dag_id, 'ingest_' || user_id AS task_id, lpad(CAST(event_id AS VARCHAR), 12, '0') AS run_id,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'view' THEN 'running' ELSE 'success' END AS status,
         ts AS started_at,
         CASE WHEN event_type <> 'view' THEN ts + to_milliseconds(CAST(round(value * 1000) AS BIGINT)) END AS ended_at,
         CASE WHEN event_type <> 'view' THEN CAST(round(value * 1000) AS BIGINT) END AS duration_ms,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS rows_ingested,
         CASE WHEN event_type = 'error' THEN 'code ' || json_extract_string(props, '$.k') END AS error_message
  FROM events
)"""


def marks(t: Tables) -> DataFrame:
    """One watermark per event type: newest event and number of events."""
    per_type = t.events.groupBy("event_type").agg(F.max("ts").alias("newest"), F.count(F.lit(1)).alias("n"))
    newest = F.col("newest").cast("timestamp")
    return per_type.select(
        F.col("event_type").alias("dataset_name"),
        F.lit("staging").alias("source_schema"),
        F.lit("events").alias("source_table"),
        F.lit("ts").alias("watermark_column"),
        newest.alias("watermark_value"),
        F.lit("run").alias("last_successful_run"),
        F.col("n").alias("last_rows_loaded"),
        newest.alias("created_at"),
        newest.alias("updated_at"),
    )


# --- versions: customers, changed once ------------------------------------

V1, V2 = "1995-01-01 00:00:00", "2000-01-01 00:00:00"
VERSION_ATTRS = ["c_name", "c_nationkey", "c_mktsegment"]


def changed_customers(t: Tables) -> DataFrame:
    """All customers, those of some nations in another segment, and every supplier as a new customer."""
    moved = F.when(F.col("c_nationkey") < 8, F.lit("MOVED")).otherwise(F.col("c_mktsegment"))
    customers = t.customer.select("c_custkey", "c_name", "c_nationkey", moved.alias("c_mktsegment"))
    suppliers = t.supplier.select(
        (-1 - F.col("s_suppkey")).alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_nationkey").alias("c_nationkey"),
        F.lit("SUPPLIER").alias("c_mktsegment"),
    )
    return union_all(customers, suppliers)


def versions(t: Tables, hash: str = "md5_concat") -> DataFrame:
    first = scd2_start(t.customer, "c_custkey", VERSION_ATTRS, F.lit(V1), hash=hash)
    return scd2_merge(first, changed_customers(t), "c_custkey", VERSION_ATTRS, F.lit(V2), hash=hash)


VERSIONS_SQL = f"""
v1 AS (
  SELECT c_custkey, c_name, c_nationkey, c_mktsegment,
         md5(c_name || '|' || c_nationkey || '|' || c_mktsegment) AS record_hash FROM customer
),
v2 AS (
  SELECT *, md5(c_name || '|' || c_nationkey || '|' || c_mktsegment) AS record_hash FROM (
    SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_nationkey < 8 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment
    FROM customer
    UNION ALL SELECT -1 - s_suppkey, s_name, s_nationkey, 'SUPPLIER' FROM supplier)
),
versions AS (
  SELECT v1.c_custkey, v1.c_name, v1.c_nationkey, v1.c_mktsegment, v1.record_hash, TIMESTAMP '{V1}' AS valid_from,
         CASE WHEN v2.record_hash <> v1.record_hash THEN TIMESTAMP '{V2}' END AS valid_to,
         v2.record_hash IS NULL OR v2.record_hash = v1.record_hash AS is_current
  FROM v1 LEFT JOIN v2 USING (c_custkey)
  UNION ALL
  SELECT v2.c_custkey, v2.c_name, v2.c_nationkey, v2.c_mktsegment, v2.record_hash, TIMESTAMP '{V2}', NULL, TRUE
  FROM v2 LEFT JOIN v1 USING (c_custkey) WHERE v1.record_hash IS NULL OR v1.record_hash <> v2.record_hash
)"""
