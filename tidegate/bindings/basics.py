"""Shaping, filters and row intake: the small operators over whole tables, and values that do not fit their types."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.bindings import Tables, query
from tidegate.bindings.shapes import NOW, marks, now
from tidegate.functions import scalars as X
from tidegate.operators import aggregates as A
from tidegate.operators import filters as P
from tidegate.operators import quality as Q
from tidegate.operators import shape as S
from tidegate.operators.history import lookup
from tidegate.operators.paging import page
from tidegate.operators.validate import Field, insert_validated
from tidegate.plans.loads import incremental_load
from tidegate.plans.runs import update_watermark
from tidegate.session import staging_path
from tidegate.sources.files import literal_rows, read_table
from tidegate.streaming.ingest import Paths, ingest_stream
from tidegate.streaming.replay import read_replay

# --- shaping --------------------------------------------------------------


@query("SELECT o_orderkey, o_custkey FROM orders")
def keep_list(t: Tables) -> DataFrame:
    return S.keep(t.orders, ["o_orderkey", "absent", "o_custkey"])


@query("SELECT event_id, CASE WHEN user_id % 5 = 0 THEN NULL ELSE value END AS value FROM events")
def nan_to_null(t: Tables) -> DataFrame:
    with_nan = t.events.select("event_id", F.expr("CASE WHEN user_id % 5 = 0 THEN DOUBLE('NaN') ELSE value END").alias("value"))
    return with_nan.withColumn("value", X.nan_to_null("value"))


@query("SELECT c_custkey, c_name, c_custkey AS customer_id FROM customer")
def duplicated_column(t: Tables) -> DataFrame:
    return S.duplicate(t.customer.select("c_custkey", "c_name"), {"customer_id": "c_custkey"})


@query("SELECT c_custkey, CASE WHEN c_nationkey = 5 THEN -1 ELSE c_nationkey END AS nation, 'none' AS deck FROM customer")
def filled_defaults(t: Tables) -> DataFrame:
    gaps = t.customer.select("c_custkey", F.expr("CASE WHEN c_nationkey <> 5 THEN c_nationkey END").alias("nation"))
    return S.fill(gaps, {"nation": -1, "deck": "none"})


@query(f"SELECT s_suppkey, TIMESTAMP '{NOW}' AS loaded_at, TIMESTAMP '{NOW}' AS updated_at FROM supplier")
def audit_columns(t: Tables) -> DataFrame:
    return S.with_audit(t.supplier.select("s_suppkey"), now(), ("loaded_at", "updated_at"))


@query("SELECT p_partkey, CAST(NULL AS VARCHAR) AS grade FROM part")
def additive_columns(t: Tables) -> DataFrame:
    return S.ensure_columns(t.part.select("p_partkey"), {"p_partkey": "bigint", "grade": "string"})


@query("SELECT c_custkey, c_custkey || '.0' AS number FROM customer WHERE c_custkey > 127")
def conform_rejects(t: Tables) -> DataFrame:
    """Numbers written ``2.0`` are whole; those that the type doesn't hold are named."""
    written = t.customer.select("c_custkey", F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("number"))
    return S.conform_rejects(written, {"number": "tinyint"}).drop("misfits")


@query("SELECT c_custkey AS number FROM customer WHERE c_custkey <= 127")
def conformed_numbers(t: Tables) -> DataFrame:
    written = t.customer.select(F.concat(F.col("c_custkey").cast("string"), F.lit(".0")).alias("number"))
    return S.conform(written, {"number": "tinyint"}).where("number IS NOT NULL")


# --- filters, scans and figures -------------------------------------------


@query("""
SELECT date_trunc('hour', ts) AS "hour", count(*) AS n FROM events
WHERE date_trunc('hour', ts) BETWEEN TIMESTAMP '2024-01-10 05:00:00' AND TIMESTAMP '2024-01-20 05:00:00' GROUP BY 1""")
def bucket_range(t: Tables) -> DataFrame:
    hours = t.events.groupBy(F.date_trunc("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    return P.between(hours, "hour", "2024-01-10 05:00:00", "2024-01-20 05:00:00")


@query("SELECT c_custkey FROM customer WHERE c_nationkey <> 5 AND c_acctbal >= 0")
def required_values(t: Tables) -> DataFrame:
    gaps = t.customer.selectExpr(
        "c_custkey", "CASE WHEN c_nationkey <> 5 THEN c_nationkey END AS nation",
        "CASE WHEN c_acctbal >= 0 THEN c_acctbal ELSE DOUBLE('NaN') END AS balance",
    )
    return P.require(gaps, ["nation", "balance"]).select("c_custkey")


@query("SELECT c_custkey, c_mktsegment FROM customer WHERE lower(c_mktsegment) = 'building'")
def case_blind_match(t: Tables) -> DataFrame:
    return t.customer.where(X.same_text("c_mktsegment", "Building")).select("c_custkey", "c_mktsegment")


@query("SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('second', ts) END AS at FROM events")
def parsed_times(t: Tables) -> DataFrame:
    written = F.when(F.col("event_id") % 7 == 0, "no time").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return t.events.select("event_id", X.parse_ts(written).alias("at"))


@query('SELECT count(*) AS "rows", CAST(sum(c_nationkey % 2) AS BIGINT) AS survivors FROM customer')
def survivor_count(t: Tables) -> DataFrame:
    return A.survivors(t.customer.withColumn("survived", F.expr("c_nationkey % 2")))


@query("SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON c_custkey = o_custkey")
def scanned_tables(t: Tables) -> DataFrame:
    """One table by its path, one by its name in the catalog."""
    t.customer.createOrReplaceTempView("scanned_customers")
    orders, customers = read_table(t.spark, f"{t.folder}/orders.parquet"), read_table(t.spark, "scanned_customers")
    return orders.join(customers, F.col("c_custkey") == F.col("o_custkey")).select("o_orderkey", "o_totalprice", "c_name")


@query("""
SELECT event_id, CASE event_type WHEN 'click' THEN 'Click' WHEN 'error' THEN 'Failure' END AS label FROM events""")
def labels_from_inline_rows(t: Tables) -> DataFrame:
    labels = literal_rows(t.spark, [("click", "Click"), ("error", "Failure")], {"code": "string", "label": "string"})
    return lookup(t.events.select("event_id", "event_type"), "event_type", labels, "code", ["label"]).drop("event_type")


KIND = "CASE WHEN user_id % 3 <> 0 THEN event_type END"


@query(f"SELECT {KIND} AS kind, event_id FROM events ORDER BY 1 NULLS FIRST, 2 LIMIT 50 OFFSET 20")
def page_with_null_keys(t: Tables) -> DataFrame:
    return page(t.events.selectExpr(f"{KIND} AS kind", "event_id"), ["kind", "event_id"], 50, 20)[0]


# --- intake ---------------------------------------------------------------


@query(f"""
SELECT 'orders' AS suite, 'row_count' AS "check", count(*) >= 1 AS success, CAST(count(*) AS DOUBLE) AS observed, 'run 1' AS run_id,
       TIMESTAMP '{NOW}' AS checked_at FROM orders
UNION ALL SELECT 'orders', 'not_null', count(*) = count(o_orderkey), CAST(count(*) - count(o_orderkey) AS DOUBLE), 'run 1', TIMESTAMP '{NOW}' FROM orders""")
def recorded_results(t: Tables) -> DataFrame:
    results = Q.run_suite(t.orders, "orders", [Q.check_row_count(1, None), Q.check_not_null("o_orderkey")])
    return Q.record_results(results, "run 1", now()).select("suite", "check", "success", "observed", "run_id", "checked_at")


ACCOUNT = [Field("id", "int", required=True, minimum=1), Field("name", "string", required=True), Field("balance", "number", minimum=0)]


def _accounts(t: Tables) -> tuple[DataFrame, DataFrame]:
    body = F.to_json(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")))
    held = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    return insert_validated(held, t.customer.select(body.alias("body")), "body", ACCOUNT)


@query("""
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS balance FROM supplier
UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey >= 1 AND c_acctbal >= 0""")
def inserted_payloads(t: Tables) -> DataFrame:
    return _accounts(t)[0]


@query("""
SELECT c_custkey AS id, 'balance' AS path, 'must be at least 0' AS message FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'id', 'must be at least 1' FROM customer WHERE c_custkey < 1""")
def rejected_payloads(t: Tables) -> DataFrame:
    rejected = _accounts(t)[1]
    return rejected.select(X.json_field("body", "$.id").cast("bigint").alias("id"), F.inline("errors"))


def _typed_ingest(t: Tables) -> Paths:
    """Every event as a trip: whole numbers written ``2.0``, some fares that are no number or too large, some ids too large."""
    root = staging_path(t.spark, "typed")
    fare = "CASE event_id % 4 WHEN 0 THEN '\"5d\"' WHEN 1 THEN '1234567.5' ELSE '12.5' END"
    line = f"""concat('{{"event_type":"trip_completed","event_time":"2024-02-01T00:00:00","pickup_datetime":"2024-01-01 00:00:00"',
        ',"vendor_id":', event_id % 40000, '.0,"passenger_count":', 1 + event_id % 6, '.0,"fare_amount":', {fare}, '}}') AS value"""
    t.events.selectExpr(line).write.text(f"{root}/source")
    paths = Paths.under(root)
    ingest_stream(read_replay(t.spark, f"{root}/source"), paths).awaitTermination()
    return paths


@query(f"""
SELECT event_id, event_type, value, NULL::BIGINT AS id, NULL::TIMESTAMP AS loaded_at FROM events WHERE ts <= TIMESTAMP '2024-01-15'
UNION ALL SELECT event_id, event_type, value, row_number() OVER (ORDER BY event_id), TIMESTAMP '{NOW}' FROM events WHERE ts > TIMESTAMP '2024-01-15'
""")
def loaded_rows_with_ids(t: Tables) -> DataFrame:
    """Rows above the mark are new to a table of the older ones; they get ids and a load stamp."""
    rows = t.events.select("event_id", "ts", "event_type", "value")
    held = rows.where("ts <= TIMESTAMP_NTZ'2024-01-15'").withColumns({"id": F.lit(None).cast("bigint"), "loaded_at": F.lit(None).cast("timestamp")})
    mark = update_watermark(marks(t), "events", datetime(2024, 1, 15), 0, "run 1", now())
    return incremental_load(held, rows, mark, "events", "ts", ["event_id"], "run 2", now()).target.drop("ts")


@query("""
SELECT DISTINCT event_id % 40000 AS vendor_id, 1 + event_id % 6 AS passenger_count, 12.5::DOUBLE AS fare_amount
FROM events WHERE event_id % 4 >= 2 AND event_id % 40000 <= 32767""")
def stream_typed_rows(t: Tables) -> DataFrame:
    return t.spark.read.parquet(_typed_ingest(t).table).select("vendor_id", "passenger_count", "fare_amount")


@query("""
SELECT CASE WHEN event_id % 4 = 0 THEN 'Field ''fare_amount'' must be numeric, got ''5d'''
            WHEN event_id % 4 >= 2 THEN 'Outside the table''s type: vendor_id'
            WHEN event_id % 40000 > 32767 THEN 'Outside the table''s type: vendor_id, fare_amount'
            ELSE 'Outside the table''s type: fare_amount' END AS reason, count(*) AS n
FROM events WHERE event_id % 4 < 2 OR event_id % 40000 > 32767 GROUP BY 1""")
def stream_typed_rejects(t: Tables) -> DataFrame:
    return t.spark.read.parquet(_typed_ingest(t).rejected).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
