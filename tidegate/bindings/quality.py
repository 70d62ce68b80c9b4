"""Suites, validation, contracts and reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.bindings import Tables, query
from tidegate.bindings.shapes import landed_trips
from tidegate.functions.scalars import unscaled
from tidegate.operators import quality as Q
from tidegate.operators.contract import contract_check
from tidegate.operators.reconcile import reconcile
from tidegate.operators.validate import Field, validate_events, validate_payloads, validate_rows
from tidegate.plans.suites import TRIP_CONTRACT, TRIP_GUARANTEES, TRIP_SOURCE_TESTS

ORDER_SUITE = [
    Q.check_row_count(1, None),
    Q.check_not_null("o_orderkey"),
    Q.check_unique("o_orderkey"),
    Q.check_in_set("o_orderstatus", ["F", "O"]),
    Q.check_between("o_totalprice", 0, 400000, strict_min=True),
    Q.check_mean("o_custkey", 1, None),
    Q.check_median("o_totalprice", 100000, 400000),
    Q.check_share("o_orderstatus", "P", 0.5, 1.0),
]
ALL = "count(*)"


def row_sql(check: str, column: str | None, ok: str, observed: str, count: str = "NULL", base: str = "count(*)") -> str:
    pct = "NULL" if count == "NULL" else f"100.0::DOUBLE * ({count}) / ({base})"
    name = f"'{column}'" if column else "NULL"
    return (
        f"SELECT 'orders' AS suite, '{check}' AS \"check\", {name} AS \"column\", {ok} AS success, CAST({observed} AS DOUBLE) AS observed, "
        f"CAST({count} AS BIGINT) AS unexpected_count, CAST({pct} AS DOUBLE) AS unexpected_pct FROM orders"
    )


def bad(condition: str) -> str:
    return f"count(*) FILTER ({condition})"


OUT_OF_SET = bad("o_orderstatus NOT IN ('F', 'O')")
OUT_OF_RANGE = bad("NOT (o_totalprice > 0 AND o_totalprice <= 400000)")
SHARE_P = "CAST(count(*) FILTER (o_orderstatus = 'P') AS DOUBLE) / count(*)"


@query(
    " UNION ALL ".join(
        [
            row_sql("row_count", None, "count(*) >= 1", "count(*)"),
            row_sql("not_null", "o_orderkey", "count(*) = count(o_orderkey)", "count(*) - count(o_orderkey)", "count(*) - count(o_orderkey)"),
            row_sql("unique", "o_orderkey", "TRUE", "0", "0"),
            row_sql("in_set", "o_orderstatus", f"{OUT_OF_SET} = 0", OUT_OF_SET, OUT_OF_SET),
            row_sql("between", "o_totalprice", f"{OUT_OF_RANGE} = 0", OUT_OF_RANGE, OUT_OF_RANGE),
            row_sql("mean", "o_custkey", "sum(o_custkey) >= count(*)", "CAST(sum(o_custkey) AS DOUBLE) / count(*)"),
            row_sql("median", "o_totalprice", "median(o_totalprice) BETWEEN 100000 AND 400000", "median(o_totalprice)"),
            row_sql("share=P", "o_orderstatus", f"{SHARE_P} BETWEEN 0.5 AND 1", SHARE_P),
        ]
    )
)
def quality_suite(t: Tables) -> DataFrame:
    return Q.run_suite(t.orders, "orders", ORDER_SUITE)


@query("""
WITH c AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
SELECT 'lineitem' AS suite, 'unique' AS "check", 'l_orderkey' AS "column", FALSE AS success, CAST(sum(n) FILTER (n > 1) AS DOUBLE) AS observed,
       CAST(sum(n) FILTER (n > 1) AS BIGINT) AS unexpected_count,
       CAST(100.0::DOUBLE * (sum(n) FILTER (n > 1))::BIGINT / sum(n)::BIGINT AS DOUBLE) AS unexpected_pct FROM c""")
def unique_check(t: Tables) -> DataFrame:
    return Q.run_suite(t.lineitem, "lineitem", [Q.check_unique("l_orderkey")])


@query("""
SELECT max(ts) AS newest, CAST(date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01') AS DOUBLE) / 3600000000 AS age_hours,
       CASE WHEN date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01') > 48 * 3600000000 THEN 'error'
            WHEN date_diff('microsecond', max(ts), TIMESTAMP '2024-02-01') > 24 * 3600000000 THEN 'warn' ELSE 'ok' END AS status
FROM events""")
def freshness(t: Tables) -> DataFrame:
    return Q.freshness(t.events, "ts", F.lit("2024-02-01").cast("timestamp_ntz"))


ACCOUNT_FORM = [
    Field("c_acctbal", "number", required=True, minimum=0),
    Field("c_nationkey", "int", maximum=20),
    Field("c_name", "string", required=True),
]


@query("""
SELECT c_custkey, 'c_acctbal' AS path, 'must be at least 0' AS message FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'c_nationkey', 'must be at most 20' FROM customer WHERE c_nationkey > 20""")
def row_errors(t: Tables) -> DataFrame:
    return validate_rows(t.customer, ACCOUNT_FORM).select("c_custkey", F.inline("errors"))


@query("""
SELECT c_custkey, 'c_acctbal' AS path, 'must be at least 0' AS message FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'c_nationkey', 'must be a number' FROM customer WHERE c_nationkey > 20
UNION ALL SELECT c_custkey, 'c_name', 'is required' FROM customer WHERE c_mktsegment = 'BUILDING'
UNION ALL SELECT c_custkey, 'c_nationkey', 'must not be null' FROM customer WHERE c_nationkey = 3""")
def payload_errors(t: Tables) -> DataFrame:
    """Customers as JSON bodies; some nations are text or null, and one segment has no name."""
    fields = [
        F.concat(F.lit('"c_acctbal":'), F.col("c_acctbal").cast("string")),
        F.when(F.col("c_nationkey") == 3, '"c_nationkey":null')
        .when(F.col("c_nationkey") > 20, F.concat(F.lit('"c_nationkey":"n'), "c_nationkey", F.lit('"')))
        .otherwise(F.concat(F.lit('"c_nationkey":'), "c_nationkey")),
        F.when(F.col("c_mktsegment") != "BUILDING", F.concat(F.lit('"c_name":"'), "c_name", F.lit('"'))),
    ]
    body = F.concat(F.lit("{"), F.concat_ws(",", *fields), F.lit("}"))
    bodies = t.customer.select("c_custkey", body.alias("body"))
    return validate_payloads(bodies, "body", ACCOUNT_FORM).select("c_custkey", F.inline("errors"))


@query("""
SELECT event_id, CASE WHEN k IS NULL THEN 'Required field ''k'' is missing or null' WHEN event_type <> 'click'
  THEN 'Unknown event_type ''' || event_type || '''' WHEN CAST(k AS DOUBLE) <= 0 THEN 'Field ''k'' must be > 0, got ''' || k || ''''
  WHEN value <> floor(value) THEN 'value must be an integer, got ''' || value || ''''
  WHEN value NOT BETWEEN 1 AND 100 THEN 'value must be between 1 and 100, got ''' || value || '''' END AS error
FROM (SELECT *, json_extract_string(props, '$.k') AS k FROM events)""")
def event_errors(t: Tables) -> DataFrame:
    fields = t.events.select(
        "event_id", "event_type", F.get_json_object("props", "$.k").alias("k"), F.col("value").cast("string").alias("value")
    )
    checked = validate_events(
        fields, required=["k"], event_type="click", positive=["k"], count=("value", 1, 100), timestamps=[]
    )
    return checked.select("event_id", "error")


@query("""
SELECT 'c_phone' AS item, 'removed' AS problem, TRUE AS breaking, 0::BIGINT AS violations
UNION ALL SELECT 'c_nationkey', 'type changed', TRUE, 0 UNION ALL SELECT 'c_mktsegment', 'added', FALSE, 0
UNION ALL SELECT 'c_acctbal', 'between', count(*) FILTER (c_acctbal < 0) > 0, count(*) FILTER (c_acctbal < 0) FROM customer
UNION ALL SELECT 'c_custkey', 'not_null', FALSE, count(*) - count(c_custkey) FROM customer""")
def contract_problems(t: Tables) -> DataFrame:
    stable = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "bigint", "c_acctbal": "double", "c_phone": "string"}
    return contract_check(t.customer, "customer", stable, [Q.check_between("c_acctbal", 0), Q.check_not_null("c_custkey")])


@query("""
SELECT 'passenger_count' AS item, 'between' AS problem, count(*) FILTER (l_linenumber > 6) > 0 AS breaking,
       count(*) FILTER (l_linenumber > 6) AS violations FROM lineitem
UNION ALL SELECT * FROM (VALUES ('fare_amount', 'between', FALSE, 0), ('trip_distance', 'between', FALSE, 0), ('source_row_hash', 'not_null', FALSE, 0))""")
def trip_contract(t: Tables) -> DataFrame:
    return contract_check(landed_trips(t), "trips", TRIP_CONTRACT, TRIP_GUARANTEES)


#: What makes two trips of these tables equal: the hash covers the values of its columns, so equal hashes are equal values.
TRIP_VALUES = (
    "l_linenumber, o_orderdate, l_shipdate, l_quantity, l_suppkey % 10, l_partkey % 10, l_partkey % 8, l_linestatus, l_suppkey % 8,"
    " round(l_extendedprice * 100), round(l_tax * 100000), round(l_discount * 10000)"
)


def trip_test_sql(check: str, column: str, unexpected: str) -> str:
    return (
        f"SELECT 'trips' AS suite, '{check}' AS \"check\", '{column}' AS \"column\", {unexpected} = 0 AS success, CAST({unexpected} AS DOUBLE) AS observed, "
        f"CAST({unexpected} AS BIGINT) AS unexpected_count, 100.0::DOUBLE * CAST({unexpected} AS BIGINT) / n AS unexpected_pct FROM figures"
    )


@query(
    f"""
WITH rows AS (
  SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey) AS same_id, count(*) OVER (PARTITION BY {TRIP_VALUES}) AS same_values
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
figures AS (
  SELECT count(*) AS n, count(*) FILTER (same_id > 1) AS ids, count(*) FILTER (same_values > 1) AS hashes,
         count(*) FILTER (l_linenumber NOT BETWEEN 1 AND 6) AS crowded FROM rows)
"""
    + " UNION ALL ".join(
        [
            trip_test_sql("not_null", "id", "0"),
            trip_test_sql("unique", "id", "ids"),
            trip_test_sql("not_null", "pickup_datetime", "0"),
            trip_test_sql("in_set", "passenger_count", "crowded"),
            trip_test_sql("not_null", "fare_amount", "0"),
            trip_test_sql("not_null", "source_row_hash", "0"),
            trip_test_sql("unique", "source_row_hash", "hashes"),
        ]
    )
)
def trip_source_tests(t: Tables) -> DataFrame:
    return Q.run_suite(landed_trips(t), "trips", TRIP_SOURCE_TESTS)


@query("""
WITH o AS (SELECT year(o_orderdate) AS slice, count(*) AS n, sum(CAST(round(o_totalprice * 100) AS BIGINT))::BIGINT AS c FROM orders GROUP BY 1),
l AS (SELECT year(o_orderdate) AS slice, count(*) AS n, sum(CAST(round(l_extendedprice * 100) AS BIGINT))::BIGINT AS c
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1)
SELECT slice, coalesce(o.n, 0) AS source_rows, coalesce(l.n, 0) AS landed_rows, coalesce(o.c, 0) AS source_cents, coalesce(l.c, 0) AS landed_cents,
       coalesce(l.n, 0) - coalesce(o.n, 0) AS rows_gap, coalesce(l.c, 0) - coalesce(o.c, 0) AS cents_gap,
       coalesce(l.n, 0) = coalesce(o.n, 0) AND coalesce(l.c, 0) = coalesce(o.c, 0) AS matches FROM o FULL JOIN l USING (slice)""")
def reconcile_years(t: Tables) -> DataFrame:
    dates = t.orders.select("o_orderkey", "o_orderdate")
    lines = t.lineitem.join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
    year = F.year("o_orderdate")
    cents = (unscaled("o_totalprice", 2), unscaled("l_extendedprice", 2))
    return reconcile(t.orders, lines, year, year, {"cents": cents})
