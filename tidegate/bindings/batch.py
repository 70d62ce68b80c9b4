"""Scans, shaping, filters, scalar functions, hashes, aggregates, windows and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.bindings import Tables, query
from tidegate.bindings.shapes import PASSENGERS_SQL, TRIPS_SQL, landed_trips, passengers
from tidegate.functions.hashing import attr_hash, spread_key, with_row_hash
from tidegate.functions.scalars import (
    clip,
    duration_minutes,
    fmt_money,
    fmt_ts,
    geofence,
    json_field,
    pages,
    size_pretty,
    to_numeric,
    unscaled,
)
from tidegate.operators import aggregates as A
from tidegate.operators import filters as P
from tidegate.operators.history import lookup
from tidegate.operators.mutate import dedup
from tidegate.operators.paging import deep_page, head_buckets, page, page_after, top_recent
from tidegate.operators.ranks import exact_median
from tidegate.operators.shape import align, conform, hour_label, label_cols, rename, union_all
from tidegate.operators.windows import latest_per_key, trailing_mean, with_delta
from tidegate.plans import models
from tidegate.plans.adhoc import adhoc
from tidegate.session import staging_path
from tidegate.sources.catalog import Catalog, register_view, table_profile
from tidegate.sources.files import read_csv

LINE_RULES = {
    "l_extendedprice": "l_extendedprice > 0",
    "l_quantity": "l_quantity > 0",
    "l_linenumber": "l_linenumber BETWEEN 1 AND 6",
    "l_absent": "l_absent > 0",
}
CENTS = "CAST(round({} * 100) AS BIGINT)"
VALUE_C = CENTS.format("value")


def avg_sql(total: str, n: str, dp: int, scale: int = 2) -> str:
    """Average of non-negative units, rounded half up in integers."""
    d = 10 ** (scale - dp)
    return f"CAST((2 * ({total}) + ({n}) * {d}) // (2 * ({n}) * {d}) AS DOUBLE) / {10**dp}"


# --- scans and shaping ----------------------------------------------------


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders")
def csv_scan(t: Tables) -> DataFrame:
    path = staging_path(t.spark, "csv")
    t.orders.write.csv(path, header=True)
    layout = {
        "o_orderkey": "bigint",
        "o_custkey": "bigint",
        "o_orderstatus": "string",
        "o_totalprice": "double",
        "o_orderdate": "timestamp_ntz",
        "o_orderpriority": "string",
    }
    return read_csv(t.spark, path, layout)


@query("SELECT p_partkey AS id, p_name AS name, CAST(p_size AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS note FROM part")
def rename_and_align(t: Tables) -> DataFrame:
    renamed = rename(t.part, {"p_partkey": "id", "p_name": "name", "p_size": "size"})
    return align(renamed, {"id": "bigint", "name": "string", "size": "bigint", "note": "string"})


@query("""
SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS SMALLINT) AS k, TRY_CAST(event_type AS INTEGER) AS bad,
       CAST(TRY_CAST(value AS DECIMAL(4,2)) AS DOUBLE) AS small_value FROM events""")
def conform_types(t: Tables) -> DataFrame:
    text = t.events.select(
        "event_id", json_field("props", "$.k").alias("k"), F.col("event_type").alias("bad"), F.col("value").alias("small_value")
    )
    return conform(text, {"event_id": "bigint", "k": "smallint", "bad": "int", "small_value": "decimal(4,2)"})


@query("""
SELECT c_custkey AS key, c_name AS name, 'customer' AS kind, c_mktsegment AS segment FROM customer
UNION ALL SELECT s_suppkey, s_name, 'supplier', NULL FROM supplier""")
def union_tables(t: Tables) -> DataFrame:
    left = t.customer.select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), F.lit("customer").alias("kind"),
        F.col("c_mktsegment").alias("segment"),
    )
    right = t.supplier.select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), F.lit("supplier").alias("kind"))
    return union_all(left, right)


@query("SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1")
def json_extract(t: Tables) -> DataFrame:
    return t.events.groupBy(json_field("props", "$.k").cast("bigint").alias("k")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""WITH {TRIPS_SQL}
SELECT id AS trip_key,
       CASE vendor_id WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone Inc' END AS vendor_name,
       pickup_datetime, dropoff_datetime,
       CASE WHEN dropoff_datetime > pickup_datetime
            THEN CAST(date_diff('microsecond', pickup_datetime, dropoff_datetime) // 600000 AS DOUBLE) / 100 END
         AS trip_duration_minutes,
       CAST(passenger_count AS BIGINT) AS passenger_count, CAST(distance_c AS DOUBLE) / 100 AS trip_distance_miles,
       CASE WHEN plon BETWEEN -74.3 AND -73.7 AND plat BETWEEN 40.5 AND 40.9 THEN plon END AS pickup_longitude,
       CASE WHEN plon BETWEEN -74.3 AND -73.7 AND plat BETWEEN 40.5 AND 40.9 THEN plat END AS pickup_latitude,
       CASE WHEN dlon BETWEEN -74.3 AND -73.7 AND dlat BETWEEN 40.5 AND 40.9 THEN dlon END AS dropoff_longitude,
       CASE WHEN dlon BETWEEN -74.3 AND -73.7 AND dlat BETWEEN 40.5 AND 40.9 THEN dlat END AS dropoff_latitude,
       CASE rate_code_id WHEN 1 THEN 'Standard Rate' WHEN 2 THEN 'JFK' WHEN 3 THEN 'Newark'
            WHEN 4 THEN 'Nassau/Westchester' WHEN 5 THEN 'Negotiated Fare' WHEN 6 THEN 'Group Ride' END AS rate_type,
       CASE payment_type WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge' WHEN 4 THEN 'Dispute'
            WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided Trip' END AS payment_method,
       CAST(fare_c AS DOUBLE) / 100 AS fare_amount_usd, CAST(tip_c AS DOUBLE) / 100 AS tip_amount_usd,
       CAST(tolls_c AS DOUBLE) / 100 AS tolls_amount_usd, CAST(0 AS DOUBLE) AS mta_tax_usd,
       CAST((2 * tip_c * 1000 + fare_c) // (2 * fare_c) AS DOUBLE) / 10 AS tip_pct
FROM staged""")
def stage_fact(t: Tables) -> DataFrame:
    return models.stage_trips(landed_trips(t)).select(
        "trip_key", "vendor_name", "pickup_datetime", "dropoff_datetime", "trip_duration_minutes", "passenger_count",
        "trip_distance_miles", "pickup_longitude", "pickup_latitude", "dropoff_longitude", "dropoff_latitude",
        "rate_type", "payment_method", "fare_amount_usd", "tip_amount_usd", "tolls_amount_usd", "mta_tax_usd", "tip_pct",
    )


@query(f"""WITH {PASSENGERS_SQL}
SELECT CAST(passenger_id AS BIGINT) AS source_passenger_id,
       CASE survived WHEN 1 THEN TRUE WHEN 0 THEN FALSE END AS did_survive,
       CASE pclass WHEN 1 THEN 'First' WHEN 2 THEN 'Second' WHEN 3 THEN 'Third' ELSE 'Unknown' END AS passenger_class_name,
       CAST(CASE WHEN pclass IN (1, 2, 3) THEN pclass END AS BIGINT) AS passenger_class_num,
       name AS full_name, sex, CAST(age_c AS DOUBLE) / 100 AS age_years, age_c IS NULL AS is_age_unknown,
       CAST(sib_sp + parch AS BIGINT) AS family_size, ticket AS ticket_number,
       CAST(greatest(fare_c, 0) AS DOUBLE) / 100 AS fare_gbp, cabin AS cabin_number,
       CASE embarked WHEN 'C' THEN 'Cherbourg' WHEN 'Q' THEN 'Queenstown' WHEN 'S' THEN 'Southampton'
            ELSE 'Unknown' END AS embarkation_port,
       CASE WHEN embarked IN ('C', 'Q', 'S') THEN embarked END AS embarkation_code
FROM passengers""")
def stage_dimension(t: Tables) -> DataFrame:
    staged = models.stage_passengers(passengers(t))
    return staged.drop("passenger_key", "loaded_at", "siblings_spouses_count", "parents_children_count")


@query("""
SELECT p_partkey, CASE WHEN inside THEN CAST(p_size AS BIGINT) END AS lon, CASE WHEN inside THEN p_retailprice END AS lat
FROM (SELECT *, p_size BETWEEN 10 AND 30 AND p_retailprice BETWEEN 910 AND 950 AS inside FROM part)""")
def coordinates_in_box(t: Tables) -> DataFrame:
    lon, lat = geofence("p_size", "p_retailprice", ("10", "30", "910", "950"))
    return t.part.select("p_partkey", lon.alias("lon"), lat.alias("lat"))


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M') AS at_minute, strftime(ts, '%Y-%m-%dT%H') AS at_hour,
       strftime(ts, '%H') || 'h' AS hour_label, '$' || printf('%.2f', value) AS money,
       'Type ' || event_type || ' ' || user_id AS label, least(greatest(value, 5.0), 100.0) AS clipped
FROM events""")
def display_columns(t: Tables) -> DataFrame:
    labelled = label_cols(t.events, "label", "Type", ["event_type", "user_id"])
    return labelled.select(
        "event_id", fmt_ts("ts").alias("at_minute"), fmt_ts("ts", "hour").alias("at_hour"), hour_label("ts").alias("hour_label"),
        fmt_money("value", "$").alias("money"), "label", clip("value", 5.0, 100.0).alias("clipped"),
    )


@query("""
SELECT source, sum(n_chars)::BIGINT AS chars,
       CASE WHEN sum(n_chars) < 10240 THEN sum(n_chars)::BIGINT || ' bytes'
            WHEN (sum(n_chars) + 512) // 1024 < 10240 THEN ((sum(n_chars) + 512) // 1024)::BIGINT || ' kB'
            ELSE ((sum(n_chars) + 524288) // 1048576)::BIGINT || ' MB' END AS pretty
FROM documents GROUP BY source""")
def readable_sizes(t: Tables) -> DataFrame:
    totals = t.documents.groupBy("source").agg(F.sum("n_chars").alias("chars"))
    return totals.withColumn("pretty", size_pretty("chars"))


@query("""
SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber,
       CASE WHEN l_shipdate > o_orderdate
            THEN CAST(date_diff('microsecond', o_orderdate, l_shipdate) // 600000 AS DOUBLE) / 100 END AS minutes
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def duration(t: Tables) -> DataFrame:
    dates = t.orders.select("o_orderkey", "o_orderdate")
    joined = t.lineitem.join(dates, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", duration_minutes("o_orderdate", "l_shipdate").alias("minutes"))


@query("SELECT event_type, count(TRY_CAST(event_type AS DOUBLE)) AS numeric_rows, count(*) AS all_rows FROM events GROUP BY 1")
def coerce_numeric(t: Tables) -> DataFrame:
    return t.events.groupBy("event_type").agg(
        F.count(to_numeric("event_type")).alias("numeric_rows"), F.count(F.lit(1)).alias("all_rows")
    )


# --- filters --------------------------------------------------------------


@query("""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber::BIGINT AS l_linenumber, l_quantity, l_extendedprice FROM lineitem
WHERE l_extendedprice > 0 AND l_quantity > 0 AND l_linenumber BETWEEN 1 AND 6""")
def clean_filter(t: Tables) -> DataFrame:
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    return P.clean(t.lineitem.select(*columns), LINE_RULES)


@query("""
SELECT 'l_extendedprice' AS rule, count(*) AS total_rows, count(*) FILTER (NOT l_extendedprice > 0) AS failed_rows FROM lineitem
UNION ALL SELECT 'l_quantity', count(*), count(*) FILTER (NOT l_quantity > 0) FROM lineitem
UNION ALL SELECT 'l_linenumber', count(*), count(*) FILTER (NOT l_linenumber BETWEEN 1 AND 6) FROM lineitem""")
def clean_report(t: Tables) -> DataFrame:
    return P.clean_report(t.lineitem, LINE_RULES)


@query("""
SELECT l_orderkey, l_partkey, l_linenumber::BIGINT AS l_linenumber, 'l_linenumber' AS failed FROM lineitem
WHERE l_linenumber NOT BETWEEN 1 AND 6""")
def rejected_rows(t: Tables) -> DataFrame:
    broken = P.rejected(t.lineitem, LINE_RULES)
    return broken.select("l_orderkey", "l_partkey", "l_linenumber", F.array_join("failed_rules", ",").alias("failed"))


@query("SELECT * FROM events WHERE ts > TIMESTAMP '2024-01-15'")
def incremental_filter(t: Tables) -> DataFrame:
    return P.filter_incremental(t.events, "ts", F.lit("2024-01-15"))


@query("SELECT * FROM events WHERE ts <= TIMESTAMP '2024-01-15'")
def late_rows(t: Tables) -> DataFrame:
    return P.late_rows(t.events, "ts", F.lit("2024-01-15"))


@query("SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_totalprice >= 100000 AND o_totalprice <= 300000")
def where_options(t: Tables) -> DataFrame:
    return P.filter_where(
        t.orders, o_orderstatus="F", o_totalprice__gte=100000, o_totalprice__lte=300000, o_custkey=None, o_orderpriority=""
    )


@query("SELECT * FROM customer WHERE c_mktsegment LIKE 'B%' AND c_nationkey IN (1, 2, 3, 5, 8, 13)")
def prefix_and_members(t: Tables) -> DataFrame:
    return P.in_values(P.like(t.customer, "c_mktsegment", "B%"), "c_nationkey", [1, 2, 3, 5, 8, 13])


@query("SELECT * FROM orders WHERE o_orderkey = 777")
def point_lookup(t: Tables) -> DataFrame:
    return P.by_key(t.orders, "o_orderkey", 777)


@query("SELECT * FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 300000)")
def semi_join(t: Tables) -> DataFrame:
    big = t.orders.where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return P.in_table(t.customer, big, "c_custkey")


@query("""
SELECT * FROM customer c WHERE NOT EXISTS (
  SELECT 1 FROM orders WHERE o_custkey = c.c_custkey AND o_totalprice > 300000)""")
def anti_join(t: Tables) -> DataFrame:
    big = t.orders.where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return P.not_in_table(t.customer, big, "c_custkey")


@query("""
SELECT c_custkey, c_name, n_name, r_name FROM customer
LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""")
def broadcast_lookup(t: Tables) -> DataFrame:
    with_nation = lookup(t.customer, "c_nationkey", t.nation, "n_nationkey", ["n_name", "n_regionkey"])
    return lookup(with_nation, "n_regionkey", t.region, "r_regionkey", ["r_name"]).select("c_custkey", "c_name", "n_name", "r_name")


# --- hashes ---------------------------------------------------------------


@query("""
SELECT event_id, sha256('{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":' || to_json(props)
  || ',"ts":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '","user_id":' || user_id || ',"value":' || value || '}') AS row_hash
FROM events""")
def row_hash(t: Tables) -> DataFrame:
    return with_row_hash(t.events, name="row_hash").select("event_id", "row_hash")


@query("""
SELECT c_custkey, md5(c_name || '|' || coalesce(CAST(nullif(c_nationkey, 7) AS VARCHAR), 'NULL') || '|' || c_mktsegment)
  AS record_hash FROM customer""")
def attribute_hash(t: Tables) -> DataFrame:
    hidden = t.customer.withColumn("c_nationkey", F.nullif("c_nationkey", F.lit(7)))
    return hidden.select("c_custkey", attr_hash(["c_name", "c_nationkey", "c_mktsegment"]).alias("record_hash"))


@query("SELECT * FROM events")
def dedup_rows(t: Tables) -> DataFrame:
    twice = union_all(t.events, t.events)
    return dedup(with_row_hash(twice), ["source_row_hash"]).drop("source_row_hash")


@query("SELECT count(*) AS rows, 16::BIGINT AS buckets FROM events")
def spread_keys(t: Tables) -> DataFrame:
    buckets = t.events.groupBy(spread_key(["event_type", "event_id"], 16).alias("bucket")).count()
    return buckets.agg(F.sum("count").alias("rows"), F.count("bucket").alias("buckets"))


# --- aggregates -----------------------------------------------------------


@query(f"""
SELECT date_trunc('hour', ts) AS "hour", count(*) AS total_trips,
       {avg_sql(f"sum({VALUE_C})", "count(value)", 2)} AS avg_value, CAST(sum(user_id) AS BIGINT) AS total_users
FROM events WHERE ts IS NOT NULL GROUP BY 1""")
def hourly_raw(t: Tables) -> DataFrame:
    return A.hourly_rollup(t.events, "ts", {"avg_value": ("value", 2)}, {"total_users": "user_id"}, scale=2)


@query(f"""WITH {TRIPS_SQL}
SELECT date_trunc('hour', pickup_datetime) AS "hour", count(*) AS total_trips,
       {avg_sql("sum(distance_c)", "count(*)", 2)} AS avg_distance_miles,
       {avg_sql("sum(fare_c)", "count(*)", 2)} AS avg_fare_usd,
       {avg_sql("sum(tip_c)", "count(*)", 2)} AS avg_tip_usd,
       CAST(sum(passenger_count) AS BIGINT) AS total_passengers
FROM staged GROUP BY 1""")
def hourly_staged(t: Tables) -> DataFrame:
    return models.trips_hourly(models.stage_trips(landed_trips(t)))


@query(f"""
SELECT o_orderstatus, o_orderpriority, count(*) AS total_passengers, count(*) FILTER (big) AS survivors,
       CAST((2 * count(*) FILTER (big) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS survival_rate_pct,
       {avg_sql("sum(cents)", "count(*)", 2)} AS avg_price
FROM (SELECT *, o_totalprice > 150000 AS big, {CENTS.format("o_totalprice")} AS cents FROM orders)
GROUP BY ALL""")
def rate_summary_raw(t: Tables) -> DataFrame:
    big = F.col("o_totalprice") > 150000
    return A.rate_summary(
        t.orders, ["o_orderstatus", "o_orderpriority"], big, {"avg_price": ("o_totalprice", 2)}, require="o_totalprice", scale=2
    )


@query(f"""WITH {PASSENGERS_SQL}
SELECT CAST(CASE WHEN pclass IN (1, 2, 3) THEN pclass END AS BIGINT) AS passenger_class_num, sex,
       count(*) AS total_passengers, count(*) FILTER (survived = 1) AS survivors,
       CAST((2 * count(*) FILTER (survived = 1) * 10000 + count(*) FILTER (survived < 2))
            // (2 * count(*) FILTER (survived < 2)) AS DOUBLE) / 100 AS survival_rate_pct,
       {avg_sql("sum(age_c)", "count(*)", 1)} AS avg_age,
       {avg_sql("sum(greatest(fare_c, 0))", "count(*)", 2)} AS avg_fare
FROM passengers WHERE age_c IS NOT NULL GROUP BY 1, 2""")
def rate_summary_staged(t: Tables) -> DataFrame:
    return models.survival_summary(models.stage_passengers(passengers(t)))


@query(f"""WITH {TRIPS_SQL}
SELECT count(*) AS total_trips, {avg_sql("sum(distance_c)", "count(*)", 2)} AS avg_distance,
       {avg_sql("sum(fare_c)", "count(*)", 2)} AS avg_fare, {avg_sql("sum(tip_c)", "count(*)", 2)} AS avg_tip,
       CAST(sum(fare_c) AS DOUBLE) / 100 AS total_revenue, CAST(sum(passenger_count) AS BIGINT) AS total_passengers
FROM trips""")
def fact_stats(t: Tables) -> DataFrame:
    return models.trip_stats(landed_trips(t))


@query("""
SELECT count(*) AS total, count(*) FILTER (c_acctbal > 0) AS survivors,
       CAST((2 * count(*) FILTER (c_acctbal > 0) * 1000 + count(*)) // (2 * count(*)) AS DOUBLE) / 10 AS survival_rate
FROM customer""")
def dim_totals(t: Tables) -> DataFrame:
    return A.dim_totals(t.customer, F.col("c_acctbal") > 0)


@query("""
SELECT c_mktsegment, count(*) AS total, count(*) FILTER (c_acctbal > 0) AS survivors FROM customer GROUP BY 1 ORDER BY 1""")
def by_class(t: Tables) -> DataFrame:
    return A.by_class(t.customer, "c_mktsegment", F.col("c_acctbal") > 0)


@query("""
SELECT bin::BIGINT AS bin, bin * 1.5::DOUBLE AS bin_start, (bin + 1) * 1.5::DOUBLE AS bin_end, count(*) AS rows
FROM (SELECT least(floor(least(greatest(value, 0.0), 60.0) / 1.5), 39) AS bin FROM events) GROUP BY bin""")
def histogram(t: Tables) -> DataFrame:
    return A.histogram(t.events, "value", 0, 60, 40)


@query(f"""
SELECT e.event_type, median(value) AS median, CAST(sum({VALUE_C}) AS DOUBLE) / count(*) AS mean,
       CAST(count(*) FILTER (user_id < 50) AS DOUBLE) / count(*) AS share FROM events e GROUP BY 1""")
def median_mean_share(t: Tables) -> DataFrame:
    medians = exact_median(t.events, "value", ["event_type"])
    rest = A.mean_and_share(t.events, ["event_type"], unscaled("value", 2), F.col("user_id") < 50)
    return medians.join(rest, "event_type")


@query("SELECT CASE WHEN user_id % 3 > 0 THEN user_id % 3 END AS part, median(value) AS median FROM events GROUP BY 1")
def median_with_null_keys(t: Tables) -> DataFrame:
    parts = t.events.withColumn("part", F.when(F.col("user_id") % 3 > 0, F.col("user_id") % 3))
    return exact_median(parts, "value", ["part"], levels=1)


@query("SELECT median(l_extendedprice) AS median FROM lineitem")
def median_by_narrowing(t: Tables) -> DataFrame:
    """The path large tables take, here with two brackets whatever the size."""
    return exact_median(t.lineitem, "l_extendedprice", levels=2)


@query(f"""
SELECT event_type AS task_id, date_trunc('day', ts) AS run_date, CAST(sum({VALUE_C}) AS DOUBLE) / count(*) / 1000 AS avg_duration_seconds,
       CAST(max({VALUE_C}) AS DOUBLE) / 1000 AS max_duration_seconds, count(*) AS run_count,
       count(*) FILTER (event_type = 'error') AS failure_count
FROM events WHERE ts > TIMESTAMP '2024-01-31' - INTERVAL 7 DAY GROUP BY 1, 2""")
def daily_trend(t: Tables) -> DataFrame:
    at = F.lit("2024-01-31").cast("timestamp_ntz")
    trend = A.run_trend(t.events, at, 7, "event_type", "ts", unscaled("value", 2), F.col("event_type") == "error")
    return trend.withColumnRenamed("event_type", "task_id")


@query(f"""
SELECT o_custkey, CAST(sum({CENTS.format("o_totalprice")}) AS DOUBLE) / count(*) AS mean FROM orders GROUP BY 1
ORDER BY mean DESC, o_custkey LIMIT 15""")
def top_groups(t: Tables) -> DataFrame:
    return A.top_groups(t.orders, "o_custkey", unscaled("o_totalprice", 2), 15)


@query("""
WITH p AS (SELECT p_brand, p_type, CAST(round(p_retailprice * 100) AS BIGINT) AS c, p_size FROM part)
SELECT p_brand, p_type, count(*) AS total_readings, CAST((2 * sum(c) + count(*) * 10) // (20 * count(*)) AS DOUBLE) / 10 AS avg_value,
       CAST((2 * min(c) + 10) // 20 AS DOUBLE) / 10 AS min_value, CAST((2 * max(c) + 10) // 20 AS DOUBLE) / 10 AS max_value,
       CAST((2 * sum(p_size) + count(*)) // (2 * count(*)) AS DOUBLE) AS avg_second
FROM p GROUP BY 1, 2""")
def city_summary(t: Tables) -> DataFrame:
    return A.city_summary(t.part, ["p_brand", "p_type"], "p_retailprice", "p_size")


@query(f"""
SELECT date_trunc('day', ts) AS "day", event_type, count(*) AS readings, {avg_sql(f"sum({VALUE_C})", "count(value)", 1)} AS avg_value
FROM events GROUP BY 1, 2""")
def daily_rollup(t: Tables) -> DataFrame:
    return A.daily_rollup(t.events, "ts", ["event_type"], {"avg_value": ("value", 1)})


@query(f"""WITH {PASSENGERS_SQL}
SELECT CAST(pclass AS BIGINT) AS pclass, upper(sex) AS sex, CAST((2 * sum(survived) * 10000 + count(*)) // (2 * count(*)) AS DOUBLE) / 10000 AS mean
FROM passengers GROUP BY ALL""")
def group_mean(t: Tables) -> DataFrame:
    bars = models.survival_rate_bars(passengers(t).withColumn("sex", F.upper("sex")))
    return bars


@query("SELECT max(ts) AS watermark_value FROM events")
def max_watermark(t: Tables) -> DataFrame:
    return A.max_watermark(t.events, "ts")


@query("SELECT l_orderkey, l_linenumber::BIGINT AS l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(t: Tables) -> DataFrame:
    return A.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


# --- windows --------------------------------------------------------------


@query("SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_row(t: Tables) -> DataFrame:
    return latest_per_key(t.events, ["user_id"], ["ts", "event_id"])


@query("""
SELECT event_id, user_id, cents, lag(cents) OVER w AS previous_value, cents - lag(cents) OVER w AS delta
FROM (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def row_delta(t: Tables) -> DataFrame:
    rows = t.events.select("event_id", "user_id", "ts", unscaled("value", 2).alias("cents"))
    return with_delta(rows, ["user_id"], ["ts", "event_id"], "cents").drop("ts")


@query(f"""
WITH d AS (SELECT event_type, date_trunc('day', ts) AS "day", count(*) AS n, CAST(sum({VALUE_C}) AS BIGINT) AS total FROM events GROUP BY 1, 2),
w AS (SELECT *, CAST(sum(n) OVER p AS BIGINT) AS trailing_n, CAST(sum(total) OVER p AS BIGINT) AS trailing_total FROM d
  WINDOW p AS (PARTITION BY event_type ORDER BY "day" RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING))
SELECT event_type, "day", n, total, trailing_n, trailing_total,
       CASE WHEN trailing_n > 0 THEN total * trailing_n * 10 > trailing_total * n * 11 END AS high FROM w""")
def trailing_mean_alert(t: Tables) -> DataFrame:
    daily = trailing_mean(t.events, ["event_type"], "ts", unscaled("value", 2))
    high = F.col("total") * F.col("trailing_n") * 10 > F.col("trailing_total") * F.col("n") * 11
    return daily.withColumn("high", F.when(F.col("trailing_n") > 0, high))


# --- sorting and pages ----------------------------------------------------


@query("SELECT * FROM orders WHERE o_totalprice >= 1000 ORDER BY o_orderdate DESC, o_orderkey LIMIT 20")
def top_recent_rows(t: Tables) -> DataFrame:
    return top_recent(t.orders, "o_orderdate", "o_orderkey", 20, o_totalprice__gte=1000)


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'O' ORDER BY o_orderkey DESC LIMIT 20 OFFSET 40")
def page_rows(t: Tables) -> DataFrame:
    return page(t.orders, ["-o_orderkey"], 20, 40, ["o_orderkey", "o_totalprice"], o_orderstatus="O")[0]


@query("SELECT count(*) AS total, ceil(count(*) / 20)::BIGINT AS pages FROM orders WHERE o_orderstatus = 'O'")
def page_total(t: Tables) -> DataFrame:
    total = page(t.orders, ["-o_orderkey"], 20, 40, o_orderstatus="O")[1]
    return total.withColumn("pages", pages("total", 20))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderkey > 5000 ORDER BY o_orderkey LIMIT 25")
def page_by_key(t: Tables) -> DataFrame:
    return page_after(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 5000, 25)


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 25 OFFSET 9000")
def page_at_depth(t: Tables) -> DataFrame:
    return deep_page(t.orders.select("o_orderkey", "o_totalprice"), "o_orderkey", 25, 9000, descending=True, shallow_rows=500)


@query("""SELECT date_trunc('hour', ts) AS "hour", count(*) AS total_trips FROM events GROUP BY 1 ORDER BY 1 LIMIT 48""")
def first_hours(t: Tables) -> DataFrame:
    return head_buckets(A.hourly_rollup(t.events, "ts", {}, {}), "hour", 48)


# --- catalog and ad hoc ---------------------------------------------------

ALL_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages",
    "benchmark", "labels", "conversations",
]


@query(
    " UNION ALL ".join(
        f"SELECT 'staging' AS schema_name, '{name}' AS table_name, 'table' AS table_type, count(*) AS row_count FROM {name}"
        for name in ALL_TABLES
    )
)
def profile_of_tables(t: Tables) -> DataFrame:
    return table_profile([("staging", name, "table", getattr(t, name)) for name in ALL_TABLES])


@query("""
WITH by_status AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus)
SELECT o_orderstatus, n FROM by_status WHERE n > 100""")
def adhoc_cte(t: Tables) -> DataFrame:
    register_view(t.orders, "orders")
    text = """
        WITH by_status AS (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus)
        SELECT o_orderstatus, n FROM by_status WHERE n > :least"""
    return adhoc(t.spark, text, {"least": 100})


@query("SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def layered_models(t: Tables) -> DataFrame:
    catalog = Catalog(t.spark)
    catalog.add_source("staging", "orders", lambda: t.orders)
    catalog.add_model("finished", "staging", lambda c: c.source("staging", "orders").where("o_orderstatus = 'F'"))
    catalog.add_model(
        "by_priority", "analytics", lambda c: c.ref("finished").groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    )
    return catalog.ref("by_priority")
