"""Upserts, patches, deletes, versions and loads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.bindings import Tables, query
from tidegate.bindings.shapes import RUNS_SQL, VERSIONS_SQL, runs, versions
from tidegate.operators import history as H
from tidegate.operators.mutate import delete_keys, fold_patches, patch, seed, upsert, upsert_counts
from tidegate.operators.shape import union_all
from tidegate.operators.windows import assign_ids, with_next
from tidegate.plans import loads
from tidegate.plans.runs import mark_finished
from tidegate.session import staging_path
from tidegate.sources import sinks

BALANCES_SQL = """
changes AS (
  SELECT o_custkey AS c_custkey, o_totalprice AS c_acctbal FROM orders
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
  UNION ALL SELECT -1 - s_suppkey, s_acctbal FROM supplier
)"""


def balances(t: Tables) -> DataFrame:
    """Every order as a new balance of its customer, every supplier as a new customer."""
    orders = t.orders.select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), F.col("o_orderdate").alias("_at"),
        F.col("o_orderkey").alias("_seq"),
    )
    suppliers = t.supplier.select((-1 - F.col("s_suppkey")).alias("c_custkey"), F.col("s_acctbal").alias("c_acctbal"))
    return union_all(orders, suppliers)


@query(f"""WITH {BALANCES_SQL}
SELECT c.c_custkey, c.c_name, c.c_nationkey::BIGINT AS c_nationkey, coalesce(h.c_acctbal, c.c_acctbal) AS c_acctbal, c.c_mktsegment
FROM customer c LEFT JOIN changes h USING (c_custkey)
UNION ALL SELECT h.c_custkey, NULL, NULL, h.c_acctbal, NULL FROM changes h ANTI JOIN customer USING (c_custkey)""")
def upsert_update(t: Tables) -> DataFrame:
    return upsert(t.customer, balances(t), ["c_custkey"], "update", ["_at", "_seq"])


@query(f"""WITH {BALANCES_SQL}
SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, c_acctbal, c_mktsegment FROM customer
UNION ALL SELECT h.c_custkey, NULL, NULL, h.c_acctbal, NULL FROM changes h ANTI JOIN customer USING (c_custkey)""")
def upsert_ignore(t: Tables) -> DataFrame:
    return upsert(t.customer, balances(t), ["c_custkey"], "ignore", ["_at", "_seq"])


@query(f"""WITH {BALANCES_SQL},
counts AS (SELECT count(*) AS keys, count(c.c_custkey) AS matched FROM changes h LEFT JOIN customer c USING (c_custkey))
SELECT (SELECT count(*) FROM orders) + (SELECT count(*) FROM supplier) AS source_rows, keys - matched AS inserted, matched,
       (SELECT count(*) FROM orders) + (SELECT count(*) FROM supplier) - keys AS repeats FROM counts""")
def upsert_report(t: Tables) -> DataFrame:
    return upsert_counts(t.customer, balances(t), ["c_custkey"])


@query("""
SELECT c_custkey, c_name, c_nationkey::BIGINT AS c_nationkey, CASE WHEN c_nationkey < 8 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_nationkey BETWEEN 8 AND 15 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer""")
def patch_rows(t: Tables) -> DataFrame:
    changes = t.customer.select(
        "c_custkey",
        F.lit("ignored").alias("c_name"),
        (F.col("c_acctbal") + 1).alias("c_acctbal"),
        F.lit(None).cast("string").alias("c_mktsegment"),
        F.expr("CASE WHEN c_nationkey < 8 THEN array('c_acctbal') WHEN c_nationkey < 16 THEN array('c_mktsegment', 'c_name') END").alias(
            "set_cols"
        ),
    )
    return patch(t.customer, changes, "c_custkey", ["c_acctbal", "c_mktsegment"])


@query("""
SELECT o_custkey, max_by(o_totalprice, o_orderkey) FILTER (o_orderstatus <> 'P') AS o_totalprice,
       max_by(o_orderpriority, o_orderkey) FILTER (o_orderstatus <> 'F') AS o_orderpriority,
       concat_ws(',', CASE WHEN bool_or(o_orderstatus <> 'P') THEN 'o_totalprice' END,
                      CASE WHEN bool_or(o_orderstatus <> 'F') THEN 'o_orderpriority' END) AS named
FROM orders GROUP BY 1""")
def folded_patches(t: Tables) -> DataFrame:
    names = F.expr(
        "CASE o_orderstatus WHEN 'F' THEN array('o_totalprice') WHEN 'P' THEN array('o_orderpriority') "
        "ELSE array('o_totalprice', 'o_orderpriority') END"
    )
    changes = t.orders.withColumn("set_cols", names)
    folded = fold_patches(changes, "o_custkey", ["o_totalprice", "o_orderpriority"], "o_orderkey")
    return folded.withColumn("named", F.array_join("set_cols", ",")).drop("set_cols")


def overdrawn(t: Tables) -> DataFrame:
    return t.customer.where("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))


@query("SELECT * FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def delete_kept(t: Tables) -> DataFrame:
    return delete_keys(t.orders, overdrawn(t), "o_custkey")[0]


@query("SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)")
def deleted_rows(t: Tables) -> DataFrame:
    return delete_keys(t.orders, overdrawn(t), "o_custkey")[1]


@query("SELECT n_nationkey::BIGINT AS key, n_name AS name FROM nation UNION SELECT r_regionkey + 100, r_name FROM region")
def seed_twice(t: Tables) -> DataFrame:
    nations = t.nation.select(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    regions = t.region.select((F.col("r_regionkey") + 100).alias("key"), F.col("r_name").alias("name"))
    return seed(seed(nations, regions, ["key"]), regions, ["key"])


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS id FROM customer")
def consecutive_ids(t: Tables) -> DataFrame:
    return assign_ids(t.customer, ["c_mktsegment", "c_custkey"]).select("c_custkey", "id")


# --- versions -------------------------------------------------------------


@query(f"WITH {VERSIONS_SQL} SELECT * REPLACE (c_nationkey::BIGINT AS c_nationkey) FROM versions")
def scd2_merge(t: Tables) -> DataFrame:
    return versions(t).select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment", "record_hash", "valid_from", "valid_to", "is_current"
    )


@query(f"WITH {VERSIONS_SQL} SELECT c_custkey, c_mktsegment, valid_from AS effective_from FROM versions WHERE is_current")
def scd2_current(t: Tables) -> DataFrame:
    return H.scd2_current(versions(t)).select("c_custkey", "c_mktsegment", "effective_from")


@query(f"""WITH {VERSIONS_SQL}
SELECT c_custkey, c_mktsegment, valid_from, coalesce(valid_to, TIMESTAMP '9999-12-31 23:59:59.999999') AS valid_until, is_current,
       row_number() OVER (PARTITION BY c_custkey ORDER BY valid_from) AS version_number FROM versions""")
def scd2_history(t: Tables) -> DataFrame:
    return H.scd2_history(versions(t), "c_custkey").select(
        "c_custkey", "c_mktsegment", "valid_from", "valid_until", "is_current", "version_number"
    )


@query(f"""WITH {VERSIONS_SQL}
SELECT c_custkey, c_mktsegment FROM versions
WHERE valid_from <= TIMESTAMP '1998-01-01' AND (valid_to IS NULL OR valid_to > TIMESTAMP '1998-01-01')""")
def scd2_as_of(t: Tables) -> DataFrame:
    return H.scd2_as_of(versions(t), F.lit("1998-01-01").cast("timestamp")).select("c_custkey", "c_mktsegment")


@query(f"""WITH {VERSIONS_SQL}
SELECT o_orderkey, o_custkey, o_orderdate, v.c_mktsegment FROM orders LEFT JOIN versions v
  ON o_custkey = c_custkey AND valid_from <= o_orderdate AND (valid_to IS NULL OR valid_to > o_orderdate)""")
def as_of_join(t: Tables) -> DataFrame:
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return H.as_of_join(orders, versions(t), ("o_custkey", "c_custkey"), "o_orderdate", ["c_mktsegment"], "o_orderkey", short_histories=True)


@query("""
WITH v AS (SELECT user_id, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS valid_to, event_id AS signup_id
           FROM events WHERE event_type = 'signup')
SELECT e.event_id, e.user_id, e.ts, v.signup_id FROM events e LEFT JOIN v
  ON e.user_id = v.user_id AND v.valid_from <= e.ts AND (v.valid_to IS NULL OR v.valid_to > e.ts)""")
def as_of_long_history(t: Tables) -> DataFrame:
    """Every sign-up opens a version of its user; histories are merged by time."""
    signups = t.events.where("event_type = 'signup'").selectExpr("user_id", "ts AS valid_from", "event_id AS signup_id")
    dim = with_next(signups, ["user_id"], ["valid_from", "signup_id"], {"valid_to": "valid_from"})
    facts = t.events.select("event_id", "user_id", "ts")
    return H.as_of_join(facts, dim, ("user_id", "user_id"), "ts", ["signup_id"], "event_id")


# --- loads ----------------------------------------------------------------


@query("SELECT * FROM events")
def append_in_two_loads(t: Tables) -> DataFrame:
    """The older half of the time range, then everything: the table holds each row once."""
    path = staging_path(t.spark, "events")
    dated = t.events.withColumn("day", F.to_date("ts"))
    loads.append_new(dated.where("ts <= TIMESTAMP '2024-01-16'"), path, ["event_id"], "day")
    loads.append_new(dated, path, ["event_id"], "day")
    return t.spark.read.parquet(path).drop("day")


@query("""
SELECT event_id, ts, user_id, event_type, CASE WHEN ts >= TIMESTAMP '2024-01-20' THEN value + 1 ELSE value END AS value, props FROM events""")
def merge_touched_slices(t: Tables) -> DataFrame:
    """Corrections to the later days rewrite those days only."""
    path = staging_path(t.spark, "events")
    sinks.write_partitioned(t.events, "ts", path, "day")
    fixes = t.events.where("ts >= TIMESTAMP '2024-01-20'").withColumns({"value": F.col("value") + 1, "day": F.to_date("ts")})
    loads.merge_slices(fixes, path, ["event_id"], "day")
    return t.spark.read.parquet(path).drop("day")


@query("SELECT event_id, CASE WHEN user_id % 3 = 0 THEN 'moved' WHEN user_id % 3 = 1 THEN event_type END AS kind, value FROM events")
def merge_text_slices(t: Tables) -> DataFrame:
    """Text slices, one of them NULL: a third of the users moves to a new slice, a third to none."""
    path = staging_path(t.spark, "kinds")
    rows = t.events.select("event_id", F.col("event_type").alias("kind"), "value", "user_id")
    sinks.append(rows.drop("user_id"), path, ["kind"])
    moved = rows.where("user_id % 3 <> 1").withColumn("kind", F.expr("CASE WHEN user_id % 3 = 0 THEN 'moved' END")).drop("user_id")
    loads.merge_slices(moved, path, ["event_id"], "kind")
    return t.spark.read.schema(moved.schema).parquet(path)


@query("SELECT * FROM orders")
def full_refresh(t: Tables) -> DataFrame:
    """Three generations with other totals go before; two copies stay."""
    root = staging_path(t.spark, "tables")
    for factor in (2, 3, 4):
        loads.full_refresh(t.orders.withColumn("o_totalprice", F.col("o_totalprice") * factor), "refreshed_orders", root)
    loads.full_refresh(t.orders, "refreshed_orders", root)
    return t.spark.table("refreshed_orders")


@query(f"""WITH {RUNS_SQL}
SELECT dag_id, task_id, run_id, 'success' AS status, started_at, started_at + INTERVAL 90 SECOND AS ended_at, 90.0::DOUBLE AS duration_seconds,
       rows_ingested + 1 AS rows_ingested FROM runs WHERE status = 'running'
UNION ALL SELECT dag_id, task_id, run_id, status, started_at, ended_at, CAST(duration_ms AS DOUBLE) / 1000, rows_ingested
FROM runs WHERE status <> 'running'""")
def run_log_finish(t: Tables) -> DataFrame:
    log = runs(t)
    ends = log.where("status = 'running'").select(
        "dag_id", "task_id", "run_id", F.lit("success").alias("status"), (F.col("started_at") + F.expr("INTERVAL 90 SECOND")).alias("ended_at"),
        F.lit(None).cast("string").alias("error_message"), (F.col("rows_ingested") + 1).alias("rows_ingested"),
    )
    return mark_finished(log, ends).drop("error_message", "created_at", "updated_at")


