"""Run queries and their SQL side by side: ``python tests/oracle_check.py [folder] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
import traceback

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, folder, name, build, sql):
    """None when both agree, else what differs."""
    df = build(spark, folder)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return None
    result = con.execute(sql)
    want = rows_of([d[0] for d in result.description], result.fetchall())
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if got[1] != want[1]:
        extra = sorted(set(got[1]) - set(want[1]))[:3]
        missing = sorted(set(want[1]) - set(got[1]))[:3]
        return f"{len(got[1])} rows against {len(want[1])}\n   columns {got[0]}\n   only Spark {extra}\n   only SQL   {missing}"
    return None


def main() -> int:
    from tidegate.session import session

    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    wanted = sys.argv[2:]
    spark = session(master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con, sql, failed = connect(folder), entry.oracle_sql(), []
    for name, build in entry.queries().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            problem = compare(spark, con, folder, name, build, sql.get(name))
        except Exception as error:  # noqa: BLE001
            problem = "".join(traceback.format_exception_only(error))[:1500]
        print(f"{'FAIL' if problem else 'ok  '} {time.time() - start:6.2f}s {name}{'' if name in sql else ' (no SQL)'}", flush=True)
        if problem:
            failed.append(name)
            print("  ", problem, flush=True)
    print(f"{len(failed)} failed: {' '.join(failed)}")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
