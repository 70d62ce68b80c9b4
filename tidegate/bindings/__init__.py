"""Operators applied to the given tables, each with the SQL that states its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


class Tables:
    """The parquet tables of one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(sql: str | None = None) -> Callable[[Callable[[Tables], DataFrame]], Callable[[Tables], DataFrame]]:
    """Register ``name(tables)`` under its own name."""

    def register(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        name = build.__name__
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, folder: plain(build(Tables(spark, folder)))
        if sql is not None:
            SQL[name] = sql
        return build

    return register


def plain(df: DataFrame) -> DataFrame:
    """Result types any engine shares: BIGINT, DOUBLE, timestamps without zone."""
    casts = {}
    for name, kind in df.dtypes:
        if kind.startswith("decimal"):
            casts[name] = F.col(name).cast("double")
        elif kind in ("tinyint", "smallint", "int"):
            casts[name] = F.col(name).cast("bigint")
        elif kind == "timestamp":
            casts[name] = F.col(name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


def load_all() -> None:
    """Import every module that registers queries."""
    from tidegate.bindings import basics, batch, metadata, mutation, published, quality, streams, upkeep  # noqa: F401
