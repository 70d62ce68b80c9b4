"""Relational databases through Spark's JDBC source.

Not exercised here: this environment has no database and none may be started.
"""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession


def read_options(url: str, table: str, split: tuple[str, Any, Any, int] | None = None, **extra: str) -> dict[str, str]:
    """Reader options; ``split`` is (column, lower, upper, partitions) for a parallel read."""
    options = {"url": url, "dbtable": table, **extra}
    if split is not None:
        names = ("partitionColumn", "lowerBound", "upperBound", "numPartitions")
        options |= {name: str(value) for name, value in zip(names, split, strict=True)}
    return options


def read_jdbc(
    spark: SparkSession, url: str, table: str, split: tuple[str, Any, Any, int] | None = None, **extra: str
) -> DataFrame:
    return spark.read.format("jdbc").options(**read_options(url, table, split, **extra)).load()


def write_options(url: str, table: str, batchsize: int = 1000, **extra: str) -> dict[str, str]:
    """Writer options; ``truncate`` keeps the table definition on overwrite."""
    return {"url": url, "dbtable": table, "batchsize": str(batchsize), "truncate": "true", **extra}


def write_jdbc(
    df: DataFrame, url: str, table: str, batchsize: int = 1000, mode: str = "append", connections: int = 16, **extra: str
) -> None:
    """Batched inserts from at most ``connections`` tasks at a time."""
    options = write_options(url, table, batchsize, **extra)
    df.coalesce(connections).write.format("jdbc").options(**options).mode(mode).save()
