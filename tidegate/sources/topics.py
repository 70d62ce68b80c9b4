"""JSON topics.

The broker path needs Spark's Kafka package, which is not part of this environment;
tests run the same frames through text files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.hashing import JSON_OPTIONS


def topic_options(servers: str, topic: str, max_per_trigger: int | None = None) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": "earliest"}
    if max_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_events(spark: SparkSession, source: str, options: Mapping[str, str], path: str | None = None) -> DataFrame:
    """A stream with one ``value`` column of raw text, from the beginning of the source."""
    reader = spark.readStream.format(source).options(**options)
    rows = reader.load(path) if path is not None else reader.load()
    return rows.select(F.col("value").cast("string").alias("value"))


def keyed_messages(df: DataFrame, key: str | None) -> DataFrame:
    """Rows as ``(key, value)``: value is the row as JSON; the key is text, NULL when NULL, zero or empty."""
    value = F.to_json(F.struct("*"), {**JSON_OPTIONS, "ignoreNullFields": "false"}).alias("value")
    if key is None:
        return df.select(F.lit(None).cast("string").alias("key"), value)
    text = F.col(key).cast("string")
    return df.select(F.when(~text.isin("", "0"), text).alias("key"), value)


def write_events(df: DataFrame, servers: str, topic: str, key: str | None = None, **producer: str) -> None:
    """Send a batch; waits for all replicas unless told otherwise."""
    settings = {"acks": "all", "retries": "3", "batch.size": "16384", "linger.ms": "10", **producer}
    options = {"kafka.bootstrap.servers": servers, "topic": topic, **{f"kafka.{k}": v for k, v in settings.items()}}
    keyed_messages(df, key).write.format("kafka").options(**options).save()
