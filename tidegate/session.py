"""Session settings and the shared folder for staged data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
}

#: For jobs that pass a whole file through several steps; the last because a compressed file is read as many lines a byte.
LEAN_SETTINGS = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.files.maxPartitionBytes": "16m",
}


def session(app_name: str = "tidegate", master: str | None = None, **settings: str) -> SparkSession:
    """Build (or reuse) a session with the library's defaults.

    Shuffle parallelism is left to the cluster: adaptive execution merges small
    shuffle partitions, so the configured number only has to be large enough.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder every executor can reach.

    The folder is the one the cluster names in ``spark.checkpoint.dir``. Only a
    local session without that setting may use a temporary folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="tidegate-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def lean_on_disk(spark: SparkSession) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind and write smaller parquet files; the settings found are put back.

    Otherwise the files of every shuffle stay until the driver happens to collect garbage, so the steps of a job add up.
    Parts of compressed text files stay small, as what a task aggregates would not fit its memory and be spilled.
    """
    before = {key: spark.conf.get(key, None) for key in LEAN_SETTINGS}
    try:
        for key, value in LEAN_SETTINGS.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
