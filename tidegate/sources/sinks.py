"""Writers for parquet tables.

A table that is read is never overwritten in place: full replacements go to a fresh
folder that a view then points to; partial ones are staged first and installed slice
by slice from the staged copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.session import staging_path

Arrange = Callable[[DataFrame], DataFrame]
NULL_SLICE = "__HIVE_DEFAULT_PARTITION__"


# --- whole tables ---------------------------------------------------------


def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    writer = _rebalanced(df, partition_by).write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def observed(seen: Observation, *names: str) -> list[int]:
    """Counts that a write has observed. A plan that turns out empty while it runs has no task that could report any: zeros then."""
    try:
        found = seen.get
    except Py4JJavaError as error:
        if "assertion failed" not in str(error.java_exception):
            raise
        found = {}
    return [found.get(n) or 0 for n in names]


def append_counted(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """Append and return the number of rows, counted by the write itself."""
    seen = Observation()
    append(df.observe(seen, F.count(F.lit(1)).alias("n")), path, partition_by)
    return observed(seen, "n")[0]


def land(df: DataFrame, label: str = "load") -> tuple[DataFrame, int]:
    """Write a load to the shared folder and read it back: ``(rows, how many)``.

    What follows reads the copy, so a lost executor does not repeat the work before it.
    """
    return landed(df, staging_path(df.sparkSession, label))


def landed(df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """The same at a path of the caller's, who can :func:`remove` the copy when nothing reads it any more."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), observed(seen, "n")[0]


def write_generation(df: DataFrame, table: str, root: str) -> str:
    """Write a new copy of a table next to the older ones and return its path."""
    path = f"{root.rstrip('/')}/{table}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return path


def repoint(spark: SparkSession, table: str, path: str) -> None:
    """Make the table name read from ``path``; one catalog update, so readers see old or new."""
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM parquet.`{path}`")


def publish(df: DataFrame, table: str, root: str) -> str:
    path = write_generation(df, table, root)
    repoint(df.sparkSession, table, path)
    return path


def drop_generations(spark: SparkSession, table: str, root: str, keep: int = 2) -> None:
    """Remove all but the newest ``keep`` copies of a table; a reader may still be at the one before the last."""
    files, folder = _path(spark, f"{root.rstrip('/')}/{table}")
    found = sorted(files.listStatus(folder), key=lambda s: s.getModificationTime())
    for status in found[: max(0, len(found) - keep)]:
        files.delete(status.getPath(), True)


# --- slices ---------------------------------------------------------------


def write_partitioned(df: DataFrame, ts: str, path: str, column: str = "pickup_date", mode: str = "append") -> None:
    """Table partitioned by the date of ``ts``; ``overwrite`` replaces only the dates present."""
    dated = df.withColumn(column, F.to_date(ts))
    if mode == "append":
        append(dated, path, [column])
    else:
        reload_slices(dated, path, column)


def reload_slices(df: DataFrame, path: str, column: str, arrange: Arrange | None = None) -> None:
    """Replace the slices present in ``df`` with its rows; other slices stay.

    ``df`` must hold each of its slices in full, so running it again is harmless. ``arrange`` deals the rows to files,
    by default by slice.
    """
    (
        (arrange(df) if arrange else _rebalanced(df, [column]))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def replace_slices(df: DataFrame, path: str, column: str, slices: DataFrame) -> str:
    """Stage the new content of the touched slices, then install it. ``df`` may read the table.

    ``slices`` lists them in a column of that name. Returns the staged path, which may be
    removed afterwards. Should the driver be lost while installing, running
    :func:`install_slices` on it again completes the change.
    """
    spark = df.sparkSession
    staged = staging_path(spark, "slices")
    _rebalanced(df, [column]).write.partitionBy(column).parquet(staged)
    install_slices(spark, staged, path, column, slices, df.schema)
    return staged


def install_slices(
    spark: SparkSession, staged: str, path: str, column: str, slices: DataFrame, schema: StructType | None = None, arrange: Arrange | None = None
) -> None:
    """Copy staged slices over those of the table and remove the slices that became empty.

    ``schema`` is the table's; without it a text slice such as ``01`` would be read as a number.
    """
    held = spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)
    fresh = spark.read.schema(held.schema).parquet(staged)
    before = in_slices(held, slices, column).select(column).distinct()
    # Folders of the table, which the driver lists for every read anyway; they come one partition at a time.
    emptied = land(before.exceptAll(fresh.select(column).distinct()), "emptied")[0]
    reload_slices(fresh, path, column, arrange)
    for (value,) in emptied.toLocalIterator():
        remove(spark, f"{path}/{column}={NULL_SLICE if value is None else value}")
    spark.catalog.refreshByPath(path)


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def remove(spark: SparkSession, path: str) -> None:
    files, target = _path(spark, path)
    files.delete(target, True)


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write to this folder has finished."""
    files, target = _path(spark, f"{path}/_SUCCESS")
    return files.exists(target)


def slices_of(df: DataFrame, column: str) -> DataFrame:
    """The slices that occur in ``df``, each once, landed."""
    return land(df.select(column).distinct(), "touched")[0]


def in_slices(table: DataFrame, slices: DataFrame, column: str) -> DataFrame:
    """Rows of the table in exactly the slices listed, however many.

    The range of the slices is a constant that prunes partitions when the query is
    planned; the semi-join does the rest, by partition pruning at run time.
    """
    lo, hi, holes = slices.agg(F.min(column), F.max(column), F.count_if(F.col(column).isNull())).first()
    within = F.lit(False) if lo is None else F.col(column).between(F.lit(lo), F.lit(hi))
    within = within | F.col(column).isNull() if holes else within
    listed = slices.where(within).select(F.col(column).alias("_slice"))
    # A plain equality unless there is a NULL slice: only that one needs the null-safe form.
    same = F.col(column).eqNullSafe(F.col("_slice")) if holes else F.col(column) == F.col("_slice")
    return table.where(within).join(listed, same, "left_semi")


def read_slices(df: DataFrame, path: str, column: str | None) -> DataFrame | None:
    """The part of a table that rows like those of ``df`` can be in; None when there is no table yet."""
    spark = df.sparkSession
    files, target = _path(spark, path)
    if not files.exists(target):
        return None
    table = spark.read.schema(df.schema).parquet(path)
    return table if column is None else in_slices(table, slices_of(df, column), column)


def _rebalanced(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gather each slice in few files; adaptive execution splits slices that are too big for one task."""
    return df.hint("rebalance", *columns) if columns else df
