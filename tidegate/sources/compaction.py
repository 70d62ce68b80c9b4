"""Compaction of partitioned tables: few files a slice, rows clustered by several columns at once.

Streams and small loads leave many small files. Slices that have more files than their bytes ask for are
rewritten, all others are left alone. Inside a slice rows follow a curve that interleaves the bits of the
clustering columns, so files and row groups are narrow in every one of these columns and a filter on any of them skips most.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidegate.session import staging_path
from tidegate.sources import sinks

FILE_BYTES = 128 << 20
#: Bits of each column that are interleaved.
BITS = 16


def file_sizes(spark: SparkSession, path: str, slice_column: str) -> DataFrame:
    """``slice, file, bytes`` of a partitioned parquet table. Lists files; reads none of them."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
    folder = F.regexp_extract("path", f"/{slice_column}=([^/]*)/", 1)
    return listed.select(folder.alias("folder"), F.col("path").alias("file"), F.col("length").alias("bytes"))


def crowded(spark: SparkSession, path: str, slice_column: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Folders of slices with more files than their bytes fill: ``folder, files, bytes, wanted``."""
    totals = file_sizes(spark, path, slice_column).groupBy("folder").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    return totals.withColumn("wanted", F.ceil(F.col("bytes") / F.lit(file_bytes)).cast("int")).where("files > wanted")


def _position(c: str, kind: str, low, high) -> Column:
    """A number's or time's place in its range, in ``BITS`` bits; NULL is the lowest."""
    value = F.col(c).cast("timestamp").cast("double") if kind.startswith("timestamp") or kind == "date" else F.col(c).cast("double")
    if low is None or high is None or not low < high:
        return F.lit(0)
    place = F.floor((value - F.lit(float(low))) / F.lit(float(high) - float(low)) * ((1 << BITS) - 1)).cast("bigint")
    return F.coalesce(F.least(F.greatest(place, F.lit(0)), F.lit((1 << BITS) - 1)), F.lit(0))


def interleaved(positions: Sequence[Column]) -> Column:
    """Bits of all positions in turn, highest first; at most three columns fit a BIGINT."""
    n = len(positions)
    if n * BITS > 63:
        raise ValueError(f"at most {63 // BITS} columns")
    parts = [F.shiftleft(F.shiftright(p, bit).bitwiseAND(F.lit(1)).cast("bigint"), bit * n + n - 1 - i) for i, p in enumerate(positions) for bit in range(BITS)]
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def compact(spark: SparkSession, path: str, slice_column: str, cluster_by: Sequence[str], file_bytes: int = FILE_BYTES) -> int:
    """Rewrite crowded slices of a parquet table partitioned by ``slice_column``; returns how many there were.

    Clustering columns are numbers, dates or times. A slice is written in as many files as its bytes ask for, by ranges of the curve,
    so no task holds more than a file. As with other changes of slices the new content is staged in full before it replaces the old.
    """
    found = sinks.land(crowded(spark, path, slice_column, file_bytes), "crowded")[0]
    n, files = found.agg(F.count(F.lit(1)), F.sum("wanted")).first()
    if not n:
        return 0
    table = spark.read.parquet(path)
    folders = table.select(F.regexp_extract(F.col("_metadata.file_path"), f"/{slice_column}=([^/]*)/", 1).alias("folder"), slice_column).distinct()
    touched = sinks.land(folders.join(found, "folder", "left_semi").select(slice_column), "touched")[0]
    rows = sinks.in_slices(table, touched, slice_column)
    kinds = dict(table.dtypes)
    ranges = rows.agg(*[f(F.col(c).cast("timestamp").cast("double") if kinds[c].startswith("timestamp") or kinds[c] == "date" else F.col(c).cast("double")) for c in cluster_by for f in (F.min, F.max)]).first()
    curve = interleaved([_position(c, kinds[c], ranges[2 * i], ranges[2 * i + 1]) for i, c in enumerate(cluster_by)])

    def arranged(df: DataFrame) -> DataFrame:
        order = [slice_column, "_curve"]
        return df.withColumn("_curve", curve).repartitionByRange(int(files), *order).sortWithinPartitions(*order).drop("_curve")

    staged = staging_path(spark, "compacted")
    arranged(rows).write.partitionBy(slice_column).parquet(staged)
    sinks.install_slices(spark, staged, path, slice_column, touched, StructType(table.schema.fields), arranged)
    sinks.remove(spark, staged)
    return n
