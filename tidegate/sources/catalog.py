"""Layered names: declared sources, models that refer to each other, views, profiles."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegate.functions.scalars import size_pretty
from tidegate.operators.shape import concat

LAYERS = ("staging", "analytics", "orchestration")


def view_name(table: str, layer: str | None = None) -> str:
    """``layer__table``; without a layer the default one is used."""
    return f"{(layer or LAYERS[0]).strip()}__{table}"


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Replaceable, not materialised."""
    df.createOrReplaceTempView(name)
    return df


class Catalog:
    """Sources by layer and models by name; a model is a function of the catalog."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._models: dict[str, tuple[str, Callable[[Catalog], DataFrame]]] = {}
        self._sources: dict[tuple[str, str], Callable[[], DataFrame]] = {}

    def add_source(self, layer: str, table: str, read: Callable[[], DataFrame]) -> None:
        self._sources[layer, table] = read

    def add_model(self, name: str, layer: str, build: Callable[[Catalog], DataFrame]) -> None:
        self._models[name] = (layer, build)

    def source(self, layer: str, table: str) -> DataFrame:
        return register_view(self._sources[layer, table](), view_name(table, layer))

    def ref(self, model: str) -> DataFrame:
        layer, build = self._models[model]
        return register_view(build(self), view_name(model, layer))

    def names(self) -> list[tuple[str, str]]:
        models = [(layer, name) for name, (layer, _) in self._models.items()]
        return sorted([*self._sources, *models])


def table_profile(tables: Iterable[tuple[str, str, str, DataFrame]]) -> DataFrame:
    """Row counts of ``(layer, table, type, frame)`` as one query, one exact count each."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("schema_name"), F.lit(name).alias("table_name"), F.lit(kind).alias("table_type"), "row_count"
        )
        for layer, name, kind, df in tables
    ]
    return concat(counts).orderBy("schema_name", "table_type", "table_name")


def table_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Stored bytes per table from the file listing; no data is read."""
    sizes = [
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.lit(name).alias("table_name"), "length")
        for name, path in paths.items()
    ]
    total = concat(sizes).groupBy("table_name").agg(F.sum("length").alias("total_bytes"))
    return total.withColumn("total_size", size_pretty("total_bytes")).orderBy("table_name")


def layer_listing(spark: SparkSession, layers: Iterable[str] = (*LAYERS, "default")) -> DataFrame:
    """Which of the layers exist as schemas."""
    wanted = set(layers)
    rows = [(db.name,) for db in spark.catalog.listDatabases() if db.name in wanted]
    return spark.createDataFrame(sorted(rows), "schema_name string")
