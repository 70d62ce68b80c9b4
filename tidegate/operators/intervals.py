"""Point-in-interval joins where intervals of a key may overlap.

Every interval is put into time bins as wide as itself or up to four times wider, so it covers two of them at most, and a
moment looks into one bin of every width that occurs. The join is an equality on key, width and
bin with the range as a filter: no moment meets intervals of its key that are far from it, and no pairs within
a key are formed. Long intervals lie in wide bins, open ones in a single one of the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The narrowest bin, and how much wider the next one is.
NARROWEST, STEP = 60_000_000, 4
#: Beyond level 18 a bin would be longer than all timestamps: level 19 is one bin, for intervals without an end.
WIDEST, ENDLESS = 18, 19


def _width(level: Column) -> Column:
    return (F.lit(NARROWEST).cast("double") * F.pow(F.lit(float(STEP)), level)).cast("bigint")


def _micros(c: str) -> Column:
    return F.unix_micros(F.col(c).cast("timestamp"))


def _bin(micros: Column, level: Column) -> Column:
    """Number of the bin."""
    return F.when(level > WIDEST, F.lit(0).cast("bigint")).otherwise(F.floor(micros / _width(F.least(level, F.lit(WIDEST)))).cast("bigint"))


def valid_versions(
    fact: DataFrame,
    dim: DataFrame,
    key: tuple[str, str],
    ts: str,
    attrs: Sequence[str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
) -> DataFrame:
    """Each fact with the attributes of every version valid at its time: one row per pair, none without a version.

    ``key`` names the key in the fact and in the dimension. A version holds from ``valid_from`` up to, not
    including, ``valid_to``; NULL there means open. Empty and reversed intervals, NULL keys and NULL times match nothing.
    """
    fact_key, dim_key = key
    start, end = _micros(valid_from), _micros(valid_to)
    fit = F.ceil(F.greatest(F.log(float(STEP), (end - start) / F.lit(float(NARROWEST))), F.lit(0.0))).cast("int")
    level = F.when(F.col(valid_to).isNull(), F.lit(ENDLESS)).otherwise(F.least(fit, F.lit(ENDLESS)))
    sound = F.col(valid_from).isNotNull() & (F.col(valid_to).isNull() | (F.col(valid_to) > F.col(valid_from)))
    leveled = dim.where(sound & F.col(dim_key).isNotNull()).select(
        F.col(dim_key).alias("_key"), start.alias("_start"), end.alias("_end"), level.alias("_level"), F.struct(*attrs).alias("_attrs")
    )
    last = F.when(F.col("_end").isNull(), F.col("_start")).otherwise(F.col("_end") - 1)
    bins = F.sequence(_bin(F.col("_start"), F.col("_level")), _bin(last, F.col("_level")))
    versions = leveled.select("*", F.explode(bins).alias("_bin"))
    levels = sorted(r[0] for r in leveled.select("_level").distinct().collect())  # 20 numbers at most
    timed = fact.withColumns({"_fact_key": F.col(fact_key), "_at": _micros(ts)})
    moments = timed.withColumn("_at_level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
    moments = moments.withColumn("_at_bin", _bin(F.col("_at"), F.col("_at_level")))
    same = (F.col("_fact_key") == F.col("_key")) & (F.col("_at_level") == F.col("_level")) & (F.col("_at_bin") == F.col("_bin"))
    inside = (F.col("_start") <= F.col("_at")) & (F.col("_end").isNull() | (F.col("_end") > F.col("_at")))
    return moments.join(versions, same & inside).select(*fact.columns, *[F.col(f"_attrs.{a}").alias(a) for a in attrs])
