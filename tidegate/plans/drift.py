"""History of validation results and of value profiles, and what changes from run to run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidegate.operators.aggregates import histogram


def profile(df: DataFrame, column: str, lo: float, hi: float, bins: int, run_id: str, now: Column) -> DataFrame:
    """Histogram of a column as rows of a history table: ``column, run_id, checked_at, bins, bin, rows``."""
    stamps = [F.lit(column).alias("column"), F.lit(run_id).alias("run_id"), now.alias("checked_at"), F.lit(bins).alias("bins")]
    return histogram(df, column, lo, hi, bins).select(*stamps, "bin", "rows")


def drift(history: DataFrame, base_run: str | None = None) -> DataFrame:
    """Population stability index of every stored profile: ``column, run_id, checked_at, against, psi``.

    Each run is compared with the run before it of the same column, or with ``base_run``. Half a row is added to
    every bin, so bins that are empty on one side count without dividing by zero. Below 0.1 is usually
    read as stable, above 0.25 as a shift. The first run, which has nothing before it, has NULL. One profile is ``bins`` rows, so this stays small.
    """
    runs = history.groupBy("column", "run_id", "checked_at", "bins").agg(F.sum("rows").alias("total"))
    if base_run is None:
        order = Window.partitionBy("column").orderBy("checked_at", "run_id")
        paired = runs.withColumn("against", F.lag("run_id").over(order))
    else:
        paired = runs.withColumn("against", F.when(F.col("run_id") != base_run, F.lit(base_run)))
    # Every bin of every run, empty ones too.
    grid = paired.select("*", F.explode(F.sequence(F.lit(0), F.col("bins") - 1)).alias("bin"))
    counts = history.select("column", "run_id", F.col("bin").alias("bin"), "rows")
    own = grid.join(counts, ["column", "run_id", "bin"], "left")
    other = counts.select("column", F.col("run_id").alias("against"), "bin", F.col("rows").alias("rows_before"))
    totals = runs.select("column", F.col("run_id").alias("against"), F.col("total").alias("total_before"))
    both = own.join(other, ["column", "against", "bin"], "left").join(totals, ["column", "against"], "left")
    smooth = lambda rows, total: (F.coalesce(F.col(rows), F.lit(0)) + 0.5) / (F.col(total) + F.col("bins") * 0.5)
    p, q = smooth("rows", "total"), smooth("rows_before", "total_before")
    index = both.groupBy("column", "run_id", "checked_at", "against").agg(F.sum((p - q) * F.log(p / q)).alias("psi"))
    return index.withColumn("psi", F.when(F.col("against").isNotNull(), F.round("psi", 6)))


def check_trend(results: DataFrame) -> DataFrame:
    """Every recorded check result next to its past: ``observed_before, change, failures_in_a_row``.

    ``results`` are the rows of :func:`tidegate.operators.quality.record_results`, appended run by run.
    """
    order = Window.partitionBy("suite", "check", "column").orderBy("checked_at", "run_id")
    # Failures since the last success: runs between two successes are one streak.
    streak = F.sum(F.col("success").cast("int")).over(order)
    marked = results.withColumns({"observed_before": F.lag("observed").over(order), "_streak": streak})
    within = Window.partitionBy("suite", "check", "column", "_streak").orderBy("checked_at", "run_id")
    failures = F.sum((~F.col("success")).cast("bigint")).over(within)
    return marked.withColumns({"change": F.col("observed") - F.col("observed_before"), "failures_in_a_row": failures}).drop("_streak")
