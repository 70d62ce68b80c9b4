"""Training rows for the classifiers: labelled documents outside the held-out fold, in bounded number."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidegate.sources.sinks import land

FOLDS, HELD_OUT = 4, 2


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id as text, modulo 4, is 2. A NULL id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def training_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """``(sample, rows of each class)``: ``doc_id, text, label`` of at most ``per_class`` rows of each class.

    Ids are taken in the order of a hash, so the sample does not depend on partitions. Only the labels are
    ordered for it; the documents are scanned once with the at most ``2 * per_class`` ids broadcast. Several rows may
    have a labelled id: equal ones (id and text) count once, and of the others the
    first ``per_class`` of a class in the order of a hash of id and text stay, so the bound holds for rows as well.
    The sample is landed in the shared folder. The class sizes are those of all training labels.
    Labels other than 0 and 1 and NULL ids are left out.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(target).isin(0, 1) & ~held_out(id_col)).select(F.col(id_col).alias("doc_id"), F.col(target).cast("int").alias("label"))
    sizes = {row.label: row.n for row in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    ids = picked[0].unionByName(picked[1]).groupBy("doc_id").agg(F.max("label").alias("label"))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(ids), "doc_id")
    hashed = rows.withColumn("row_hash", F.xxhash64("doc_id", F.coalesce("text", F.lit(""))))
    # Repeated rows are combined in the tasks, so not even a hot id gathers its rows.
    found = land(hashed.groupBy("doc_id", "label", "row_hash").agg(F.first("text").alias("text")), "labelled")[0]
    keys = found.select("doc_id", "label", "row_hash")
    first = [keys.where(F.col("label") == c).orderBy("row_hash", "doc_id").limit(per_class) for c in (0, 1)]
    kept = found.join(F.broadcast(first[0].unionByName(first[1])), ["doc_id", "label", "row_hash"], "left_semi")
    return land(kept.select("doc_id", "text", "label"), "sample")[0], sizes
