"""Exact deduplication with two passes over a blocked Bloom filter.

Texts are equal when identical after deleting the blanks (space, U+0009 to U+000D).

Pass 1 gives every text a word of the filter and three bits in it, from a 64-bit hash, and
counts the rows of each (word, bits) pair. Few pairs repeat inside a task, so about one pair of
16 bytes a row is shuffled here, but no text. The pairs that several rows have are OR-ed into the filter. Pass 2 probes it: a row whose bits are not all set has
no equal and passes straight through, without a shuffle. Only the possible repeats shuffle,
are grouped by SHA-256 and meet the row that stays.

The filter has about 32 bits a row and 8 MB at most. Beyond that more rows are taken for
possible repeats and shuffle; the result is the same. Groups are combined before the shuffle,
and the groups are dealt anew for the join back, so that adaptive execution can split the
rows of a hot group.

Of equal texts the row with the most code points in the original text stays, then the one
with the smallest id, NULL ids last. Rows that agree in all of this are repeated rows; exactly
one of them stays, the least by a number that each gets in a landed copy, so no task gathers them. NULL texts count as empty. A row without an equal is a group of one; an
empty table gives no rows. Columns of ``docs`` named like a result are replaced, all others are kept whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm import bloom
from tidegate.llm.common import blankless
from tidegate.operators.shape import compute_once
from tidegate.sources.sinks import land

RESULTS = ("keep_id", "group_size", "kept", "text_sha256")


def marked(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``keep_id, group_size, kept, text_sha256``; ids are integers."""
    docs = docs.drop(*[c for c in RESULTS if c in docs.columns])
    own = "__"
    while any(c.startswith(own) for c in docs.columns):
        own += "_"
    words = bloom.filter_words(docs.count())
    plain = blankless(F.col(text))

    pairs = compute_once(docs.select(F.col(text)), {"hash": F.xxhash64(plain)}).select(*[c.alias(n) for n, c in bloom.place(F.col("hash"), words).items()])
    repeated = pairs.groupBy("word", "mask").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    held = bloom.dense(repeated, words).scalar()

    probed = compute_once(docs, {f"{own}plain": plain, f"{own}len": F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long")})
    probed = compute_once(probed, {f"{own}hash": F.xxhash64(f"{own}plain"), "text_sha256": F.sha2(F.col(f"{own}plain").cast("binary"), 256)}).drop(f"{own}plain")
    probed = probed.withColumn(f"{own}maybe", bloom.may_hold(held, **bloom.place(F.col(f"{own}hash"), words)))

    alone = probed.where(f"NOT {own}maybe").withColumns({"keep_id": F.col(id_col), "group_size": F.lit(1).cast("long"), "kept": F.lit(True)})
    maybe = probed.where(f"{own}maybe")
    place = F.struct(F.col(f"{own}len").alias("len"), F.col(id_col).isNotNull().alias("known"), F.coalesce(F.bitwise_not(F.col(id_col)), F.lit(0)).cast("long").alias("smaller"))
    # Rows of the same place first, then groups: the best place of a group comes with its number of rows.
    placed = maybe.groupBy(F.unhex("text_sha256").alias(f"{own}sha"), place.alias("place")).agg(F.count(F.lit(1)).alias("rows"))
    groups = placed.groupBy(f"{own}sha").agg(F.sum("rows").alias("group_size"), F.max(F.struct("place", "rows")).alias(f"{own}best"))
    # The key as text: not the key that the groups are dealt by, so the join deals both sides and can split them.
    groups = groups.select(F.lower(F.hex(f"{own}sha")).alias("text_sha256"), "group_size", f"{own}best")

    def joined(those: DataFrame) -> DataFrame:
        out = maybe.join(those, "text_sha256").withColumn("kept", place == F.col(f"{own}best.place"))
        return out.withColumn("keep_id", F.when(F.col(f"{own}best.place.known"), F.bitwise_not(F.col(f"{own}best.place.smaller"))).cast(dict(docs.dtypes)[id_col])).drop(f"{own}best")

    groups, _ = land(groups, "groups")
    several = groups.where(f"{own}best.rows > 1")
    out = alone.unionByName(joined(groups.where(f"{own}best.rows = 1")))
    if not several.isEmpty():
        tied = joined(several)
        # Numbered in the landed copy, so that both uses below see the same numbers.
        numbered, _ = land(tied.where("kept").withColumn(f"{own}row", F.monotonically_increasing_id()), "tied")
        least = numbered.groupBy(F.unhex("text_sha256").alias(f"{own}sha")).agg(F.min(f"{own}row").alias(f"{own}least"))
        least = least.select(F.lower(F.hex(f"{own}sha")).alias("text_sha256"), f"{own}least")
        one_of_tied = numbered.join(least, "text_sha256").withColumn("kept", F.col(f"{own}row") == F.col(f"{own}least")).drop(f"{own}row", f"{own}least")
        out = out.unionByName(tied.where("NOT kept")).unionByName(one_of_tied)
    return out.drop(f"{own}maybe", f"{own}hash", f"{own}len")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return marked(rows).where("kept").select("row.*")
