"""A blocked Bloom filter out of SQL expressions: every key has three bits in one 64-bit word."""

from __future__ import annotations

from struct import pack

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_A_KEY, MIN_WORDS, MAX_WORDS, CHUNK = 32, 1 << 10, 1 << 20, 1 << 10


def filter_words(keys: int) -> int:
    """Words for so many keys: a power of two, at most ``MAX_WORDS`` (8 MB), which bounds what each task receives."""
    wanted = max(MIN_WORDS, keys * BITS_A_KEY // 64)
    return min(MAX_WORDS, 1 << (wanted - 1).bit_length())


def place(hashed: Column, words: int) -> dict[str, Column]:
    """``word`` and ``mask`` of a key, from different parts of its 64-bit hash."""
    mask = F.lit(0).cast("long")
    for start in (24, 30, 36):
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, start).bitwiseAND(F.lit(63)).cast("int")))
    return {"word": hashed.bitwiseAND(F.lit(words - 1)), "mask": mask}


def dense(bits: DataFrame, words: int) -> DataFrame:
    """One row, one column: the filter as chunks of words, from rows ``word, mask`` OR-ed together.

    Chunk by chunk, so no task ever holds more rows than there are chunks or words in a chunk.
    """
    filled = bits.groupBy("word").agg(F.bit_or("mask").alias("bits"))
    every = bits.sparkSession.range(words).withColumnRenamed("id", "word").join(filled, "word", "left").withColumn("bits", F.coalesce("bits", F.lit(0)))
    chunks = every.groupBy(F.expr(f"word DIV {CHUNK}").alias("chunk")).agg(F.collect_list(F.struct("word", "bits")).alias("held"))
    chunks = chunks.select("chunk", F.transform(F.array_sort("held"), lambda x: x.bits).alias("words"))
    return chunks.agg(F.collect_list(F.struct("chunk", "words")).alias("held")).select(F.transform(F.array_sort("held"), lambda x: x.words).alias("filter"))


def may_hold(dense_filter: Column, word: Column, mask: Column) -> Column:
    """Whether all bits of the key are set; a key that was added always has them."""
    chunk, at = F.floor(word / F.lit(CHUNK)).cast("int"), word.bitwiseAND(F.lit(CHUNK - 1)).cast("int")
    return F.coalesce(F.get(F.get(dense_filter, chunk), at).bitwiseAND(mask) == mask, F.lit(False))


def packed(dense_row: list[list[int]]) -> bytes:
    """The collected filter as a literal, eight bytes a word, for use inside array functions (where subqueries may not stand)."""
    return b"".join(pack(f">{len(words)}q", *words) for words in dense_row)


def packed_may_hold(literal: Column, word: Column, mask: Column) -> Column:
    held = F.conv(F.hex(F.substr(literal, (word * 8 + 1).cast("int"), F.lit(8))), 16, -10).cast("long")
    return F.coalesce(held.bitwiseAND(mask) == mask, F.lit(False))
