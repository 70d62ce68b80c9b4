"""Best-fit packing of documents into sequences, by hierarchical residual packing.

Every task encodes its documents, cuts those above the capacity into pieces, and packs its own
pieces best-fit in decreasing size. Nearly full bins are final. The underfull ones become items
of the next round: a tree merges the tasks' leftovers, ``FAN`` to one, packs them again and
passes on what is still underfull. A merge task gets a bounded number of bins (``BINS`` on average), so
the tree ends before its root if too many bins are left that don't fit together (bins over half
full can't be joined); those are sequences as they are. No piece is dropped, capped or split
further, and texts are never shuffled: only bins, lists of where their pieces come from.

Pieces have their place from the merge itself, so a sequence is gapless from 0. Every round is
landed in the shared folder; a lost task repeats only its own share.

NULL texts count as empty: a document of the end token alone. Repeated rows and NULL ids are
packed like others. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from struct import pack

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.bpe import packed_ids
from tidegate.llm.common import raw_texts, small_batches
from tidegate.sources.sinks import land

CAPACITY, END, NEARLY, FAN, BINS, PIECES = 4_096, 1, 8, 8, 20_000, 100_000
ITEM = "struct<doc_id:bigint,piece:int,start:bigint,length:int,crc:bigint,offset:int>"
BIN = f"fill int, items array<{ITEM}>"
ITEM_TYPE = pa.struct([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int32()), ("crc", pa.int64()), ("offset", pa.int32())])


def best_fit(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """Best-fit decreasing: item numbers of each bin. Ties go by item number."""
    bins: list[list[int]] = []
    free: list[list[int]] = [[] for _ in range(capacity + 1)]
    # Bit r is set while some bin has r free; the lowest such bit from the item's size up is the best fit.
    some = 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[i]
        fitting = some >> size
        if fitting:
            room = size + (fitting & -fitting).bit_length() - 1
            b = free[room].pop()
            if not free[room]:
                some &= ~(1 << room)
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - size
        if left:
            free[left].append(b)
            some |= 1 << left
    return bins


def merged(bins: list[tuple[int, list]], capacity: int) -> list[tuple[int, list]]:
    """Pack bins (fill, pieces) into bins; offsets move along."""
    out = []
    for group in best_fit([fill for fill, _ in bins], capacity):
        at, pieces = 0, []
        for i in group:
            fill, own = bins[i]
            pieces += [(*p[:5], p[5] + at) for p in own] if at else own
            at += fill
        out.append((at, pieces))
    return out


def _batch(bins: list[tuple[int, list]]) -> pa.RecordBatch:
    names = [f.name for f in ITEM_TYPE]
    items = [[dict(zip(names, p, strict=True)) for p in pieces] for _, pieces in bins]
    return pa.RecordBatch.from_arrays([pa.array([f for f, _ in bins], pa.int32()), pa.array(items, pa.list_(ITEM_TYPE))], ["fill", "items"])


def pieces_of(doc_id, ids: bytes, capacity: int = CAPACITY) -> list[tuple[int, list]]:
    """The pieces of one document as bins of their own; ``ids`` are little-endian 32-bit numbers."""
    out = []
    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
        part = ids[at : at + 4 * capacity]
        out.append((len(part) // 4, [(doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part), 0)]))
    return out


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    end = pack("<I", END)

    def first(batches):
        bins: list = []
        for batch in small_batches(batches):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, packed in zip(ids, packed_ids(tokenizer, raw_texts(batch.column("text"))), strict=True):
                bins += pieces_of(doc_id, packed + end, capacity)
                if len(bins) >= PIECES:
                    yield from batches_of(merged(bins, capacity))
                    bins = []
        yield from batches_of(merged(bins, capacity))

    def again(batches):
        bins: list = []
        for batch in batches:
            rows = zip(batch.column("fill").to_pylist(), batch.column("items").to_pylist(), strict=True)
            bins += [(fill, [tuple(p.values()) for p in pieces]) for fill, pieces in rows]
            if len(bins) >= PIECES:
                yield from batches_of(merged(bins, capacity))
                bins = []
        yield from batches_of(merged(bins, capacity))

    def batches_of(bins):
        for at in range(0, len(bins), 1_000):
            yield _batch(bins[at : at + 1_000])

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    packed, n = land(source.mapInArrow(first, BIN).withColumn("task", F.spark_partition_id()), "bins")
    nearly = F.col("fill") > capacity - NEARLY
    done, left = [packed.where(nearly)], packed.where(~nearly)
    count, tasks = left.agg(F.count(F.lit(1)), F.coalesce(F.max("task"), F.lit(0)) + 1).first()
    width = FAN
    while count > 1 and tasks > 1:
        merges = max(-(-tasks // width), -(-count // BINS))
        branch = F.expr(f"CAST(task * {merges} DIV {tasks} AS INT)") if merges < tasks else F.pmod(F.xxhash64("items"), F.lit(merges)).cast("int")
        dealt = left.withColumn("branch", branch).repartition(merges, "branch").sortWithinPartitions("branch", F.desc("fill"), F.xxhash64("items"))
        packed, _ = land(dealt.select("fill", "items").mapInArrow(again, BIN).withColumn("task", F.spark_partition_id()), "bins")
        done.append(packed.where(nearly))
        left = packed.where(~nearly)
        before = count
        count = left.count()
        if merges == 1 or (merges >= tasks and count > 0.98 * before):
            break
        tasks = merges
    bins = left
    for part in done:
        bins = bins.unionByName(part)
    pieces = bins.withColumn("sequence_id", F.monotonically_increasing_id()).select("sequence_id", F.explode("items").alias("p"))
    return pieces.select(
        F.col("p.doc_id").alias("doc_id"), F.col("p.piece").alias("piece"), F.col("p.start").alias("start"), F.col("p.length").cast("long").alias("length"),
        F.col("p.crc").alias("ids_crc32"), "sequence_id", F.col("p.offset").cast("long").alias("offset"),
    )
