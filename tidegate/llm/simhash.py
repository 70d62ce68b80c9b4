"""SimHash near-duplicates with BK-trees.

Fingerprints: A-Z lower-cased, words between blanks, 3-word shingles with repeats (fewer words:
the whole sequence; none: fingerprint zero), XXH64 with seed 42 of each; a bit is 1 if it is set
in over half of the hashes. Fingerprints that differ in at most ``RADIUS`` bits link.

Equal fingerprints are one from the start, so copies are never compared. The distinct ones are
dealt into shards: of three blocks of bits, two fingerprints within the radius agree in at least
one, so a shard holds those that agree in a block. A shard with more than ``SHARD`` fingerprints is
cut further by the same rule over its remaining bits, at most ``len(BLOCKS) - 1`` times; then 14 bits
are left at most (64 less blocks of 21, 14, 9 and 6), so no shard can exceed 16,384. Each shard becomes a BK-tree (children keyed by
their integer distance to the parent), which is searched along the edges within the radius. A
shard passes on only links that join two of its components, fewer than it has members, so a
dense group never emits its pairs, and no link is lost.

A shard's tree is sent to the queries of its own shard only. The trees of all shards together
grow with the corpus, so broadcasting them all would have no bound.

Components: links become stars by alternating large-star and small-star steps, landed in the
shared folder after each round. Nothing of it reaches the driver but two numbers a round.

NULL texts count as empty. NULL ids get a component like others; the component's id is the
smallest id that isn't NULL (NULL if there is none). Repeated rows are copies of each other; an
empty table gives no rows. Other columns are ignored. Where one row of a component stays, it is
the one with the smallest id, then by a hash of the text; rows that repeat both id and text are
one document and stay or go together (exact deduplication tells them apart).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import in_chunks, per_batch, raw_texts
from tidegate.llm.bpe import GAP
from tidegate.sources.sinks import land

WORDS, SEED, RADIUS, SHARD = 3, 42, 2, 1_024
LOW64 = (1 << 64) - 1
#: Rows of fingerprints or links that make a task and its file worth while.
TASK_ROWS, LEAST_TASKS = 20_000, 8


def _masks() -> list[list[int]]:
    """Per level, the bits that a shard agrees in; mask ``i`` is refined by masks ``3 i`` to ``3 i + 2`` of the next level."""
    levels, held = [], [0]
    for _ in range(4):
        refined = []
        for mask in held:
            free = [b for b in range(64) if not mask >> b & 1]
            cuts = [i * len(free) // 3 for i in range(4)]
            refined += [mask | sum(1 << b for b in free[a:z]) for a, z in zip(cuts, cuts[1:], strict=False)]
        levels.append(refined)
        held = refined
    return levels


BLOCKS = _masks()


def in_few(rows: DataFrame, n: int) -> DataFrame:
    """The rows in no more tasks, and so landed files, than about ``n`` rows are worth."""
    return rows.coalesce(max(LEAST_TASKS, n // TASK_ROWS))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bit_counts(hashes: list[int]) -> np.ndarray:
    """How many of the hashes have each bit set, from bit 0 up."""
    octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
    return np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)


def fingerprint_of(counts: np.ndarray, n: int) -> int:
    return int.from_bytes(np.packbits(counts * 2 > n, bitorder="little").tobytes(), "little") if n else 0


def fingerprints(raws: list[bytes], words: int = WORDS) -> list[int]:
    import xxhash

    digest = xxhash.xxh64_intdigest
    out = [0] * len(raws)
    state: dict[int, list] = {}

    def finish(row):
        carried, counts, n = state.pop(row)
        if not n and carried:
            counts, n = bit_counts([digest(b" ".join(carried), SEED)]), 1
        out[row] = fingerprint_of(counts, n)

    last = None
    for rows, group in in_chunks(raws, GAP):
        for row, piece in zip(rows, group, strict=True):
            if last is not None and row != last:
                finish(last)
            last = row
            carried, counts, n = state.get(row, ([], np.zeros(64, np.int64), 0))
            tokens = carried + piece.lower().split()
            if len(tokens) >= words:
                shingles = map(b" ".join, zip(*(tokens[i:] for i in range(words)), strict=False))
                hashes = [digest(s, SEED) for s in shingles]
                counts, n = counts + bit_counts(hashes), n + len(hashes)
                tokens = tokens[len(tokens) - words + 1 :]
            state[row] = [tokens, counts, n]
    if last is not None:
        finish(last)
    return out


class Tree:
    """BK-tree of integers under Hamming distance."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add_and_find(self, value: int, radius: int = RADIUS) -> list[int]:
        """Nodes within the radius of a new value, which becomes the last node."""
        found, values, children = [], self.values, self.children
        if values:
            stack = [0]
            while stack:
                node = stack.pop()
                d = (values[node] ^ value).bit_count()
                if d <= radius:
                    found.append(node)
                edges = children[node]
                for e in range(d - radius, d + radius + 1):
                    if e in edges:
                        stack.append(edges[e])
            node = 0
            while True:
                d = (values[node] ^ value).bit_count()
                if d not in children[node]:
                    children[node][d] = len(values)
                    break
                node = children[node][d]
        values.append(value)
        children.append({})
        return found


def tree_links(values: list[int], radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """Links that join components of distinct values: enough of them to connect all that are within the radius."""
    tree, parent = Tree(), list(range(len(values)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(values):
        for j in tree.add_and_find(value, radius):
            a, b = root(i), root(j)
            if a != b:
                parent[a] = b
                yield value, values[j]


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, tie, fp``: the fingerprint as a signed 64-bit number, and a hash of the text."""
    schema = f"doc_id {dict(docs.dtypes)[id_col]}, tie long, fp long"

    def make():
        return lambda batch: {"fp": pa.array([signed(x) for x in fingerprints(raw_texts(batch.column("text")))], pa.int64())}

    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("tie"), F.col(text).alias("text")).mapInArrow(per_batch(make, schema), schema)


def links(distinct: DataFrame, shard: int = SHARD) -> list[DataFrame]:
    """Links between distinct fingerprints (column ``fp``), one frame ``a, b`` per level of cutting."""

    def dealt(rows: DataFrame, level: int) -> DataFrame:
        kids = F.array(*[F.lit(i) for i in range(3)])
        own = rows.withColumn("mask", F.explode(F.transform(kids, lambda i: (F.col("mask") * 3 + i).cast("int"))))
        bits = F.get(F.array(*[F.lit(signed(m)) for m in BLOCKS[level]]), F.col("mask"))
        return own.withColumn("key", F.col("fp").bitwiseAND(bits))

    def search(batches):
        held_mask = held_key = None
        values: list[int] = []

        def links_of(values):
            return [(signed(a), signed(b)) for a, b in tree_links(values)] if len(values) > 1 else []

        for batch in batches:
            out = []
            for mask, key, fp in zip(*(batch.column(c).to_pylist() for c in ("mask", "key", "fp")), strict=True):
                if key != held_key or mask != held_mask:
                    out += links_of(values)
                    held_mask, held_key, values = mask, key, []
                values.append(fp & LOW64)
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])
        out = links_of(values)
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in out], pa.int64()), pa.array([b for _, b in out], pa.int64())], ["a", "b"])

    found, rows = [], distinct.select("fp", F.lit(0).alias("mask"))
    for level in range(len(BLOCKS)):
        shards = dealt(rows, level)
        large = None
        if level < len(BLOCKS) - 1:
            # At most one row for each ``shard`` members; dealt by other keys than the join's, see the join in ``components``.
            sizes = shards.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > shard)
            large, n = land(sizes.select("mask", F.bitwise_not("key").alias("key")), "shards")
            large = large.withColumn("key", F.bitwise_not("key")) if n else None
        small = shards if large is None else shards.join(large, ["mask", "key"], "left_anti")
        found.append(small.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp").mapInArrow(search, "a long, b long"))
        if large is None:
            break
        rows = shards.join(large, ["mask", "key"], "left_semi").select("fp", "mask")
    return found


def _contract(edges: DataFrame) -> DataFrame:
    """Each task joins up its own links: fewer and shorter chains for the rounds that follow."""

    def run(batches):
        parent: dict[int, int] = {}

        def root(i):
            while parent.setdefault(i, i) != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        for batch in batches:
            for a, b in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                if len(parent) > 500_000:
                    yield stars(parent, root)
                    parent.clear()
        yield stars(parent, root)

    def stars(parent, root):
        pairs = [(i, root(i)) for i in list(parent) if root(i) != i]
        return pa.RecordBatch.from_arrays([pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], ["a", "b"])

    return edges.mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """``a, b``: every node but the smallest of its component, and that smallest node. Links go in as ``a, b``.

    No round makes more links than it gets, so the number of the last round says how many tasks the next one is worth.
    """
    edges, n = land(_contract(edges.where("a <> b")), "links")
    seen = None
    while n:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        edges = _stars(both, both.where("b > a"))
        down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        small = down.groupBy("a").agg(F.min("b").alias("least"))
        centre = small.select("a", F.col("least").alias("b"))
        # (b, least) for every other neighbour below a node.
        others = _at(down, small).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b"))
        edges, n = land(in_few(centre.unionByName(others).distinct(), n), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(1 << 31)))).first()
        if now == seen:
            break
        seen = now
    return edges


def _at(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Join a node's number to its links. The key is inverted on both sides, so that the join deals both anew and can split a hot node."""
    other = least.select(F.bitwise_not("a").alias("__a"), "least")
    return edges.withColumn("__a", F.bitwise_not("a")).join(other, "__a").drop("__a")


def _stars(both: DataFrame, upward: DataFrame) -> DataFrame:
    """Large-star: link each larger neighbour to the smallest of a node and its neighbours."""
    least = both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("least"))
    return _at(upward, least).where("b <> least").select(F.col("b").alias("a"), F.col("least").alias("b")).distinct()


def grouped(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, tie, fp, first`` of every row; ``first`` is the first row of its component: ``(no_id, doc_id, tie)``."""
    printed, n = land(with_fingerprint(docs, id_col, text), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    distinct, n = land(in_few(printed.groupBy("fp").agg(F.min(row).alias("first")), n), "distinct")
    found = [in_few(level, 3 * n) for level in links(distinct)]
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    stars = components(edges)
    members = stars.unionByName(stars.select(F.col("b").alias("a"), "b").distinct())
    named = members.join(distinct, F.col("a") == F.col("fp"))
    least = named.groupBy("b").agg(F.min("first").alias("least"))
    of_linked = named.select("a", "b").join(least, "b").select(F.col("a").alias("fp"), "least")
    of_all = distinct.join(of_linked, "fp", "left").select(F.bitwise_not("fp").alias("key"), F.coalesce("least", "first").alias("first"))
    # The inverted key makes the join deal both sides anew, so that copies of one text can be split.
    return printed.withColumn("key", F.bitwise_not("fp")).join(of_all, "key").drop("key")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    return grouped(docs, id_col, text).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with the columns of ``docs``."""
    rows = grouped(docs, id_col, text)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "tie")
    gone = rows.where(~first.eqNullSafe(F.col("first"))).select(F.col("doc_id").alias("__id"), F.col("tie").alias("__tie")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(gone["__id"]) & (F.xxhash64(docs[text]) == gone["__tie"]), "left_anti")
