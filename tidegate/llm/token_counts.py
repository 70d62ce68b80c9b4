"""Token counts of whole texts by a two-tier lookup of pre-token lengths.

The tokenizer is a sentencepiece BPE whose pieces hold a space mark only at their start
and never a line feed. So a text falls into pre-tokens (a run of spaces with what follows,
or a line feed with what follows) whose token counts simply add up.

Tier 1 is a table of the lengths of frequent pre-tokens. It is found from all texts:
each task counts its own pre-tokens in bounded memory and passes on its most frequent
ones, so no pre-token is shuffled, only a fixed number of candidates per task. The table
has at most ``TABLE_ROWS`` pre-tokens of at most ``KEY_BYTES`` bytes, which bounds the
broadcast to about 1 MB. Tier 2 encodes what is not in the table and keeps it in a
bounded cache of the worker. Both tiers give the tokenizer's own count; the table only
saves work.

NULL and empty texts have no bytes and no tokens. Any other column is ignored, NULL ids
and repeated rows are counted like all others, an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import in_chunks, per_batch, raw_texts, small_batches

LIMIT = 4096
TABLE_ROWS, KEY_BYTES = 16_384, 48
#: Pre-tokens that a task counts before it drops the rare ones, and those it passes on.
COUNTED, PASSED_ON = 150_000, 2_048
#: Lengths a worker keeps before it starts again from the table.
CACHED = 250_000

PRE_TOKEN = re.compile(rb" +[^ \n]*|\n[^ \n]*")
MARK = "▁".encode()
#: A single space between other characters: a long text may be cut there.
GAP = re.compile(rb"(?<=[^ \n]) (?=[^ \n])")


def pre_tokens(raw: bytes) -> list[bytes]:
    """Pre-tokens of a text whose space marks are spaces, in order: ``word`` after one space, ``  word`` after more, ``\\nword`` after a line feed."""
    if not raw:
        return []
    if raw[0] in b" \n" or raw[-1] == 32 or b"  " in raw or b" \n" in raw:
        return [x[1:] if x[0] == 32 else x for x in PRE_TOKEN.findall(b" " + raw)]
    return raw.replace(b"\n", b" \n").split(b" ")


def check_model(processor) -> None:
    """Refuse a vocabulary for which the pre-token counts would not add up."""
    for i in range(processor.get_piece_size()):
        piece = processor.id_to_piece(i)
        if "\n" in piece or "▁" in piece.lstrip("▁"):
            raise ValueError(f"piece {piece!r} crosses the cuts between pre-tokens")


class Lengths:
    """Token counts of pre-tokens: the frequent ones given, the others encoded and kept for a while."""

    def __init__(self, processor, frequent: dict[bytes, int]):
        self.encode, self.frequent, self.known = processor.encode, frequent, dict(frequent)

    def of_each(self, keys) -> list[int]:
        # The tokenizer puts one space mark in front: wanted, but for a line feed.
        found = self.encode([k.decode() for k in keys], num_threads=1)
        return [len(ids) - (k[:1] == b"\n") if k else 1 for k, ids in zip(keys, found, strict=True)]

    def totals(self, texts: list[list[bytes]]) -> list[int]:
        """Sum of the counts of each list of pre-tokens."""
        missing = set().union(*texts).difference(self.known)
        if missing:
            if len(self.known) + len(missing) > CACHED:
                self.known = dict(self.frequent)
                missing = set().union(*texts).difference(self.known)
            self.known.update(zip(missing, self.of_each(missing), strict=True))
        found = self.known.__getitem__
        return [sum(map(found, keys)) for keys in texts]


_LOADED: dict = {}


def processor(path: str):
    """The tokenizer, once per worker."""
    if path not in _LOADED:
        import sentencepiece

        _LOADED[path] = sentencepiece.SentencePieceProcessor(model_file=path)
    return _LOADED[path]


def frequent_pre_tokens(docs: DataFrame, text: str = "text") -> list[bytes]:
    """The most frequent pre-tokens of all texts, counted without shuffling pre-tokens."""

    def count(batches):
        seen: Counter = Counter()
        for batch in small_batches(batches):
            for _, group in in_chunks([r.replace(MARK, b" ") for r in raw_texts(batch.column(0))], GAP):
                for piece in group:
                    seen.update(pre_tokens(piece))
                if len(seen) > COUNTED:
                    seen = Counter(dict(seen.most_common(COUNTED // 2)))
        top = [(k, n) for k, n in seen.most_common(PASSED_ON) if len(k) <= KEY_BYTES]
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in top], pa.binary()), pa.array([n for _, n in top], pa.int64())], ["key", "n"])

    counted = docs.select(F.col(text).alias("text")).mapInArrow(count, "key binary, n long")
    top = counted.groupBy("key").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(TABLE_ROWS)
    return [bytes(row.key) for row in top.collect()]


def count_tokens(docs: DataFrame, model: str, limit: int = LIMIT, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row."""
    checked = processor(model)
    check_model(checked)
    lengths = Lengths(checked, {})
    keys = frequent_pre_tokens(docs, text)
    small = docs.sparkSession.sparkContext.broadcast((b"\0".join(keys), bytes(min(n, 255) for n in lengths.of_each(keys))))
    schema = f"{id_col} {dict(docs.dtypes)[id_col]}, n_bytes long, n_tokens long, over_limit boolean"

    def make():
        packed, counts = small.value
        # A pre-token with a zero byte, or of 255 tokens and more, is left to tier 2.
        split = packed.split(b"\0")
        frequent = {k: n for k, n in zip(split, counts, strict=True) if n < 255} if len(split) == len(counts) else {}
        lengths = Lengths(processor(model), frequent)

        def work(batch):
            raws = raw_texts(batch.column("text"))
            counts = [0] * len(raws)
            for rows, group in in_chunks([r.replace(MARK, b" ") for r in raws], GAP):
                for row, n in zip(rows, lengths.totals([pre_tokens(x) for x in group]), strict=True):
                    counts[row] += n
            return {"n_bytes": pa.array([len(r) for r in raws], pa.int64()), "n_tokens": pa.array(counts, pa.int64()), "over_limit": [n > limit for n in counts]}

        return work

    return docs.select(F.col(id_col), F.col(text).alias("text")).mapInArrow(per_batch(make, schema), schema)
