"""Token counts, BPE and packing against the tokenizer libraries on whole and odd texts."""

import hashlib
import math
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from tidegate.llm import bpe, packing, token_counts

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "  a  b ", "\n", "\n\na \n b", "▁x ▁▁y", "it's I'LL don't !'s 'S ''t", "é́ x́ İ ΑΣ σς ﬁ ½", "a b c\x1cd\x85e",
    "<|endoftext|>x<|startoftext|> y <|end <s> </s> <unk> <0x0A>", "日本語テキスト 🎉🎉👩‍👩‍👧", "x" * 3_000, "0x1F 12,345.67 ABC123def", "\t\ttab\r\nline",
    "nul\0 \0", "same text", "same text", "word " * 4_000,
]


def odd_rows():
    rng = random.Random(7)
    letters = "abz'AÉß 0 \n\t.,!ñ日🎉́▁ <|>İΣ"
    made = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 40))) for _ in range(400)]
    return [(None if i == 3 else i, t, "x") for i, t in enumerate([*ODD, *made])]


@pytest.fixture(scope="module")
def docs(spark):
    # The further columns have names that the operators use themselves.
    return spark.createDataFrame(odd_rows(), "doc_id long, text string, n_tokens string").repartition(3)


@pytest.fixture(scope="module")
def library_ids():
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(WORDS)
    encoded = whole.encode_batch([t or "" for _, t, _ in odd_rows()], add_special_tokens=False)
    return [e.ids for e in encoded], whole


def by_text(rows, key):
    return sorted((tuple(-1 if v is None else v for v in key(r)) for r in rows), key=repr)


def test_counts(docs):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 100) for i, t, _ in odd_rows()]
    got = token_counts.count_tokens(docs, PIECES, limit=100).collect()
    assert by_text(got, tuple) == by_text(want, tuple)


def test_small_pieces_and_caches_change_nothing(monkeypatch):
    import sentencepiece

    from tidegate.llm import common

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    monkeypatch.setattr(token_counts, "CACHED", 5)
    texts = [(t or "").encode() for _, t, _ in odd_rows()[:200]]
    lengths = token_counts.Lengths(library, {b"a": 1})
    totals = [0] * len(texts)
    for rows, group in common.in_chunks([t.replace(token_counts.MARK, b" ") for t in texts], token_counts.GAP, 7):
        for row, n in zip(rows, lengths.totals([token_counts.pre_tokens(x) for x in group]), strict=True):
            totals[row] += n
    assert totals == [len(library.encode(t.decode())) for t in texts]


def test_frequent_table_covers_all_rows(spark):
    docs = spark.createDataFrame([(i, "often " * 5 + f"rare{i}") for i in range(50)], "doc_id long, text string").repartition(4)
    assert token_counts.frequent_pre_tokens(docs)[0] == b"often"


def test_bpe(docs, library_ids):
    ids, whole = library_ids
    want = [
        (i, len(x), hashlib.sha256(" ".join(map(str, x)).encode()).hexdigest(), hashlib.sha256(whole.decode(x, skip_special_tokens=False).encode()).hexdigest())
        for (i, _, _), x in zip(odd_rows(), ids, strict=True)
    ]
    assert by_text(bpe.round_trip_digest(docs, WORDS).collect(), tuple) == by_text(want, tuple)


def test_encode_and_decode_frames(docs, library_ids):
    ids, whole = library_ids
    rows = bpe.decode_ids(bpe.encode_texts(docs, WORDS), WORDS).select("doc_id", "ids", "decoded").collect()
    want = [(i, x, whole.decode(x, skip_special_tokens=False)) for (i, _, _), x in zip(odd_rows(), ids, strict=True)]
    assert by_text(rows, tuple) == by_text(want, tuple)


def test_long_fragments_are_cut_at_forced_boundaries(library_ids):
    ids, _ = library_ids
    enc = bpe.encoder(WORDS)
    texts = [(t or "").encode() for _, t, _ in odd_rows()]
    short, bpe.SHORT = bpe.SHORT, 0
    try:
        found = bpe.Forms(enc, tuple)
        got = [[] for _ in texts]
        for row, forms in found.of_texts(texts):
            got[row] += [int(i) for form in forms for i in form]
    finally:
        bpe.SHORT = short
    assert got == ids
    assert len(enc.fragments("xqzjxqzj")) > 1


def check_packing(rows, documents, capacity):
    want = {}
    for doc_id, ids in documents:
        ids = [*ids, 1]
        for at in range(0, len(ids), capacity):
            part = np.array(ids[at : at + capacity], "<u4")
            want.setdefault((doc_id, at // capacity, at, len(part), zlib.crc32(part.tobytes())), []).append(1)
    got = {}
    for r in rows:
        got.setdefault((r.doc_id, r.piece, r.start, r.length, r.ids_crc32), []).append(1)
    assert got == want
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


@pytest.mark.parametrize("capacity", [4_096, 40])
def test_packing(docs, library_ids, capacity):
    documents = [(i, ids) for (i, _, _), ids in zip(odd_rows(), library_ids[0], strict=True)]
    rows = packing.pack_documents(docs.repartition(11), WORDS, capacity).collect()
    bins = check_packing(rows, documents, capacity)
    least = math.ceil(sum(len(x) + 1 for _, x in documents) / capacity)
    assert bins <= least * 1.02 + 1


def test_best_fit():
    assert packing.best_fit([5, 5, 4, 3, 3], 10) == [[0, 1], [2, 3, 4]]
    assert packing.best_fit([6, 5, 4, 3], 10) == [[0, 2], [1, 3]]
    assert packing.best_fit([], 10) == []


def test_bins_that_do_not_fit_together(spark, monkeypatch):
    monkeypatch.setattr(packing, "BINS", 3)
    docs = spark.createDataFrame([(i, "a " * 5) for i in range(40)], "doc_id long, text string").repartition(6)
    rows = packing.pack_documents(docs, WORDS, 10).collect()
    assert len(rows) == 40 and len({r.sequence_id for r in rows}) == 40


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts.count_tokens(none, PIECES).count() == 0
    assert bpe.round_trip_digest(none, WORDS).count() == 0
    assert packing.pack_documents(none, WORDS).count() == 0
