"""Repeated passages against brute force over all windows."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidegate.llm import substring_dedup
from tidegate.llm.substring_dedup import COVER, PERIOD, cover_positions, run_hashes, without_repeats, word_hashes

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    """Rows are documents in order of their ids."""
    seen, out = set(), []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            if run in seen:
                gone[i : i + window] = [True] * window
            seen.add(run)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc_id, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def documents(seed, n=150, length=160):
    """Few words and shared passages, shifted against each other, so runs begin and end anywhere."""
    rng = random.Random(seed)
    passages = [[rng.choice("abcdefgh") + str(rng.randrange(30)) for _ in range(rng.choice([13, 19, 20, 21, 33, 90]))] for _ in range(12)]
    rows = []
    for i in range(n):
        words = []
        while len(words) < rng.randrange(length):
            words += rng.choice(passages) if rng.random() < 0.5 else [f"u{rng.randrange(10**9)}" for _ in range(rng.randrange(30))]
        rows.append((i, rng.choice([" ", "  ", "\t", "\n", "\x0b\x0c\r"]).join(words)))
    rows[:4] = [(0, None), (1, ""), (2, " \n "), (3, "x " * 70)]
    rows[10:12] = [(10, rows[9][1]), (11, "É é " * 25)]
    return rows


def test_cover_has_every_difference():
    for a in range(PERIOD):
        for b in range(PERIOD):
            assert any((a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER for d in range(PERIOD))
    assert cover_positions(30).tolist() == [i for i in range(30) if i % PERIOD in COVER]


def test_run_hashes_are_of_the_words_alone():
    words = word_hashes(b"a b c d e f g a b c d e f g h")
    for length in range(1, 8):
        hashes = run_hashes(words, length)
        assert len(hashes) == len(words) - length + 1
        same = [(i, j) for i in range(len(hashes)) for j in range(i) if np.array_equal(words[i : i + length], words[j : j + length])]
        assert same == [(i, j) for i in range(len(hashes)) for j in range(i) if hashes[i] == hashes[j]]


@pytest.mark.parametrize("seed,window,stretch", [(1, 20, 1_000_000), (2, 20, 300), (3, 13, 50), (4, 25, 1)])
def test_against_all_windows(spark, monkeypatch, seed, window, stretch):
    monkeypatch.setattr(substring_dedup, "STRETCH", stretch)
    rows = documents(seed)
    frame = spark.createDataFrame([(i, t, "other", 1) for i, t in rows], "doc_id int, text string, key string, starts int").repartition(6)
    got = without_repeats(frame, window=window)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert sorted(map(tuple, got.collect())) == brute(rows, window)
    assert sum(r[2] for r in brute(rows, window)) > 100


def test_long_text_in_pieces(spark, monkeypatch):
    text = " ".join(f"w{i % 5_000}" for i in range(400_000))
    rows = [(1, text), (2, "w1 " + text[:3_000])]
    assert sorted(map(tuple, without_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())) == brute(rows, 20)


def test_repeated_rows_null_and_equal_ids(spark):
    text, other = " ".join(map(str, range(50))), " ".join(map(str, range(30, 90)))
    rows = [(None, text)] * 5 + [(4, text)] * 7 + [(4, "short")] * 2 + [(4, other), (3, other), (None, None)]
    got = Counter(tuple(r) for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect())
    empty = hashlib.sha256(b"").hexdigest()
    first = brute([(3, other), (4, text)], 20)
    # The other text with id 4 and all further copies are repeats of what id 3 and one row of id 4 hold.
    want = Counter(first) + Counter({(4, 60, 60, empty): 1, (4, 50, 50, empty): 6, (None, 50, 50, empty): 5})
    want += Counter({(4, 1, 0, hashlib.sha256(b"short").hexdigest()): 2, (None, 0, 0, empty): 1})
    assert got == want


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    with pytest.raises(ValueError):
        without_repeats(spark.createDataFrame([], "doc_id long, text string"), window=12)
