"""BPE encoding and decoding by forced boundaries.

A pair of bytes that no vocabulary token has inside can never be merged, so a text may be
cut there and its fragments encoded on their own:

1. Texts are cut at ASCII white space and at the pairs that no token has inside, by a table made from the
   vocabulary: where a letter (of ASCII, or U+00C0 to U+00FF) meets ASCII punctuation, around ASCII digits, and between two letters. At the former
   normaliser and pre-tokenizer see a boundary as well; a fragment cut off within a word is marked, as it
   doesn't carry the end-of-word mark. So the fragments are independent of each other from the first step on. (Near
   apostrophes, at combining marks and at other bytes outside ASCII nothing is cut here: contractions and composed letters reach across.)
2. A fragment that is not in the worker's cache is normalised, split into pre-tokens and cut at every pair
   in the table, also within words; only the last part carries the end-of-word mark. Missing fragments
   that are one word, or one run of punctuation, without such a pair inside need no further cut: they are merged together,
   in one call of the bare merge model, and told apart by their end-of-word marks.
3. The ids of the fragments are concatenated.

Special tokens written out in a text become their ids, as the library does by default.
The caches are bounded, so memory does not depend on the text. NULL counts as empty; an
empty text has no ids and decodes to an empty text; repeated rows, NULL ids and other
columns are passed or ignored, an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegate.llm.common import BLANKS, in_chunks, per_batch, raw_texts, small_batches

#: Fragments a worker remembers, none of them longer than ``KEPT`` bytes, and bytes up to which a fragment is merged along with others.
CACHED, KEPT, SHORT = 240_000, 128, 64
GAP = re.compile(rb"[ \t\n\x0b\x0c\r]")
GAPS = np.isin(np.arange(256), [ord(c) for c in BLANKS])


def byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: printable Latin-1 ones for themselves, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


#: Stands at the end of fragments that are not the end of their word; no UTF-8 text has this byte.
INNER = b"\xff"
#: ASCII punctuation but for the apostrophe, which contractions reach across.
MARKS = bytes(b for b in range(0x21, 0x7F) if not chr(b).isalnum() and chr(b) != "'")
#: Letters below this code point are composed, and Unicode's versions agree on them.
LATIN = "\u0250"
#: Words in one string for the merge model; its time grows faster than the string.
TOGETHER = 200
BYTE_LETTERS = {b: letter for b, letter in enumerate(byte_letters()) if b != 0x20}


class Encoder:
    """Ids and decoded forms of words, by one tokenizer file."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.path = path
        self.whole = whole = Tokenizer.from_file(path)
        self.normalize, self.split = whole.normalizer.normalize_str, whole.pre_tokenizer.pre_tokenize_str
        self.suffix = spec["model"]["end_of_word_suffix"] or ""
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if spec.get("decoder") or any(t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("only tokenizers without a decoder and with plain added tokens are supported")
        self.special = re.compile("|".join(re.escape(t) for t in sorted(self.added, key=len, reverse=True)) or r"(?!)")
        self.starts = {t[:2].encode() for t in self.added}
        self.inside = self.pairs_inside(spec["model"]["vocab"])
        self.boundary = self.safe_boundaries()

    @cached_property
    def models(self) -> tuple:
        """The model without and with the end-of-word mark, for parts of fragments; the latter is the tokenizer's own, not a copy."""
        from tokenizers import models

        with open(self.path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        # Few parts are inner ones: no cache of words.
        return models.BPE(vocab=model["vocab"], merges=merges, cache_capacity=0), self.whole.model

    @cached_property
    def token(self) -> dict[int, str]:
        return {i: t for t, i in self.whole.get_vocab(with_added_tokens=True).items()}

    def pairs_inside(self, vocab: dict[str, int]) -> set[str]:
        """Adjacent byte letters that occur inside some token; every other pair is a forced boundary."""
        letters, pairs = byte_letters(), set()
        for token in vocab:
            body = token.removesuffix(self.suffix) if self.suffix else token
            if token not in self.added:
                pairs.update(a + b for a, b in zip(body, body[1:], strict=False))
        gaps = {letters[b] for b in b" \t\n\x0b\x0c\r"}
        if any(set(pair) & gaps for pair in pairs):
            raise ValueError("tokens with white space inside: gaps are no forced boundaries")
        return pairs

    def safe_boundaries(self) -> np.ndarray:
        """Table of the byte pairs at which texts are cut, none of them inside a token in either case.

        1: between two pre-tokens, as a letter next to a mark, or a digit next to anything, of ASCII. 2: within a word. Bytes
        from 0x80 on stand for letters after 0xC3 (see :meth:`cut`); adding 0x20 makes them small.
        """
        letters, table = byte_letters(), np.zeros((256, 256), np.uint8)
        digits, words = list(range(0x30, 0x3A)), [b for b in range(128) if chr(b).isalpha()]
        trails = list(range(0x80, 0xC0))

        def free(a: int, b: int) -> bool:
            cases = [(x, y) for x in {a, a | 0x20} for y in ({b, b | 0x20} if b < 0x80 else {b})]
            return not any(letters[x] + letters[y] in self.inside for x, y in cases)

        for kind, lefts, rights in (
            (1, [*words, *trails], MARKS), (1, MARKS, [*words, 0xC3]), (1, digits, [*words, 0xC3, *MARKS, *digits]), (1, [*words, *trails, *MARKS], digits),
            (2, [*words, *trails], [*words, 0xC3]),
        ):
            for a in lefts:
                for b in rights:
                    table[a, b] = kind * free(a, b)
        return table

    def fragments(self, piece: str) -> list[str]:
        """Cut a pre-token at its forced boundaries."""
        cuts = [0, *(i for i in range(1, len(piece)) if piece[i - 1 : i + 1] not in self.inside), len(piece)]
        return [piece[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]

    def encode_word(self, raw: bytes) -> list[int]:
        """Ids of any fragment, by all steps; one that ends with ``INNER`` is not the end of its word."""
        ids: list[int] = []
        inner, final = self.models
        pieces = self.split(self.normalize(raw.removesuffix(INNER).decode()))
        for n, (piece, _) in enumerate(pieces, 1):
            *first, last = self.fragments(piece)
            for part in first:
                ids.extend(t.id for t in inner.tokenize(part))
            ends = n < len(pieces) or not raw.endswith(INNER)
            ids.extend(t.id for t in (final if ends else inner).tokenize(last))
        return ids

    def parts(self, raw: bytes) -> list[tuple[bytes, int | None]]:
        """The text between special tokens, each with the id of the special token after it."""
        if not any(s in raw for s in self.starts):
            return [(raw, None)]
        text, out, at = raw.decode(), [], 0
        for m in self.special.finditer(text):
            out.append((text[at : m.start()].encode(), self.added[m[0]]))
            at = m.end()
        return [*out, (text[at:].encode(), None)]

    def cut(self, raw: bytes) -> tuple[list[bytes], np.ndarray]:
        """The fragments of a text, and where they start. Those cut off within a word end with ``INNER``."""
        codes = np.frombuffer(raw, np.uint8)
        kinds = self.boundary[codes[:-1], codes[1:]]
        left = np.flatnonzero(kinds)
        padded = np.concatenate([[0], codes, [0, 0, 0]]).astype(np.uint8)  # byte i is at i + 1
        # Beyond ASCII only U+00C0 to U+00FF without the two signs among them: 0xC3 and one more byte.
        latin = (padded[:-1] == 0xC3) & (padded[1:] != 0x97) & (padded[1:] != 0xB7)
        at, after = padded[left + 1], padded[left + 2]
        fine = ((at < 0x80) | latin[left]) & ((after < 0x80) | latin[left + 2])
        left, after = left[fine], after[fine]
        within = kinds[left] == 2
        # No cut within a contraction, nor before a letter that a combining mark may follow.
        marks = np.flatnonzero(codes == 0x27)
        near = left - np.concatenate([[-100], marks])[np.searchsorted(marks, left, "right")] <= 6
        following = padded[left + 3 + (after >= 0x80)]
        fine = ~within | (~near & ((following < 0x80) | (following == 0xC3)))
        left, within = left[fine], within[fine]
        gaps = GAPS[codes]
        starts = ~gaps
        starts[1:] &= gaps[:-1]
        starts[left + 1] = True
        where = np.repeat(left + 1, within + 1)
        # The mark of an inner end and a blank, or a blank alone.
        put = np.full(len(where), 0x20, np.uint8)
        put[np.cumsum(within + 1)[within] - 2] = INNER[0]
        return np.insert(codes, where, put).tobytes().split(), np.flatnonzero(starts)

    @cached_property
    def merger(self):
        """The merge model alone, for words that are normalised already, a blank apart."""
        from tokenizers import Tokenizer, pre_tokenizers

        out = Tokenizer(self.models[1])
        out.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        return out

    @cached_property
    def last(self) -> np.ndarray:
        """Which ids end a word."""
        ends = np.zeros(max(self.token) + 1, bool)
        ends[[i for i, t in self.token.items() if t.endswith(self.suffix) and t not in self.added]] = True
        return ends

    @cached_property
    def forced(self) -> np.ndarray:
        """Table of all byte pairs that no token has inside; pairs with a blank are not among them."""
        letters = byte_letters()
        table = np.array([[letters[a] + letters[b] not in self.inside for b in range(256)] for a in range(256)])
        table[0x20, :] = table[:, 0x20] = False
        return table

    @staticmethod
    def single(fragment: bytes) -> bytes | None:
        """The normalised form of a fragment that is one pre-token for certain: letters of Latin scripts, or marks of ASCII."""
        if not fragment.translate(None, MARKS):
            return fragment
        low = fragment.decode().lower()
        return low.encode() if max(low) < LATIN and low.isalpha() else None

    def merge(self, words: list[bytes]) -> list[bytes | None]:
        """Ids of normalised words of one pre-token each; None for those that have a forced boundary inside."""
        if not words:
            return []
        codes = b" ".join(words)
        pairs = np.frombuffer(codes, np.uint8)
        cut = np.flatnonzero(self.forced[pairs[:-1], pairs[1:]])
        text = codes.decode() if codes.isascii() else codes.decode("latin-1").translate(BYTE_LETTERS)
        each = text.split(" ")
        groups = [" ".join(each[i : i + TOGETHER]) for i in range(0, len(each), TOGETHER)]
        ids = np.array([i for e in self.merger.encode_batch_fast(groups, add_special_tokens=False) for i in e.ids], "<u4")
        stops = ((np.flatnonzero(self.last[ids]) + 1) * 4).tolist()
        packed = ids.tobytes()
        out: list[bytes | None] = [packed[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]
        for n in set(np.cumsum(pairs == 0x20)[cut].tolist()):
            out[n] = None
        return out

    def encode_each(self, fragments: list[bytes]) -> dict[bytes, bytes]:
        """The ids of each fragment, as little-endian unsigned 32-bit numbers."""
        found: dict = {}
        if self.suffix and SHORT:
            plain = [f for f in fragments if f.isalpha() and len(f) <= SHORT]
            found.update(zip(plain, self.merge(b" ".join(plain).lower().split()), strict=True))
            others = [(f, low) for f in fragments if f not in found and len(f) <= SHORT and not f.endswith(INNER) and (low := self.single(f))]
            found.update(zip([f for f, _ in others], self.merge([low for _, low in others]), strict=True))
        for f in fragments:
            if found.get(f) is None:
                found[f] = np.array(self.encode_word(f), "<u4").tobytes()
        return found


class Forms:
    """Bounded memory of ``make(ids)`` for fragments, or of the ids themselves: little-endian unsigned 32-bit numbers."""

    def __init__(self, enc: Encoder, make=None):
        self.enc, self.make, self.known, self.older = enc, make, {}, {}

    def made(self, missing: set[bytes]) -> dict:
        """Forms of fragments that are not in the newer half of the memory."""
        if len(self.known) + len(missing) > CACHED // 2:
            # The older half goes, but for what is asked for again.
            self.older, self.known = self.known, {}
        found = {f: self.older[f] for f in missing if f in self.older}
        made = self.enc.encode_each([f for f in missing if f not in found] if found else list(missing))
        found.update(made if self.make is None else {f: self.make(np.frombuffer(ids, "<u4")) for f, ids in made.items()})
        self.known.update(found)
        for f in [f for f in found if len(f) > KEPT]:
            del self.known[f]
        return found

    def special(self, number: int):
        ids = np.array([number], "<u4")
        return ids.tobytes() if self.make is None else self.make(ids)

    def of_texts(self, raws: list[bytes]):
        """For each text, the forms of its fragments and special tokens in order; long texts in pieces: ``(row, forms)``."""
        for rows, group in in_chunks(raws, GAP):
            parts = [(row, part, after) for row, raw in zip(rows, group, strict=True) for part, after in self.enc.parts(raw)]
            fragments, starts = self.enc.cut(b"\n".join(part for _, part, _ in parts))
            forms = list(map(self.known.get, fragments))
            if None in forms:
                lacking = [i for i, form in enumerate(forms) if form is None]
                found = self.made({fragments[i] for i in lacking})
                for i in lacking:
                    forms[i] = found[fragments[i]]
            stops = np.searchsorted(starts, np.cumsum([len(part) + 1 for _, part, _ in parts])).tolist()
            at = 0
            for (row, _, after), stop in zip(parts, stops, strict=True):
                yield row, forms[at:stop] if after is None else [*forms[at:stop], self.special(after)]
                at = stop


_LOADED: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One per worker."""
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


_FORMS: dict[tuple[str, str], Forms] = {}


def forms(path: str, name: str, make=None) -> Forms:
    """One memory per worker and kind of form."""
    if (path, name) not in _FORMS:
        _FORMS[path, name] = Forms(encoder(path), make)
    return _FORMS[path, name]


def packed_ids(path: str, raws: list[bytes]) -> list[bytes]:
    """The ids of each text as little-endian unsigned 32-bit numbers."""
    found: list[list[bytes]] = [[] for _ in raws]
    for row, part in forms(path, "packed").of_texts(raws):
        found[row].append(b"".join(part))
    return [b"".join(x) for x in found]


def encode_texts(docs: DataFrame, tokenizer: str, text: str = "text", into: str = "ids") -> DataFrame:
    """All columns of ``docs`` and the ids of the text as an array in ``into`` (replaced if it exists)."""
    rest = [c for c in docs.columns if c != into]
    source = docs.select(*rest, F.col(text).alias("__text"))
    schema = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in rest) + (", " if rest else "") + f"`{into}` array<int>"

    def run(batches):
        for batch in small_batches(batches):
            ids = [np.frombuffer(x, "<u4").astype("int32") for x in packed_ids(tokenizer, raw_texts(batch.column("__text")))]
            arrays = [batch.column(c) for c in rest] + [pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, [*rest, into])

    return source.mapInArrow(run, schema)


def decode_ids(docs: DataFrame, tokenizer: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """All columns of ``docs`` and the decoded text of an array of ids in ``into``; NULL arrays count as empty."""
    rest = [c for c in docs.columns if c != into]
    schema = ", ".join(f"`{c}` {dict(docs.dtypes)[c]}" for c in rest) + f", `{into}` string"

    def run(batches):
        token = encoder(tokenizer).token
        for batch in small_batches(batches):
            texts = [" ".join(token[i] for i in row or () if i in token) for row in batch.column(ids).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(texts, pa.string())], [*rest, into])

    return docs.select(*rest).mapInArrow(run, schema)


def round_trip_digest(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id_col, n_tokens, ids_sha256, decoded_sha256``: encode, decode what was encoded, and digest both."""
    schema = f"{id_col} {dict(docs.dtypes)[id_col]}, n_tokens long, ids_sha256 string, decoded_sha256 string"

    def make():
        enc = encoder(tokenizer)

        def digested(found: np.ndarray) -> tuple[int, bytes, bytes]:
            ids = found.tolist()
            return len(ids), b"".join([b" %d" % i for i in ids]), b"".join([b" " + enc.token[i].encode() for i in ids])

        memory = forms(tokenizer, "digest", digested)

        def work(batch):
            raws = raw_texts(batch.column("text"))
            counts, ids, decoded = [0] * len(raws), [hashlib.sha256() for _ in raws], [hashlib.sha256() for _ in raws]
            for row, found in memory.of_texts(raws):
                if found:
                    n, a, b = zip(*found, strict=True)
                    # The first id of a text has no blank in front of it.
                    skip = 0 if counts[row] else 1
                    counts[row] += sum(n)
                    ids[row].update(memoryview(b"".join(a))[skip:])
                    decoded[row].update(memoryview(b"".join(b))[skip:])
            return {"n_tokens": pa.array(counts, pa.int64()), "ids_sha256": [x.hexdigest() for x in ids], "decoded_sha256": [x.hexdigest() for x in decoded]}

        return work

    return docs.select(F.col(id_col), F.col(text).alias("text")).mapInArrow(per_batch(make, schema), schema)
