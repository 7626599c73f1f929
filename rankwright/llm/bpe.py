"""BPE encoding by dynamic programming over prefixes, and decoding.

A BPE encoding is legal exactly if each of its tokens is what its own text encodes
to and each neighbouring pair stays apart when encoded together. So every prefix of
a word has one last token that is compatible with the last token of the prefix
before it. An automaton over the vocabulary lists the tokens that end at each
position, compatibility picks the one, and back-pointers give the ids: no merge
queue, and time linear in the matches.

Words repeat, so each worker keeps the ids of the words it has met, up to a bound.
"""

from __future__ import annotations

import json
import struct
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.llm.common import ship_package

#: Runs of text a worker remembers (and half as many words); then it starts anew.
REMEMBERED = 800_000
#: A word's last symbol is a symbol of its own: its character moved to this range.
_LAST = 0xF0000


def _byte_letters() -> list[str]:
    """The printable letter that stands for each byte value in byte-level vocabularies."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


class _Remembering(dict):
    """Results by key, computed when first asked for; emptied when ``bound`` is reached."""

    def __init__(self, compute, bound: int):
        self.compute, self.bound = compute, bound

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.bound:
            self.clear()
        found = self[key] = self.compute(key)
        return found


class Vocabulary:
    """A byte-level vocabulary with word ends: splitting, memory, decoding.

    Takes the JSON of a tokenizer whose parts are: NFC, white space to one space,
    lower case; a split into words by pattern; byte letters; BPE with a word-end
    suffix; no decoder. Anything else is refused. Subclasses encode one word.
    """

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as file:
            self.spec = json.load(file)
        model, splitter = self.spec["model"], self.spec["pre_tokenizer"]["pretokenizers"]
        kinds = [x["type"] for x in self.spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or self.spec["decoder"] or not model["end_of_word_suffix"]:
            raise ValueError(f"{path}: not a lower-case byte-level vocabulary with word ends")
        self._words = regex.compile(splitter[0]["pattern"]["Regex"]).findall
        self.letters = _byte_letters()
        self._special = {x["content"]: x["id"] for x in self.spec["added_tokens"]}
        marks = sorted(self._special, key=len, reverse=True)
        self._cut = regex.compile("|".join(map(regex.escape, marks)) or "(?!)")
        #: Texts without any of these need no care beyond lower case: special tokens
        #: are found before it, and these letters change by their neighbours.
        self._care = regex.compile("|".join([*map(regex.escape, marks), "[ΣİͅͰ\x1c-\x1f]"]))
        self._space = regex.compile(r"\p{White_Space}+")
        self.names: list[str] = [""] * (1 + max([*model["vocab"].values(), *self._special.values()]))
        for name, i in [*model["vocab"].items(), *self._special.items()]:
            self.names[i] = name
        self._by_word = _Remembering(self._pack_word, REMEMBERED // 2)
        self._by_chunk = _Remembering(self._pack_chunk, REMEMBERED)

    def encode_word(self, word: str) -> list[int]:
        raise NotImplementedError

    def _pack_word(self, word: str) -> bytes:
        ids = self.encode_word(word)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _pack_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self._by_word.__getitem__, self._words(chunk)))

    def _encode_with_care(self, text: str) -> bytes:
        """Special tokens first, then NFC, white space, and lower case letter by letter."""
        found, at = [], 0
        for mark in [*self._cut.finditer(text), None]:
            plain = unicodedata.normalize("NFC", text[at : mark.start() if mark else len(text)])
            for chunk in self._space.split(plain):
                found.append(self._pack_chunk("".join(map(str.lower, chunk))))
            if mark:
                found.append(struct.pack("<I", self._special[mark.group()]))
                at = mark.end()
        return b"".join(found)

    def encode(self, text: str) -> bytes:
        """The ids of a whole text, as little-endian unsigned 32-bit numbers.

        Words never reach across white space, so its runs are encoded one by one.
        """
        if self._care.search(text) or not unicodedata.is_normalized("NFC", text):
            return self._encode_with_care(text)
        return b"".join(map(self._by_chunk.__getitem__, text.lower().split()))

    def decode(self, ids: bytes) -> str:
        """Tokens by name, with a space between: what a vocabulary without a decoder gives."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


class PrefixEncoder(Vocabulary):
    """Encoding by the unique last token of every prefix of a word."""

    def __init__(self, path: str):
        import ahocorasick

        super().__init__(path)
        model, vocab = self.spec["model"], self.spec["model"]["vocab"]
        # Symbols and merges by id; a token's rank is the number of its merge.
        suffix, symbols = model["end_of_word_suffix"], {}
        for letter in self.letters:
            symbols[vocab[letter]] = letter
            symbols[vocab[letter + suffix]] = chr(_LAST + ord(letter))
        self._rank, self._parts, self._merged = dict.fromkeys(symbols, -1), {}, {}
        for rank, (a, b) in enumerate(model["merges"]):
            left, right, whole = vocab[a], vocab[b], vocab[a + b]
            if whole in symbols or left not in symbols or right not in symbols:
                raise ValueError(f"merge {rank} makes a known token or needs a later one")
            symbols[whole] = symbols[left] + symbols[right]
            self._rank[whole], self._parts[whole], self._merged[left, right] = rank, (left, right), rank
        own, automaton = set(), ahocorasick.Automaton()
        for token in symbols:  # merges come in order, so parts are settled before wholes
            parts = self._parts.get(token)
            if parts is None or (own.issuperset(parts) and self._apart(*parts, self._rank[token])):
                own.add(token)
                automaton.add_word(symbols[token], (token, len(symbols[token])))
        automaton.make_automaton()
        self._ending, self._known = automaton.iter, {}

    def _apart(self, left: int, right: int, limit: float) -> bool:
        """Whether no merge below ``limit`` joins across the seam of two tokens.

        Merges are undone latest first; between two of them, the tokens at the seam
        must have no merge that was due earlier. Equal merges run left to right.
        """
        rank = self._rank
        while True:
            joint = self._merged.get((left, right))
            if joint is not None and joint < limit:
                return False
            if rank[left] > rank[right]:
                limit, left = rank[left], self._parts[left][1]
            elif rank[right] >= 0:
                limit, right = rank[right] + 1, self._parts[right][0]
            else:
                return True

    def _compatible(self, left: int, right: int) -> bool:
        known = self._known.get((left, right))
        if known is None:
            if len(self._known) >= 4 * REMEMBERED:
                self._known.clear()
            known = self._known[left, right] = self._apart(left, right, float("inf"))
        return known

    def encode_word(self, word: str) -> list[int]:
        """The ids of one word, by the last tokens of its prefixes."""
        letters = [self.letters[b] for b in word.encode("utf-8")]
        letters[-1] = chr(_LAST + ord(letters[-1]))
        last, step, known, compatible = [-1] * (len(letters) + 1), [0] * (len(letters) + 1), self._known, self._compatible
        for end, (token, length) in self._ending("".join(letters)):
            if last[end + 1] >= 0:
                continue  # the last token of a prefix is unique
            start = end + 1 - length
            before = last[start]
            if start == 0 or (before >= 0 and (known.get((before, token)) or compatible(before, token))):
                last[end + 1], step[end + 1] = token, length
        ids, at = [], len(letters)
        while at:
            ids.append(last[at])
            at -= step[at]
        ids.reverse()
        return ids


@lru_cache(maxsize=2)
def _worker(path: str) -> PrefixEncoder:
    """One encoder, with its memory, per vocabulary and Python worker."""
    return PrefixEncoder(path)


def encode_texts(documents: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``ids`` and ``decoded`` of every row.

    ``ids`` holds the whole text's ids as little-endian unsigned 32-bit numbers;
    ``decoded`` is the text they stand for. ``vocabulary`` is a path every executor
    can open. Null and empty texts give no ids and the empty text. Rows are kept one
    for one, repeated ones too; other columns are left out. Nothing is shuffled.
    """
    ship_package(documents.sparkSession)
    narrow = documents.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker(vocabulary)
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):  # small outputs keep memory flat
                part = batch.slice(at, 1024)
                ids = [encoder.encode(t) for t in part.column(1).to_pylist()]
                decoded = pa.array([encoder.decode(x) for x in ids], pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), decoded], ["_key", "ids", "decoded"])

    kind = narrow.schema["_key"].dataType.simpleString()
    return narrow.mapInArrow(run, f"_key {kind}, ids binary, decoded string").withColumnRenamed("_key", key)
