"""Substring dedup by sliding sentence spans and windows of words.

Sentences are slid over in runs: from every sentence the shortest run forward, and to
every sentence the shortest run backward, that has enough sentences and words. Beside
them stand windows of the least number of words, whatever their sentences: of each few
neighbouring ones the one with the smallest hash is taken, so two texts that share a
long enough stretch take the same windows in it, wherever it lies and whatever
sentences it is part of.

All runs and windows are hashed and joined globally; every occurrence of a repeated
one but the first goes, and with it the words to both sides that it has in common with
the first. The first is the one with the smallest key and place. As words are added to
both sides, backward runs, and runs so long that they hold a window, need not be joined.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.llm.common import ship_package
from rankwright.sources.files import delete_folder
from rankwright.sources.scratch import materialize_anew, materialize_once

#: Where a sentence ends: end marks with closing marks and white space, or a line's end.
_END = re.compile(r"[.!?…。！？]+[\"'”’»)\]]*\s+|\n\s*")
_WORD = re.compile(r"\S+")


@dataclass(frozen=True)
class SpanRules:
    min_sentences: int = 3
    min_words: int = 40
    longest: int = 16  # words of a piece of a long sentence
    sure: int = 51  # words from which a repeated stretch is found wherever it lies

    @property
    def neighbours(self) -> int:
        """Windows of which one is taken: a stretch of `sure` words has as many."""
        return self.sure - self.min_words + 1


def sentences(text: str, longest: int) -> list[tuple[int, int, str]]:
    """(start, end, evened text) of each sentence with words; the ends include white space."""
    out, at = [], 0
    for end in [*(m.end() for m in _END.finditer(text)), len(text)]:
        body = text[at:end]
        found = body.split()
        if len(found) > longest:
            starts = [m.start() for m in _WORD.finditer(body)][longest::longest]
            edges = [0, *starts, len(body)]
            for i, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                out.append((at + a, at + b, " ".join(found[i * longest : (i + 1) * longest])))
        elif found:
            out.append((at, end, " ".join(found)))
        at = end
    return out


#: Odd, so it has an inverse modulo 2**64.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


@lru_cache(1 << 17)
def _side_hash(word: str) -> int:
    """A signed hash of a word beside a stretch: two different words agree once in four billion."""
    return int.from_bytes(hashlib.blake2b(word.lower().encode("utf-8", "surrogatepass"), digest_size=4).digest(), "little", signed=True)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _forward(counts: list[int], rules: SpanRules) -> Iterator[tuple[int, int]]:
    """(first, last) of the shortest run from every part of ``counts`` words."""
    last, total, n = 0, 0, len(counts)  # parts[first:last] have `total` words
    for first in range(n):
        while last < n and (last - first < rules.min_sentences or total < rules.min_words):
            total += counts[last]
            last += 1
        if last - first < rules.min_sentences or total < rules.min_words:
            return
        yield first, last
        total -= counts[first]


#: Of the first 65536 letters: 1 white space as ``str.split`` knows it, 2 marks that end a sentence, 4 marks that may close one.
_KINDS = np.array([chr(c).isspace() for c in range(0x10000)] + [False], np.uint8)
_KINDS[[ord(c) for c in ".!?…。！？"]] = 2
_KINDS[[ord(c) for c in "\"'”’»)]"]] = 4
_KEPT_POWERS = {base: _powers(base, 1 << 16) for base in (_BASE, _INVERSE)}


def _first_powers(base: int, n: int) -> np.ndarray:
    return _KEPT_POWERS[base][:n] if n <= 1 << 16 else _powers(base, n)


def _hashed(text: str, longest: int) -> tuple[np.ndarray, list[int]]:
    """The words' hashes, and the numbers of words of the pieces ``sentences`` makes.

    All words at once: differences of the running sum of the text's letters, times powers
    of a base, and divided by the power at the word's start.
    """
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = _KINDS.take(codes, mode="clip")
    space = np.ones(len(codes) + 2, bool)
    space[1:-1] = kinds == 1
    starts, ends = np.flatnonzero(space[:-1] & ~space[1:]), np.flatnonzero(~space[:-1] & space[1:])
    if not len(starts):
        return np.empty(0, np.uint64), []
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * _first_powers(_BASE, len(codes)), out=sums[1:])
    hashes = _mixed((sums[ends] - sums[starts]) * _first_powers(_INVERSE, len(codes))[starts])

    last = ends - 1
    closing = np.flatnonzero(kinds[last] == 4)
    while len(closing):  # back over the closing marks of the few words that have some
        last[closing] -= 1
        closing = closing[(last[closing] >= starts[closing]) & (kinds[last[closing]] == 4)]
    ending = (last >= starts) & (kinds[last] == 2)
    breaks = np.flatnonzero(codes == 10)
    ending[np.searchsorted(starts, breaks) - 1] = True  # the word before a line's end; before the first, the last one
    ending[-1] = True
    counts: list[int] = []
    before = -1
    for at in np.flatnonzero(ending).tolist():
        n, before = at - before, at
        if n > longest:
            counts.extend([longest] * ((n - 1) // longest))
        counts.append((n - 1) % longest + 1)
    return hashes, counts


def _probes(text: str, rules: SpanRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first word and number of words of every run and window that is joined."""
    hashed, counts = _hashed(text, rules.longest)
    n, k = len(hashed), rules.min_words
    if n < k:
        none = np.empty(0, np.int64)
        return none.astype(np.uint64), none, none
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashed * _first_powers(_BASE, n), out=sums[1:])
    back = _first_powers(_INVERSE, n)

    edges = [0, *np.cumsum(counts).tolist()]
    # A place is its first word and, below 32 bits, its number of words.
    places = {edges[a] << 32 | edges[b] - edges[a] for a, b in _forward(counts, rules) if edges[b] - edges[a] < rules.sure}
    if n >= rules.sure:
        hashes = _mixed((sums[k:] - sums[: n - k + 1]) * back[: n - k + 1])
        near = np.ndarray((len(hashes) - rules.neighbours + 1, rules.neighbours), np.uint64, hashes, strides=(8, 8))
        taken = near.argmin(axis=1) + np.arange(len(near))  # never falls from one window to the next
        new = np.ones(len(taken), bool)
        np.not_equal(taken[1:], taken[:-1], out=new[1:])
        places.update((taken[new] << 32 | k).tolist())
    packed = np.sort(np.fromiter(places, np.int64, len(places)))
    at, size = packed >> 32, packed & 0xFFFFFFFF
    return _mixed((sums[at + size] - sums[at]) * back[at] + size.astype(np.uint64)), at, size


def _digest(words: list[str], size: int) -> bytes:
    return hashlib.blake2b(" ".join(words).lower().encode("utf-8", "surrogatepass"), digest_size=size).digest()


def text_spans(text: str, rules: SpanRules) -> list[tuple[int, int, bytes]]:
    """(start, end, digest of 12 bytes) of every run and window of a text, letters' case aside."""
    counts = [p[2].count(" ") + 1 for p in sentences(text, rules.longest)]
    n = len(counts)
    edges = [0, *np.cumsum(counts).tolist()]
    runs = {(edges[a], edges[b]) for a, b in _forward(counts, rules)}
    runs |= {(edges[n - b], edges[n - a]) for a, b in _forward(counts[::-1], rules)}
    _, at, size = _probes(text, rules)
    runs.update(zip(at.tolist(), (at + size).tolist(), strict=True))
    words, starts = text.split(), _word_starts(text)
    return [(starts[a], starts[b], _digest(words[a:b], 12)) for a, b in sorted(runs)]


def _word_starts(text: str) -> list[int]:
    """Where each word starts, the first at 0, and the text's end."""
    return [0, *[m.start() for m in _WORD.finditer(text)][1:], len(text)]


def document_spans(documents: DataFrame, rules: SpanRules) -> DataFrame:
    """What is joined of (``id``, ``text``): the hash as ``k1``; first word and number of words in ``place``."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, found = part.column(0).to_numpy(), [_probes(text, rules) for text in part.column(1).to_pylist()]
                counts = [len(keys) for keys, _, _ in found]
                if sum(counts):
                    keys, first, size = (np.concatenate(x) for x in zip(*found, strict=True))
                    columns = [np.repeat(ids, counts), keys.view(np.int64), first << 16 | size]
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["id", "k1", "place"])

    return documents.mapInArrow(run, "id long, k1 long, place long")


def _occurrences(documents: DataFrame, rules: SpanRules) -> DataFrame:
    """Digest, offsets and nearby words of each of the ``places`` (words a to b) of (``id``, ``text``).

    ``left`` and ``right`` are 32-bit hashes of the words to both sides, nearest first;
    ``starts`` and ``ends`` where a span would start or end with that many of them.
    """
    reach = rules.neighbours

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                id_, text, places = (batch.column(c)[i].as_py() for c in range(3))
                words, at = text.split(), _word_starts(text)
                rows = []
                for a, b in ((x["a"], x["b"]) for x in places):
                    if b > len(words):  # of another text with this key
                        continue
                    digest = _digest(words[a:b], 16)
                    low, high = max(0, a - reach), min(len(words), b + reach)
                    left, right = ([_side_hash(w) for w in x] for x in (words[low:a][::-1], words[b:high]))
                    rows.append((id_, a, b, digest, at[a], at[b], left, right, at[low:a][::-1], at[b + 1 : high + 1]))
                for k in range(0, len(rows), 1024):
                    ids, firsts, lasts, digests, starts, ends, *lists = zip(*rows[k : k + 1024], strict=True)
                    columns = [pa.array(x, pa.int64()) for x in (ids, firsts, lasts)] + [pa.array(digests, pa.binary())]
                    columns += [pa.array(x, pa.int32()) for x in (starts, ends)]
                    columns += [pa.array(y, pa.list_(pa.int32())) for y in lists]
                    yield pa.RecordBatch.from_arrays(columns, ["id", "a", "b", "digest", "start", "end", "left", "right", "starts", "ends"])

    kinds = "start int, end int, left array<int>, right array<int>, starts array<int>, ends array<int>"
    return documents.select("id", "text", "places").mapInArrow(run, f"id long, a long, b long, digest binary, {kinds}")


def repeated_ranges(documents: DataFrame, rules: SpanRules) -> DataFrame:
    """``id`` and sorted ``ranges`` (start, end) of what repeats an earlier run or window.

    Hashes of 64 bits find each candidate's first place; their minimum combines
    before the shuffle, so a passage in a third of all documents is one key and then
    rows of a join, which adaptive skew splitting divides. Candidates of a document
    that keep their distance to the same document are merged; only the merged
    stretches are compared, by digests of 128 bits, and then grown word by word, by
    hashes of 32 bits: they are most of what is moved.
    Words that a place shares with later ones than the first stay.
    """
    known, place = materialize_anew(document_spans(documents, rules), "spans", None)
    first = known.groupBy("k1").agg(F.min(F.struct("id", "place")).alias("first"), F.count("*").alias("n"))
    later = known.join(first.filter("n > 1").select("k1", "first"), "k1").filter("id != first.id or place != first.place")
    lanes = (
        later.selectExpr("id", "first.id as of", "(place >> 16) - (first.place >> 16) as off", "place >> 16 as a", "(place >> 16) + (place & 65535) as b")
        .groupBy("id", "of", "off")
        .agg(F.sort_array(F.collect_list(F.struct("a", "b"))).alias("places"))
    )
    merged = F.expr(
        """aggregate(places, cast(array() as array<struct<a: bigint, b: bigint>>),
             (done, x) -> case
               when size(done) > 0 and x.a <= done[size(done) - 1].b
               then concat(slice(done, 1, size(done) - 1), array(named_struct(
                      'a', done[size(done) - 1].a, 'b', greatest(x.b, done[size(done) - 1].b))))
               else concat(done, array(x)) end)"""
    )
    stretches = materialize_once(lanes.select("id", "of", "off", F.inline(merged)), "spans")
    delete_folder(documents.sparkSession, place)  # what is left to do begins with the stretches
    asked = stretches.selectExpr("id", "named_struct('a', a, 'b', b) as x").union(
        stretches.selectExpr("of", "named_struct('a', a - off, 'b', b - off)")
    )
    places = asked.groupBy("id").agg(F.collect_set("x").alias("places"))
    found = materialize_once(_occurrences(documents.join(places, "id"), rules), "spans")
    origin = found.selectExpr("id as of", "a as of_a", "b as of_b", "digest as of_digest", "left as of_left", "right as of_right")
    pairs = (
        stretches.join(found, ["id", "a", "b"])
        .withColumns({"of_a": F.expr("a - off"), "of_b": F.expr("b - off")})
        .join(origin, ["of", "of_a", "of_b"])
        .filter("digest = of_digest")
    )
    same = "array_position(zip_with({0}, of_{0}, (x, y) -> x <=> y), false)"
    shared = pairs.withColumns({f"n_{x}": F.expr(f"if({same.format(x)} = 0, size({x}), {same.format(x)} - 1)") for x in ("left", "right")})
    grown = shared.selectExpr(
        "id", "if(n_left = 0, start, starts[int(n_left - 1)]) as start", "if(n_right = 0, end, ends[int(n_right - 1)]) as end"
    )
    return grown.groupBy("id").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("ranges"))


_RANGES = "array<struct<start: int, end: int>>"
_CUT = f"clean_text string, removed {_RANGES}"
_CUT_TYPE = pa.struct([("clean_text", pa.string()), ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))])


def _cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
    """Each text without its sorted ranges, and the ranges merged; null where no ranges are.

    One pass over the text and its ranges, however many a long text has.
    """
    out = []
    for text, found in zip(texts, ranges, strict=True):
        if not found.is_valid:
            out.append(None)
            continue
        body, merged = text.as_py(), []
        for x in found.as_py():
            if merged and x["start"] <= merged[-1]["end"]:
                merged[-1]["end"] = max(merged[-1]["end"], x["end"])
            else:
                merged.append(x)
        edges = [0, *(e for x in merged for e in (x["start"], x["end"])), len(body)]
        kept = "".join(body[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        out.append({"clean_text": kept, "removed": merged})
    return pa.array(out, _CUT_TYPE)


def remove_repeats(
    documents: DataFrame, rules: SpanRules = SpanRules(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``documents`` with ``clean_text`` and ``removed``: merged (start, end) of what went.

    Offsets count code points from 0. Null texts are read as empty and have nothing
    removed; texts below the least run keep everything. Rows that repeat a key hold
    one document: the run they share is not a repeat of itself, and all of them get
    the same ranges. Rows with a null key are kept as they are. Empty tables give no
    rows; other columns stay, except that ``clean_text`` and ``removed`` are replaced.
    """
    plain = documents.drop("clean_text", "removed")
    ids = plain.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = repeated_ranges(ids.filter("id is not null"), rules).withColumnsRenamed({"id": "_id", "ranges": "_ranges"})
    joined = plain.join(ranges, plain[key].cast("long") == ranges["_id"], "left")
    ship_package(documents.sparkSession)
    cut = F.arrow_udf(_cut, _CUT)  # texts that lose nothing are not sent: their ranges and texts are null there
    whole = F.coalesce(F.col(text), F.lit(""))
    return (
        joined.withColumn("_cut", cut(F.when(F.col("_ranges").isNotNull(), whole), F.col("_ranges")))
        .withColumn("removed", F.coalesce("_cut.removed", F.array().cast(_RANGES)))
        .withColumn("clean_text", F.coalesce(F.col("_cut.clean_text"), whole))
        .drop("_id", "_ranges", "_cut")
    )
