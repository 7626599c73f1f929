"""Document fingerprints: invertible Bloom lookup sketches of a text's paragraphs.

Every paragraph's digest is added to three cells, which hold how many digests they got,
their sum, and the sum of their check values (Goodrich and Mitzenmacher, "Invertible
Bloom Lookup Tables", 2011). Two sketches subtract cell by cell; what both have cancels.
A cell with one digest left gives it away and is taken from its other cells, until all
are empty, and then the paragraphs that differ are known, or none has just one left,
and both are sketched again in four times the cells.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.llm.common import ship_package

#: Cells of a stored fingerprint, and how many times more each further try has.
CELLS, GROWTH = 24, 4
#: A paragraph ends with its line, and in it after one word of so many, as the bytes before say.
WORDS = 4
#: Bytes of text that are compared at a time; results do not depend on it.
SLICE_BYTES = 1 << 21

_HASHES = 3
_GAP = b"\n" * 8
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_STORED = np.dtype([("count", "<i2"), ("key", "<u8"), ("check", "<u4")])
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _check(keys: np.ndarray) -> np.ndarray:
    return (mix(keys ^ np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)).astype(np.uint32)


def _cells(keys: np.ndarray, size: int, number: int) -> np.ndarray:
    third = np.uint64(size // _HASHES)
    seed = np.uint64(((_HASHES + number) * size + 1) * _ODD & 0xFFFFFFFFFFFFFFFF)
    return (mix(keys + seed) % third).astype(np.int64) + number * (size // _HASHES)


def paragraph_digests(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit digests of the paragraphs of UTF-8 texts, one after the other, and how many each has.

    Long lines are cut after a word whose last eight bytes, the ones before a short word
    included, hash to 0 modulo WORDS: an insertion moves no cut behind the next one.
    White space at the ends of a paragraph does not count, nor do blank ones. A
    paragraph that comes again in a text has another digest each time.
    """
    joined = _GAP + _GAP.join(texts) + _GAP
    data = np.frombuffer(joined, np.uint8)
    starts = np.cumsum([len(_GAP)] + [len(t) + len(_GAP) for t in texts[:-1]]) if texts else np.zeros(0, np.int64)
    blank = _BLANK[data]
    word_ends = np.flatnonzero(~blank[:-1] & blank[1:])
    tail = np.zeros(len(word_ends), np.uint64)
    for k in range(8):
        tail |= data[word_ends - k].astype(np.uint64) << np.uint64(8 * k)
    cuts = word_ends[mix(tail) % np.uint64(WORDS) == 0] + 1
    edges = np.union1d(np.concatenate([[0], cuts]), np.flatnonzero(data == 10))
    seen = np.concatenate([[0], np.cumsum(~blank)])
    a, b = edges[:-1], edges[1:]
    full = seen[b] > seen[a]
    a, b = a[full], b[full]
    digest = xxhash.xxh3_64_intdigest
    found = np.array([digest(joined[x:y].strip()) for x, y in zip(a.tolist(), b.tolist(), strict=True)], np.uint64)
    owner = np.searchsorted(starts, b - 1, "right") - 1  # a first paragraph begins in the gap before its text
    return _numbered(found, owner), np.bincount(owner, minlength=len(texts))


def _numbered(digests: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Digests made different where one owner has equal ones, by how often it came before."""
    order = np.lexsort((digests, owner))
    new = np.ones(len(order), bool)
    new[1:] = (digests[order][1:] != digests[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    at = np.arange(len(order))
    times = np.empty(len(order), np.uint64)
    times[order] = (at - np.maximum.accumulate(np.where(new, at, 0))).astype(np.uint64)
    return mix(digests + times * np.uint64(_ODD))


class Sketches:
    """Tables of one size, a row for each text."""

    def __init__(self, keys: np.ndarray, owner: np.ndarray, n: int, size: int):
        self.size, self.n = size, n
        self.count, self.key, self.check = np.zeros(n * size, np.int64), np.zeros(n * size, np.uint64), np.zeros(n * size, np.uint32)
        self.add(keys, owner, np.ones(len(keys), np.int64))

    def add(self, keys: np.ndarray, owner: np.ndarray, times: np.ndarray) -> np.ndarray:
        """Add digests (``times`` 1) or take them away (-1); the cells they lie in."""
        own, checks = keys * times.astype(np.uint64), _check(keys) * times.astype(np.uint32)
        touched = [owner * self.size + _cells(keys, self.size, j) for j in range(_HASHES)]
        for at in touched:
            np.add.at(self.count, at, times)
            np.add.at(self.key, at, own)
            np.add.at(self.check, at, checks)
        return np.concatenate(touched)

    def subtract(self, other: Sketches) -> Sketches:
        self.count, self.key, self.check = self.count - other.count, self.key - other.key, self.check - other.check
        return self

    def texts(self) -> list[str]:
        """Each table as base64."""
        cells = np.empty(len(self.count), _STORED)
        cells["count"], cells["key"], cells["check"] = self.count, self.key, self.check
        return [base64.b64encode(row.tobytes()).decode() for row in cells.reshape(self.n, self.size)]

    @staticmethod
    def read(fingerprints: list[str]) -> Sketches:
        """Stored tables, all of one size."""
        cells = np.frombuffer(b"".join(base64.b64decode(x) for x in fingerprints), _STORED)
        nothing = np.zeros(0, np.uint64)
        made = Sketches(nothing, nothing.astype(np.int64), len(fingerprints), len(cells) // max(1, len(fingerprints)))
        made.count, made.key, made.check = cells["count"].astype(np.int64), cells["key"].copy(), cells["check"].copy()
        return made

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Digests left in each table: owner, digest, 1 or -1; and the tables that came out empty."""
        found: list[tuple] = []
        at = np.flatnonzero(np.abs(self.count) == 1)
        for _ in range(self.size + 1):  # each round empties a cell of every table that goes on
            times = self.count[at]
            keys = self.key[at] * times.astype(np.uint64)
            alone = _check(keys) * times.astype(np.uint32) == self.check[at]
            owner, keys, times = at[alone] // self.size, keys[alone], times[alone]
            if not len(keys):
                break
            order = np.lexsort((keys, owner))
            owner, keys, times = owner[order], keys[order], times[order]
            new = np.ones(len(keys), bool)  # a digest may lie alone in several of its cells
            new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
            owner, keys, times = owner[new], keys[new], times[new]
            found.append((owner, keys, times))
            touched = np.unique(self.add(keys, owner, -times))
            at = touched[np.abs(self.count[touched]) == 1]
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        empty = ~left.reshape(self.n, self.size).any(axis=1)
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), empty
        return *(np.concatenate(x) for x in zip(*found, strict=True)), empty


def _of(owner_counts: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of the digests of the wanted texts, and their new owner numbers."""
    first = np.concatenate([[0], np.cumsum(owner_counts)])
    counts = owner_counts[wanted]
    owner = np.repeat(np.arange(len(wanted)), counts)
    inside = np.arange(counts.sum()) - np.repeat(np.concatenate([[0], np.cumsum(counts)])[:-1], counts)
    return np.repeat(first[:-1][wanted], counts) + inside, owner


def differences(old: tuple, new: tuple, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pairs' differing digests: pair, digest, 1 (only the old text has it) or -1; and the cells that sufficed.

    ``old`` and ``new`` are results of ``paragraph_digests`` with as many texts. All pairs
    begin with the cells of a stored fingerprint; those that fail go on with more.
    """
    n = len(old[1])
    pending, size, used = np.arange(n), cells, np.zeros(n, np.int64)
    found: list[tuple] = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    while len(pending):
        tables = []
        for digests, counts in (old, new):
            at, owner = _of(counts, pending)
            tables.append(Sketches(digests[at], owner, len(pending), size))
        owner, keys, times, empty = tables[0].subtract(tables[1]).peel()
        done = empty[owner]
        found.append((pending[owner[done]], keys[done], times[done]))
        used[pending[empty]] = size
        pending = pending[~empty]
        if len(pending) and size > 1000 * int((old[1] + new[1])[pending].max()) + 1000:
            raise ArithmeticError("two paragraphs of one text share a 64-bit digest")
        size *= GROWTH
    return *(np.concatenate(x) for x in zip(*found, strict=True)), used


def _lists(owner: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Values as one sorted list per owner, as signed numbers."""
    values = values.view(np.int64)
    order = np.lexsort((values, owner))
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[order]))


def _compare(kept: list[pa.Array], old: list[bytes], news: list[list[bytes]], names: list[str]) -> pa.RecordBatch:
    """The output rows of some texts, after the columns that are kept."""
    n = len(old)
    before = paragraph_digests(old)

    def sketched(digests: tuple) -> list[str]:
        return Sketches(digests[0], np.repeat(np.arange(n), digests[1]), n, CELLS).texts()

    columns = [*kept, pa.array(sketched(before)), pa.array(before[1], pa.int64())]
    for texts in news:
        after = paragraph_digests(texts)
        owner, digests, times, used = differences(before, after)
        changed, both = np.bincount(owner, minlength=n), before[1] + after[1]
        likeness = np.where(both > 0, (both - changed) / np.maximum(both, 1), 1.0)
        columns += [
            pa.array(sketched(after)),
            pa.array(likeness),
            _lists(owner[times > 0], digests[times > 0], n),
            _lists(owner[times < 0], digests[times < 0], n),
            pa.array(used),
        ]
    return pa.RecordBatch.from_arrays(columns, names)


def compare_versions(rows: DataFrame, keep: list[str], old: str, news: list[str]) -> DataFrame:
    """Every row's ``old`` text against each of its ``news``, by their sketches.

    Returns the columns to ``keep``, ``fingerprint`` and ``n_paragraphs`` of the old text,
    and per new column its name with ``_fingerprint``, ``_likeness`` (the share of both
    texts' paragraphs that are in both; 1 if neither has any), ``_lost`` and ``_gained``
    (digests only the old or only the new text has) and ``_cells`` (the size that sufficed).
    A fingerprint is a table of CELLS cells in base64, equal for equal texts.

    Null texts are empty; empty texts have no paragraphs; null keys and repeated rows are
    kept; an empty table gives no rows. Columns to keep may have any name but those
    returned; others are left out. A task holds one batch of texts, and compares
    SLICE_BYTES or one row of it at a time.
    """
    ship_package(rows.sparkSession)
    made = [("fingerprint", "string"), ("n_paragraphs", "long")]
    for n in news:
        made += [(f"{n}_fingerprint", "string"), (f"{n}_likeness", "double"), (f"{n}_lost", "array<long>")]
        made += [(f"{n}_gained", "array<long>"), (f"{n}_cells", "long")]
    schema = [(f"_keep{i}", rows.schema[c].dataType.simpleString()) for i, c in enumerate(keep)] + made
    names, width = [name for name, _ in schema], len(keep)
    kept = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    texts = [F.coalesce(F.col(c), F.lit("")).cast("binary").alias(f"_text{i}") for i, c in enumerate([old, *news])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(i) for i in range(batch.num_columns)]
            sizes = sum(pc.binary_length(c).to_numpy().astype(np.int64) for c in columns[width:])
            upto, at = np.concatenate([[0], np.cumsum(sizes)]), 0
            while at < batch.num_rows:
                last = max(at + 1, int(np.searchsorted(upto, upto[at] + SLICE_BYTES, "right")) - 1)
                part = [c.slice(at, last - at) for c in columns]
                held = [c.to_pylist() for c in part[width:]]
                yield _compare(part[:width], held[0], held[1:], names)
                at = last

    compared = rows.select(*kept, *texts).mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in schema))
    return compared.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], *[name for name, _ in made])


def read_difference(a: str, b: str) -> tuple[list[int], list[int]] | None:
    """What two stored fingerprints differ by: digests only the first and only the second has.

    None if their cells do not suffice, and the texts must be sketched in more.
    """
    owner, keys, times, empty = Sketches.read([a]).subtract(Sketches.read([b])).peel()
    if not empty[0]:
        return None
    found = keys.view(np.int64)
    return sorted(found[times > 0].tolist()), sorted(found[times < 0].tolist())
