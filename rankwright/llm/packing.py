"""Packing token sequences by sum-of-squares online placement.

Each piece goes where it least increases the sum of squares of the numbers of
windows at each partial fill level: an array of counts by level decides, and a
stack per level holds the windows. That keeps windows of every fill at hand, so most
pieces close one.

Documents longer than a window are cut into full windows first; only the rest is
placed. A partition packs its own documents, so nothing is shuffled. When it ends,
the windows left open are merged: pieces of the emptiest are cut to fill the
fullest, until at most one is partial.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.llm.bpe import Vocabulary
from rankwright.llm.common import ship_package


class LibraryEncoder(Vocabulary):
    """Words encoded by the tokenizers library's own model."""

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer

        self._tokenize = Tokenizer.from_file(path).model.tokenize

    def encode_word(self, word: str) -> list[int]:
        return [t.id for t in self._tokenize("".join(map(self.letters.__getitem__, word.encode("utf-8"))))]


@lru_cache(maxsize=2)
def _worker(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)


@dataclass
class Piece:
    document: int  # row number in the partition
    start: int
    ids: bytes


@dataclass
class Window:
    number: int
    fill: int = 0
    pieces: list[Piece] = field(default_factory=list)


class SumOfSquares:
    """Online placement into windows of a fixed size."""

    def __init__(self, size: int):
        self.size, self.opened = size, 0
        self._levels = np.zeros(size + 1, np.int64)  # windows at each partial level
        self._open: dict[int, list[Window]] = {}

    def _new(self) -> Window:
        self.opened += 1
        return Window(self.opened - 1)

    def level_for(self, length: int) -> int:
        """The fill level that minimises the sum of squares; ties to the fullest, 0 is a new window.

        Taking a window from level h and leaving one at h + length changes the sum by
        2 (N[h + length] - N[h]) + 2; filling one up changes it by 1 - 2 N[h].
        """
        counts, top = self._levels, self.size - length
        if top == 0:
            return 0
        change = 2 * (counts[length + 1 : self.size] - counts[1:top]) + 2
        change[counts[1:top] == 0] = np.iinfo(np.int64).max
        best, level = 2 * int(counts[length]) + 1, 0
        if len(change):
            at = len(change) - 1 - int(np.argmin(change[::-1]))
            if change[at] <= best:
                best, level = int(change[at]), at + 1
        if counts[top] and 1 - 2 * int(counts[top]) <= best:
            level = top
        return level

    def place(self, piece: Piece) -> Window | None:
        """Put a piece into a window; the window, if that fills it."""
        length = len(piece.ids) // 4
        level = self.level_for(length)
        if level:
            stack = self._open[level]
            window = stack.pop()
            self._levels[level] -= 1
        else:
            window = self._new()
        window.pieces.append(piece)
        window.fill += length
        if window.fill == self.size:
            return window
        self._levels[window.fill] += 1
        self._open.setdefault(window.fill, []).append(window)
        return None

    def close(self) -> Iterator[Window]:
        """The open windows, merged until at most one is partial."""
        left = [w for level in sorted(self._open, reverse=True) for w in self._open[level]]
        self._open, self._levels[:] = {}, 0
        first, last = 0, len(left) - 1
        while first < last:
            full, source = left[first], left[last]
            piece = source.pieces.pop()
            room, length = self.size - full.fill, len(piece.ids) // 4
            taken = min(room, length)
            if taken < length:  # the piece's end moves, its start stays
                kept = length - taken
                source.pieces.append(Piece(piece.document, piece.start, piece.ids[: 4 * kept]))
                piece = Piece(piece.document, piece.start + kept, piece.ids[4 * kept :])
            source.fill -= taken
            full.fill += taken
            full.pieces.append(piece)
            if full.fill == self.size:
                yield full
                first += 1
            if not source.pieces:
                last -= 1
        if first == last:
            yield left[first]


def pack_documents(
    documents: DataFrame,
    vocabulary: str,
    size: int = 2048,
    end_id: int = 1,
    key: str = "doc_id",
    text: str = "text",
    rows_per_batch: int = 512,
) -> DataFrame:
    """All documents as pieces of token sequences of at most ``size`` ids.

    One row per piece: ``key``, ``start`` (its document's ids before it), ``length``,
    ``ids`` (little-endian unsigned 32-bit numbers), ``doc_tokens`` (the document's
    ids with the end id), ``sequence_id`` and ``offset`` (gapless from 0). A document
    is its text's ids and one ``end_id``; null and empty texts are the end id alone.
    Pieces of a document lie in one partition and cover it once; repeated rows are
    packed as often as they occur; an empty table gives no rows. Other columns are
    left out. ``sequence_id`` is the partition's number above 33 bits and a count.

    Open windows are all a task keeps: at most the ids of the partition's documents,
    in practice a few hundred windows.
    """
    ship_package(documents.sparkSession)
    kind = documents.schema[key].dataType.simpleString()
    narrow = documents.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    schema = f"_key {kind}, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, packer = _worker(vocabulary), SumOfSquares(size)
        partition = TaskContext.get().partitionId() << 33
        keys: dict[int, tuple] = {}  # key and tokens of each document of the partition
        done: list[tuple] = []
        rows = 0

        def emit(window: Window) -> None:
            offset = 0
            for piece in window.pieces:
                length = len(piece.ids) // 4
                done.append((*keys[piece.document], piece.start, length, piece.ids, partition | window.number, offset))
                offset += length

        def flush() -> pa.RecordBatch:
            columns = list(zip(*done, strict=True))
            key_, tokens, start, length, ids, sequence, offset = columns
            done.clear()
            longs = [pa.array(x, pa.int64()) for x in (start, length, tokens, sequence, offset)]
            return pa.RecordBatch.from_arrays(
                [pa.array(key_, key_type), longs[0], longs[1], pa.array(ids, pa.binary()), *longs[2:]],
                ["_key", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )

        key_type = None
        for batch in batches:
            key_type = batch.schema.field(0).type
            for at in range(0, batch.num_rows, rows_per_batch):
                part = batch.slice(at, rows_per_batch)
                for k, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    ids = encoder.encode(t) + end
                    keys[rows] = (k, len(ids) // 4)
                    for start in range(0, len(ids), 4 * size):
                        window = packer.place(Piece(rows, start // 4, ids[start : start + 4 * size]))
                        if window:
                            emit(window)
                    rows += 1
                if done:
                    yield flush()
        for window in packer.close():
            emit(window)
        if done:
            yield flush()

    return narrow.mapInArrow(run, schema).withColumnRenamed("_key", key)
