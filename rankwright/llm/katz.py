"""Katz backoff language model of pairs of words, fitted and applied to a corpus.

P(w | v) is d(r) r / c(v) for a pair seen r times in training, and alpha(v) P(w)
otherwise; P(w) is (c(w) + 1/2) / Z with one more type for all unknown words. The
discount d(r) is Good and Turing's for small r, where theirs is a discount, and takes
a constant from larger counts, so every context keeps some mass. alpha(v) is
what makes the probabilities after v sum to one over all words and the unknown type.

Nothing of the size of the vocabulary is ever in one place. Work is dealt by words:

1. Chunks of documents become sorted pairs with the documents they occur in, split by
   the second word into blocks of bounded size. Very frequent words are
   split over several blocks by the first word; their counts are taken beforehand.
2. A block holds all pairs of its words, so it has the counts of words and pairs. It
   adds up what it knows of every document's score, and passes on two things by
   first word: the discounted mass and the words seen after it, and held-out pairs
   that were never seen.
3. With the counts of counts known, each block of first words has its alphas and adds
   them to the documents of unseen pairs.
4. Sums of the blocks are added up per document.

The blocks of 1 and 2 are the model's tables, partitioned by word: they are shuffled,
counted and read where they lie. Words are known by 64-bit hashes, contexts by 48 bits.
"""

from __future__ import annotations

from array import array
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwright.llm.common import ship_package
from rankwright.llm.minhash import hash_word, mix
from rankwright.sources.scratch import materialize

#: Pseudo-words; no word holds white space.
_START, _END = b" start", b" end"
#: Bounds of a chunk of documents, and the tokens of a block of words.
CHUNK_DOCUMENTS, CHUNK_TOKENS, BLOCK_TOKENS = 8192, 1_500_000, 2_000_000
#: Counts up to this one are discounted by Good and Turing's estimate.
TURING = 5
_ID_BITS, _DOC_BITS = 25, 14
_CONTEXT = np.uint64((1 << 48) - 1)
_PAIRS = "target int, kind int, chunk long, a binary, b binary, c binary, d binary, e binary, f binary"


@dataclass(frozen=True)
class Discounts:
    """d(r) r for r = 1 to TURING by count, and the constant taken from larger counts."""

    small: tuple[float, ...]
    constant: float


def discounts(counts: list[int], constant: float = 0.75) -> Discounts:
    """From the numbers of pairs seen 1, 2, ... TURING + 1 times.

    (r + 1) n(r + 1) / n(r), where that lies between 0 and r; else r less the constant.
    """
    small = []
    for r in range(1, TURING + 1):
        turing = (r + 1) * counts[r] / counts[r - 1] if counts[r - 1] else 0.0
        small.append(turing if 0 < turing < r else r - constant)
    return Discounts(tuple(small), constant)


def _tokens(text: bytes) -> list[bytes]:
    return text.lower().split()


def _texts(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Batches in small slices, so few texts are Python objects at a time; then memory goes back."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
    pa.default_memory_pool().release_unused()


def _frequent(documents: DataFrame, share: float) -> tuple[int, list[bytes]]:
    """All tokens, and the words that make up more than ``share`` of them.

    A task passes on the words with more than half that share of its own tokens, which
    is at most 2 / share of them; a word above the share overall is above half of it in
    some task. The list is at most 1 / share long, by its condition. It only says which
    words are dealt over several blocks; a word it lacks is counted like any other.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, total = Counter(), 0
        for batch in _texts(batches):
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                found = _tokens(text)
                seen.update(found)
                total += len(found) + 1
            if len(seen) > 100_000:  # words far below the share go; the list only directs rows, it counts nothing
                seen = Counter({w: n for w, n in seen.items() if n > share / 4 * total})
        words = [w for w, n in seen.items() if n > share / 2 * total]
        yield pa.RecordBatch.from_arrays(
            [pa.array([b" ", *words], pa.binary()), pa.array([total, *(seen[w] for w in words)], pa.int64())], ["word", "n"]
        )

    summed = documents.select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = summed.filter(F.col("word") == F.lit(bytearray(b" "))).agg(F.sum("n")).first()[0] or 0
    found = summed.filter((F.col("n") > share * total) & (F.col("word") != F.lit(bytearray(b" ")))).collect()
    return total, sorted(bytes(r["word"]) for r in found)


def _counted(documents: DataFrame, words: list[bytes]) -> dict[bytes, int]:
    """Exact training counts of a few words."""
    wanted = frozenset(words)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in _texts(batches):
            for text in batch.column("text").cast(pa.binary()).to_pylist():
                seen.update(filter(wanted.__contains__, _tokens(text)))
        yield pa.RecordBatch.from_arrays([pa.array(seen.keys(), pa.binary()), pa.array(seen.values(), pa.int64())], ["word", "n"])

    if not words:
        return {}
    rows = documents.filter("train").select("text").mapInArrow(count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return dict.fromkeys(words, 0) | {bytes(r["word"]): r["n"] for r in rows.collect()}


class _Numbered(dict):
    """Words numbered in the order they are met."""

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _hash_of(word: bytes) -> np.uint64:
    return np.uint64(hash_word(word))


def _pack48(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def _unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").ravel()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 6]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["target", "kind", "chunk", "a", "b", "c", "d", "e", "f"]
    )


def _split_pairs(documents: DataFrame, blocks: int, hot: dict[bytes, int]) -> DataFrame:
    """Chunks of (``id``, ``text``, ``train``) as sorted pairs by block: kind 1, and kind 0 with the ids.

    Kind 1: second words, pairs of each, first words of the pairs, occurrences of each,
    documents of the occurrences, and which documents are for training.
    """

    def pairs_of(chunk: int, ids: list, trains: list, numbers: _Numbered, tokens: array, lengths: list) -> Iterator[tuple]:
        second = np.frombuffer(tokens, np.uint32).astype(np.uint64)
        n_tokens = np.array(lengths, np.int64)
        first = np.empty_like(second)
        first[1:] = second[:-1]
        first[np.cumsum(n_tokens) - n_tokens] = numbers[_START]
        doc = np.repeat(np.arange(len(ids), dtype=np.uint64), n_tokens)
        if len(numbers) >= 1 << _ID_BITS:
            raise ValueError("a document with over 33 million different words")
        key = np.sort((second << np.uint64(_ID_BITS + _DOC_BITS)) | (first << np.uint64(_DOC_BITS)) | doc)
        del second, first, doc
        names = np.fromiter(map(hash_word, numbers), np.uint64, len(numbers))  # each once: nothing to remember
        doc = (key & np.uint64((1 << _DOC_BITS) - 1)).astype(np.uint16)
        pair = key >> np.uint64(_DOC_BITS)
        new = np.flatnonzero(np.concatenate(([True], pair[1:] != pair[:-1])))
        occurrences = np.diff(np.append(new, len(pair)))
        pair = pair[new]
        i2, i1 = (pair >> np.uint64(_ID_BITS)).astype(np.int64), (pair & np.uint64((1 << _ID_BITS) - 1)).astype(np.int64)
        spread = np.zeros(len(numbers), bool)
        spread[[numbers[w] for w in hot if w in numbers]] = True
        home = mix(names) % np.uint64(blocks)
        block = np.where(spread[i2], mix(names[i1] ^ names[i2]) % np.uint64(blocks), home[i2]).astype(np.int32)
        by_block = np.argsort(block, kind="stable")
        edges = np.searchsorted(block[by_block], np.arange(blocks + 1))
        doc_of = np.append(new, len(key))
        train = np.packbits(np.array(trains, bool)).tobytes()
        for target in range(blocks):
            at = by_block[edges[target] : edges[target + 1]]
            if not len(at):
                continue
            w2, counts = i2[at], occurrences[at]
            starts = np.flatnonzero(np.concatenate(([True], w2[1:] != w2[:-1])))
            # The documents of the chosen pairs, run by run.
            inner = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            docs = doc[np.repeat(doc_of[at], counts) + inner]
            yield (
                target, 1, chunk, names[w2[starts]].tobytes(), np.diff(np.append(starts, len(at))).astype("<u4").tobytes(),
                _pack48(names[i1[at]] & _CONTEXT), counts.astype("<u4").tobytes(), docs.astype("<u2").tobytes(), train,
            )
        yield (
            chunk % blocks, 0, chunk, np.array(ids, "<i8").tobytes(), n_tokens.astype("<i8").tobytes(), train, b"", b"", b"",
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = TaskContext.get().partitionId() << 32
        ids, trains, lengths, tokens, numbers = [], [], [], array("I"), _Numbered()
        for batch in _texts(batches):
            texts = batch.column(1).cast(pa.binary())
            for id_, text, train in zip(batch.column(0).to_pylist(), texts.to_pylist(), batch.column(2).to_pylist(), strict=True):
                before = len(tokens)
                tokens.extend(map(numbers.__getitem__, _tokens(text)))
                tokens.append(numbers[_END])
                ids.append(id_), trains.append(train), lengths.append(len(tokens) - before)
                if len(ids) >= CHUNK_DOCUMENTS or len(tokens) >= CHUNK_TOKENS:
                    for row in pairs_of(chunk, ids, trains, numbers, tokens, lengths):
                        yield _batch([row])
                    chunk += 1
                    ids, trains, lengths, tokens, numbers = [], [], [], array("I"), _Numbered()
        if ids:
            for row in pairs_of(chunk, ids, trains, numbers, tokens, lengths):
                yield _batch([row])

    return documents.mapInArrow(run, _PAIRS)


def _by_target(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict]]]:
    """Rows of each target in turn; rows come sorted by target."""
    target, rows = None, []
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i] for name in batch.schema.names}
            row = {k: x.as_buffer() if pa.types.is_binary(x.type) else x.as_py() for k, x in row.items()}
            if row["target"] != target and rows:
                yield target, rows
                rows = []
            target = row["target"]
            rows.append(row)
    if rows:
        yield target, rows


def _grouped(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, inverse = np.unique(keys, return_inverse=True)
    return found, inverse.ravel()


def _sum_by(index: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(index, weights=weights, minlength=n)


def _by_context(blocks: int, contexts: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    home = (mix(contexts) % np.uint64(blocks)).astype(np.int32)
    order = np.argsort(home, kind="stable")
    edges = np.searchsorted(home[order], np.arange(blocks + 1))
    for target in range(blocks):
        at = order[edges[target] : edges[target + 1]]
        if len(at):
            yield target, at


def _touched(docs: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """The documents of a chunk that occur, and the sums of each value over their occurrences."""
    n = int(docs.max()) + 1
    at = np.flatnonzero(np.bincount(docs, minlength=n))
    return at.astype("<u2"), [np.bincount(docs, weights=v, minlength=n)[at] for v in values]


def _count_block(rows: list[dict], blocks: int, hot: dict[int, int], constant: float) -> Iterator[tuple]:
    """What a block of second words passes on.

    Kind 2, by chunk: for its documents, the sums of log10(c + 1/2) and of the score so
    far, then the numbers of known tokens, of pairs seen 1 to TURING times, and of
    unseen pairs. Kind 3, by first word: the sum of c + 1/2 over the words seen after
    it, and the numbers and counts of these pairs. Kind 4: unseen first words and their
    documents. Kind 5, once: counts of counts, of training tokens and of words.
    """
    w2 = np.concatenate([np.repeat(np.frombuffer(r["a"], "<u8"), np.frombuffer(r["b"], "<u4")) for r in rows])
    w1 = np.concatenate([_unpack48(r["c"]) for r in rows])
    trained = []
    for r in rows:
        counts = np.frombuffer(r["d"], "<u4").astype(np.int64)
        flags = np.unpackbits(np.frombuffer(r["f"], np.uint8))[np.frombuffer(r["e"], "<u2")]
        trained.append(np.add.reduceat(flags, np.cumsum(counts) - counts, dtype=np.int32))
    in_training = np.concatenate(trained)
    del trained
    ends = np.cumsum([len(r["d"]) // 4 for r in rows])

    # Counts of pairs and words, a quarter of the words at a time to bound memory.
    r_at, c_at = np.empty(len(w2), np.int32), np.empty(len(w2), np.int64)
    own_types, of_counts, seen_pairs = 0, np.zeros(TURING + 1, np.int64), []
    hot_words = np.fromiter(hot, np.uint64, len(hot))
    quarter = (w2 >> np.uint64(13)) & np.uint64(3)
    for part in range(4):
        at = np.flatnonzero(quarter == part)
        if not len(at):
            continue
        pairs, pair_of = _grouped(mix(w2[at] ^ mix(w1[at])))
        r_of = _sum_by(pair_of, in_training[at], len(pairs)).astype(np.int32)
        first_at = np.empty(len(pairs), np.int64)
        first_at[pair_of] = at
        words, word_of = _grouped(w2[at])
        c_of = _sum_by(word_of, in_training[at], len(words)).astype(np.int64)
        own_types += int((c_of > 0).sum())
        for i in np.flatnonzero(np.isin(words, hot_words)):
            own_types -= int(c_of[i] > 0)  # words of several blocks are counted by the caller
            c_of[i] = hot[int(words[i])]
        r_at[at], c_at[at] = r_of[pair_of], c_of[word_of]
        of_counts += [int((r_of == k).sum()) for k in range(1, TURING + 2)]
        seen_pairs.append(first_at[r_of > 0])

    unseen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for r, end in zip(rows, ends, strict=True):
        own = slice(end - len(r["d"]) // 4, end)
        counts, docs = np.frombuffer(r["d"], "<u4"), np.frombuffer(r["e"], "<u2")
        r_own, c_own = r_at[own], c_at[own]
        half = np.log10(c_own + 0.5)
        # As a later token's context, a word divides by its count.
        context = np.where(w2[own] == _hash_of(_END), 0.0, np.log10(np.maximum(c_own, 1)))
        large = np.where(r_own > TURING, np.log10(np.maximum(r_own - constant, 0.25)), 0.0)
        score = np.where(r_own > 0, large, half) - context
        each = [half, score, c_own > 0, *(r_own == k for k in range(1, TURING + 1)), r_own == 0]
        at, sums = _touched(docs, [np.repeat(x, counts) for x in each])
        small = np.concatenate(sums[2:]).astype("<u4").tobytes()
        yield (r["chunk"] % blocks, 2, r["chunk"], sums[0].tobytes(), sums[1].tobytes(), small, at.tobytes(), b"", b"")
        missing = np.repeat(r_own == 0, counts)
        unseen.append((np.repeat(w1[own], counts)[missing], docs[missing], np.full(int(missing.sum()), r["chunk"], np.int64)))

    contexts, docs, chunks = (np.concatenate(x) for x in zip(*unseen, strict=True))
    del unseen
    for target, at in _by_context(blocks, contexts):
        found, first = np.unique(chunks[at], return_index=True)  # chunks come in order
        runs = np.diff(np.append(first, len(at)))
        yield (
            target, 4, 0, _pack48(contexts[at]), docs[at].astype("<u2").tobytes(), found.tobytes(), runs.astype("<u4").tobytes(), b"", b"",
        )

    at = np.concatenate(seen_pairs) if seen_pairs else np.empty(0, np.int64)
    r, contexts, mass = r_at[at], w1[at], c_at[at] + 0.5
    del w2, w1, r_at, c_at
    contexts, index = _grouped(contexts)
    n = len(contexts)
    mass = _sum_by(index, mass, n)
    numbers = [_sum_by(index, r == k, n) for k in range(1, TURING + 1)]
    numbers += [_sum_by(index, r > TURING, n), _sum_by(index, np.where(r > TURING, r, 0), n)]
    table = np.stack(numbers).astype("<u4")
    for target, at in _by_context(blocks, contexts):
        yield (target, 3, 0, _pack48(contexts[at]), mass[at].tobytes(), table[:, at].tobytes(), b"", b"", b"")
    totals = [*of_counts.tolist(), int(in_training.sum()), own_types]
    yield (0, 5, 0, np.array(totals, "<i8").tobytes(), b"", b"", b"", b"", b"")


def _alphas(rows: list[dict], blocks: int, found: Discounts, z: float) -> Iterator[tuple]:
    """Kind 6, by chunk: log10 of count times alpha, added up for documents of unseen pairs."""
    tables = [r for r in rows if r["kind"] == 3]
    asked = [r for r in rows if r["kind"] == 4]
    if not asked or not tables:
        return
    contexts, index = _grouped(np.concatenate([_unpack48(r["a"]) for r in tables]))
    n = len(contexts)
    mass = _sum_by(index, np.concatenate([np.frombuffer(r["b"], "<f8") for r in tables]), n)
    numbers = np.concatenate([np.frombuffer(r["c"], "<u4").reshape(TURING + 2, -1) for r in tables], axis=1)
    numbers = np.stack([_sum_by(index, row, n) for row in numbers])
    total = sum(k * numbers[k - 1] for k in range(1, TURING + 1)) + numbers[-1]
    # What is taken from the counts, which is the mass left over times the count.
    left = sum((k - found.small[k - 1]) * numbers[k - 1] for k in range(1, TURING + 1)) + found.constant * numbers[TURING]
    value = np.log10(left) - np.log10(1 - mass / z)
    del total
    for r in asked:
        want, docs = _unpack48(r["a"]), np.frombuffer(r["b"], "<u2")
        at = np.minimum(np.searchsorted(contexts, want), n - 1)
        add = np.where(contexts[at] == want, value[at], 0.0)
        begin = 0
        for chunk, run in zip(np.frombuffer(r["c"], "<i8").tolist(), np.frombuffer(r["d"], "<u4").tolist(), strict=True):
            ids, index_ = np.unique(docs[begin : begin + run], return_inverse=True)
            sums = np.bincount(index_.ravel(), weights=add[begin : begin + run])
            yield (chunk % blocks, 6, chunk, ids.astype("<u2").tobytes(), sums.tobytes(), b"", b"", b"", b"")
            begin += run


def _document_sums(rows: list[dict]) -> Iterator[tuple[np.ndarray, ...]]:
    """Per chunk: ids, training flags, tokens, and the sums of kinds 2 and 6."""
    by_chunk: dict[int, list[dict]] = {}
    for r in rows:
        by_chunk.setdefault(r["chunk"], []).append(r)
    for parts in by_chunk.values():
        head = next(r for r in parts if r["kind"] == 0)
        ids, tokens = np.frombuffer(head["a"], "<i8"), np.frombuffer(head["b"], "<i8")
        n = len(ids)
        train = np.unpackbits(np.frombuffer(head["c"], np.uint8))[:n].astype(bool)
        sums, small = np.zeros((2, n)), np.zeros((TURING + 2, n))
        for r in parts:
            if r["kind"] == 2:
                at = np.frombuffer(r["d"], "<u2")
                sums[0, at] += np.frombuffer(r["a"], "<f8")
                sums[1, at] += np.frombuffer(r["b"], "<f8")
                small[:, at] += np.frombuffer(r["c"], "<u4").reshape(TURING + 2, -1)
            elif r["kind"] == 6:
                sums[1, np.frombuffer(r["a"], "<u2")] += np.frombuffer(r["b"], "<f8")
        yield ids, train, tokens, sums, small


def score_documents(
    documents: DataFrame, train: Column, key: str = "doc_id", text: str = "text", constant: float = 0.75
) -> DataFrame:
    """Every document's scores under the model of the rows where ``train`` holds.

    ``key``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score``: log10 probabilities of the whole text by words alone and by pairs. Tokens
    are runs without ASCII white space, A to Z lowered, and one end per text. A null
    or empty text is one end. A null ``train`` counts as true, a null key stays null.
    Without training rows every word is unknown. Rows are scored one for one, repeated
    ones each; an empty table gives no rows; other columns are left out. Keys are
    integers.
    """
    spark = documents.sparkSession
    ship_package(spark)
    # A key of this value stands for null on the way.
    no_key = -(2**63)
    rows = documents.select(
        F.coalesce(F.col(key).cast("long"), F.lit(no_key)).alias("id"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
        F.coalesce(train, F.lit(True)).alias("train"),
    )
    total, frequent = _frequent(rows, 0.002)
    blocks = max(12, -(-total // BLOCK_TOKENS))
    hot_share = 0.25 / blocks
    if hot_share < 0.002:  # more blocks make less frequent words too large for one
        total, frequent = _frequent(rows, hot_share)
    hot = _counted(rows, frequent)
    hot_hashes = {int(_hash_of(w)): n for w, n in hot.items()}
    hot_types = sum(n > 0 for n in hot.values())

    def dealt(df: DataFrame) -> DataFrame:
        return df.repartition(blocks, "target").sortWithinPartitions("target", "chunk")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _by_target(batches):
            pairs = [r for r in group if r["kind"] == 1]
            passed = [tuple(x.to_pybytes() if isinstance(x, pa.Buffer) else x for x in r.values()) for r in group if r["kind"] == 0]
            if passed:
                yield _batch(passed)
            if pairs:
                for row in _count_block(pairs, blocks, hot_hashes, constant):
                    yield _batch([row])
        pa.default_memory_pool().release_unused()

    counted = materialize(dealt(_split_pairs(rows, blocks, hot)).mapInArrow(count, _PAIRS), "counted")

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([np.frombuffer(x, "<i8") for x in batch.column("a").to_pylist()], np.int64).reshape(-1, TURING + 3)
            yield pa.RecordBatch.from_arrays([pa.array(found[:, i]) for i in range(TURING + 3)], [f"n{i}" for i in range(TURING + 3)])

    names = [f"n{i}" for i in range(TURING + 3)]
    once = counted.filter("kind = 5").select("a").mapInArrow(totals, ", ".join(f"{n} long" for n in names))
    summed = [x or 0 for x in once.agg(*[F.sum(n).alias(n) for n in names]).first()]
    train_tokens, types = summed[-2], summed[-1] + hot_types
    found = discounts(summed[: TURING + 1], constant)
    z = train_tokens + 0.5 * (types + 1)
    train_documents = rows.filter("train").count()

    def alphas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in _by_target(batches):
            for row in _alphas(group, blocks, found, z):
                yield _batch([row])

    added = dealt(counted.filter("kind in (3, 4)")).mapInArrow(alphas, _PAIRS)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        log_small = np.log10(np.array(found.small))
        for _, group in _by_target(batches):
            for ids, trained, tokens, sums, small in _document_sums(group):
                base = sums[0] - tokens * np.log10(z)
                score = sums[1] + log_small @ small[1 : TURING + 1] - small[-1] * np.log10(z)
                if train_documents:  # the first token's context is the start
                    score = score - np.log10(train_documents)
                columns = [ids, ~trained, tokens, small[0].astype(np.int64), np.full(len(ids), train_tokens, np.int64), base, score]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    schema = "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    scored = dealt(counted.filter("kind in (0, 2)").unionByName(added)).mapInArrow(finish, schema)
    return scored.withColumn("id", F.when(F.col("id") != no_key, F.col("id"))).withColumnRenamed("id", key)
