"""Near-duplicates by fast similarity sketches, banding and exact verification.

A sketch has one bin per coordinate. In each round every shingle lands in one bin,
and a bin keeps the smallest value of the first round that reached it; late rounds
visit the bins in turn, so every bin fills, for sets of any size. Equal bins are as
likely as the sets are similar. Bands of bins are join keys; what meets in a band is
compared on the full shingle sets.

Documents with equal sets are one class first. Then, per band key:

1. each class is compared with the one there that meets most others, the hub, and
   linked classes get a component;
2. two classes of a hub in different components, not both linked to it, are compared
   if what each adds to the hub and lacks of it lets them reach the threshold at all.

So every pair that shares a key is connected, compared or ruled out by exact counts,
and no group is expanded into all its pairs. A pair at the threshold of 0.85 shares none of
40 bands of 6 with probability 6e-9.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwright.llm.common import ship_package
from rankwright.llm.components import components
from rankwright.sources.scratch import materialize

#: Words a worker remembers the hash of.
REMEMBERED = 1_000_000
#: Classes compared with one copy of a class's shingles in one task.
COMPARED_PER_GROUP = 64
_M1, _M2, _GOLDEN = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def hash_word(word: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = hash_word(word)
        return found


@lru_cache(maxsize=1)
def word_hashes() -> _WordHashes:
    return _WordHashes()


def shingle_set(text: bytes, width: int) -> np.ndarray:
    """The sorted hashes of a text's distinct runs of ``width`` words, ASCII letters lowered.

    Fewer words give one run of all of them; no words give none.
    """
    found = text.lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(word_hashes().__getitem__, found), np.uint64, n)
    k = min(n, width)
    run = np.full(n - k + 1, np.uint64(k * int(_GOLDEN) % 2**64))
    for i in range(k):
        run = mix(run + h[i : n - k + 1 + i]) * _GOLDEN
    return np.unique(run)


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """The sketch of each non-empty set, a row of ``bins`` numbers."""
    n, t = len(sets), np.uint64(bins)
    out = np.full(n * bins, np.iinfo(np.uint64).max)
    owner = np.repeat(np.arange(n, dtype=np.int64), [len(s) for s in sets])
    items = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    unfilled = np.iinfo(np.uint64).max
    for r in range(2 * bins):
        if not len(items):
            break
        h = mix(items + np.uint64((r + 1) * int(_GOLDEN) % 2**64))
        # Rounds order the values; the high bits choose the bin, the low bits the value.
        value = (np.uint64(r) << np.uint64(48)) | (h & np.uint64((1 << 48) - 1))
        place = ((h >> np.uint64(48)) * t >> np.uint64(16)).astype(np.int64) if r < bins else r - bins
        np.minimum.at(out, owner * bins + place, value)
        if r < 8 or r % 8 == 0 or r >= bins:
            open_ = (out.reshape(n, bins) == unfilled).any(axis=1)
            still = open_[owner]
            if not still.all():
                items, owner = items[still], owner[still]
    return out.reshape(n, bins)


def _bands(sketch: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    n = len(sketch)
    parts = sketch.reshape(n, bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64) * _M1, (n, bands)).copy()
    for i in range(rows):
        key = mix(key + parts[:, :, i]) * _GOLDEN
    return key.view(np.int64)


def sketch_documents(documents: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """``id``, ``n_shingles``, ``digest`` of the set and band ``keys`` of (``id``, ``text``)."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(t, width) for t in part.column(1).cast(pa.binary()).to_pylist()]
                full = [i for i, s in enumerate(sets) if len(s)]
                keys: list = [None] * len(sets)
                if full:
                    found = _bands(sketches([sets[i] for i in full], bands * rows), bands, rows)
                    for i, row in zip(full, found, strict=True):
                        keys[i] = row
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    ["id", "n_shingles", "digest", "keys"],
                )

    return documents.mapInArrow(run, "id long, n_shingles long, digest binary, keys array<long>")


def compared_pairs(pairs: DataFrame, documents: DataFrame, width: int, with_added: bool = False) -> DataFrame:
    """Pairs (``a``, ``b``) with the sizes of their full shingle sets, ``n_a`` and ``n_b``, and ``shared``.

    ``added`` holds the shingles of ``a`` that ``b`` lacks, if asked for. Each ``b`` is
    compared in groups of bounded size: its shingles are copied to as many groups as
    its pairs need, so a hub is spread over tasks. Texts travel once; their sets then
    go only where they are compared.
    """
    sizes = pairs.groupBy("b").agg(F.ceil(F.count("*") / COMPARED_PER_GROUP).cast("int").alias("groups"))
    grouped = pairs.join(sizes, "b").withColumn("part", F.pmod(F.xxhash64("a"), F.col("groups")).cast("int"))
    hub = F.struct(F.col("b").alias("hub"), "part")
    roles = grouped.select(F.col("a").alias("id"), hub.alias("role")).unionByName(
        grouped.select(F.col("b").alias("id"), hub.alias("role")).distinct()
    )
    wanted = documents.join(roles, "id").select("id", "text", "role.hub", "role.part")

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, packed = None, b""
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                sets = []
                for id_, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), strict=True):
                    if id_ != last:  # the join leaves the roles of a document together
                        last, packed = id_, shingle_set(text, width).tobytes()
                    sets.append(packed)
                columns = [part.column(0), part.column(2), part.column(3), pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["id", "hub", "part", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, hub = np.empty(0, np.uint64), None
        for batch in batches:
            ids, hubs, sizes_, shared, added = [], [], [], [], []
            for id_, hub_, packed in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                found = np.frombuffer(packed, np.uint64)
                if id_ == hub_:
                    of, hub = found, hub_
                    continue
                both = np.isin(found, of, assume_unique=True)
                ids.append(id_), hubs.append(hub), sizes_.append((len(found), len(of))), shared.append(int(both.sum()))
                added.append(found[~both].view(np.int64) if with_added else [])
            columns = [pa.array(x, pa.int64()) for x in (ids, hubs, [n for n, _ in sizes_], [n for _, n in sizes_], shared)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(added, pa.list_(pa.int64()))], ["a", "b", "n_a", "n_b", "shared", "added"])

    placed = wanted.mapInArrow(shingles, "id long, hub long, part int, shingles binary")
    # A hub's own row comes first in each of its groups.
    groups = placed.repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("id") != F.col("hub"))
    return groups.mapInArrow(compare, "a long, b long, n_a long, n_b long, shared long, added array<long>")


def _left_to_compare(compared: DataFrame, named: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) of classes under one hub that may be linked though a hub does not link them.

    Let x not be linked to hub h. A class y of the same hub shares with x what both have
    of h, at most |h| less the larger of what they lack, and what both added to h. So
    without a common addition, y must be small enough for that bound, which no y
    as large as h is; with some, their number enters the bound. Both cases are joins of
    few rows: additions are the edits of copies and seldom agree, and only an x just
    short of the hub has a partner smaller than the hub.
    """
    ones = compared.join(named.withColumnRenamed("node", "a"), "a", "left").select(
        F.col("b").alias("hub"), F.col("a").alias("id"), F.coalesce("component", "a").alias("component"), "linked",
        F.col("n_a").alias("n"), F.col("n_b").alias("n_hub"), (F.col("n_b") - F.col("shared")).alias("lacks"), "added",
    )
    open_ = ones.filter(~F.col("linked")).groupBy("hub").agg(F.min("n").alias("_"))
    ones = ones.join(open_.select("hub"), "hub")
    least = ones.groupBy("hub").agg(F.min("n").alias("least"))

    def side(df: DataFrame, mark: str) -> DataFrame:
        return df.withColumnsRenamed({c: f"{c}_{mark}" for c in ("id", "component", "linked", "n", "lacks", "n_hub") if c in df.columns})

    other = (F.col("component_x") != F.col("component_y")) & (F.col("linked_y") | (F.col("id_x") < F.col("id_y")))
    fitting = 100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y")
    most = F.col("n_hub_x") - F.greatest("lacks_x", "lacks_y")  # of h in both

    def reaches(shared: Column) -> Column:
        return (100 + percent) * shared >= percent * (F.col("n_x") + F.col("n_y"))

    plain = ones.drop("added")
    near = plain.filter(~F.col("linked")).join(least, "hub").filter(
        (100 + percent) * (F.col("n_hub") - F.col("lacks")) >= percent * (F.col("n") + F.col("least"))
    )
    alone = side(near, "x").join(side(plain.drop("n_hub"), "y"), "hub").filter(other & fitting & reaches(most))

    edits = ones.withColumn("edit", F.explode("added")).drop("added")
    agreed = side(edits.filter(~F.col("linked")), "x").join(side(edits.drop("n_hub"), "y"), ["hub", "edit"])
    added = [F.col(f"n_{c}") - F.col("n_hub_x") + F.col(f"lacks_{c}") for c in ("x", "y")]
    agreed = agreed.filter(other & fitting & reaches(most + F.least(*added)))  # as if the smaller addition agreed whole
    counted = agreed.groupBy("hub", "id_x", "id_y", "n_x", "n_y", "n_hub_x", "lacks_x", "lacks_y").agg(F.count("*").alias("both"))
    together = counted.filter(reaches(most + F.col("both")))
    columns = [F.col("id_x").alias("a"), F.col("id_y").alias("b")]
    return alone.select(*columns).unionByName(together.select(*columns)).distinct()


def near_duplicates(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = 5,
    percent: int = 80,
    bands: int = 40,
    rows: int = 6,
) -> DataFrame:
    """``key``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Rows are linked if their sets of ``width``-word shingles share ``percent`` of
    their union; a component's id is its smallest key. Null and empty texts have no
    shingles and are alone. Rows with one key (repeated rows) must hold one text, and
    are one member that is returned as often as it occurs. Keys are integers; a row
    with a null key is returned alone, with a null component, and kept. Empty tables
    give no rows; other columns are left out.
    """
    ids = documents.select(F.col(key).cast("long").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    known = materialize(sketch_documents(ids, width, bands, rows), "sketches")

    filled = known.filter("n_shingles > 0 and id is not null")
    classes = filled.groupBy("digest", "n_shingles").agg(F.min("id").alias("class"))
    # The smallest member stands for its class; repeated rows of it are one.
    heads = filled.join(classes.select(F.col("class").alias("id")), "id", "left_semi").dropDuplicates(["id"])
    banded = heads.select("id", F.explode("keys").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1")
    met = materialize(banded.join(shared, "band"), "bands")
    # The class that meets most others leads a key: an original rather than one of its copies.
    weight = met.groupBy("id").agg(F.sum("n").alias("weight"))
    lead = met.select("id", "band").join(weight, "id").groupBy("band").agg(F.min_by("id", F.struct(-F.col("weight"), F.col("id"))).alias("hub"))
    met = materialize(met.drop("n").join(lead, "band"), "bands")

    texts = ids.filter("id is not null")
    pairs = met.filter("id <> hub").select(F.col("id").alias("a"), F.col("hub").alias("b")).distinct()
    linked = 100 * F.col("shared") >= percent * (F.col("n_a") + F.col("n_b") - F.col("shared"))
    compared = compared_pairs(pairs, texts, width, with_added=True).withColumn("linked", linked)
    compared = materialize(compared, "compared")
    links = compared.filter("linked").select("a", "b")
    named = components(links, "a", "b")
    second = materialize(_left_to_compare(compared, named, percent), "pairs")
    if not second.isEmpty():
        more = materialize(compared_pairs(second, texts, width).filter(linked).select("a", "b"), "linked")
        if not more.isEmpty():
            named = components(links.unionByName(more), "a", "b")

    of_class = classes.join(named.withColumnRenamed("node", "class"), "class", "left").select(
        "digest", "n_shingles", F.coalesce("component", "class").alias("component_id")
    )
    alone = known.filter("n_shingles = 0 or id is null").select("id", "n_shingles", F.col("id").alias("component_id"))
    member = filled.join(of_class, ["digest", "n_shingles"]).select("id", "n_shingles", "component_id")
    return member.unionByName(alone).select(
        F.col("id").alias(key), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
