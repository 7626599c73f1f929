"""The prefix trie of conversations as a table of nodes.

A prefix is known by a digest of its turns and their places, so the digests of all
prefixes are running sums (exclusive or) and a long conversation can be summed in
blocks. A shard takes some blocks, enumerates their distinct digests, gives each a slot
by a minimal perfect hash that is verified against the digests themselves, and keeps
its counts in flat arrays by slot. Nodes that several shards know are added up by digest.
Every node is owned by its smallest member, so what is summed over subtrees is counted
in one shard only; each shard adds its part up through the slots of the parents, deepest
nodes first, and the parts are added by digest again.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwright.llm.common import ship_package, words
from rankwright.llm.fingerprints import mix
from rankwright.operators.ordinals import with_ordinal
from rankwright.sources.scratch import materialize

#: Depths of a block and, about, rows of a shard; the results do not depend on them.
BLOCK = 1 << 12
SHARD_ROWS = 1 << 16
#: Ids of one range of this width are joined to one text before they are digested in order.
ENDS_WIDTH = 1 << 12

_NODE = ["d1", "d2"]


class MinimalHash:
    """Distinct 128-bit keys to 0 .. n - 1 by a cascade of bit tables.

    Each level hashes what is left into twice as many places; keys that are alone in
    theirs stay, the others go on (Limasset et al., "Fast and Scalable Minimal Perfect
    Hashing for Massive Key Sets", 2017). A slot is the number of places taken before.
    """

    def __init__(self, first: np.ndarray, second: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        taken = 0
        while len(first):
            at = self._place(first, second, len(self.levels), max(64, 2 * len(first)))
            alone = np.bincount(at, minlength=max(64, 2 * len(first))) == 1
            self.levels.append((alone, taken + np.cumsum(alone) - 1))
            taken += int(alone.sum())
            first, second = first[~alone[at]], second[~alone[at]]

    @staticmethod
    def _place(first: np.ndarray, second: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(first + mix(second + np.uint64(level + 1))) % np.uint64(size)).astype(np.int64)

    def slots(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """The slot of each key; of a key that was not given, any slot or -1."""
        found, left = np.full(len(first), -1, np.int64), np.arange(len(first))
        for level, (alone, rank) in enumerate(self.levels):
            at = self._place(first[left], second[left], level, len(alone))
            here = alone[at]
            found[left[here]] = rank[at[here]]
            left = left[~here]
        return found


def _digested(turns: DataFrame) -> DataFrame:
    """Turns as (conv, turn, a, b, n_words): 120 bits of the digest of role and text."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    halves = [F.conv(F.substring(digest, 15 * i + 1, 15), 16, 10).cast("long") for i in range(2)]
    return turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        halves[0].alias("a"),
        halves[1].alias("b"),
        F.size(words(text)).cast("long").alias("n_words"),
    )


def _rebuilt(turns: DataFrame, every: int, most: int) -> DataFrame:
    """(conv, depth, length, g1, g2, n_words): a row per turn, and one of depth 0 per conversation.

    With ``every`` 0 conversations are as they are. Otherwise the first h turns of a
    conversation are those of the one whose id is the next lower multiple of ``every``,
    h being the CRC-32 of its own id as text modulo ``most + 1``.
    """
    numbered = with_ordinal(_digested(turns), ["conv", "turn", "a", "b"], "_n")
    sizes = materialize(numbered.groupBy("conv").agg(F.min("_n").alias("first"), F.count("*").alias("n")), "conversations")
    piece = "array<struct<at: bigint, a: bigint, b: bigint, n_words: bigint>>"
    nothing = F.array().cast(piece)
    if every:
        lenders = numbered.where(F.col("conv") % every == 0).join(sizes.select("conv", "first"), "conv")
        lenders = lenders.withColumn("at", F.col("_n") - F.col("first")).where(F.col("at") < most)
        heads = lenders.groupBy(F.col("conv").alias("lender")).agg(
            F.array_sort(F.collect_list(F.struct("at", "a", "b", "n_words"))).alias("head")
        )
        take = F.crc32(F.col("conv").cast("string")) % (most + 1)
        lent = sizes.withColumns({"take": take, "lender": F.col("conv") - F.col("conv") % every}).join(heads, "lender", "left")
        lent = lent.withColumn("head", F.slice(F.coalesce("head", nothing), F.lit(1), F.col("take").cast("int")))
    else:
        lent = sizes.withColumns({"take": F.lit(0).cast("long"), "head": nothing})
    kept = F.greatest(F.col("n") - F.col("take"), F.lit(0))
    lent = lent.withColumn("borrowed", F.size("head").cast("long")).withColumn("length", F.col("borrowed") + kept)
    root = F.array(F.struct(*[F.lit(x).cast("long").alias(c) for x, c in ((-1, "at"), (0, "a"), (0, "b"), (0, "n_words"))]))
    top = lent.select("conv", "length", F.inline(F.concat(root, "head"))).withColumn("depth", F.col("at") + 1)
    own = numbered.join(lent.select("conv", "first", "take", "borrowed", "length"), "conv")
    own = own.withColumn("at", F.col("_n") - F.col("first")).where("at >= take")
    own = own.withColumn("depth", F.col("at") - F.col("take") + F.col("borrowed") + 1)
    names = ["conv", "depth", "length", "a", "b", "n_words"]
    rows = top.select(*names).unionByName(own.select(*names))

    def placed(seed: int, half: str) -> Column:
        return F.when(F.col("depth") == 0, F.lit(0).cast("long")).otherwise(F.xxhash64(F.lit(seed), "depth", half))

    return rows.select("conv", "depth", "length", placed(1, "a").alias("g1"), placed(2, "b").alias("g2"), "n_words")


def _with_shards(rows: DataFrame, size: int) -> DataFrame:
    """Rows in blocks dealt over shards, and per later block a row with the sum of the blocks before."""
    blocks = rows.withColumns({"block": F.floor(F.col("depth") / size), "carried": F.lit(False)})
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.where(F.col("length") >= size).groupBy("conv", "block", "length").agg(*[F.bit_xor(g).alias(g) for g in ("g1", "g2")])
    carried = sums.withColumns({g: F.bit_xor(g).over(before) for g in ("g1", "g2")}).where("block > 0").withColumns(
        {"depth": F.col("block") * size - 1, "n_words": F.lit(0).cast("long"), "carried": F.lit(True)}
    )
    shards = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), math.ceil(rows.count() / SHARD_ROWS))
    return blocks.unionByName(carried).withColumn("shard", F.pmod(F.xxhash64("conv", "block"), F.lit(shards)))


def _grouped(slots: np.ndarray, values: np.ndarray, n: int) -> pa.Array:
    """Values as one list per slot."""
    order = np.argsort(slots, kind="stable")
    ends = np.concatenate([[0], np.cumsum(np.bincount(slots, minlength=n))]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values[order], pa.int64()))


_TABLE = (
    "shard long, slot long, parent_slot long, depth long, d1 long, d2 long, p1 long, p2 long, n_words long, "
    "members long, least long, ends array<long>, onward array<long>"
)


def shard_table(rows: pa.Table, size: int) -> pa.Table:
    """One shard's nodes by slot: digest, parent, members, smallest member, and who ends or goes on there."""
    order = rows.sort_by([("conv", "ascending"), ("block", "ascending"), ("depth", "ascending")])
    conv, block, depth, length, n_words = (order[c].to_numpy() for c in ("conv", "block", "depth", "length", "n_words"))
    g = [order[c].to_numpy().view(np.uint64) for c in ("g1", "g2")]
    starts = np.ones(len(conv), bool)
    starts[1:] = (conv[1:] != conv[:-1]) | (block[1:] != block[:-1])
    first = np.flatnonzero(starts)
    digest = []
    for part in g:
        running = np.bitwise_xor.accumulate(part)
        begin = np.where(first > 0, running[first - 1], np.uint64(0))
        digest.append(running ^ np.repeat(begin, np.diff(np.append(first, len(conv)))))
    real = ~order["carried"].to_numpy(zero_copy_only=False)
    conv, depth, length, n_words = conv[real], depth[real], length[real], n_words[real]
    d1, d2 = digest[0][real], digest[1][real]
    p1, p2 = d1 ^ g[0][real], d2 ^ g[1][real]

    by_digest = np.lexsort((d2, d1))
    new = np.ones(len(d1), bool)
    new[1:] = (d1[by_digest][1:] != d1[by_digest][:-1]) | (d2[by_digest][1:] != d2[by_digest][:-1])
    distinct = by_digest[new]
    n = len(distinct)
    table = MinimalHash(d1[distinct], d2[distinct])
    slots = table.slots(d1, d2)
    columns = {}
    for name, values in (("depth", depth), ("d1", d1), ("d2", d2), ("p1", p1), ("p2", p2), ("n_words", n_words)):
        columns[name] = np.empty(n, values.dtype)
        columns[name][slots] = values
        if not (columns[name][slots] == values).all():
            raise ArithmeticError("two prefixes share a 128-bit digest or a slot")
    members, least = np.bincount(slots, minlength=n), np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(least, slots, conv)
    parent = np.full(n, -1, np.int64)
    inner = columns["depth"] % size != 0  # the parent of a block's first node is in another block
    parent[inner] = table.slots(columns["p1"][inner], columns["p2"][inner])
    above = parent[inner]
    if (above < 0).any() or not ((columns["d1"][above] == columns["p1"][inner]) & (columns["d2"][above] == columns["p2"][inner])).all():
        raise ArithmeticError("a prefix has no parent in its shard")
    done, onward = depth == length, (depth % size == size - 1) & (depth < length)
    signed = {name: columns[name].view(np.int64) for name in columns}
    return pa.table(
        {
            "shard": pa.repeat(rows["shard"][0], n),
            "slot": np.arange(n),
            "parent_slot": parent,
            "depth": signed["depth"],
            **{name: signed[name] for name in ("d1", "d2", "p1", "p2", "n_words")},
            "members": members,
            "least": least,
            "ends": _grouped(slots[done], conv[done], n),
            "onward": _grouped(slots[onward], conv[onward], n),
        }
    )


def _nodes(tables: DataFrame) -> DataFrame:
    """Every node once, with its members, owner and children; what shards say of one must agree."""
    same = F.lit(True)
    for c in ("depth", "p1", "p2", "n_words"):
        same = same & (F.min(c) == F.max(c))
    checked = F.when(same, F.min("depth")).otherwise(F.raise_error(F.lit("two prefixes share a 128-bit digest")).cast("long"))
    nodes = tables.groupBy(*_NODE).agg(
        checked.alias("depth"),
        *[F.min(c).alias(c) for c in ("p1", "p2", "n_words")],
        F.sum("members").alias("n_convs"),
        F.min("least").alias("conv_id"),
    )
    nodes = materialize(nodes, "trie-nodes")
    children = nodes.where("depth > 0").groupBy(F.col("p1").alias("d1"), F.col("p2").alias("d2")).agg(F.count("*").alias("n_children"))
    own = F.when(F.col("depth") > 0, (F.col("n_convs") - 1) * F.col("n_words")).otherwise(0)
    found = nodes.join(children, _NODE, "left").withColumns({"n_children": F.coalesce("n_children", F.lit(0)), "own_saved": own})
    return materialize(found, "trie-nodes")


def _from_later_blocks(tables: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """(shard, slot, more_leaves, more_saved): what a conversation owns in the blocks after the one that ends there."""
    block = F.floor(F.col("depth") / size)
    owned = nodes.where(F.col("depth") >= size).groupBy(F.col("conv_id").alias("conv"), block.alias("block")).agg(
        F.count_if(F.col("n_children") == 0).alias("leaves"), F.sum("own_saved").alias("saved")
    )
    to_end = Window.partitionBy("conv").orderBy("block").rowsBetween(0, Window.unboundedFollowing)
    since = owned.withColumns({c: F.sum(c).over(to_end) for c in ("leaves", "saved")})
    earliest = owned.groupBy("conv").agg(F.min("block").alias("earliest"))  # later blocks all have some of its nodes
    onward = tables.where(F.size("onward") > 0).select("shard", "slot", block.alias("ended"), F.explode("onward").alias("conv"))
    onward = onward.join(earliest, "conv").withColumn("block", F.greatest(F.col("ended") + 1, "earliest"))
    return onward.join(since, ["conv", "block"]).groupBy("shard", "slot").agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
    )


_PART = "d1 long, d2 long, leaves long, saved long, parent_conv_id long"


def add_up(nodes: pa.Table) -> pa.Table:
    """One shard's share of what its nodes sum over their subtrees, and the owners' parents."""
    by_slot = nodes.sort_by("slot")
    parent, depth, owner = (by_slot[c].to_numpy() for c in ("parent_slot", "depth", "conv_id"))
    sums = [by_slot[c].to_numpy().copy() for c in ("leaves", "saved")]
    order = np.argsort(depth, kind="stable")
    levels = np.flatnonzero(np.diff(depth[order], prepend=-1))
    for level in np.split(order, levels)[:0:-1]:  # deepest first
        level = level[parent[level] >= 0]
        for values in sums:
            np.add.at(values, parent[level], values[level])
    known = (parent >= 0) & by_slot["own"].to_numpy(zero_copy_only=False)
    above = pa.array(owner[np.maximum(parent, 0)], pa.int64(), mask=~known)
    return pa.table({"d1": by_slot["d1"], "d2": by_slot["d2"], "leaves": sums[0], "saved": sums[1], "parent_conv_id": above})


def _subtree_sums(tables: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    facts = nodes.select(*_NODE, "conv_id", "n_children", "own_saved")
    own = F.col("least") == F.col("conv_id")
    later = _from_later_blocks(tables, nodes, size)
    rows = tables.drop("ends", "onward").join(facts, _NODE).join(later, ["shard", "slot"], "left")
    rows = rows.select(
        "shard", "slot", "parent_slot", "depth", *_NODE, "conv_id", own.alias("own"),
        (F.when(own & (F.col("n_children") == 0), 1).otherwise(0) + F.coalesce("more_leaves", F.lit(0))).cast("long").alias("leaves"),
        (F.when(own, F.col("own_saved")).otherwise(0) + F.coalesce("more_saved", F.lit(0))).cast("long").alias("saved"),
    )
    parts = rows.groupBy("shard").applyInArrow(add_up, _PART)
    above = nodes.select(F.col("d1").alias("p1"), F.col("d2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    firsts = nodes.where((F.col("depth") > 0) & (F.col("depth") % size == 0)).select(*_NODE, "p1", "p2").join(above, ["p1", "p2"])
    none = F.lit(0).cast("long")
    parts = parts.unionByName(firsts.select(*_NODE, none.alias("leaves"), none.alias("saved"), "parent_conv_id"))
    return parts.groupBy(*_NODE).agg(
        F.sum("leaves").alias("n_leaves"), F.sum("saved").alias("saved_tokens"), F.max("parent_conv_id").alias("parent_conv_id")
    )


def _end_digests(tables: DataFrame) -> DataFrame:
    """(d1, d2, ends_sha256): the ids of the conversations that end at a node, ascending.

    A digest is one sequence, so it passes through one task; what it reads there are
    texts of up to ENDS_WIDTH ids each, in order, a batch at a time.
    """
    ends = tables.select(*_NODE, F.explode("ends").alias("conv"))
    ranges = ends.groupBy(*_NODE, F.floor(F.col("conv") / ENDS_WIDTH).alias("range")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")
    )
    ordered = ranges.repartition(*_NODE).sortWithinPartitions(*_NODE, "range").select(*_NODE, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in batches:
            done: list[tuple] = []
            for d1, d2, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if (d1, d2) == current:
                    state.update(b"," + ids.encode())
                else:
                    if current:
                        done.append((*current, state.hexdigest()))
                    current, state = (d1, d2), hashlib.sha256(ids.encode())
            if done:
                yield _rows(done)
        if current:
            yield _rows([(*current, state.hexdigest())])

    def _rows(done: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string())
        arrays = [pa.array(x, k) for x, k in zip(zip(*done, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, [*_NODE, "ends_sha256"])

    return ordered.mapInArrow(run, "d1 long, d2 long, ends_sha256 string")


def prefix_trie(turns: DataFrame, every: int = 0, most: int = 0, block: int = BLOCK) -> DataFrame:
    """One row per distinct prefix of the conversations in (``conv_id``, ``turn``, ``role``, ``text``).

    Turns are in order of ``turn``, null first, then of the digest of role and text; null
    role or text is empty; turns without a conversation take no part; repeated rows are
    turns of their own; an empty table has no nodes; other columns are left out. ``every``
    and ``most`` exchange first turns as ``_rebuilt`` says; a conversation left without
    turns still belongs to the root.

    Returns ``conv_id`` (smallest member), ``depth``, ``parent_conv_id`` (null for the
    root), ``n_convs`` (members), ``n_children``, ``n_leaves`` (childless nodes in the
    subtree), ``saved_tokens`` (words of the last turn times the members after the first,
    over the subtree) and ``ends_sha256`` (of the ids of the members that end there).

    A shard's rows are bounded: conversations are divided into blocks of ``block`` turns. A
    node known to many shards comes from each of them once.
    """
    ship_package(turns.sparkSession)
    rows = materialize(_rebuilt(turns, every, most), "trie-rows")
    tables = _with_shards(rows, block).groupBy("shard").applyInArrow(lambda shard: shard_table(shard, block), _TABLE)
    tables = materialize(tables, "trie-tables")
    nodes = _nodes(tables)
    found = nodes.join(_subtree_sums(tables, nodes, block), _NODE).join(_end_digests(tables), _NODE, "left")
    return found.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
