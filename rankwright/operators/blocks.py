"""Rows of a fit as blocks: one row of a DataFrame holds the arrays of many sessions.

For sessions that were not split. Every session lies whole in one block, so a task finds
its gradients and NDCG, and its share of a tree's sums, on arrays: a round shuffles
nothing but those sums, and rows are not turned into Arrow one by one. A task reads block
after block and adds up what they give, so it holds one of them at a time.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from rankwright.operators.histogram import MAX_BINS, Tree
from rankwright.operators.lambdas import row_lambdas, values_of_sessions

#: A packed block, by type; bins lie by feature, and fewer than 257 fit a byte. All of a block is for training, or nothing.
PACKED = {"qid": "i8", "is_train": "?", "target_label": "i4", "bins": "u1", "score": "f8"}
#: What a block keeps from round to round: its sessions are known by their lengths, its bins by codes of their own.
KEPT = {"is_train": "?", "length": "i4", "target_label": "i4", "codes": "u2", "meaning": "i4", "score": "f8"}
#: What is found anew under each score. Rows' values take four bytes where all of a block fit them; validation has none.
FOUND = {"pull": None, "hessian": None, "ndcg": "i8", "root": "i8"}
_TYPES = {**PACKED, **KEPT, **FOUND}
#: What the rows of a block lie by; only the session is needed after that.
_ORDER = ("qid", "product_id", "user_id")
#: A block ends with a session, after so many rows.
BLOCK_ROWS = 1 << 17
#: Features share a code if a block has at most so many of them, and so many rows for each.
_CODES, _ROWS_PER_CODE = 1 << 12, 16
#: A sum of NDCGs is cut here in two: whole numbers of 2**-40 per session would not fit a long for all of them.
_LOW_BITS = 20
_EXACT = float(1 << 53)
_BATCH = 1 << 16
_SUMS = "node int, feature int, bin int, pull long, hessian long"
#: The five highest bits of 32 tell by how many bits this number was shifted.
_SHIFTED = np.uint32(0x077CB531)


def _schema(names: list[str]) -> str:
    return ", ".join(f"{name} {'boolean' if _TYPES[name] == '?' else 'binary'}" for name in names)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            held = {c: batch.column(c)[i] for c in batch.schema.names}
            block = {c: np.frombuffer(value.as_buffer(), _TYPES[c]) for c, value in held.items() if c not in ("pull", "hessian", "is_train")}
            block |= {c: value.as_py() for c, value in held.items() if _TYPES[c] == "?"}
            if "bins" in block:
                block["bins"] = block["bins"].reshape(-1, len(block["score"]))
            if "codes" in block:
                n_rows = int(block["length"].sum())
                block["codes"] = block["codes"].reshape(-1, n_rows)
                block |= {c: np.frombuffer(value.as_buffer(), f"i{value.as_buffer().size // n_rows or 8}") for c, value in held.items() if c in ("pull", "hessian")}
            yield block


def _row(block: dict[str, np.ndarray], names: list[str]) -> pa.RecordBatch:
    held = [
        pa.array([block[c]]) if _TYPES[c] == "?" else pa.array([np.ascontiguousarray(block[c], _TYPES[c]).tobytes()], pa.binary())
        for c in names
    ]
    return pa.RecordBatch.from_arrays(held, names)


def _packed(rows: pa.Table) -> pa.RecordBatch:
    """Rows of whole sessions as one block."""
    rows = rows.combine_chunks()
    block = {c: rows[c].to_numpy() for c in PACKED if c not in ("bins", "is_train")}
    bins = rows["bins"].combine_chunks().flatten().to_numpy().astype(np.uint8)
    return _row({**block, "is_train": rows["is_train"][0].as_py(), "bins": bins.reshape(len(rows), -1).T}, list(PACKED))


def pack(rows: DataFrame) -> DataFrame:
    """``rows`` as blocks of whole sessions. Each session must lie in one partition, and is sorted there by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, list[pa.RecordBatch]] = {True: [], False: []}
        for batch in batches:
            for train, own in held.items():
                some = batch.filter(batch["is_train"] if train else pa.compute.invert(batch["is_train"]))
                own += [some] if len(some) else []
                if sum(len(b) for b in own) < BLOCK_ROWS:
                    continue
                table = pa.Table.from_batches(own)
                begins = np.flatnonzero(np.diff(table["qid"].to_numpy())) + 1
                if len(begins):
                    yield _packed(table.slice(0, begins[-1]))
                    own[:] = table.slice(begins[-1]).combine_chunks().to_batches()
        for own in held.values():
            if own:
                yield _packed(pa.Table.from_batches(own))

    kept = rows.select(*dict.fromkeys((*_ORDER, *PACKED))).sortWithinPartitions(*_ORDER)
    return kept.mapInArrow(run, _schema(list(PACKED)))


def with_lambdas(rows: DataFrame, k: int) -> DataFrame:
    """Rows of sessions with a positive, with ``pull`` and ``hessian``. Each session must lie in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            table = pa.Table.from_batches(held)
            found = row_lambdas(*[table[c].to_numpy() for c in ("qid", "product_id", "user_id", "target_label", "score")], k)
            order, values = found[0], found[1:]
            table = table.take(pa.array(order))
            for name, value in zip(("pull", "hessian"), values, strict=True):
                table = table.append_column(name, pa.array(value))
            yield from table.combine_chunks().to_batches(max_chunksize=_BATCH)

    schema = StructType([*rows.schema.fields, *StructType.fromDDL("pull double, hessian double").fields])
    return rows.mapInArrow(run, schema)


def _coded(bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codes, meaning): the bins of some features together as one code, where they take few values.

    Columns of one product or one user take far fewer values together than each for itself would
    allow: sums by code are then as good as sums by bin, and there are fewer of them. Features
    that have many values together keep a code each. ``meaning`` lists, for every row of
    ``codes``, how many features and codes it has, its features, and the bins of each by code.
    """
    most = min(_CODES, max(MAX_BINS, bins.shape[1] // _ROWS_PER_CODE))
    held: list[tuple[list[int], np.ndarray, np.ndarray]] = []
    for feature, own in enumerate(bins):
        for i, (features, table, code) in enumerate([*held, ([], np.zeros((0, 1), np.int64), np.zeros(1, np.int64))]):
            both = code * MAX_BINS + own
            met = np.zeros(table.shape[1] * MAX_BINS, bool)
            met[both] = True
            values = np.flatnonzero(met)
            if not features or len(values) <= most:
                number = np.zeros(len(met), np.int64)
                number[values] = np.arange(len(values))
                held[i : i + 1] = [([*features, feature], np.vstack([table[:, values // MAX_BINS], values % MAX_BINS]), number[both])]
                break
    meaning = [part for features, table, _ in held for part in ([len(features), table.shape[1], *features], table.ravel())]
    return np.stack([code for *_, code in held]).astype(np.uint16), np.concatenate(meaning).astype(np.int32)


def _groups(block: dict[str, np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features, bins by feature and code, codes) of every row of a block's codes."""
    meaning, at = block["meaning"], 0
    for codes in block["codes"]:
        n, size = meaning[at : at + 2]
        features, table = meaning[at + 2 : at + 2 + n], meaning[at + 2 + n : at + 2 + n + n * size]
        yield features, table.reshape(n, size), codes
        at += 2 + n + n * size


def _arrays(tree: Tree) -> dict[str, np.ndarray]:
    return {name: np.array(getattr(tree, name), np.int64) for name in ("feature", "bin", "left", "right")}


def _walker(tree: dict[str, np.ndarray], steps: int, of_node: np.ndarray) -> Callable[[dict[str, np.ndarray]], np.ndarray]:
    """A function from blocks to what ``of_node`` says of the node each row is in after so many steps from the root.

    Every split rules out the nodes below its other side. A code tells what all splits on its features
    leave, as bits, and what a row's codes leave together is its one node.
    """
    ends, splits = [], []

    def below(node: int, left: int) -> int:
        if left == 0 or tree["left"][node] == node:
            ends.append(node)
            return 1 << (len(ends) - 1)
        sides = [below(int(tree[side][node]), left - 1) for side in ("left", "right")]
        splits.append((int(tree["feature"][node]), int(tree["bin"][node]) + 1, *sides))
        return sides[0] | sides[1]

    every = below(0, steps)
    # A word holds the bits of 32 nodes; trees with more take several, and a row's bit is in one of them.
    words = range(0, len(ends), 32)
    of_bin = {feature: np.full((len(words), MAX_BINS), 0xFFFFFFFF, np.uint32) for feature, *_ in splits}
    for feature, first_right, to_left, to_right in splits:
        for word, bits in zip(of_bin[feature], words, strict=True):
            word[:first_right] &= ~np.uint32(to_right >> bits & 0xFFFFFFFF)
            word[first_right:] &= ~np.uint32(to_left >> bits & 0xFFFFFFFF)
    found = np.zeros((len(words), 32), of_node.dtype)
    for i, node in enumerate(ends):
        found[i // 32, (_SHIFTED << np.uint32(i % 32)) >> np.uint32(27)] = of_node[node]

    def walk(block: dict[str, np.ndarray]) -> np.ndarray:
        groups, values = list(_groups(block)), None
        for i, bits in enumerate(words):
            left = np.full(block["codes"].shape[1], every >> bits & 0xFFFFFFFF, np.uint32)
            for features, table, codes in groups:
                tested = [of_bin[f][i].take(own) for f, own in zip(features.tolist(), table, strict=True) if f in of_bin]
                if tested:
                    left &= np.bitwise_and.reduce(tested)[codes]
            own = found[i].take((left * _SHIFTED) >> np.uint32(27))
            values = own if values is None else np.where(left != 0, own, values)
        return values

    return walk


def _least(values: np.ndarray) -> np.ndarray:
    """Whole numbers in four bytes each, if all fit."""
    fit = not len(values) or max(values.max(), -values.min()) < 1 << 31
    return values.astype(np.int32) if fit else values


def with_values(blocks: DataFrame, cuts: tuple[int, ...], tree: Tree | None = None, rate: float = 0.0) -> DataFrame:
    """``blocks`` with what ``session_values`` finds, after a tree's values, times ``rate``, are added to the scores.

    ``root`` has the sums of the next tree's root over all blocks of a task, in its last one.
    """
    names, step = [*KEPT, *FOUND], None
    if tree is not None:
        step = _walker(_arrays(tree), tree.depth(), np.array([rate * value for value in tree.value]))
    packed = "qid" in blocks.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, root = None, 0
        for block in _each(batches):
            if before is not None:
                yield _row({**before, "root": np.zeros(0)}, names)
            if packed:
                ends = np.flatnonzero(np.diff(block["qid"], append=block["qid"][-1:] + 1)) + 1
                block["length"] = np.diff(ends, prepend=0)
                block["codes"], block["meaning"] = _coded(block["bins"])
            if step is not None:
                block["score"] = block["score"] + step(block)
            train = np.full(len(block["length"]), block["is_train"])
            block |= values_of_sessions(block["length"].astype(np.int64), train, block["target_label"], block["score"], cuts)
            if block["is_train"]:
                root = root + _node_sums(block, None, 1, MAX_BINS)
            block |= {c: _least(block[c]) if block["is_train"] else np.zeros(0, np.int64) for c in ("pull", "hessian")}
            before = block
        if before is not None:
            yield _row({**before, "root": root if isinstance(root, np.ndarray) else np.zeros(0)}, names)

    return blocks.select(*(PACKED if packed else KEPT)).mapInArrow(run, _schema(names))


def _exactly(values: np.ndarray) -> np.ndarray:
    """Whole numbers as doubles, if those hold any sum of them exactly, up to 2**53; otherwise as they are."""
    doubles = values.astype(np.float64)
    return doubles if np.abs(doubles).sum() < _EXACT else values


def _added(index: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Sums by index of what ``_exactly`` gives."""
    if values.dtype == np.float64:
        return np.rint(np.bincount(index, values, size)).astype(np.int64)
    sums = np.zeros(size, np.int64)
    np.add.at(sums, index, values)
    return sums


def _node_sums(block: dict[str, np.ndarray], slot: np.ndarray | None, n_slots: int, width: int) -> np.ndarray:
    """Sums of pull and hessian of one block's rows by slot, feature and bin; rows in slot -1 are left out."""
    values, own, groups = [_exactly(block[c]) for c in ("pull", "hessian")], slice(None), list(_groups(block))
    at, slots = 0, np.arange(n_slots)[:, None]
    if slot is not None:
        own = np.flatnonzero(slot >= 0)
        at, values = slot[own].astype(np.int64), [held[own] for held in values]
    sums = np.empty((n_slots, sum(len(features) for features, *_ in groups), width, 2), np.int64)
    for features, table, codes in groups:
        size = table.shape[1]
        index = at * size + codes[own].astype(np.int64)
        by_code = [_added(index, held, n_slots * size) for held in values]
        for feature, bins in zip(features, table, strict=True):
            index = (slots * width + bins).ravel()
            for i, held in enumerate(by_code):
                sums[:, feature, :, i] = _added(index, _exactly(held), n_slots * width).reshape(n_slots, width)
    return sums


def _ndcg_sums(ndcg: np.ndarray) -> np.ndarray:
    """NDCGs in the form of a tree's sums: node -1 for validation, -2 for training; feature names the cut."""
    found = []
    for flag, of_flag in enumerate(ndcg.tolist()):
        for i, (total, n) in enumerate(of_flag):
            found += [(-1 - flag, i, 0, total >> _LOW_BITS, n), (-1 - flag, i, 1, total & ((1 << _LOW_BITS) - 1), 0)]
    return np.array(found, np.int64).T


def task_sums(blocks: DataFrame, tree: Tree, steps: int, wanted: list[int], width: int, n_cuts: int = 0) -> DataFrame:
    """What every task of ``tree_sums`` adds to it, a row for each (node, feature, bin)."""
    walked, slots = _arrays(tree), np.full(len(tree.left), -1, np.int16)
    slots[wanted] = np.arange(len(wanted))
    walk = _walker(walked, steps, slots) if steps else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, ndcg = 0, 0
        for block in _each(batches):
            if walk is None:
                if len(block["root"]):
                    sums = sums + block["root"].reshape(1, -1, MAX_BINS, 2)[:, :, :width]
            elif len(block["pull"]):
                sums = sums + _node_sums(block, walk(block), len(wanted), width)
            if n_cuts:
                ndcg = ndcg + block["ndcg"].reshape(2, n_cuts, 2)
        found = [_ndcg_sums(ndcg)] if isinstance(ndcg, np.ndarray) else []
        if isinstance(sums, np.ndarray):
            node, feature, bin_ = np.nonzero(sums.any(axis=3))
            found.append(np.stack([np.array(wanted, np.int64)[node], feature, bin_, *sums[node, feature, bin_].T]))
        if found:
            values = np.concatenate(found, axis=1)
            columns = [pa.array(v.astype(np.int32)) for v in values[:3]] + [pa.array(v) for v in values[3:]]
            yield pa.RecordBatch.from_arrays(columns, ["node", "feature", "bin", "pull", "hessian"])

    names = ["root"] if walk is None else ["length", "codes", "meaning", "pull", "hessian"]
    # Validation has no part in a tree.
    read = blocks if n_cuts else blocks.where("is_train")
    return read.select(*names, *(["ndcg"] if n_cuts else [])).mapInArrow(run, _SUMS)


def tree_sums(blocks: DataFrame, tree: Tree, steps: int, wanted: list[int], width: int, n_cuts: int = 0) -> DataFrame:
    """(node, feature, bin) with the sums of ``pull`` and ``hessian`` over valued blocks, as ``histogram`` gives them.

    With ``n_cuts``, also the sums that ``ndcg_means`` reads.
    """
    found = task_sums(blocks, tree, steps, wanted, width, n_cuts)
    return found.groupBy("node", "feature", "bin").agg(F.sum("pull").alias("pull"), F.sum("hessian").alias("hessian"))


def ndcg_means(sums: pa.Table, unit: float) -> Callable[[bool, int], float]:
    """The mean NDCG of the training (True) or validation sessions at a cut, given by its place."""
    total: dict[tuple[bool, int], int] = {}
    count: dict[tuple[bool, int], int] = {}
    for row in sums.filter(pa.compute.less(sums["node"], 0)).to_pylist():
        key = (row["node"] == -2, row["feature"])
        total[key] = total.get(key, 0) + (row["pull"] << (0 if row["bin"] else _LOW_BITS))
        count[key] = count.get(key, 0) + row["hessian"]
    return lambda train, cut: total[train, cut] / count[train, cut] / unit if count.get((train, cut)) else 0.0


# Workers get these functions with the task, so they need not have the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
