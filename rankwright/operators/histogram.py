"""Regression trees grown from histograms of binned features.

Features are binned once. A level of a tree needs one grouped sum of pull and hessian by
(node, feature, bin), over the rows of the smaller child of every split; the larger
child's sums are what remains of their parent's. What reaches the driver is bounded by
the settings, whatever the rows: nodes of a level x features x bins.

Pulls and hessians are whole numbers of 2**-26 here, so that sums are exact and the
same in any order: equal inputs grow equal trees.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_BINS = 256
#: Whole numbers per unit of pull and hessian.
UNIT = float(1 << 26)
MIN_GAIN = 1e-9


@dataclass(frozen=True)
class Tree:
    """Nodes by number, the root 0. A row goes left if its feature's bin is at most ``bin``.

    A leaf is its own left and right. ``bound`` is the first value that goes right.
    """

    feature: tuple[int, ...]
    bin: tuple[int, ...]
    bound: tuple[float, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]

    def depth(self) -> int:
        """Steps from the root to the deepest leaf."""
        below = [0] * len(self.left)
        for node in reversed(range(len(self.left))):  # children have larger numbers
            if self.left[node] != node:
                below[node] = 1 + max(below[self.left[node]], below[self.right[node]])
        return below[0]


def fit_bounds(rows: DataFrame, features: list[str], bins: int = MAX_BINS) -> list[list[float]]:
    """Per feature at most ``bins - 1`` increasing values that begin a bin, at even shares of the rows."""
    shares = [i / bins for i in range(1, bins)]
    found = rows.agg(F.array(*[F.percentile_approx(c, shares) for c in features]), F.array(*[F.min(c) for c in features]))
    cuts, least = found.first()
    return [sorted({float(x) for x in cut or []} - {least[i]}) for i, cut in enumerate(cuts)]


def with_bins(rows: DataFrame, features: list[str], bounds: list[list[float]], name: str = "bins") -> DataFrame:
    """``rows`` with the number of bounds at or below each feature, as an array.

    Features must not be NULL or NaN; one without bounds has a single bin.
    """
    cut = [i for i, found in enumerate(bounds) if found]
    binned = rows
    if cut:
        infinite = float("inf")
        binned = Bucketizer(
            splitsArray=[[-infinite, *bounds[i], infinite] for i in cut],
            inputCols=[features[i] for i in cut],
            outputCols=[f"_bin{i}" for i in cut],
        ).transform(rows)
    found = F.array(*[F.col(f"_bin{i}").cast("int") if i in cut else F.lit(0) for i in range(len(bounds))])
    return binned.withColumn(name, found).drop(*[f"_bin{i}" for i in cut])


def _at(values: list, index: Column) -> Column:
    """The value at an index of a constant array, which is given as one text: a literal each would take longer."""
    kind = "D" if values and isinstance(values[0], float) else ""
    return F.get(F.expr(f"array({', '.join(f'{value}{kind}' for value in values)})"), index)


def with_node(rows: DataFrame, tree: Tree, steps: int, name: str = "node") -> DataFrame:
    """``rows`` with the node of ``tree`` they are in after so many steps from the root.

    One projection a step over constant arrays: the plans of all trees of a depth are
    alike, so their code is compiled once. A generator ends them, because a filter on the
    node would be pushed into them, and repeat each step as often as it names the one before.
    """
    found = rows.withColumn(name, F.lit(0))
    for _ in range(steps):
        node = F.col(name)
        goes_left = F.get("bins", _at(list(tree.feature), node)) <= _at(list(tree.bin), node)
        found = found.withColumn(name, F.when(goes_left, _at(list(tree.left), node)).otherwise(_at(list(tree.right), node)))
    return found.select(*rows.columns, F.explode(F.array(name)).alias(name))


def with_step(rows: DataFrame, tree: Tree, rate: float) -> DataFrame:
    """``rows`` with the tree's value, times ``rate``, added to ``score``."""
    placed = with_node(rows, tree, tree.depth(), "_node")
    steps = [rate * value for value in tree.value]
    return placed.withColumn("score", F.col("score") + _at(steps, F.col("_node"))).drop("_node")


def histogram(rows: DataFrame, nodes: Column | None = None) -> DataFrame:
    """(node, feature, bin) with the sums of ``pull`` and ``hessian``, for the nodes wanted.

    ``rows`` hold ``node``, ``bins``, ``pull`` and ``hessian``. Sums combine before the shuffle.
    """
    wanted = rows if nodes is None else rows.where(nodes)
    return (
        wanted.select("node", F.posexplode("bins").alias("feature", "bin"), "pull", "hessian")
        .groupBy("node", "feature", "bin")
        .agg(F.sum("pull").alias("pull"), F.sum("hessian").alias("hessian"))
    )


def _sums(rows: DataFrame, tree: Tree, steps: int, wanted: list[int], width: int) -> pa.Table:
    """The wanted nodes' histograms, every row placed in its node."""
    marks = [node in wanted for node in range(len(tree.left))]
    return histogram(with_node(rows, tree, steps), _at(marks, F.col("node"))).toArrow()


def _by_node(found: pa.Table, wanted: list[int], shape: tuple[int, int]) -> dict[int, np.ndarray]:
    """Histograms of the wanted nodes as arrays (feature, bin, pull and hessian); rows of one cell are added up."""
    number = {node: i for i, node in enumerate(wanted)}
    sums = np.zeros((len(wanted), *shape, 2), np.int64)
    node, feature, bin_ = (found[c].to_numpy() for c in ("node", "feature", "bin"))
    at = np.array([number[int(n)] for n in node], np.int64)
    for i, c in enumerate(("pull", "hessian")):
        np.add.at(sums, (at, feature, bin_, i), found[c].to_numpy())
    return {n: sums[i] for n, i in number.items()}


def best_split(sums: np.ndarray, l2: float, min_hessian: float) -> tuple[int, int] | None:
    """(feature, bin) that raises pull**2 / (hessian + l2) most; ties to the first; None if no split does."""
    left = sums.cumsum(axis=1) / UNIT
    whole = left[:, -1:, :]
    right = whole - left

    def worth(part: np.ndarray) -> np.ndarray:
        return part[..., 0] ** 2 / np.maximum(part[..., 1] + l2, 1e-300)

    gain = worth(left) + worth(right) - worth(whole)
    allowed = (left[..., 1] >= min_hessian) & (right[..., 1] >= min_hessian)
    gain = np.where(allowed, gain, -np.inf)
    at = int(np.argmax(gain))
    if not gain.flat[at] > MIN_GAIN:
        return None
    return divmod(at, sums.shape[1])


#: Histograms of the wanted nodes of a tree after so many steps, features having at most so many bins.
Sums = Callable[[Tree, int, list[int], int], pa.Table]


def grow_tree(rows: DataFrame | Sums, bounds: list[list[float]], max_depth: int, l2: float, min_hessian: float) -> Tree:
    """A tree over rows with ``bins``, ``pull`` and ``hessian``, level by level; leaves are Newton steps.

    ``rows`` are passed over once per level, so they should be stored. Rows of another form
    are given by a function that finds their histograms.
    """
    sums_of = partial(_sums, rows) if isinstance(rows, DataFrame) else rows
    shape = (len(bounds), max(len(b) for b in bounds) + 1)
    feature, bin_, bound, left, right, total = [0], [shape[1]], [0.0], [0], [0], [(0, 0)]

    def so_far() -> Tree:
        values = tuple(float(pull / UNIT / max(hessian / UNIT + l2, 1e-300)) for pull, hessian in total)
        return Tree(tuple(feature), tuple(bin_), tuple(bound), tuple(left), tuple(right), values)

    level = _by_node(sums_of(so_far(), 0, [0], shape[1]), [0], shape)
    total[0] = tuple(int(x) for x in level[0][0].sum(axis=0))
    for depth in range(max_depth):
        smaller: dict[int, tuple[int, int]] = {}  # the child to be summed, its sibling and parent
        for node, sums in level.items():
            split = best_split(sums, l2, min_hessian)
            if split is None:
                continue
            f, b = split
            below = [sums[f, : b + 1].sum(axis=0), sums[f, b + 1 :].sum(axis=0)]
            children = [len(left), len(left) + 1]
            feature[node], bin_[node], bound[node], left[node], right[node] = f, b, bounds[f][b], *children
            for child, part in zip(children, below, strict=True):
                feature.append(0)
                bin_.append(shape[1])
                bound.append(0.0)
                left.append(child)
                right.append(child)
                total.append(tuple(int(x) for x in part))
            light, heavy = children if below[0][1] <= below[1][1] else children[::-1]
            smaller[light] = (heavy, node)
        if not smaller or depth + 1 == max_depth:
            break
        summed = _by_node(sums_of(so_far(), depth + 1, list(smaller), shape[1]), list(smaller), shape)
        above, level = level, {}
        for light, (heavy, node) in smaller.items():
            level[light], level[heavy] = summed[light], above[node] - summed[light]
        level = dict(sorted(level.items()))
    return so_far()
