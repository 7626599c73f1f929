"""Boosted trees as rows of a table, and the score they give a row."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwright.operators.histogram import Tree

#: One row per node. Rows go left if the named feature is below ``bound``; a leaf names none.
TREE_TABLE = "round int, node int, feature string, bin int, bound double, left int, right int, value double"


def tree_rows(trees: tuple[Tree, ...], features: tuple[str, ...]) -> list[tuple]:
    """The nodes of all trees, rounds from 1 on."""
    return [
        (number, node, features[f] if l != node else None, b if l != node else None, x if l != node else None, l, r, value)
        for number, tree in enumerate(trees, start=1)
        for node, (f, b, x, l, r, value) in enumerate(
            zip(tree.feature, tree.bin, tree.bound, tree.left, tree.right, tree.value, strict=True)
        )
    ]


def tree_table(spark: SparkSession, trees: tuple[Tree, ...], features: tuple[str, ...]) -> DataFrame:
    return spark.createDataFrame(tree_rows(trees, features), TREE_TABLE)


def read_trees(rows: list, features: tuple[str, ...]) -> tuple[Tree, ...]:
    """Trees from the rows of a table, in any order."""
    by_round: dict[int, list] = {}
    for row in sorted(rows, key=lambda r: (r["round"], r["node"])):
        by_round.setdefault(row["round"], []).append(row)
    number = {name: i for i, name in enumerate(features)}
    found = []
    for nodes in by_round.values():
        leaf = [r["feature"] is None for r in nodes]
        found.append(
            Tree(
                tuple(0 if x else number[r["feature"]] for x, r in zip(leaf, nodes, strict=True)),
                tuple(1 << 30 if x or r["bin"] is None else r["bin"] for x, r in zip(leaf, nodes, strict=True)),
                tuple(0.0 if x else r["bound"] for x, r in zip(leaf, nodes, strict=True)),
                tuple(r["left"] for r in nodes),
                tuple(r["right"] for r in nodes),
                tuple(r["value"] for r in nodes),
            )
        )
    return tuple(found)


def walker(trees: tuple[Tree, ...], rate: float) -> Callable[[list[np.ndarray]], np.ndarray]:
    """A function from one array per feature to scores: all trees' values, times ``rate``, in their order."""
    made = []
    for tree in trees:
        feature, left, right = (np.array(x, np.int64) for x in (tree.feature, tree.left, tree.right))
        bound = np.where(left == np.arange(len(left)), np.inf, np.array(tree.bound))
        child = np.stack([right, left], axis=1).ravel()  # of node n at 2n, or 2n + 1 if the row goes left
        made.append((feature, bound, child, rate * np.array(tree.value), tree.depth()))

    def walk(values: list[np.ndarray]) -> np.ndarray:
        flat = np.stack(values, axis=1).ravel()  # a row's features lie together
        at, score = np.arange(len(values[0])) * len(values), np.zeros(len(values[0]))
        for feature, bound, child, step, depth in made:
            node = np.zeros(len(at), np.int64)
            for _ in range(depth):
                node = child.take(2 * node + (flat.take(at + feature.take(node)) < bound.take(node)))
            score += step.take(node)
        return score

    return walk


def tree_score(trees: tuple[Tree, ...], rate: float, features: list[Column]) -> Column:
    """The score as one column: an Arrow batch of rows walks each tree at once.

    The trees travel with the expression as small arrays, bounded by rounds and depth.
    Features are doubles without NULLs.
    """
    walk = walker(trees, rate)

    @F.arrow_udf("double")
    def score(*values: pa.Array) -> pa.Array:
        return pa.array(walk([v.to_numpy(zero_copy_only=False) for v in values]))

    return score(*features)
