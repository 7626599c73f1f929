"""Binned features, levels of a tree, and trees as tables, against plain loops."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rankwright.operators import histogram as h
from rankwright.operators.trees import read_trees, tree_rows, tree_score, tree_table, walker

NAMES = ("a", "b", "c")


def rows_of(n, seed=1):
    r = random.Random(seed)
    return [(r.choice([0.0, 1.5, r.random() * 9]), r.gauss(0, 3), 7.0, r.randrange(-(1 << 20), 1 << 20), r.randrange(1, 1 << 18)) for _ in range(n)]


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "a double, b double, c double, pull long, hessian long")


def naive_tree(rows, bounds, depth, l2, min_hessian):
    """Split recursively by trying every bound, then number the nodes level by level."""

    def worth(part):
        g, hess = sum(x[3] for x in part) / h.UNIT, sum(x[4] for x in part) / h.UNIT
        return g * g / (hess + l2), hess, g / (hess + l2)

    nodes, level = [], [(None, rows)]
    while level:
        below = []
        for parent, part in level:
            best, found = h.MIN_GAIN, None
            if len(nodes) and nodes[parent[0]]["depth"] + 1 >= depth:
                candidates = []
            else:
                candidates = [(f, b) for f in range(len(bounds)) for b in range(len(bounds[f]))]
            for f, b in candidates:
                left, right = [x for x in part if x[f] < bounds[f][b]], [x for x in part if x[f] >= bounds[f][b]]
                if not left or not right or worth(left)[1] < min_hessian or worth(right)[1] < min_hessian:
                    continue
                gain = worth(left)[0] + worth(right)[0] - worth(part)[0]
                if gain > best + 1e-12:
                    best, found = gain, (f, b, left, right)
            number = len(nodes)
            nodes.append({"depth": nodes[parent[0]]["depth"] + 1 if parent else 0, "value": worth(part)[2], "split": found and found[:2], "n": len(part)})
            if parent:
                nodes[parent[0]].setdefault("children", []).append(number)
            if found:
                below += [((number, 0), found[2]), ((number, 1), found[3])]
        level = below
    return nodes


@pytest.mark.parametrize(("depth", "min_hessian"), [(1, 0.0), (3, 1e-3), (5, 0.05)])
def test_tree_equals_trying_every_bound(spark, depth, min_hessian):
    rows = rows_of(400)
    frame = frame_of(spark, rows)
    bounds = h.fit_bounds(frame, list(NAMES), bins=16)
    assert bounds[2] == [] and all(len(b) <= 15 and b == sorted(set(b)) for b in bounds)
    binned = h.with_bins(frame, list(NAMES), bounds).persist()
    for r in binned.collect():
        assert r.bins == [sum(x <= v for x in b) for b, v in zip(bounds, (r.a, r.b, r.c), strict=True)]
    tree = h.grow_tree(binned, bounds, depth, 0.5, min_hessian)
    expected = naive_tree(rows, bounds, depth, 0.5, min_hessian)
    assert len(tree.left) == len(expected) and tree.depth() <= depth
    for i, node in enumerate(expected):
        assert tree.value[i] == pytest.approx(node["value"])
        if node["split"]:
            assert (tree.feature[i], tree.bin[i]) == node["split"] and tree.bound[i] == bounds[node["split"][0]][node["split"][1]]
            assert [tree.left[i], tree.right[i]] == node["children"]
        else:
            assert tree.left[i] == tree.right[i] == i
    again = h.grow_tree(binned.repartition(5), bounds, depth, 0.5, min_hessian)
    assert again == tree
    binned.unpersist()


def test_histogram_sums_the_wanted_nodes(spark):
    frame = spark.createDataFrame(
        [(0, [1, 0], 5, 2), (0, [1, 3], -1, 2), (1, [0, 0], 7, 1), (2, [1, 0], 9, 1)], "node int, bins array<int>, pull long, hessian long"
    )
    got = {tuple(r)[:3]: tuple(r)[3:] for r in h.histogram(frame, F.col("node") < 2).collect()}
    assert got == {(0, 0, 1): (4, 4), (0, 1, 0): (5, 2), (0, 1, 3): (-1, 2), (1, 0, 0): (7, 1), (1, 1, 0): (7, 1)}
    assert h.histogram(frame.limit(0)).count() == 0


def test_no_split_without_gain(spark):
    frame = frame_of(spark, [(float(i), 0.0, 0.0, 1 << 20, 1 << 20) for i in range(50)])
    bounds = h.fit_bounds(frame, list(NAMES))
    tree = h.grow_tree(h.with_bins(frame, list(NAMES), bounds), bounds, 4, 0.0, 0.0)
    assert tree.left == (0,) and tree.value == (1.0,) and tree.depth() == 0


def test_trees_survive_their_table_and_score_alike(spark):
    rows = rows_of(300, seed=2)
    frame = frame_of(spark, rows)
    bounds = h.fit_bounds(frame, list(NAMES), bins=32)
    binned = h.with_bins(frame, list(NAMES), bounds).withColumn("score", F.lit(0.0)).persist()
    trees = []
    for k in range(3):
        trees.append(h.grow_tree(binned.withColumn("pull", F.col("pull") * (k + 1) + F.col("bins")[k % 2]), bounds, 4, 1.0, 1e-3))
    table = tree_table(spark, tuple(trees), NAMES)
    read = read_trees(table.collect(), NAMES)
    assert tree_rows(read, NAMES) == tree_rows(tuple(trees), NAMES)
    stepped = binned
    for tree in trees:
        stepped = h.with_step(stepped, tree, 0.3)
    both = stepped.withColumn("at_once", tree_score(read, 0.3, [F.col(c) for c in NAMES])).collect()
    assert all(r.score == r.at_once for r in both)  # the same additions in the same order
    by_hand = walker(read, 0.3)([np.array([x[i] for x in rows]) for i in range(3)])
    assert sorted(by_hand.tolist()) == sorted(r.score for r in both)
    binned.unpersist()
