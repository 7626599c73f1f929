"""Connected components of links too many for one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.sources.scratch import materialize


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(``node``, ``component``) for every end of a link; the component is its smallest node.

    Alternates two steps until nothing changes: all larger neighbours of a node are
    linked to its smallest one, then all smaller ones are. Links always become stars
    around the smallest node, in a number of rounds that grows with the logarithm of
    a component's width. Smallest neighbours are minima that combine before the
    shuffle and come back by a join, so a hub's links are never gathered; adaptive
    skew splitting divides them. Every round is written to the shared folder.
    Links with a null end and of a node to itself connect nothing.
    """
    u, v = F.greatest(a, b).alias("u"), F.least(a, b).alias("v")
    edges = materialize(links.filter(f"`{a}` <> `{b}`").select(u, v).distinct(), "links")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = materialize(large.filter("u <> v").distinct(), "links")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
        small = small.unionByName(low.select("u", F.col("m").alias("v")))
        edges = materialize(small.distinct(), "links")
        now = _state(edges)
        if now == before:
            break
        before = now
    members = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
