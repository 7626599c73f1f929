"""The row after each row in a global order, without sorting the table in one place."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwright.llm.common import settled, ship_package
from rankwright.operators.ordinals import with_ordinal

#: Rows of a chunk, about, and sampled rows between two bounds; results do not depend on them.
CHUNK_ROWS = 1 << 14
SAMPLED = 16

_NULL_KEY = -(1 << 63)


def chunk_of(ids: np.ndarray, ties: np.ndarray, bound_ids: np.ndarray, bound_ties: np.ndarray) -> tuple:
    """How many sorted bounds are at or before each (id, tie), and whether it is the last of them."""
    low, high = np.searchsorted(bound_ids, ids, "left"), np.searchsorted(bound_ids, ids, "right")
    chunk, first = low.astype(np.int64), np.zeros(len(ids), bool)
    for i in np.flatnonzero(high > low):  # ids that a bound has: their ties decide
        a, b = low[i], high[i]
        at = a + int(np.searchsorted(bound_ties[a:b], ties[i], "right"))
        chunk[i] = at
        first[i] = at > a and bound_ties[at - 1] == ties[i]
    return chunk, first


def _bounds(keys: DataFrame) -> tuple[np.ndarray, np.ndarray, tuple[int, int] | None]:
    """Keys that cut the order into chunks, and the smallest key.

    The driver gets one key per chunk, as it would of any division by ranges.
    """
    spark = keys.sparkSession
    found = keys.agg(F.count("*").alias("n"), F.min(F.struct("_id", "_tie")).alias("least")).first()
    if not found["n"]:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), None
    chunks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(found["n"] / CHUNK_ROWS))
    share = min(1.0, SAMPLED * chunks / found["n"])
    sampled = keys if share == 1.0 else keys.sample(share, seed=5)
    ordered = with_ordinal(sampled.select("_id", "_tie").distinct(), ["_id", "_tie"], "_n")
    cuts = ordered.where(F.col("_n") % SAMPLED == 0).select("_id", "_tie").collect()
    least = (found["least"]["_id"], found["least"]["_tie"])
    ends = sorted({(r["_id"], r["_tie"]) for r in cuts} - {least})
    return np.array([x for x, _ in ends], np.int64), np.array([x for _, x in ends], np.int64), least


def with_next(rows: DataFrame, key: str, text: str, name: str) -> DataFrame:
    """``rows`` with the text of the row after it as ``name``; after the last row comes the first.

    Rows are ordered by an integral ``key``, nulls first, and rows of one key by a hash
    of the text, so a key that many rows share is divided too. Chunks of the order are
    bounded by sampled keys; the first row of a chunk is copied to the end of the chunk
    before it, so every row finds its next one inside its chunk, after one shuffle.
    """
    ship_package(rows.sparkSession)
    order = {"_id": F.coalesce(F.col(key).cast("long"), F.lit(_NULL_KEY)), "_tie": F.xxhash64(text)}
    keyed = rows.withColumns(order)
    bound_ids, bound_ties, least = _bounds(keyed.select("_id", "_tie"))
    last = len(bound_ids)

    @F.arrow_udf("chunk long, copy long")
    def placed(ids: pa.Array, ties: pa.Array) -> pa.Array:
        x, y = ids.to_numpy(zero_copy_only=False), ties.to_numpy(zero_copy_only=False)
        chunk, first = chunk_of(x, y, bound_ids, bound_ties)
        copy = np.where(first, chunk - 1, -1)
        if least is not None:
            copy[(x == least[0]) & (y == least[1])] = last
        return pa.StructArray.from_arrays([pa.array(chunk), pa.array(copy, mask=copy < 0)], ["chunk", "copy"])

    def copies(place: Column) -> Column:
        """The row itself, and its copy for the chunk before."""
        own = F.struct(place["chunk"].alias("_chunk"), F.lit(0).alias("_ahead"))
        ahead = F.struct(place["copy"].alias("_chunk"), F.lit(1).alias("_ahead"))
        return F.inline(F.when(place["copy"].isNull(), F.array(own)).otherwise(F.array(own, ahead)))

    divided = settled(keyed.withColumn("_place", placed("_id", "_tie")), ["_place"])
    divided = divided.select(*[c for c in divided.columns if c != "_place"], copies(F.col("_place")))
    following = Window.partitionBy("_chunk").orderBy("_ahead", "_id", "_tie")
    found = divided.withColumn(name, F.lead(text).over(following)).where("_ahead = 0")
    return found.drop("_chunk", "_ahead", "_id", "_tie")
