"""Sharding by rendezvous hashing of record keys over weighted shards.

Every record draws one number per shard from a hash of its key and the shard's
number, and goes where ``-ln(u) / weight`` is smallest. A shard's share is
proportional to its weight, and a shard that is added only draws records to itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwright.operators.ordinals import with_ordinal
from rankwright.sources.scratch import materialize

#: Hex digits of the digest that become a number: 52 bits, exact in a double.
_DIGITS = 13


def _cost(key: Column, shard: int, weight: float) -> Column:
    digest = F.substring(F.md5(F.concat(key, F.lit(f"#{shard}"))), 1, _DIGITS)
    unit = (F.conv(digest, 16, 10).cast("double") + 0.5) / float(16**_DIGITS)
    return -F.ln(unit) / F.lit(float(weight))


def _cheapest(key: Column, weights: Sequence[float], first: int = 0) -> Column:
    costs = [
        F.struct(_cost(key, first + i, w).alias("cost"), F.lit(first + i).alias("shard"))
        for i, w in enumerate(weights)
        if w > 0
    ]
    if not costs:
        raise ValueError("at least one shard needs a positive weight")
    return F.array_min(F.array(*costs)) if len(costs) > 1 else costs[0]


def assign_shards(df: DataFrame, key: str, weights: Sequence[float], added: Sequence[float] = ()) -> DataFrame:
    """``df`` with ``shard`` and, if shards are ``added``, the shard with these (``grown_shard``).

    ``weights`` holds a shard's relative capacity at its number; shards of weight 0
    get nothing. Rows with equal keys share a shard; null keys count as one key of
    their own. Equal costs go to the smaller number. Row-wise: nothing is shuffled.
    """
    text = F.coalesce(F.concat(F.lit("k"), F.col(key).cast("string")), F.lit("null"))
    placed = df.withColumn("_best", _cheapest(text, weights))
    if added:
        other = _cheapest(text, added, len(weights))
        placed = placed.withColumn("_other", other).withColumn(
            "grown_shard",
            F.when(F.col("_other.cost") < F.col("_best.cost"), F.col("_other.shard")).otherwise(F.col("_best.shard")),
        )
    return placed.withColumn("shard", F.col("_best.shard")).drop("_best", "_other")


def with_slots(placed: DataFrame, order: Sequence[str]) -> DataFrame:
    """``placed`` with each row's gapless position (``slot``, from 0) in its shard, by ``order``.

    Rows are numbered over ranges of (shard, order), so no task holds a shard. Keep
    ``placed`` narrow: its rows are written, sorted and written once more. Rows equal
    in all of ``order`` share an arbitrary but gapless run of slots.
    """
    stored = materialize(placed, "shards")
    numbered = with_ordinal(stored, ["shard", *order], "_ordinal")
    sizes = stored.groupBy("shard").agg(F.count("*").alias("_rows"))
    # One row per shard: bounded by the number of weights, so safe to broadcast.
    a, b = sizes.alias("a"), sizes.alias("b")
    starts = (
        a.join(F.broadcast(b), F.col("b.shard") < F.col("a.shard"), "left")
        .groupBy(F.col("a.shard").alias("shard"))
        .agg(F.coalesce(F.sum("b._rows"), F.lit(0)).alias("_start"))
    )
    return (
        numbered.join(F.broadcast(starts), "shard")
        .withColumn("slot", F.col("_ordinal") - F.col("_start"))
        .drop("_ordinal", "_start")
    )


def shard_records(
    df: DataFrame, key: str, weights: Sequence[float], added: Sequence[float] = (), text: str = "text"
) -> DataFrame:
    """Key, ``size`` in bytes, ``text_crc32``, ``shard``, ``slot`` and ``grown_shard`` of each row.

    The text itself never travels: only its size and checksum do. Null texts have
    size 16 and checksum 0; empty tables give no rows; other columns are ignored.
    Without ``added``, ``grown_shard`` is null.
    """
    content = F.coalesce(F.col(text), F.lit(""))
    narrow = df.select(
        F.col(key),
        (F.octet_length(content) + 16).cast("long").alias("size"),
        F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
    )
    placed = assign_shards(narrow, key, weights, added)
    if not added:
        placed = placed.withColumn("grown_shard", F.lit(None).cast("int"))
    return with_slots(placed, [key, "size", "text_crc32"])
