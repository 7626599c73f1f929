"""Global row numbers without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankwright.sources.scratch import materialize


def with_ordinal(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its 0-based position under a total order of columns.

    Rows are split by ranges of the order, so each partition only needs to know
    how many rows lie in the partitions before it: one number per partition,
    which is all that is summed in one place and broadcast. The sorted rows are
    written once, for both uses must see the same split.

    Equal keys may fall on both sides of a range only if ``order`` is not total.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # monotonically_increasing_id is (partition << 33) + position in it.
    placed = materialize(ranged.withColumn("_place", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("_place", 33).alias("_part")
    sizes = placed.groupBy(part).agg(F.count("*").alias("_rows"))
    preceding = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(preceding), F.lit(0)).alias("_offset"))
    position = F.col("_offset") + F.col("_place") - F.shiftleft(F.col("_part"), 33)
    # At most one row per shuffle partition: small enough to broadcast, always.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, position)
        .drop("_part", "_place", "_offset")
    )


def with_total_before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` over all rows before it in the order of a unique column.

    As with ordinals: rows are split by ranges, a window sums inside each, and one sum
    per partition is all that is added up in one place and broadcast.
    """
    ranged = df.repartitionByRange(order).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id())
    placed = materialize(ranged, "totals")
    sums = placed.groupBy("_part").agg(F.sum(value).alias("_sum"))
    preceding = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_sum").over(preceding), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum(value).over(inside), F.lit(0))
    # At most one row per shuffle partition: small enough to broadcast, always.
    return (
        placed.withColumn("_before", before)
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + F.col("_offset"))
        .drop("_part", "_before", "_offset")
    )


def with_previous(df: DataFrame, keys: list[str], order: list[str], value: str, name: str) -> DataFrame:
    """``df`` with ``value`` of the row before it among the rows of its keys; NULL for the first.

    Rows are split by ranges of (keys, order), so the rows of a key that many share lie in
    many partitions, and a window holds one key's rows of one partition. The last
    value of a key in a partition is carried to its next partition: one row per key and
    partition meets the rows there. Rows equal in all of ``order`` may take either place.
    """
    ranged = df.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order)
    placed = materialize(ranged.withColumn("_part", F.spark_partition_id()), "ordered")
    own = Window.partitionBy("_part", *keys).orderBy(*order)
    inside = placed.withColumns({"_first": F.row_number().over(own) == 1, name: F.lag(value).over(own)})
    last = placed.groupBy("_part", *keys).agg(F.max_by(value, F.struct(*order)).alias("_last"))
    earlier = Window.partitionBy(*keys).orderBy("_part")
    carried = last.withColumn("_carried", F.lag("_last").over(earlier)).where(F.col("_carried").isNotNull())
    return (
        inside.join(carried.drop("_last"), ["_part", *keys], "left")
        .withColumn(name, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col(name)))
        .drop("_part", "_first", "_carried")
    )
