"""How often products sold: overall, and before a given moment.

The point-in-time ranking must not compare every session with every product of
its category. It rests on one fact: sales counts only grow. A product that is
in the top k at time t was either in the top k at an earlier time s, or was sold
between s and t and has by then at least as many sales as the k-th product had
at s. So time is cut into nested buckets, and the top k at a coarse
bucket's start plus the few products that can still overtake give the exact
top k at the finer moments inside it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwright.config import CANDIDATES_PER_CATEGORY
from rankwright.functions.timeline import micros
from rankwright.operators.ordinals import with_total_before
from rankwright.sources.scratch import materialize

FANOUT = 128
#: Products per place of a top k that bound from below what it takes to rank.
BOUNDING = 8
SALES_PER_BUCKET = 1 << 13
ROWS_PER_TASK = 1 << 20


def popularity_global(products: DataFrame, order_items: DataFrame) -> DataFrame:
    """Sales per product over all time; 0 for products never sold."""
    sold = (
        order_items.where(F.col("product_id").isNotNull())
        .groupBy(F.col("product_id").alias("id"))
        .agg(F.count("id").alias("sales"))
    )
    return products.select("id", "category").join(sold, "id", "left").select(
        "id", "category", F.coalesce("sales", F.lit(0)).alias("sales_count")
    )


def _dated_sales(order_items: DataFrame) -> DataFrame:
    """Sales that can count: identified, on a product, with a time."""
    return order_items.where(
        F.col("id").isNotNull() & F.col("product_id").isNotNull() & F.col("created_at").isNotNull()
    ).select("product_id", micros(order_items, "created_at").alias("tick"))


def _div(value: Column, width: int) -> Column:
    """Whole-number division; dividing as doubles could misplace a boundary."""
    return F.call_function("div", value, F.lit(width).cast("bigint"))


def _running_before(order: str, *keys: str) -> Window:
    return Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, -1)


def sales_as_of(points: DataFrame, order_items: DataFrame, at: str, bucket_micros: int = 3_600_000_000) -> DataFrame:
    """``points`` distinct on (product_id, at), with the sales strictly before ``at``.

    Points and sales are laid on one timeline and counted by running sums, in
    two steps (whole buckets, then inside the bucket), so that a best-seller's
    history never has to pass through one window partition. Both steps read the
    timeline, so it is written once, and no task counts it and its buckets side by side.
    """
    asked = points.select("product_id", at).where(F.col("product_id").isNotNull() & F.col(at).isNotNull()).distinct()
    timeline = materialize(
        asked.select("product_id", micros(asked, at).alias("tick"), F.lit(0).alias("n"), F.lit(1).alias("asked"))
        .unionByName(_dated_sales(order_items).withColumns({"n": F.lit(1), "asked": F.lit(0)}))
        .groupBy("product_id", "tick")
        .agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
        .withColumn("bucket", _div(F.col("tick"), bucket_micros)),
        "timeline",
    )
    buckets = (
        timeline.groupBy("product_id", "bucket")
        .agg(F.sum("n").alias("n"), F.max("asked").alias("asked"))
        .withColumn("base", F.coalesce(F.sum("n").over(_running_before("bucket", "product_id")), F.lit(0)))
        .where(F.col("asked") == 1)
        .select("product_id", "bucket", "base")
    )
    counted = (
        timeline.withColumn(
            "inside", F.coalesce(F.sum("n").over(_running_before("tick", "product_id", "bucket")), F.lit(0))
        )
        .where(F.col("asked") == 1)
        .join(buckets, ["product_id", "bucket"])
        .select("product_id", "tick", (F.col("base") + F.col("inside")).alias("sales_count"))
    )
    return (
        asked.withColumn("tick", micros(asked, at)).join(counted, ["product_id", "tick"]).select("product_id", at, "sales_count")
    )


def _best(df: DataFrame, k: int, *keys: str) -> DataFrame:
    """The k best-selling products per key, ties by product id.

    A rank filter like this one is applied before the shuffle too, so a hot key
    sends at most k rows per task.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("sales_count"), "product_id")
    return df.withColumn("product_rank", F.row_number().over(order)).where(F.col("product_rank") <= k)


def _floor(tops: DataFrame, k: int) -> DataFrame:
    """The k-th product's sales at each bucket's start: what it takes to rank inside."""
    return tops.groupBy("category", "bucket").agg(
        F.coalesce(F.max(F.when(F.col("product_rank") == k, F.col("sales_count"))), F.lit(0)).alias("kth")
    )


def _lower_bounds(steps: DataFrame, k: int, fanout: int) -> DataFrame:
    """(category, bounds): for every child of the root, sales that k products have at its start, at least.

    steps  category, product_id, since, sales_count: totals reached by sales inside a child

    The products that sold best by the end stand for all: the k-th of them cannot have
    more than the k-th of all. They are a bounded number per category.
    """
    sold = steps.groupBy("category", "product_id").agg(F.max("sales_count").alias("sales_count"))
    # Written, so that its size is known where all steps meet it. A product of several categories may bound them all.
    some = materialize(_best(sold, BOUNDING * k, "category").select("product_id").distinct(), "bounding-products")
    own = (
        steps.join(some, "product_id", "left_semi")
        .groupBy("category", "product_id", "since")
        .agg(F.max("sales_count").alias("sales_count"))
    )
    following = Window.partitionBy("category", "product_id").orderBy("since")
    last = F.coalesce(F.lead("since").over(following), F.lit(fanout - 1))
    held = own.withColumn("last", last).where(F.col("since") < F.col("last"))
    at_child = held.select(
        "category", "product_id", "sales_count", F.explode(F.sequence(F.col("since") + 1, F.col("last"))).alias("bucket")
    )
    kth = _floor(_best(at_child, k, "category", "bucket"), k)
    found = kth.groupBy("category").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "kth"))).alias("known"))
    children = F.sequence(F.lit(0).cast("bigint"), F.lit(fanout - 1).cast("bigint"))
    return found.select(
        "category", F.transform(children, lambda c: F.coalesce(F.element_at("known", c), F.lit(0).cast("bigint"))).alias("bounds")
    )


def _first_states(tops: DataFrame, steps: DataFrame, k: int, fanout: int) -> DataFrame:
    """``_states`` of the root, where every product begins at 0 and no floor keeps any out.

    A total below the bound of a child ranks in neither that child nor a later one, as
    bounds only grow. So steps that fall short from the next child on go before they are
    shuffled, and an interval ends with the last child whose bound it reaches. That also
    ends those whose following step went: it fell short with the larger total.
    """
    bounds = materialize(_lower_bounds(steps, k, fanout), "bounds")
    bound = F.coalesce(F.get("bounds", (F.col("since") + 1).cast("int")), F.lit(0))
    reached = (
        steps.where(F.col("since") + 1 < fanout)
        .join(bounds, "category", "left")
        .where(F.col("sales_count") >= bound)
        .groupBy("category", "product_id", "since")
        .agg(F.max("sales_count").alias("sales_count"))
        .withColumn("bucket", F.lit(0).cast("bigint"))
    )
    passed = F.size(F.filter("bounds", lambda least: least <= F.col("sales_count")))
    until = F.coalesce("until", F.lit(fanout - 1).cast("bigint"))
    return (
        _states(tops, reached, F.lit(-1))
        .join(bounds, "category", "left")
        .withColumn("until", F.when(F.col("bounds").isNull(), until).otherwise(F.least(until, passed - 1)))
        .drop("bounds")
    )


def _states(tops: DataFrame, reached: DataFrame, before_all: Column) -> DataFrame:
    """The sales of every product that may rank inside a bucket, as intervals.

    tops     category, bucket, product_id, sales_count: the top k at its start
    reached  category, bucket, product_id, since, sales_count: totals reached by
             sales inside the bucket, without those that cannot rank in it
    Returns the columns of ``reached`` and ``until``: the total holds for moments
    after ``since`` up to ``until`` (NULL: the bucket's end).

    A total below the k-th product's at the bucket's start ranks nowhere in the
    bucket and goes; every later total of the product is larger, so intervals
    stay whole. A product outside the top k matters from its first sale on only.
    """
    leading = tops.select("category", "bucket", "product_id", before_all.cast("bigint").alias("since"), "sales_count")
    following = Window.partitionBy("category", "bucket", "product_id").orderBy("since")
    return reached.unionByName(leading).withColumn("until", F.lead("since").over(following))


def _tops_of_children(states: DataFrame, wanted: DataFrame, fanout: int, k: int) -> DataFrame:
    """The top k at the start of every wanted child bucket.

    Each interval is unfolded over the at most ``fanout`` children it covers. The
    rank limit runs on the map side, so only k rows per child leave a task, and
    a category that holds most products is spread over its children.
    """
    last = F.coalesce("until", (F.col("bucket") + 1) * fanout - 1)
    unfolded = states.where(F.col("since") < last).select(
        "category", "product_id", "sales_count", F.explode(F.sequence(F.col("since") + 1, last)).alias("moment")
    )
    asked = unfolded.join(wanted.distinct(), ["category", "moment"], "left_semi")
    return _best(asked, k, "category", "moment").withColumnRenamed("moment", "bucket")


def _tops_at_moments(states: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """The top k at every wanted moment, looked up in the intervals of its bucket."""
    held = wanted.join(states, ["category", "bucket"]).where(
        (F.col("moment") > F.col("since")) & (F.col("until").isNull() | (F.col("moment") <= F.col("until")))
    )
    return _best(held.select("category", "moment", "product_id", "sales_count"), k, "category", "moment")


def depth_for(n_sales: int, fanout: int = FANOUT) -> int:
    """Bucket levels so that the finest bucket holds a moderate number of sales."""
    wanted = math.log(max(n_sales, 1) / SALES_PER_BUCKET, fanout)
    return max(1, math.ceil(wanted))


def top_products_as_of(
    moments: DataFrame,
    products: DataFrame,
    order_items: DataFrame,
    at: str,
    k: int = CANDIDATES_PER_CATEGORY,
    fanout: int = FANOUT,
    depth: int | None = None,
) -> DataFrame:
    """The k best-selling products of a category strictly before each moment.

    ``moments`` holds (category, at). Products never sold count 0 and may rank.
    Returns category, at, product_id, sales_count, product_rank.
    """
    asked, tops = top_products_by_moment(moments, products, order_items, at, k, fanout, depth)
    return asked.join(tops, ["category", "moment"]).select("category", at, "product_id", "sales_count", "product_rank")


def top_products_by_moment(
    moments: DataFrame,
    products: DataFrame,
    order_items: DataFrame,
    at: str,
    k: int = CANDIDATES_PER_CATEGORY,
    fanout: int = FANOUT,
    depth: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``top_products_as_of`` in two frames that share (category, moment).

    (category, at, moment) and (category, moment, product_id, sales_count, product_rank).
    Times between two sales share one moment, so the second is often far smaller than both joined.
    """
    catalog = products.select(F.col("id").alias("product_id"), "category").where(
        F.col("category").isNotNull() & F.col("product_id").isNotNull()
    )
    asked = (
        moments.where(F.col("category").isNotNull() & F.col(at).isNotNull())
        .select("category", F.col(at), micros(moments, at).alias("clock"))
        .distinct()
    )
    # All that follows reads these rows, not the items. Few sales share product and time, so none are combined here.
    sales = materialize(_dated_sales(order_items).withColumnRenamed("tick", "clock"), "sales")
    # The number of sales before every time that is sold or asked at. It grows with each
    # time sold at, so "strictly before" is the same by this number as by the clock.
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    times = sales.select("clock", one.alias("n")).unionByName(asked.select("clock", none.alias("n")))
    told = materialize(with_total_before(times.groupBy("clock").agg(F.sum("n").alias("n")), "clock", "n", "tick"), "times")
    n_sales = told.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    told = told.select("clock", "tick")
    asked, sales = materialize(asked.join(told, "clock").drop("clock"), "moments"), sales.join(told, "clock").drop("clock")
    depth = depth or depth_for(n_sales, fanout)
    # Every level's bucket holds exactly `fanout` buckets of the next; the root
    # bucket (level 0) holds all sales, and later moments fall into its last part.
    finest = max(1, math.ceil(n_sales / fanout**depth))
    widths = [finest * fanout ** (depth - level) for level in range(depth + 1)]

    def bucket(level: int, tick: str = "tick") -> Column:
        last = fanout**level - 1
        return F.least(_div(F.col(tick), widths[level]), F.lit(last).cast("bigint"))

    # Sales per product and finest bucket: combined before the shuffle, and all
    # that the coarse levels need. Running totals lie by product, as the catalog then
    # does that they are joined with. Written once, as every level reads it.
    dated = sales.withColumn("leaf", bucket(depth))
    upto = Window.partitionBy("product_id").orderBy("leaf").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    leaves = materialize(
        dated.groupBy("product_id", "leaf")
        .agg(F.count("*").alias("n"))
        .withColumn("after", F.sum("n").over(upto))
        .join(catalog.groupBy("category", "product_id").agg(F.count("*").alias("times")), "product_id")
        .select(
            "category",
            "product_id",
            "leaf",
            ((F.col("after") - F.col("n")) * F.col("times")).alias("before"),
            (F.col("after") * F.col("times")).alias("after"),
        ),
        "sales-by-bucket",
    )

    moment = F.col("tick").alias("moment")
    first = Window.partitionBy("category").orderBy("product_id")
    tops = (
        catalog.withColumn("product_rank", F.row_number().over(first))
        .where(F.col("product_rank") <= k)
        .select("category", F.lit(0).cast("bigint").alias("bucket"), "product_id",
                F.lit(0).cast("bigint").alias("sales_count"), "product_rank")
    )
    for level in range(depth):
        steps = leaves.select(
            "category",
            "product_id",
            _div(F.col("leaf"), fanout ** (depth - level - 1)).alias("since"),
            F.col("after").alias("sales_count"),
        )
        if level == 0:
            states = _first_states(tops, steps, k, fanout)
        else:
            # What falls short goes before several leaves become one step: their largest total stays, if any does.
            steps = steps.withColumn("bucket", _div(F.col("since"), fanout)).join(_floor(tops, k), ["category", "bucket"])
            reached = steps.where(F.col("sales_count") >= F.col("kth")).drop("kth")
            if level + 1 < depth:
                reached = reached.groupBy("category", "bucket", "product_id", "since").agg(F.max("sales_count").alias("sales_count"))
            states = _states(tops, reached, F.col("bucket") * fanout - 1)
        wanted = asked.select("category", bucket(level + 1).alias("moment"))
        tops = materialize(_tops_of_children(states, wanted, fanout, k), f"top-products-{level + 1}")

    floor = _floor(tops, k)
    # The few products that still move inside a finest bucket: written, so that their size is known where all sales meet them.
    movers = materialize(
        leaves.withColumnRenamed("leaf", "bucket")
        .join(floor, ["category", "bucket"])
        .where(F.col("after") >= F.col("kth"))
        .select("category", "bucket", "product_id", "before", "kth"),
        "movers",
    )
    running = Window.partitionBy("category", "bucket", "product_id").orderBy("since")
    steps = (
        dated.select(F.col("leaf").alias("bucket"), "product_id", F.col("tick").alias("since"))
        .join(movers, ["bucket", "product_id"])
        .groupBy("category", "bucket", "product_id", "since")
        .agg(F.count("*").alias("n"), F.first("before").alias("before"), F.first("kth").alias("kth"))
        .withColumn("sales_count", F.col("before") + F.sum("n").over(running))
        .drop("n", "before")
    )
    reached = steps.where(F.col("sales_count") >= F.col("kth")).drop("kth")
    # Few moments give k rows for every time asked at. Tasks are counted by those rows; by their own size they would be few.
    tasks = max(asked.sparkSession.sparkContext.defaultParallelism, math.ceil(asked.count() * k / ROWS_PER_TASK))
    wanted = asked.select("category", bucket(depth).alias("bucket"), moment).distinct().repartition(tasks, "category", "moment")
    tops = _tops_at_moments(_states(tops, reached, F.lit(-1)), wanted, k)
    return asked.select("category", at, moment), tops
