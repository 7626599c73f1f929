"""Feature tables beside the training set: interactions, windows, users, products, time.

All count what happened, over all rows; guests (no user) and unknown products drop
out where a user or a product is the key. Sums of prices and weights are decimal, so
no order of adding changes them. Wide keys are counted before they meet the catalog;
windows run over days, or over one user's events of one range partition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rankwright.config import INTERACTION_WEIGHTS, ROLLING_WINDOWS
from rankwright.operators.ordinals import with_previous


def _weight() -> Column:
    """An event's weight by type; 0 for types without one."""
    cases = [F.col("event_type") == name for name in INTERACTION_WEIGHTS]
    found = reduce(
        lambda so_far, pair: so_far.when(pair[0], F.lit(str(pair[1]))),
        zip(cases, INTERACTION_WEIGHTS.values()),
        F.when(F.lit(False), F.lit(None).cast("string")),
    )
    return F.coalesce(found, F.lit("0")).cast("decimal(10,2)")


def _price(name: str) -> Column:
    return F.col(name).cast("decimal(20,4)")


def _with_keys(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())


def _on_known(counted: DataFrame, products: DataFrame) -> DataFrame:
    """Rows on a product of the catalog: one per user and product, so a hot product moves no events.

    An inner join with distinct ids: a semi join would be pushed below the counting.
    """
    return counted.join(products.select(F.col("id").alias("product_id")).distinct(), "product_id")


def _events_of_type(name: str) -> Column:
    return F.count_if(F.col("event_type") == name)


def interaction_scores(events: DataFrame, products: DataFrame) -> DataFrame:
    """Events and summed weight of every user on every product they met."""
    counted = _with_keys(events).groupBy("user_id", "product_id").agg(
        F.count("*").alias("n_events"), F.sum(_weight()).cast("double").alias("score")
    )
    return _on_known(counted, products).select("user_id", "product_id", "n_events", "score")


def user_item_matrix(events: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """The user-item matrix in long form: event weights, and a purchase's per item bought."""
    bought = F.lit(str(INTERACTION_WEIGHTS["purchase"])).cast("decimal(10,2)")
    rows = events.select("user_id", "product_id", _weight().alias("weight")).unionByName(
        order_items.select("user_id", "product_id", bought.alias("weight"))
    )
    summed = _with_keys(rows).groupBy("user_id", "product_id").agg(F.sum("weight").cast("double").alias("weight"))
    return _on_known(summed.where(F.col("weight") != 0), products).select("user_id", "product_id", "weight")


def rolling_user_activity(events: DataFrame, windows: tuple[int, ...] = ROLLING_WINDOWS) -> DataFrame:
    """Per user and active day: events and weight of the last n days, that day included.

    A window passes over a user's active days, so its size is bounded by the calendar.
    """
    days = (
        events.where(F.col("user_id").isNotNull() & F.col("created_at").isNotNull())
        .groupBy("user_id", F.to_date("created_at").alias("day"))
        .agg(F.count("*").alias("n"), F.sum(_weight()).alias("weight"))
        .withColumn("_number", F.unix_date("day"))
    )
    order = Window.partitionBy("user_id").orderBy("_number")
    columns = []
    for n in windows:
        last = order.rangeBetween(-(n - 1), 0)
        columns.append(F.sum("n").over(last).alias(f"events_{n}d"))
        columns.append(F.sum("weight").over(last).cast("double").alias(f"score_{n}d"))
    return days.select("user_id", "day", *columns)


def user_features(users: DataFrame, events: DataFrame, order_items: DataFrame) -> DataFrame:
    """Every user with their activity and purchases; 0 where there is none."""
    active = events.where(F.col("user_id").isNotNull()).groupBy(F.col("user_id").alias("id")).agg(
        F.count("*").alias("n_events"),
        F.countDistinct("session_id").alias("n_sessions"),
        _events_of_type("purchase").alias("n_purchases"),
        F.max("created_at").alias("last_event_at"),
    )
    bought = order_items.where(F.col("user_id").isNotNull()).groupBy(F.col("user_id").alias("id")).agg(
        F.count("*").alias("n_items"),
        F.countDistinct("order_id").alias("n_orders"),
        F.sum(_price("sale_price")).cast("double").alias("spend"),
        F.max("created_at").alias("last_item_at"),
    )
    counts = ["n_events", "n_sessions", "n_purchases", "n_items", "n_orders"]
    return (
        users.select("id")
        .join(active, "id", "left")
        .join(bought, "id", "left")
        .select(
            F.col("id").alias("user_id"),
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
            F.coalesce("spend", F.lit(0.0)).alias("spend"),
            "last_event_at",
            "last_item_at",
        )
    )


def product_features(products: DataFrame, events: DataFrame, order_items: DataFrame) -> DataFrame:
    """Every product with its sales and events; ``conversion`` is purchases per view, NULL without views."""
    met = events.where(F.col("product_id").isNotNull()).groupBy(F.col("product_id").alias("id")).agg(
        *[_events_of_type(kind).alias(name) for kind, name in (("product", "n_views"), ("cart", "n_carts"), ("purchase", "n_purchases"))]
    )
    sold = order_items.where(F.col("product_id").isNotNull()).groupBy(F.col("product_id").alias("id")).agg(
        F.count("*").alias("n_items"),
        F.countDistinct("user_id").alias("n_buyers"),
        F.sum(_price("sale_price")).cast("double").alias("revenue"),
    )
    counts = ["n_views", "n_carts", "n_purchases", "n_items", "n_buyers"]
    return (
        products.select("id", "category")
        .join(met, "id", "left")
        .join(sold, "id", "left")
        .select(
            F.col("id").alias("product_id"),
            "category",
            *[F.coalesce(c, F.lit(0)).alias(c) for c in counts],
            F.coalesce("revenue", F.lit(0.0)).alias("revenue"),
            F.when(F.col("n_views") > 0, F.col("n_purchases") / F.col("n_views")).alias("conversion"),
        )
    )


def interaction_features(events: DataFrame, order_items: DataFrame, products: DataFrame) -> DataFrame:
    """What a user did with a product: events by type, first and last time, items and money."""
    nothing = F.lit(None).cast("decimal(20,4)")
    rows = events.select("user_id", "product_id", "event_type", "created_at", F.lit(0).alias("item"), nothing.alias("price")).unionByName(
        order_items.select(
            "user_id", "product_id", F.lit(None).cast("string").alias("event_type"), "created_at", F.lit(1).alias("item"),
            _price("sale_price").alias("price"),
        )
    )
    counted = _with_keys(rows).groupBy("user_id", "product_id").agg(
        _events_of_type("product").alias("n_views"),
        _events_of_type("cart").alias("n_carts"),
        _events_of_type("purchase").alias("n_purchases"),
        F.sum("item").alias("n_items"),
        F.coalesce(F.sum("price").cast("double"), F.lit(0.0)).alias("spend"),
        F.min("created_at").alias("first_at"),
        F.max("created_at").alias("last_at"),
    )
    return _on_known(counted, products).select("user_id", *[c for c in counted.columns if c != "user_id"])


def temporal_features(events: DataFrame) -> DataFrame:
    """Hour, ISO weekday, weekend, and seconds since the user's event before, per dated event of a user.

    A user's events may fill many range partitions; only the last of each is carried on.
    """
    dated = events.where(F.col("user_id").isNotNull() & F.col("created_at").isNotNull())
    order = ["created_at", "event_type", "product_id", "session_id"]
    followed = with_previous(dated, ["user_id"], order, "created_at", "_before")
    weekday = F.weekday("created_at") + 1
    return followed.select(
        "user_id", "session_id", "event_type", "product_id", "created_at",
        F.hour("created_at").alias("hour"),
        weekday.alias("day_of_week"),
        (weekday >= 6).alias("is_weekend"),
        F.timestamp_diff("SECOND", F.col("_before"), F.col("created_at")).alias("gap_seconds"),
    )
