"""Session events with labels, and what is derived from them per session."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.config import POSITIVE_EVENTS, SESSION_START


def session_context(events: DataFrame, products: DataFrame) -> DataFrame:
    """Events of a session on a known product, labelled positive or not.

    No broadcast hint: Spark compares the size of ``products`` with its own
    threshold, and falls back to a shuffled join with skew splitting beyond it.
    """
    catalog = products.select(F.col("id").alias("product_id"), "category")
    return (
        events.where(F.col("session_id").isNotNull())
        .join(catalog, "product_id")
        .select(
            "session_id",
            "user_id",
            F.col("created_at").alias(SESSION_START),
            F.col("category").alias("current_session_category"),
            F.col("product_id").alias("interacted_product_id"),
            F.when(F.col("event_type").isin(*POSITIVE_EVENTS), 1).otherwise(0).alias("is_positive"),
        )
    )


def met_products(events: DataFrame, products: DataFrame) -> DataFrame:
    """``session_context`` with one row per session, user and product: first time, any positive.

    Events combine before they are shuffled, and only what is left meets the catalog,
    so neither a hot product nor a hot session moves its raw events.
    """
    met = (
        events.where(F.col("session_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("session_id", "user_id", "product_id")
        .agg(F.min("created_at").alias("created_at"), F.bool_or(F.col("event_type").isin(*POSITIVE_EVENTS)).alias("positive"))
        .withColumn("event_type", F.when(F.col("positive"), F.lit(POSITIVE_EVENTS[0])).otherwise(F.lit("")))
    )
    return session_context(met.drop("positive"), products)


def positive_samples(context: DataFrame) -> DataFrame:
    """Distinct positive (session, user, category, product) rows, label 1."""
    return (
        context.where(F.col("is_positive") == 1)
        .select("session_id", "user_id", "current_session_category", F.col("interacted_product_id").alias("product_id"))
        .distinct()
        .withColumn("label", F.lit(1))
    )


def session_starts(context: DataFrame) -> DataFrame:
    """The first event time of every session."""
    return context.groupBy("session_id").agg(F.min(SESSION_START).alias(SESSION_START))

