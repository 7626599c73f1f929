"""User and product columns of training rows, and the columns a model sees."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.config import CATEGORICAL, IDENTITY, SESSION_START, UNKNOWN


def attach_features(samples: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Training rows of 12 columns; rows of guests and unknown users drop out.

    ``samples`` carries the session start. Both joins are left to Spark's own
    size check: a small dimension is broadcast, a large one shuffled with skewed
    keys split.
    """
    people = users.select(
        F.col("id").alias("user_id"),
        F.col("age").alias("user_age"),
        F.col("gender").alias("user_gender"),
        F.col("country").alias("user_country"),
    )
    catalog = products.select(F.col("id").alias("product_id"), "retail_price", "cost", "brand")
    return (
        samples.join(people, "user_id")
        .join(catalog, "product_id")
        .select(
            F.col("session_id").alias("qid"),
            "user_id",
            "product_id",
            "user_age",
            "user_gender",
            "user_country",
            "retail_price",
            "cost",
            (F.col("retail_price") - F.col("cost")).alias("profit_margin"),
            "brand",
            "target_label",
            SESSION_START,
        )
    )


def fill_categories(df: DataFrame) -> DataFrame:
    """NULL categories become a category of their own."""
    return df.fillna(UNKNOWN, subset=[c for c in CATEGORICAL if c in df.columns])


def feature_columns(df: DataFrame) -> list[str]:
    """What a model may see: everything but identity, label and session time."""
    return [c for c in df.columns if c not in (*IDENTITY, SESSION_START)]


def feature_matrix(df: DataFrame) -> DataFrame:
    """The label and the feature columns of filled rows."""
    return fill_categories(df).select("target_label", *feature_columns(df))
