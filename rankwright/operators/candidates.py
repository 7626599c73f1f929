"""Positives plus popular products of the same category as negatives.

All frames carry their session's start, so it is never joined back later.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.config import CANDIDATES_PER_CATEGORY, SESSION_START

ROWS_PER_TASK = 1 << 20
SAMPLE = ("session_id", "user_id", "current_session_category", "product_id", "label", SESSION_START)


def candidate_generation(positives: DataFrame, tops: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """One label-0 row per positive and top product of its category.

    ``tops`` holds at most k rows per (category, session start), so the output
    grows with the positives only. Where ``asked`` gives the moment of every (category,
    session start), ``tops`` are by moment; positives then meet the moments before they
    meet the products, and the rows that come of it are not joined again.
    """
    category, when = F.col("category").alias("current_session_category"), SESSION_START
    if asked is not None:
        positives = positives.join(asked.select(category, SESSION_START, "moment"), ["current_session_category", SESSION_START])
        when = "moment"
    return (
        positives.drop("product_id", "label")
        .join(tops.select(category, when, "product_id"), ["current_session_category", when])
        .withColumn("label", F.lit(0))
        .select(*SAMPLE)
    )


def combined_candidates(positives: DataFrame, candidates: DataFrame) -> DataFrame:
    """The union of both without duplicate rows."""
    return positives.select(*SAMPLE).unionByName(candidates.select(*SAMPLE)).distinct()


def final_deduped(combined: DataFrame) -> DataFrame:
    """One row per (session, user, product); a positive wins over a candidate."""
    return combined.groupBy("session_id", "user_id", "product_id").agg(
        F.max("label").alias("target_label"), F.min(SESSION_START).alias(SESSION_START)
    )


def _by_sample(samples: DataFrame, most: int) -> DataFrame:
    """``samples``, of which there are at most so many, dealt by (session, user, product) where the cores cannot take them in tasks of ROWS_PER_TASK.

    Hardly any of them are equal: counted before the shuffle they would fill a hash table and
    hardly become fewer, and adaptive execution would deal them by bytes, of which they take few.
    """
    spark = samples.sparkSession
    if most <= ROWS_PER_TASK * spark.sparkContext.defaultParallelism:
        return samples
    shuffled = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return samples.repartition(max(shuffled, math.ceil(most / ROWS_PER_TASK)), "session_id", "user_id", "product_id")


def labelled_samples(
    positives: DataFrame, tops: DataFrame, asked: DataFrame | None = None, k: int = CANDIDATES_PER_CATEGORY
) -> DataFrame:
    """What ``final_deduped`` gives for these positives, the short way.

    Candidates are made once per (session, user, category) rather than once per
    positive, and MAX makes removing duplicates before it pointless. ``tops`` has at most
    ``k`` products per category and start; positives are counted, so they should be stored.
    """
    asking = positives.select("session_id", "user_id", "current_session_category", SESSION_START).distinct()
    samples = positives.select(*SAMPLE).unionByName(candidate_generation(asking, tops, asked))
    return final_deduped(_by_sample(samples, positives.count() * (k + 1)))
