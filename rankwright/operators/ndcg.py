"""NDCG@k per session, with tied scores averaged.

Labels are 0 or 1. Rows with one score form a level; every row of a level has
the level's mean label as its gain, so a level contributes its mean label times
the discounts of the positions it covers. Only the first k levels can matter,
and they are found by a rank filter that runs before the shuffle: a session
holding most of all rows never meets in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def discount_sum(k: int, positions: Column) -> Column:
    """Sum of 1 / log2(1 + p) over p = 1 .. min(positions, k)."""
    sums = [0.0]
    for position in range(1, k + 1):
        sums.append(sums[-1] + 1.0 / math.log2(1 + position))
    table = F.array(*[F.lit(value) for value in sums])
    return F.element_at(table, (F.least(positions, F.lit(k)) + 1).cast("int"))


def session_totals(scored: DataFrame, label: str = "target_label", by: tuple[str, ...] = ("qid",)) -> DataFrame:
    """Rows and positives per session; they do not depend on the score."""
    return scored.groupBy(*by).agg(F.count("*").alias("n_rows"), F.sum(label).alias("positives"))


def session_ndcg(
    scored: DataFrame,
    cuts: tuple[int, ...] = (5,),
    score: str = "score",
    label: str = "target_label",
    by: tuple[str, ...] = ("qid",),
    totals: DataFrame | None = None,
) -> DataFrame:
    """Per session: rows, positives and ``ndcg_<k>`` for every cut.

    NDCG is NULL for sessions that do not count: no positive, or a single row.
    A caller that scores the same rows again and again passes their ``totals``.
    """
    keys = list(by)
    levels = scored.groupBy(*keys, score).agg(F.count("*").alias("n"), F.sum(label).alias("hits"))
    by_score = Window.partitionBy(*keys).orderBy(F.desc(score))
    best = levels.withColumn("level", F.row_number().over(by_score)).where(F.col("level") <= max(cuts))
    upto = F.sum("n").over(Window.partitionBy(*keys).orderBy("level"))
    gains = best.withColumn("upto", upto).groupBy(*keys).agg(
        *[
            F.sum(
                F.col("hits") / F.col("n")
                * (discount_sum(k, F.col("upto")) - discount_sum(k, F.col("upto") - F.col("n")))
            ).alias(f"dcg_{k}")
            for k in cuts
        ]
    )
    totals = totals if totals is not None else session_totals(scored, label, by)
    counts = (F.col("positives") > 0) & (F.col("n_rows") > 1)
    return totals.join(gains, keys).select(
        *keys,
        "n_rows",
        "positives",
        *[F.when(counts, F.col(f"dcg_{k}") / discount_sum(k, F.col("positives"))).alias(f"ndcg_{k}") for k in cuts],
    )


def evaluation_counts(per_session: DataFrame, cuts: tuple[int, ...] = (5,)) -> DataFrame:
    """One row: sessions, those with a positive, those scored, and mean NDCGs (0 if none)."""
    scored = (F.col("positives") > 0) & (F.col("n_rows") > 1)
    return per_session.agg(
        F.count("*").alias("total_sessions"),
        F.count_if(F.col("positives") > 0).alias("sessions_with_positive"),
        F.count_if(scored).alias("sessions_scored"),
        *[F.coalesce(F.avg(f"ndcg_{k}"), F.lit(0.0)).alias(f"mean_ndcg_{k}") for k in cuts],
    )


def top_k_by_score(scored: DataFrame, k: int, score: str = "score") -> DataFrame:
    """The k best rows of every session, ties by product, then user."""
    order = Window.partitionBy("qid").orderBy(F.desc(score), "product_id", "user_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def decide(summary: DataFrame, threshold: float, metric: str = "mean_ndcg_5") -> DataFrame:
    """``summary`` with the threshold and approve or reject."""
    return summary.withColumn("threshold", F.lit(threshold)).withColumn(
        "decision", F.when(F.col(metric) >= threshold, "approve").otherwise("reject")
    )


def early_stop(curve: DataFrame, value: str, patience: int) -> DataFrame:
    """One row: the round boosting stops at and its best one, on a whole learning curve.

    ``curve`` holds ``round`` from 1 on. A round improves if it beats all before it; the
    first that ends ``patience`` rounds without an improvement is the last. A curve is as
    long as the rounds allowed, so its one window partition is bounded by that setting.
    """
    order = Window.orderBy("round")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    improved = F.col(value) > F.coalesce(F.max(value).over(before), F.lit(float("-inf")))
    seen = curve.withColumn("_own", F.when(improved, F.col("round"))).withColumn(
        "_best", F.max("_own").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    stop = F.coalesce(F.min(F.when(F.col("round") - F.col("_best") >= patience, F.col("round"))), F.max("round"))
    last = seen.agg(stop.alias("stop_round"))
    return seen.join(F.broadcast(last), F.col("round") == F.col("stop_round")).select(
        F.col("stop_round").cast("bigint").alias("stop_round"), F.col("_best").cast("bigint").alias("best_round")
    )
