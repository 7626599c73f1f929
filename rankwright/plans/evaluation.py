"""How good a scored set is, and whether that is good enough."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from rankwright.config import NDCG_THRESHOLD, choose_threshold
from rankwright.operators.ndcg import decide, evaluation_counts, session_ndcg
from rankwright.plans.gate import as_metrics


def evaluate(scored: DataFrame, threshold_override: float = 0.0, default: float = NDCG_THRESHOLD) -> DataFrame:
    """One row: session counts, mean NDCG@5, threshold and decision."""
    threshold = choose_threshold(threshold_override, default)
    return decide(evaluation_counts(session_ndcg(scored)), threshold)


def feature_metrics(training: DataFrame, n_features: int) -> DataFrame:
    """Size and label balance of a training set, as (stage, metric, value)."""
    row = training.agg(
        F.count("*").alias("total_training_samples"),
        F.lit(n_features).alias("total_features"),
        F.coalesce(F.sum("target_label"), F.lit(0)).alias("positive_samples"),
        (F.count("*") - F.coalesce(F.sum("target_label"), F.lit(0))).alias("negative_samples"),
    )
    return as_metrics(row, "features")


def observed_features(training: DataFrame, n_features: int) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``training``, to be written once, and what gives its metrics after that: the write counts on its way."""
    seen = Observation()
    positives = F.coalesce(F.sum("target_label"), F.lit(0))
    counted = training.observe(seen, F.count("*").alias("n"), positives.alias("positives"))

    def metrics() -> DataFrame:
        n, positives = seen.get["n"], seen.get["positives"]
        row = {"total_training_samples": n, "total_features": n_features, "positive_samples": positives, "negative_samples": n - positives}
        rows = [("features", name, float(value)) for name, value in row.items()]
        return training.sparkSession.createDataFrame(rows, "stage string, metric string, value double")

    return counted, metrics


def evaluation_metrics(summary: DataFrame) -> DataFrame:
    row = summary.select(F.col("mean_ndcg_5").alias("test_mean_ndcg_5"), F.col("threshold").alias("target_threshold"))
    return as_metrics(row, "evaluation")
