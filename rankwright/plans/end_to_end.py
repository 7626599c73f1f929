"""Gate, training set, registration, ranker, evaluation, publication in one run."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from rankwright.config import RunConfig
from rankwright.operators.features import feature_columns, fill_categories
from rankwright.operators.ranker import Training, fit_ranker
from rankwright.operators.split import split_by_time
from rankwright.plans.evaluation import evaluate, evaluation_metrics, observed_features
from rankwright.plans.gate import run_gate
from rankwright.plans.training_set import training_set
from rankwright.sources.files import delete_folder
from rankwright.sources.store import append_metrics, model_path, publish_model, read_feature_table, register_features
from rankwright.sources.tables import Tables


def held_out(split: DataFrame, scope: str) -> DataFrame:
    """The rows a ranker is judged on: the validation part, or all of them."""
    if scope not in ("held_out", "all"):
        raise ValueError(f"scope must be held_out or all, not {scope!r}")
    return split if scope == "all" else split.where("not is_train")


def training_metrics(spark: SparkSession, fitted: Training) -> DataFrame:
    best = fitted.curve[fitted.best_round - 1]["validation_ndcg_5"]
    return spark.createDataFrame([("training", "val_ndcg_5", best)], "stage string, metric string, value double")


def run_end_to_end(
    tables: Tables,
    config: RunConfig = RunConfig(),
    as_of: str | None = None,
    on_fail: str = "raise",
    scope: str = "held_out",
    run_id: str | None = None,
) -> DataFrame:
    """The run's evaluation as one row: its id, gate outcome, scores and decision.

    Popularity is counted on validated rows once the gate has passed. A closed
    gate stops the run, or with ``on_fail="report"`` lets it go on with the raw
    rows. A model is saved and published only when its evaluation says approve.

    The fit's state lies beside the models until the run ends. A run that was lost is
    started again under its ``run_id`` and boosts on from the last state written.
    """
    if on_fail not in ("raise", "report"):
        raise ValueError(f"on_fail must be raise or report, not {on_fail!r}")
    if config.ranker.n_trees < 1:
        raise ValueError("a run needs at least one tree")
    spark = tables.events.sparkSession
    run_id = run_id or uuid.uuid4().hex
    gate = run_gate(tables, config.max_nulls, as_of, config.ignore_null_keys)
    append_metrics(gate.metrics, run_id, config.store)
    if gate.passed or on_fail == "raise":
        tables = replace(tables, order_items=gate.require())
    training = fill_categories(training_set(tables, config.top_k))
    training, feature_metrics = observed_features(training, len(feature_columns(training)))
    uri = register_features(training, config.feature_group, config.store)
    append_metrics(feature_metrics(), run_id, config.store)
    stored = read_feature_table(spark, uri)

    split = split_by_time(stored, config.validation_share)
    path = model_path(spark, config.model_name, run_id, config.store)
    state = f"{path}-state"
    fitted: Training = fit_ranker(split, config.ranker, state=state)
    append_metrics(training_metrics(spark, fitted), run_id, config.store)
    summary = evaluate(fitted.ranker.score(held_out(split, scope)), config.ndcg_threshold)
    append_metrics(evaluation_metrics(summary), run_id, config.store)
    outcome = summary.first()
    approved = outcome["decision"] == "approve"
    if approved:
        fitted.ranker.save(path)
        publish_model(spark, config.model_name, path, run_id, outcome["mean_ndcg_5"], "approve", config.store)
    delete_folder(spark, state)
    row = {
        "run_id": run_id,
        "gate_passed": gate.passed,
        "rounds": len(fitted.curve),
        "best_round": fitted.best_round,
        **outcome.asDict(),
        "model_path": path if approved else "",
    }
    return spark.createDataFrame([tuple(row.values())], list(row))
