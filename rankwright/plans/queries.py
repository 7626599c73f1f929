"""Every operator as a query over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwright.config import PATIENCE, SESSION_START, RankerParams, RunConfig, StoreConfig
from rankwright.operators import feature_tables as tables_of
from rankwright.operators import validation as checks
from rankwright.operators.candidates import candidate_generation, combined_candidates, final_deduped
from rankwright.operators.encoding import apply_codes, fit_codes, fit_rates
from rankwright.operators.features import attach_features, feature_columns, feature_matrix, fill_categories
from rankwright.operators.ndcg import decide, early_stop, evaluation_counts, session_ndcg, session_totals, top_k_by_score
from rankwright.operators.ordinals import with_ordinal
from rankwright.operators.popularity import popularity_global, sales_as_of
from rankwright.operators.histogram import Tree, histogram, with_bins, with_node
from rankwright.operators.quarantine import part_items, quarantined_items, rule_names, valid_items
from rankwright.operators.ranker import FEATURES, NUMERIC, Ranker, Training, assemble, fit_ranker, session_lambdas
from rankwright.operators.sessions import met_products, positive_samples, session_context, session_starts
from rankwright.operators.split import group_sizes, split_by_time
from rankwright.operators.trees import TREE_TABLE, read_trees, tree_score
from rankwright.plans import gate
from rankwright.plans.end_to_end import run_end_to_end, training_metrics
from rankwright.plans.evaluation import evaluation_metrics, feature_metrics
from rankwright.plans.training_set import dated_positives, moments_and_tops, top_products, training_set
from rankwright.sources import store
from rankwright.sources.fixtures import fixture_tables, repaired_tables
from rankwright.sources.scratch import materialize, new_path

AS_OF = "2001-01-01"
Query = Callable[[SparkSession, str], DataFrame]

_WRITTEN: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[], object]):
    """A stored result the queries of one application share, as a feature table is."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _WRITTEN:
        _WRITTEN[key] = make()
    return _WRITTEN[key]


def _training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "training", lambda: materialize(training_set(fixture_tables(spark, sf_dir)), "training"))


def _fitted(spark: SparkSession, sf_dir: str) -> Training:
    return _once(spark, sf_dir, "ranker", lambda: fit_ranker(split_by_time(_training(spark, sf_dir)), RankerParams()))


def _tables(spark: SparkSession, sf_dir: str):
    return fixture_tables(spark, sf_dir)


def _dirty(spark: SparkSession, sf_dir: str):
    return fixture_tables(spark, sf_dir, dirty=True)


def _context(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fixture_tables(spark, sf_dir)
    return session_context(tables.events, tables.products)


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.validation_stats(_dirty(spark, sf_dir), AS_OF)


def _candidates(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tables = fixture_tables(spark, sf_dir)
    positives = materialize(dated_positives(tables), "positives")
    asked, tops = moments_and_tops(positives, tables)
    return positives, candidate_generation(positives, tops, asked)


def _combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return combined_candidates(*_candidates(spark, sf_dir))


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training rows under a fixed, heavily tied score."""
    return _training(spark, sf_dir).withColumn("score", F.floor(F.col("retail_price") / 50).cast("double"))


def _popularity_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fixture_tables(spark, sf_dir)
    met = materialize(met_products(tables.events, tables.products), "met-products")
    points = (
        met.select("session_id", F.col("interacted_product_id").alias("product_id"))
        .distinct()
        .join(session_starts(met), "session_id")
    )
    return sales_as_of(points, tables.order_items, SESSION_START)


def _top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fixture_tables(spark, sf_dir)
    return top_products(materialize(dated_positives(tables), "positives"), tables)


def _feature_attachment(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = fixture_tables(spark, sf_dir)
    return attach_features(final_deduped(_combined(spark, sf_dir)), tables.users, tables.products)


def _sorted_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ordinal(_training(spark, sf_dir), [SESSION_START, "qid", "product_id", "user_id"], "position")


def _sink_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "validated")
    store.save_parquet(checks.validated_order_items(_dirty(spark, sf_dir).order_items), path)
    return spark.read.parquet(path)


def _sink_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "features")
    store.save_by_day(fill_categories(_training(spark, sf_dir)), path)
    return spark.read.parquet(path)


#: No repaired order is dated after it.
AS_OF_OPEN = "2002-01-01"


def _quarantined_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items the gate holds back, with the rules they break, from the one write that parts them."""
    tables = _dirty(spark, sf_dir)
    parted = part_items(tables, new_path(spark, "parted-items"))
    return quarantined_items(parted, tables.order_items).withColumn("rules", F.array_join(rule_names(F.col("broken")), ","))


def _quarantine_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items per rule, as counted on the way by that write."""
    counts = part_items(_dirty(spark, sf_dir), new_path(spark, "parted-items")).counts
    return spark.createDataFrame(sorted(counts.items()), "rule string, items long")


def _report_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = checks.validation_stats(repaired_tables(spark, sf_dir), AS_OF_OPEN)
    return gate.report_json(gate.validation_report(stats))


def _training_validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training set of a run whose gate is open, on the items it let through."""
    tables = repaired_tables(spark, sf_dir)
    gate.run_gate(tables, as_of=AS_OF_OPEN).require()
    parted = part_items(tables, new_path(spark, "parted-items"))
    return training_set(replace(tables, order_items=valid_items(parted, tables.order_items)))


def _store_for(spark: SparkSession, sf_dir: str) -> StoreConfig:
    """One database per test scale and application, so that they do not overwrite each other."""
    name = f"feature_store_{sf_dir.strip('/')}_{spark.sparkContext.applicationId}"
    return StoreConfig(database="".join(c if c.isalnum() else "_" for c in name).lower())


def _stored(spark: SparkSession, sf_dir: str, name: str, *dispositions: str) -> DataFrame:
    rows, target = fill_categories(_training(spark, sf_dir)), _store_for(spark, sf_dir)
    store.create_database(spark, target)
    for disposition in dispositions:
        store.save_table(rows, target.table_ref(name), disposition, rows.schema)
    return spark.table(target.table_ref(name))


def _feature_table_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = store.register_features(fill_categories(_training(spark, sf_dir)), "training_dataset", _store_for(spark, sf_dir))
    return store.read_feature_table(spark, uri, (SESSION_START, "qid"))


def _feature_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registering twice leaves one entry per feature."""
    target = _store_for(spark, sf_dir)
    rows = fill_categories(_training(spark, sf_dir))
    for _ in range(2):
        uri = store.register_features(rows, "training_dataset", target)
    loaded = store.read_feature_table(spark, uri).select(F.count("*")).scalar()
    return store.feature_catalog(spark, target).select(
        "feature_group",
        "feature",
        "description",
        F.array_join("entity_keys", ",").alias("entity_keys"),
        "schema_version",
        loaded.alias("table_rows"),
    )


def _stored_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per session of a table that is stored by session: its buckets are counted where they lie."""
    target = _store_for(spark, sf_dir)
    store.create_database(spark, target)
    store.save_sessions(_training(spark, sf_dir), target.table_ref("sessions"))
    grouped, hot = store.load_sessions(spark, target.table_ref("sessions"))
    found = group_sizes(grouped)
    return found if hot is None else found.unionByName(group_sizes(hot))


def _split(train: bool) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        split = split_by_time(_training(spark, sf_dir))
        part = split.where("is_train" if train else "not is_train")
        return part.select("qid", "user_id", "product_id", "target_label", SESSION_START)

    return query


def _ndcg(k: int) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        per_session = session_ndcg(_scored(spark, sf_dir), (k,))
        return per_session.select("qid", "n_rows", "positives", F.round(f"ndcg_{k}", 6).alias(f"ndcg_{k}"))

    return query


def _summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    summary = evaluation_counts(session_ndcg(_scored(spark, sf_dir)))
    return summary.withColumn("mean_ndcg_5", F.round("mean_ndcg_5", 6))


def _ranker_train_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    fitted = _fitted(spark, sf_dir)
    best = fitted.curve[fitted.best_round - 1]
    return spark.createDataFrame(
        [(len(fitted.curve), fitted.best_round, best["validation_ndcg_5"], best["validation_ndcg_10"])],
        "rounds int, best_round int, val_ndcg_5 double, val_ndcg_10 double",
    )


def _ranker_learning_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    curve = _fitted(spark, sf_dir).curve
    return spark.createDataFrame([tuple(row.values()) for row in curve], list(curve[0]))


def _ranker_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _training(spark, sf_dir)
    return _fitted(spark, sf_dir).ranker.score(rows).select("qid", "user_id", "product_id", "score")


def _end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = RunConfig(store=_store_for(spark, sf_dir), feature_group="end_to_end")
    return run_end_to_end(fixture_tables(spark, sf_dir), config, AS_OF, on_fail="report").drop("run_id", "model_path")


def _lambdas(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _scored(spark, sf_dir).select("qid", "user_id", "product_id", "target_label", "score")
    found = session_lambdas(rows, 10)
    return found.select("qid", "user_id", "product_id", F.round("pull", 6).alias("pull"), F.round("hessian", 6).alias("hessian"))


def _early_stop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A curve that the tables give: events per date, a round a day from the first one on."""
    days = fixture_tables(spark, sf_dir).events.where("created_at is not null").groupBy(F.to_date("created_at").alias("day"))
    curve = days.agg(F.count("*").cast("double").alias("value"))
    first = curve.select(F.min("day")).scalar()
    return early_stop(curve.withColumn("round", F.datediff("day", first) + 1), "value", PATIENCE)


def _ranker_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: all rows scored, none NULL, better in training than a constant, the same after reloading."""
    rows, fitted = _training(spark, sf_dir), _fitted(spark, sf_dir)
    scored = materialize(fitted.ranker.score(rows).select("qid", "user_id", "product_id", "score"), "ranker-check")
    path = new_path(spark, "ranker-check")
    fitted.ranker.save(path)
    again = Ranker.load(spark, path).score(rows).select("qid", "user_id", "product_id", "score")
    train = split_by_time(rows).where("is_train").withColumn("score", F.lit(0.0))
    constant = evaluation_counts(session_ndcg(train, (10,)), (10,)).first()["mean_ndcg_10"]
    better = fitted.curve[fitted.best_round - 1]["train_ndcg_10"] > constant
    return scored.agg(
        F.count("*").alias("rows_scored"), F.countDistinct("qid").alias("sessions"), F.count_if(F.col("score").isNull()).alias("null_scores")
    ).withColumns({"better_than_constant": F.lit(better), "same_after_reload": F.lit(again.exceptAll(scored).isEmpty())})


def _end_to_end_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row: what a whole run stored, and whether a model was kept exactly if approved."""
    target = replace(_store_for(spark, sf_dir), database=_store_for(spark, sf_dir).database + "_run")
    config = RunConfig(store=target, feature_group="end_to_end")
    run = run_end_to_end(fixture_tables(spark, sf_dir), config, AS_OF, on_fail="report").first()
    own = spark.table(target.table_ref("run_metrics")).where(F.col("run_id") == run["run_id"]).count()
    catalog = store.feature_catalog(spark, target).count()
    kept = bool(run["model_path"]) == (run["decision"] == "approve")
    return spark.table(target.table_ref("end_to_end")).agg(F.count("*").alias("stored_rows")).withColumns(
        {
            "metric_rows": F.lit(own).cast("bigint"),
            "catalog_rows": F.lit(catalog).cast("bigint"),
            "gate_passed": F.lit(run["gate_passed"]),
            "model_kept_iff_approved": F.lit(kept),
        }
    )


# Fixed values that the SQL counterparts state too: bounds of bins, and two trees over all kinds of features.
PLANTED_BOUNDS = [[18.0, 30.0, 45.0, 60.0, 75.0], [925.0, 950.0, 1000.0, 1100.0], [555.0, 600.0, 660.0], [370.0, 400.0]]
PLANTED_TREES = (
    (1, 0, "retail_price", None, 950.0, 1, 2, 0.0),
    (1, 1, "user_age", None, 45.0, 3, 4, 0.0),
    (1, 2, "brand_rate", None, 0.05, 5, 6, 0.0),
    (1, 3, None, None, None, 3, 3, 0.5),
    (1, 4, None, None, None, 4, 4, -0.25),
    (1, 5, None, None, None, 5, 5, 0.125),
    (1, 6, None, None, None, 6, 6, 1.0),
    (2, 0, "profit_margin", None, 400.0, 1, 2, 0.0),
    (2, 1, None, None, None, 1, 1, -1.5),
    (2, 2, "user_gender_rate", None, 0.0515, 3, 4, 0.0),
    (2, 3, None, None, None, 3, 3, 0.75),
    (2, 4, None, None, None, 4, 4, -2.0),
)


def _planted_trees() -> tuple[Tree, ...]:
    names = [part.split()[0] for part in TREE_TABLE.split(", ")]
    return read_trees([dict(zip(names, row, strict=True)) for row in PLANTED_TREES], FEATURES)


def _ranker_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sums one level of a tree is grown on: after two splits, for a logistic loss at score 0, in quarters."""
    rows = _training(spark, sf_dir)
    numbers = {f"_{c}": F.coalesce(F.col(c).cast("double"), F.lit(-1.0)) for c in NUMERIC}
    binned = with_bins(rows.withColumns(numbers), list(numbers), PLANTED_BOUNDS)
    tree = Tree((1, 0, 0), (1, 2, 9), (950.0, 45.0, 0.0), (1, 3, 2), (2, 4, 2), (0.0, 0.0, 0.0))
    tree = Tree(tree.feature + (0, 0), tree.bin + (9, 9), tree.bound + (0.0, 0.0), tree.left + (3, 4), tree.right + (3, 4), (0.0,) * 5)
    pulled = with_node(binned, tree, 2).select(
        "node", "bins", (F.col("target_label") * 4 - 2).cast("long").alias("pull"), F.lit(1).cast("long").alias("hessian")
    )
    return histogram(pulled)


def _ranker_planted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A given table of trees over every row, by the expression a fitted ranker scores with."""
    rows = _training(spark, sf_dir)
    known = assemble(rows, materialize(fit_rates(rows, "target_label"), "rates"))
    score = tree_score(_planted_trees(), 0.5, [F.col(f"_{c}") for c in FEATURES])
    return known.select("qid", "user_id", "product_id", score.alias("score"))


def _category_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = fit_rates(_training(spark, sf_dir), "target_label", folds=RankerParams().folds)
    return rates.withColumn("rate", F.round("rate", 9))


def _metrics_training(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_metrics(spark, _fitted(spark, sf_dir))


def _metrics_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation_metrics(decide(_summary(spark, sf_dir), 0.65))


_SAMPLE = ("session_id", "user_id", "current_session_category", "product_id", "label")


def queries() -> dict[str, Query]:
    return {
        "scan_order_items": lambda s, d: fixture_tables(s, d).order_items,
        "v01_missing_values": lambda s, d: checks.missing_values(_dirty(s, d).order_items),
        "v02_duplicates": lambda s, d: checks.duplicate_records(_dirty(s, d).order_items),
        "v03_negative_prices": lambda s, d: checks.negative_prices(_dirty(s, d).order_items),
        "v04_invalid_ages": lambda s, d: checks.invalid_ages(_dirty(s, d).users),
        "v05_broken_products": lambda s, d: checks.broken_relations(_dirty(s, d).order_items, _dirty(s, d).products, "product_id"),
        "v06_broken_users": lambda s, d: checks.broken_relations(_dirty(s, d).order_items, _dirty(s, d).users, "user_id"),
        "v07_future_orders": lambda s, d: checks.future_orders(_dirty(s, d).orders, AS_OF),
        "v08_empty_names": lambda s, d: checks.empty_names(_dirty(s, d).products),
        "v09_invalid_product_prices": lambda s, d: checks.invalid_product_prices(_dirty(s, d).products),
        "v10_orders_without_items": lambda s, d: checks.orders_without_items(_dirty(s, d).orders, _dirty(s, d).order_items),
        "v11_schema": lambda s, d: checks.schema_check(_dirty(s, d).order_items),
        "validated_order_items": lambda s, d: checks.validated_order_items(_dirty(s, d).order_items),
        "validation_stats": _stats,
        "validation_checks": lambda s, d: checks.validation_checks(_stats(s, d)),
        "validation_report": lambda s, d: gate.report_json(gate.validation_report(_stats(s, d))),
        "metrics_validation": lambda s, d: gate.validation_metrics(_stats(s, d)),
        "sink_validated_roundtrip": _sink_validated,
        "validation_report_open": _report_open,
        "quarantined_items": _quarantined_items,
        "quarantine_counts": _quarantine_counts,
        "training_set_validated": _training_validated,
        "session_context": _context,
        "session_start": lambda s, d: session_starts(_context(s, d)),
        "positive_samples": lambda s, d: positive_samples(_context(s, d)),
        "popularity_global": lambda s, d: popularity_global(fixture_tables(s, d).products, fixture_tables(s, d).order_items),
        "popularity_asof": _popularity_asof,
        "top_products_per_category": _top_products,
        "candidate_generation": lambda s, d: _candidates(s, d)[1].select(*_SAMPLE),
        "combined_candidates": lambda s, d: _combined(s, d).select(*_SAMPLE),
        "final_deduped": lambda s, d: final_deduped(_combined(s, d)).drop(SESSION_START),
        "feature_attachment": _feature_attachment,
        "training_set": lambda s, d: training_set(fixture_tables(s, d)),
        "feature_sorted": _sorted_features,
        "categorical_fill": lambda s, d: fill_categories(_training(s, d)),
        "categorical_codes": lambda s, d: fit_codes(_training(s, d)),
        "categorical_encode": lambda s, d: apply_codes(_training(s, d), fit_codes(_training(s, d))).select(
            "qid", "user_id", "product_id", "user_gender_code", "user_country_code", "brand_code"
        ),
        "feature_matrix": lambda s, d: feature_matrix(_training(s, d)),
        "metrics_features": lambda s, d: feature_metrics(_training(s, d), len(feature_columns(_training(s, d)))),
        "sink_features_roundtrip": _sink_features,
        "store_truncate": lambda s, d: _stored(s, d, "truncated", "WRITE_TRUNCATE", "WRITE_TRUNCATE"),
        "store_append": lambda s, d: _stored(s, d, "appended", "WRITE_TRUNCATE", "WRITE_APPEND"),
        "feature_table_read": _feature_table_read,
        "feature_catalog": _feature_catalog,
        "split_train": _split(train=True),
        "split_val": _split(train=False),
        "group_sizes": lambda s, d: group_sizes(_training(s, d)),
        "stored_group_sizes": _stored_group_sizes,
        "ndcg_at_5": _ndcg(5),
        "ndcg_at_10": _ndcg(10),
        "recommend_top_k": lambda s, d: top_k_by_score(_scored(s, d), 5).select(
            "qid", "user_id", "product_id", "score", "target_label", "rank"
        ),
        "eval_session_counts": lambda s, d: _summary(s, d).drop("mean_ndcg_5"),
        "eval_summary": _summary,
        "deploy_decision": lambda s, d: decide(_summary(s, d), 0.65).select("mean_ndcg_5", "threshold", "decision"),
        "ranker_train_summary": _ranker_train_summary,
        "ranker_learning_curve": _ranker_learning_curve,
        "ranker_scores": _ranker_scores,
        "end_to_end_run": _end_to_end,
        "ranker_lambdas": _lambdas,
        "ranker_histogram": _ranker_histogram,
        "ranker_planted_scores": _ranker_planted_scores,
        "category_rates": _category_rates,
        "metrics_training": _metrics_training,
        "metrics_evaluation": _metrics_evaluation,
        "early_stop": _early_stop,
        "ranker_check": _ranker_check,
        "end_to_end_check": _end_to_end_check,
        "interaction_scores": lambda s, d: tables_of.interaction_scores(_tables(s, d).events, _tables(s, d).products),
        "rolling_user_activity": lambda s, d: tables_of.rolling_user_activity(_tables(s, d).events),
        "user_features": lambda s, d: tables_of.user_features(_tables(s, d).users, _tables(s, d).events, _tables(s, d).order_items),
        "product_features": lambda s, d: tables_of.product_features(
            _tables(s, d).products, _tables(s, d).events, _tables(s, d).order_items
        ),
        "interaction_features": lambda s, d: tables_of.interaction_features(
            _tables(s, d).events, _tables(s, d).order_items, _tables(s, d).products
        ),
        "temporal_features": lambda s, d: tables_of.temporal_features(_tables(s, d).events),
        "user_item_matrix": lambda s, d: tables_of.user_item_matrix(
            _tables(s, d).events, _tables(s, d).order_items, _tables(s, d).products
        ),
    }
