"""NDCG, splits, codes and ordinals: hand cases and properties."""

import math
import random

import pytest
from pyspark.sql import functions as F

from rankwright.config import NDCG_THRESHOLD, RankerParams, choose_threshold
from rankwright.operators.encoding import apply_codes, fit_codes
from rankwright.operators.features import feature_columns, fill_categories
from rankwright.operators.ndcg import evaluation_counts, session_ndcg, top_k_by_score
from rankwright.operators.ordinals import with_ordinal
from rankwright.operators.split import group_sizes, split_by_time
from rankwright.plans.evaluation import evaluate


def scored(spark, rows):
    return spark.createDataFrame(rows, "qid long, target_label int, score double")


def plain_ndcg(rows, k):
    """Tie-averaged NDCG of (label, score) rows, straight from the definition."""
    mean = {}
    for _, score in rows:
        same = [label for label, other in rows if other == score]
        mean[score] = sum(same) / len(same)
    order = sorted(rows, key=lambda row: -row[1])[:k]
    dcg = sum(mean[score] / math.log2(2 + i) for i, (_, score) in enumerate(order))
    best = sorted((label for label, _ in rows), reverse=True)[:k]
    return dcg / sum(label / math.log2(2 + i) for i, label in enumerate(best))


@pytest.mark.parametrize(
    ("labels", "scores", "expected"),
    [([1, 0, 0], [7, 7, 7], 0.710310), ([0, 1, 1], [3, 2, 2], 0.693426), ([1, 0], [2, 1], 1.0)],
)
def test_ndcg_hand_cases(spark, labels, scores, expected):
    rows = [(1, label, float(score)) for label, score in zip(labels, scores)]
    assert round(session_ndcg(scored(spark, rows)).first()["ndcg_5"], 6) == expected


def test_ndcg_equals_the_definition_on_tied_sessions(spark):
    rng = random.Random(3)
    rows = [(q, int(rng.random() < 0.3), float(rng.randrange(6))) for q in range(40) for _ in range(rng.randrange(2, 30))]
    got = {r["qid"]: r for r in session_ndcg(scored(spark, rows), (1, 5, 10)).collect()}
    for q in range(40):
        own = [(label, score) for qid, label, score in rows if qid == q]
        for k in (1, 5, 10):
            want = plain_ndcg(own, k) if any(label for label, _ in own) else None
            assert got[q][f"ndcg_{k}"] == (pytest.approx(want) if want is not None else None)


def test_sessions_that_do_not_count(spark):
    rows = [(1, 1, 0.5), (2, 0, 0.5), (2, 0, 0.1), (3, 1, 0.9), (3, 0, 0.1)]
    summary = evaluation_counts(session_ndcg(scored(spark, rows))).first()
    assert tuple(summary) == (3, 2, 1, 1.0)


def test_no_eligible_session_rejects(spark):
    row = evaluate(scored(spark, [(1, 1, 0.5), (2, 0, 0.5)])).first()
    assert (row["mean_ndcg_5"], row["decision"]) == (0.0, "reject")


def test_threshold_and_overrides():
    assert choose_threshold(0.0) == NDCG_THRESHOLD and choose_threshold(0.3) == 0.3
    params = RankerParams()
    assert params.override(n_trees=7, max_depth=0) == RankerParams(n_trees=7)
    assert params == RankerParams()


def test_a_threshold_met_exactly_approves(spark):
    assert evaluate(scored(spark, [(1, 1, 2.0), (1, 0, 1.0)]), 1.0).first()["decision"] == "approve"


def test_hot_session_is_limited_before_the_shuffle(spark):
    """The rank filter must run on the map side, or one session fills one task."""
    plan = session_ndcg(scored(spark, [(1, 1, 2.0)]))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize(("n", "expected"), [(1, 0), (4, 3), (5, 4), (10, 8), (23, 18)])
def test_split_sizes(spark, n, expected):
    rows = [(q, q * 7 % n, i) for q in range(n) for i in range(2)]
    df = spark.createDataFrame(rows, "qid long, day int, product_id long").select(
        "qid", "product_id", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(day % 3)").alias("session_start_time")
    )
    parts = {bool(r["is_train"]): r["n"] for r in split_by_time(df).groupBy("is_train").agg(F.countDistinct("qid").alias("n")).collect()}
    assert parts.get(True, 0) == expected and sum(parts.values()) == n


def test_split_is_in_time_and_by_session(training):
    split = split_by_time(training).persist()
    assert split.groupBy("qid").agg(F.countDistinct("is_train").alias("n")).where("n > 1").count() == 0
    late = split.where("is_train").agg(F.max("session_start_time")).first()[0]
    early = split.where("not is_train").agg(F.min("session_start_time")).first()[0]
    assert late <= early
    assert split.count() == training.count()
    split.unpersist()


def test_group_sizes_add_up(training):
    assert group_sizes(training).agg(F.sum("group_size")).first()[0] == training.count()


def test_ordinals_are_dense_and_sorted_with_a_hot_key(spark):
    rng = random.Random(1)
    rows = [(5 if rng.random() < 0.5 else rng.randrange(9), i) for i in range(5000)]
    df = with_ordinal(spark.createDataFrame(rows, "a int, b int").repartition(5), ["a", "b"], "n")
    assert [(r.a, r.b) for r in df.orderBy("n").collect()] == sorted(rows)
    assert sorted(r.n for r in df.collect()) == list(range(5000))


def test_codes_are_sorted_and_unseen_values_share_one(spark):
    seen = spark.createDataFrame([("b", "X"), (None, "X"), ("a", "Y")], "user_gender string, brand string")
    columns = ("user_gender", "brand")
    codes = fit_codes(seen, columns)
    assert sorted(map(tuple, codes.collect())) == [
        ("brand", "X", 0), ("brand", "Y", 1), ("user_gender", "Unknown", 0), ("user_gender", "a", 1), ("user_gender", "b", 2),
    ]
    fresh = spark.createDataFrame([("zz", "Y"), (None, "Q")], "user_gender string, brand string")
    coded = apply_codes(fresh, codes, columns).select("user_gender_code", "brand_code")
    assert sorted(map(tuple, coded.collect())) == [(0, 2), (3, 1)]


def test_feature_columns_are_seven(training):
    assert feature_columns(training) == [
        "user_age", "user_gender", "user_country", "retail_price", "cost", "profit_margin", "brand",
    ]
    assert fill_categories(training).where("user_gender is null").count() == 0
    assert training.where("user_gender is null").count() == 1924


def test_top_k_breaks_ties_by_product(spark):
    rows = [(1, 9, 1, 0.5), (1, 3, 1, 0.5), (1, 4, 1, 0.1), (2, 1, 1, 0.3)]
    df = spark.createDataFrame(rows, "qid long, product_id long, user_id long, score double")
    assert sorted((r.qid, r.product_id, r["rank"]) for r in top_k_by_score(df, 2).collect()) == [(1, 3, 1), (1, 9, 2), (2, 1, 1)]
