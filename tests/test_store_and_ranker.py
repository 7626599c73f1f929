"""Tables, catalog, metrics, the ranker and the whole run."""

import math
import random
from dataclasses import replace

import pytest
from conftest import SMALL
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rankwright.config import RankerParams, RunConfig, StoreConfig
from rankwright.operators.encoding import apply_rates, fit_rates, fold_of
from rankwright.operators.features import fill_categories
from rankwright.operators.ndcg import discount_sum, evaluation_counts, session_ndcg
from rankwright.operators.ranker import Ranker, compare_with_leaders, fit_ranker, gather_lambdas
from rankwright.operators.split import split_by_time
from rankwright.plans.end_to_end import held_out, run_end_to_end
from rankwright.plans.gate import ValidationError
from rankwright.sources import store, tables
from rankwright.sources.fixtures import fixture_tables
from rankwright.sources.scratch import new_path, shared_root


@pytest.fixture(scope="module")
def target(spark):
    config = StoreConfig(database="test_store")
    store.create_database(spark, config)
    return config


def test_write_dispositions(spark, target):
    ref, rows = target.table_ref("dispositions"), spark.range(3)
    for disposition, n in (("WRITE_EMPTY", 3), ("WRITE_APPEND", 6), ("WRITE_TRUNCATE", 3)):
        store.save_table(rows, ref, disposition)
        assert spark.table(ref).count() == n
    with pytest.raises(AnalysisException):
        store.save_table(rows, ref, "WRITE_EMPTY")
    assert tables.table_exists(spark, ref) and not tables.table_exists(spark, target.table_ref("absent"))


def test_explicit_schema_is_enforced(spark, target):
    from pyspark.sql.types import StructType

    with pytest.raises(AnalysisException):
        store.save_table(spark.range(1), target.table_ref("typed"), schema=StructType.fromDDL("other long not null"))
    store.save_table(spark.range(1), target.table_ref("typed"), schema=StructType.fromDDL("id decimal(30,0)"))
    assert spark.table(target.table_ref("typed")).dtypes == [("id", "decimal(30,0)")]


def test_durable_output_stays_out_of_the_scratch_folder(spark, target, tmp_path):
    root = store.strip_scheme(shared_root(spark))
    assert root not in spark.catalog.getDatabase(target.database).locationUri
    assert root not in store.model_path(spark, "m", "r", target)
    elsewhere = replace(target, database="elsewhere", location=f"{tmp_path}/db", model_root=f"{tmp_path}/models")
    store.create_database(spark, elsewhere)
    assert f"{tmp_path}/db" in spark.catalog.getDatabase("elsewhere").locationUri
    assert store.model_path(spark, "m", "r", elsewhere) == f"{tmp_path}/models/m/r"
    for wrong in (replace(target, database="wrong", location=f"{root}/db"), replace(target, model_root=f"{root}/models")):
        with pytest.raises(ValueError, match="scratch"):
            store.create_database(spark, wrong)
            store.model_path(spark, "m", "r", wrong)


def test_categories_of_any_size_are_treated_alike(spark):
    rows = [(f"b{i % 1500}", f"c{i % 500}", "x", int(i % 1500 < 300)) for i in range(6000)]
    df = spark.createDataFrame(rows, "brand string, user_country string, user_gender string, target_label int")
    rates = fit_rates(df, "target_label", prior=2.0)
    known = {(r.column, r.value): r.rate for r in rates.collect()}
    assert len(known) == 1500 + 500 + 1 + 3
    assert known["brand", "b7"] == pytest.approx((4 + 2 * 0.2) / 6) and known["brand", "b900"] == pytest.approx(0.4 / 6)
    assert known["user_country", None] == pytest.approx(0.2)
    seen = apply_rates(df.limit(1).withColumn("brand", F.lit("new")), rates).first()
    assert seen.brand_rate == pytest.approx(0.2)


def test_a_part_without_positives_is_a_clear_error(planted):
    with pytest.raises(ValueError, match="validation"):
        fit_ranker(planted.where("is_train"), RankerParams(n_trees=1))


def test_options_are_checked(spark):
    with pytest.raises(ValueError, match="on_fail"):
        run_end_to_end(fixture_tables(spark, SMALL), RunConfig(), on_fail="ignore")
    with pytest.raises(ValueError, match="tree"):
        run_end_to_end(fixture_tables(spark, SMALL), RunConfig(ranker=RankerParams(n_trees=0)))


def test_uris_and_sql(spark):
    assert store.strip_scheme(store.table_uri("db.t_v1")) == "db.t_v1" == store.strip_scheme("db.t_v1")
    assert store.parent_uri("s3://bucket/run/model.bin") == "s3://bucket/run"
    assert tables.run_sql(spark, "SELECT :n + 1 AS x", {"n": 4}).first().x == 5
    tables.run_ddl(spark, "CREATE DATABASE IF NOT EXISTS ddl_made")
    assert spark.catalog.databaseExists("ddl_made")


def test_tables_by_name(spark, tmp_path):
    for name in tables.TABLE_NAMES[:5]:
        spark.range(2).write.parquet(f"{tmp_path}/{name}")
    assert tables.load_tables(spark, str(tmp_path)).events.count() == 2
    with pytest.raises(KeyError):
        tables.scan(spark, "nothing")


def test_catalog_is_idempotent(spark, target, training):
    for _ in range(2):
        uri = store.register_features(training, "demo", target)
    entries = store.feature_catalog(spark, target).where("feature_group = 'demo'")
    assert entries.count() == 8 == entries.select("feature").distinct().count()
    assert store.read_feature_table(spark, uri, ("session_start_time", "qid")).count() == training.count()


def test_features_by_day_round_trip(spark, training):
    path = new_path(spark, "by-day")
    store.save_by_day(training, path)
    back = spark.read.parquet(path)
    assert back.where("session_day <> to_date(session_start_time)").isEmpty()
    assert back.drop("session_day").exceptAll(training).isEmpty() and back.count() == training.count()


@pytest.fixture(scope="module")
def planted(training):
    """Training rows whose label depends on user and product features."""
    strength = F.pmod(F.col("retail_price"), F.lit(100.0)) + F.when(F.col("user_gender") == "BUILDING", 40).otherwise(0)
    order = F.row_number().over(__import__("pyspark").sql.Window.partitionBy("qid").orderBy(F.desc(strength), "product_id"))
    rows = fill_categories(training).withColumn("target_label", (order <= 2).cast("int"))
    from rankwright.sources.scratch import materialize

    return split_by_time(materialize(rows, "planted"))


@pytest.fixture(scope="module")
def fitted(planted):
    return fit_ranker(planted, RankerParams(n_trees=6, patience=6, learning_rate=0.5))


def naive_lambdas(rows, k):
    """Pull and hessian per product over all pairs of one session, by definition."""
    order = sorted(rows, key=lambda row: (-row[2], row[0]))
    disc = {row[0]: 1 / math.log2(2 + i) if i < k else 0.0 for i, row in enumerate(order)}
    ideal = sum(1 / math.log2(2 + i) for i in range(min(k, sum(label for _, label, _ in rows))))
    out = {product: [0.0, 0.0] for product, _, _ in rows}
    for high, label, s_high in rows:
        for low, other, s_low in rows:
            if label > other:
                rho = 1 / (1 + math.exp(s_high - s_low))
                weight = abs(disc[high] - disc[low]) / ideal
                for product, sign in ((high, 1), (low, -1)):
                    out[product][0] += sign * rho * weight
                    out[product][1] += rho * (1 - rho) * weight
    return out


@pytest.mark.parametrize("salts", [1, 3])
def test_lambdas_equal_the_sum_over_all_pairs(spark, salts):
    rng = random.Random(11)
    sessions = {q: [(p, int(rng.random() < 0.3), rng.choice([0.0, 0.5, rng.random()])) for p in range(n)] for q, n in enumerate((4, 9, 30))}
    sessions[0][0] = (0, 1, 0.2)
    rows = [(q, 1, p, p % salts, label, score) for q, own in sessions.items() for p, label, score in own]
    scored = spark.createDataFrame(rows, "qid long, user_id long, product_id long, salt long, target_label int, score double")
    hits = scored.groupBy("qid").agg(F.sum("target_label").alias("hits"))
    parts = scored.select("qid", "salt").distinct().join(hits, "qid").select("qid", "salt", discount_sum(3, F.col("hits")).alias("idcg"))
    got = gather_lambdas(compare_with_leaders(scored, parts, 3), parts).collect()
    assert len(got) == len(rows)
    want = {q: naive_lambdas(own, 3) for q, own in sessions.items()}
    for r in got:
        assert [r.pull, r.hessian] == pytest.approx(want[r.qid][r.product_id], abs=1e-9)


def mean_ndcg(scored):
    return evaluation_counts(session_ndcg(scored)).first()["mean_ndcg_5"]


def test_ranker_learns_a_planted_signal(planted, fitted):
    curve = [row["train_ndcg_5"] for row in fitted.curve]
    assert curve[-1] > curve[0]
    rows = held_out(planted, "held_out")
    constant = mean_ndcg(rows.withColumn("score", F.lit(0.0)))
    learned = mean_ndcg(fitted.ranker.score(rows))
    assert learned > constant + 0.1
    assert learned == pytest.approx(fitted.curve[fitted.best_round - 1]["validation_ndcg_5"])


def test_saved_ranker_scores_the_same(spark, planted, fitted):
    path = new_path(spark, "model")
    fitted.ranker.save(path)
    rows = held_out(planted, "held_out")
    keys = ["qid", "user_id", "product_id", "score"]
    again = Ranker.load(spark, path).score(rows).select(keys)
    assert fitted.ranker.score(rows).select(keys).exceptAll(again).isEmpty()


def test_salting_hot_sessions_changes_nothing(planted, monkeypatch):
    from rankwright.operators import ranker

    params = RankerParams(n_trees=2)
    whole = fit_ranker(planted, params)
    monkeypatch.setattr(ranker, "ROWS_PER_SALT", 5)
    split = fit_ranker(planted, params)
    for left, right in zip(whole.curve, split.curve):
        assert left == pytest.approx(right, abs=1e-6)


def test_a_round_is_one_job_per_level_and_moves_no_rows(spark, planted):
    context, jobs = spark.sparkContext, {}
    for n in (3, 7):
        context.setJobGroup(f"rounds-{n}", "")
        fit_ranker(planted, RankerParams(n_trees=n, patience=n, max_depth=4))
        jobs[n] = len(context.statusTracker().getJobIdsForGroup(f"rounds-{n}"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[7] - jobs[3] <= 4 * 4


def test_blocks_sum_as_rows_do(spark):
    """A tree's sums over blocks and over rows are equal, validation rows left out; so are mean NDCGs."""
    from rankwright.operators import blocks
    from rankwright.operators.histogram import Tree, histogram, with_node
    from rankwright.operators.lambdas import PAIR_UNIT

    rng = random.Random(5)
    rows = [(q, q, p, 0, q % 4 > 0, int(rng.random() < 0.3), [rng.randrange(256), rng.randrange(3)], rng.choice([0.0, 0.5, 1.0])) for q in range(60) for p in range(rng.randint(1, 30))]
    schema = "qid long, user_id long, product_id long, salt long, is_train boolean, target_label int, bins array<int>, score double"
    frame = spark.createDataFrame(rows, schema)
    valued = blocks.with_values(blocks.pack(frame.repartition(3, "qid")), (5, 10)).persist()
    tree = Tree((0, 1, 0), (100, 1, 999), (0.0, 0.0, 0.0), (1, 3, 2), (2, 4, 2), (0.0, 0.0, 0.0))
    tree = Tree(tree.feature + (0, 0), tree.bin + (999, 999), tree.bound + (0.0, 0.0), tree.left + (3, 4), tree.right + (3, 4), (0.0,) * 5)
    table = blocks.tree_sums(valued, tree, 2, [2, 4], 256, 2).toArrow()
    got = {(r["node"], r["feature"], r["bin"]): (r["pull"], r["hessian"]) for r in table.to_pylist() if r["node"] >= 0}
    parts = frame.where("is_train").groupBy("qid").agg(F.sum("target_label").alias("hits")).where("hits > 0")
    parts = parts.select("qid", F.lit(0).cast("long").alias("salt"), discount_sum(10, F.col("hits")).alias("idcg"))
    pulled = gather_lambdas(compare_with_leaders(frame.where("is_train"), parts, 10), parts)
    pulled = pulled.withColumns({c: F.rint(F.col(c) * float(1 << 26)).cast("long") for c in ("pull", "hessian")})
    want = {tuple(r)[:3]: tuple(r)[3:] for r in histogram(with_node(pulled, tree, 2), F.col("node").isin(2, 4)).collect()}
    want = {key: sums for key, sums in want.items() if any(sums)}
    assert got.keys() == want.keys()
    assert all(abs(a - b) <= 1 for key in want for a, b in zip(got[key], want[key], strict=True))
    mean, plain = blocks.ndcg_means(table, PAIR_UNIT), session_ndcg(frame, (5, 10), by=("is_train", "qid"))
    for r in plain.groupBy("is_train").agg(F.avg("ndcg_5"), F.avg("ndcg_10")).collect():
        assert [mean(r[0], 0), mean(r[0], 1)] == pytest.approx(list(r)[1:], abs=1e-9)
    valued.unpersist()


def test_blocks_hold_only_what_rounds_need(spark):
    """A block's rows lie by session, product and user; the ids of products and users do not go from round to round."""
    import numpy as np

    from rankwright.operators import blocks

    rows = [(q, u, p, 0, True, (q + u + p) % 2, [u, p], float(u * 10 + p)) for q in (3, 1) for p in (2, 0, 1) for u in (5, 4)]
    schema = "qid long, user_id long, product_id long, salt long, is_train boolean, target_label int, bins array<int>, score double"
    packed = blocks.pack(spark.createDataFrame(rows, schema).coalesce(1))
    assert packed.columns == ["qid", "is_train", "target_label", "bins", "score"]
    [block] = packed.collect()
    lying = sorted(rows, key=lambda r: (r[0], r[2], r[1]))
    assert np.frombuffer(block["qid"], "i8").tolist() == [r[0] for r in lying]
    assert np.frombuffer(block["score"], "f8").tolist() == [r[7] for r in lying]
    assert np.frombuffer(block["bins"], "u1").reshape(2, -1).T.tolist() == [r[6] for r in lying]


def test_early_stop_keeps_the_best_round(planted):
    noise = planted.withColumn("target_label", (F.pmod(F.xxhash64("qid", "product_id"), F.lit(5)) == 0).cast("int"))
    run = fit_ranker(noise, RankerParams(n_trees=30, patience=1))
    assert len(run.curve) == min(30, run.best_round + 1) and len(run.ranker.trees) == run.best_round


def test_a_broken_fit_goes_on_as_if_unbroken(spark, planted, tmp_path, monkeypatch):
    from rankwright.operators import ranker

    monkeypatch.setattr(ranker, "ROUNDS_PER_WRITE", 4)
    params, keys = RankerParams(n_trees=15, patience=15), ["qid", "user_id", "product_id", "score"]
    whole = fit_ranker(planted, params, state=f"{tmp_path}/whole")
    grow, calls = ranker.grow_tree, []

    def breaking(*args):
        calls.append(1)
        if len(calls) == 14:  # rounds 1 to 12 are written, 13 is not
            raise RuntimeError("driver lost")
        return grow(*args)

    monkeypatch.setattr(ranker, "grow_tree", breaking)
    with pytest.raises(RuntimeError, match="driver lost"):
        fit_ranker(planted, params, state=f"{tmp_path}/broken")
    resumed = fit_ranker(planted, params, state=f"{tmp_path}/broken")
    assert len(calls) == 14 + 3 and resumed.curve == whole.curve and resumed.best_round == whole.best_round
    assert resumed.ranker.table().collect() == whole.ranker.table().collect()
    scores = [run.ranker.score(planted).select(keys) for run in (whole, resumed)]
    assert scores[0].exceptAll(scores[1]).isEmpty()
    again = fit_ranker(planted, params, state=f"{tmp_path}/broken")  # nothing is left to do
    assert again.curve == whole.curve and len(calls) == 17
    with pytest.raises(ValueError, match="settings"):
        fit_ranker(planted, replace(params, l2=3.0), state=f"{tmp_path}/broken")
    with pytest.raises(ValueError, match="rows"):
        fit_ranker(planted.where("qid % 3 > 0"), params, state=f"{tmp_path}/broken")


def test_rates_leave_a_rows_own_label_out(spark, planted):
    noise = planted.withColumn("target_label", (F.pmod(F.xxhash64("qid", "product_id", F.lit(3)), F.lit(6)) == 0).cast("int"))
    noise = noise.withColumn("brand", F.concat(F.lit("b"), F.pmod(F.xxhash64("qid", "product_id"), F.lit(4000))))
    honest = fit_ranker(noise, RankerParams(n_trees=6, patience=6)).curve[-1]
    leaking = fit_ranker(noise, RankerParams(n_trees=6, patience=6, folds=0)).curve[-1]
    constant = session_ndcg(noise.withColumn("score", F.lit(0.0)), (10,), by=("is_train", "qid"))
    base = {r.is_train: r.mean for r in constant.groupBy("is_train").agg(F.avg("ndcg_10").alias("mean")).collect()}
    assert abs(honest["validation_ndcg_10"] - base[False]) < 0.08
    assert honest["train_ndcg_10"] - base[True] < 0.5 * (leaking["train_ndcg_10"] - base[True])
    leaking = fit_rates(noise.where("is_train"), "target_label", prior=0.0)
    told = apply_rates(noise.where("is_train"), leaking)
    left_out = apply_rates(noise.where("is_train"), fit_rates(noise.where("is_train"), "target_label", folds=5), fold=fold_of("qid", 5))
    assert told.agg(F.corr("brand_rate", "target_label")).first()[0] > 0.5
    assert abs(left_out.agg(F.corr("brand_rate", "target_label")).first()[0]) < 0.2


def test_whole_run_publishes_only_when_approved(spark):
    config = RunConfig(ranker=RankerParams(n_trees=1), store=StoreConfig(database="run_store"), ndcg_threshold=0.0001)
    source = fixture_tables(spark, SMALL)
    good = run_end_to_end(source, config, "2001-01-01", on_fail="report").first()
    assert good["decision"] == "approve" and not good["gate_passed"]
    models = spark.table(config.store.table_ref("models"))
    assert [r.path for r in models.collect()] == [good["model_path"]]
    assert len(Ranker.load(spark, good["model_path"]).trees) == 1
    bad = run_end_to_end(source, replace(config, ndcg_threshold=0.99), "2001-01-01", on_fail="report", scope="all").first()
    assert bad["decision"] == "reject" and bad["model_path"] == ""
    assert spark.table(config.store.table_ref("models")).count() == 1
    metrics = spark.table(config.store.table_ref("run_metrics"))
    assert metrics.where(F.col("run_id") == good["run_id"]).count() == 11
    with pytest.raises(ValidationError):
        run_end_to_end(source, config, "2001-01-01")


def test_some_million_rows_are_one_task_per_core(spark):
    """A round's tasks are short; more of them than cores cost more to start than they save."""
    from rankwright.operators.ranker import _task_count

    cores = spark.sparkContext.defaultParallelism
    assert _task_count(spark, cores * 570_000) == cores
    assert _task_count(spark, cores * 5_700_000) > 5 * cores


def test_sessions_are_ranked_by_score_with_ties_in_place():
    """One stable sort by session and score gives the order of two."""
    import numpy as np

    from rankwright.operators.lambdas import session_values

    r = np.random.default_rng(3)
    qid = np.repeat(np.arange(300), r.integers(1, 40, 300))
    block = {"qid": qid, "is_train": qid % 4 > 0, "target_label": (r.random(len(qid)) < 0.2).astype(np.int32), "score": r.integers(-3, 4, len(qid)) / 4}
    found = session_values(block, (5, 10))
    order = np.lexsort((np.arange(len(qid)), -block["score"], qid))
    sorted_block = {c: values[order] for c, values in block.items()}
    again = session_values(sorted_block, (5, 10))
    assert (again["ndcg"] == found["ndcg"]).all()
    assert all((again[c] == found[c][order]).all() for c in ("pull", "hessian"))


def test_many_rows_are_written_by_day_in_tasks_of_so_many_rows(spark, training, monkeypatch):
    monkeypatch.setattr(store, "ROWS_PER_TASK", 200)
    path = new_path(spark, "by-day")
    store.save_by_day(training, path)
    back = spark.read.parquet(path)
    largest = back.groupBy(F.input_file_name().alias("file")).count().agg(F.max("count")).first()[0]
    assert largest < 800
    assert back.drop("session_day").exceptAll(training).isEmpty() and back.count() == training.count()


def test_lambdas_of_whole_sessions_equal_those_of_joins(spark, monkeypatch):
    """Ties, rows that come twice, sessions without a positive or an id: both ways give the same rows."""
    from rankwright.operators import ranker

    rows = spark.range(900).selectExpr(
        "if(id % 31 = 0, null, id % 40) as qid", "id % 3 as user_id", "id % 17 as product_id",
        "int(id % 40 > 3 and id % 7 = 0) as target_label", "double(id % 5) as score",
    )
    rows = rows.unionByName(rows.where("product_id < 3").withColumn("score", F.col("score") + 1))
    found = ranker.session_lambdas(rows, 10)
    assert "MapInArrow" in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(ranker, "ROWS_PER_SALT", 5)
    joined = ranker.session_lambdas(rows, 10)
    assert found.columns == joined.columns and found.count() == joined.count() > 100

    def rounded(frame):
        return frame.withColumns({c: F.round(c, 6) + 0.0 for c in ("pull", "hessian")})

    assert rounded(found).exceptAll(rounded(joined)).isEmpty()
    # A missing score has no place in an array: such rows go the other way.
    missing = rows.withColumn("score", F.when(F.col("product_id") > 2, F.col("score")))
    monkeypatch.setattr(ranker, "ROWS_PER_SALT", 1 << 20)
    assert "MapInArrow" not in ranker.session_lambdas(missing, 10)._jdf.queryExecution().executedPlan().toString()


def test_sums_are_exact_whatever_their_size():
    import numpy as np

    from rankwright.operators.blocks import _added, _exactly

    index = np.array([0, 1, 0, 1])
    for top in (5, 1 << 60):
        values = np.array([top, 1, 1, -3])
        held = _exactly(values)
        assert held.dtype == (np.float64 if top == 5 else np.int64)
        assert _added(index, held, 2).tolist() == [top + 1, -2]


def test_a_task_packs_blocks_of_some_rows_and_whole_sessions(spark, monkeypatch):
    """What a worker holds does not grow with the rows of its task; validation has blocks of its own."""
    import numpy as np

    from rankwright.operators import blocks

    monkeypatch.setattr(blocks, "BLOCK_ROWS", 50)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    rows = spark.range(1500).selectExpr(
        "(id * 7919 % 1500) % 90 as qid", "id % 4 as user_id", "id as product_id", "0L as salt", "id % 1500 % 90 % 5 > 0 as is_train",
        "int(id % 11 = 0) as target_label", "array(int(id % 250), int(id % 3)) as bins", "double(id % 13) as score",
    ).withColumn("is_train", F.expr("qid % 5 > 0"))
    try:
        packed = blocks.pack(rows.coalesce(1)).collect()
        valued = blocks.with_values(blocks.pack(rows.coalesce(1)), (5, 10)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    qids = [np.frombuffer(block["qid"], "i8") for block in packed]
    assert len(packed) > 10 and max(len(own) for own in qids) <= 50 + 20
    assert sorted(q for own in qids for q in set(own.tolist())) == list(range(90))  # no session lies in two blocks
    assert sum(len(own) for own in qids) == 1500
    assert all((own % 5 > 0).all() == block["is_train"] == (own % 5 > 0).any() for own, block in zip(qids, packed))
    # The root's sums come once a task, and validation has no gradients.
    assert [len(block["root"]) > 0 for block in valued] == [False] * (len(valued) - 1) + [True]
    assert all((len(block["pull"]) > 0) == block["is_train"] for block in valued)


@pytest.mark.parametrize("depth", [1, 3, 5, 7])
def test_codes_of_several_features_walk_and_sum_as_bins_do(depth):
    """Columns that go together share a code; others keep their own; a tree may have more leaves than a word has bits."""
    import numpy as np

    from rankwright.operators import blocks

    r = np.random.default_rng(depth)
    product, n = r.integers(0, 90, 6000), 6000
    bins = np.stack([product, r.integers(0, 256, n), product // 3, r.integers(0, 256, n), r.integers(0, 4, n)]).astype(np.uint8)
    block = {"pull": r.integers(-(1 << 30), 1 << 30, n), "hessian": r.integers(0, 1 << 20, n)}
    block["codes"], block["meaning"] = blocks._coded(bins)
    assert len(block["codes"]) < len(bins)
    inner = 2**depth - 1
    split = [(int(f), int(b)) for f, b in zip(r.integers(0, 5, inner), r.integers(0, 100, inner))]
    tree = {
        "feature": np.array([f for f, _ in split] + [0] * (inner + 1)), "bin": np.array([b for _, b in split] + [999] * (inner + 1)),
        "left": np.array([2 * i + 1 for i in range(inner)] + list(range(inner, 2 * inner + 1))),
        "right": np.array([2 * i + 2 for i in range(inner)] + list(range(inner, 2 * inner + 1))),
    }
    node = np.zeros(n, np.int64)
    for _ in range(depth):
        node = np.where(bins[tree["feature"][node], np.arange(n)] <= tree["bin"][node], tree["left"][node], tree["right"][node])
    assert (blocks._walker(tree, depth, np.arange(2 * inner + 1))(block) == node).all()
    slot = np.where(node % 2 == 0, node % 3, -1)
    found = blocks._node_sums(block, slot, 3, 256)
    want = np.zeros((3, 5, 256, 2), np.int64)
    for feature in range(5):
        for i, c in enumerate(("pull", "hessian")):
            np.add.at(want, (slot[slot >= 0], feature, bins[feature][slot >= 0], i), block[c][slot >= 0])
    assert (found == want).all()


def test_pairs_give_what_leaders_give(monkeypatch):
    """Pulls from pairs, cut into parts of any size, in short and in long sessions, with and without ties."""
    import numpy as np

    from rankwright.operators import lambdas

    r = np.random.default_rng(7)
    for most, pairs, exact in ((256, 1 << 16, 1 << 13), (8, 16, 1)):
        monkeypatch.setattr(lambdas, "_MATRIX", most)
        monkeypatch.setattr(lambdas, "_PAIRS", pairs)
        monkeypatch.setattr(lambdas, "_EXACT_PAIRS", exact)
        length = np.concatenate([[400, 1, 700], r.integers(1, 40, 60)])
        first = np.cumsum(length) - length
        for share, tied in ((0.0, True), (0.1, True), (0.1, False), (1.0, True)):
            score = r.integers(-3, 4, length.sum()) / 4 if tied else r.normal(size=length.sum())
            order = lambdas.by_score(first, length, score)
            assert (order == np.lexsort((np.arange(len(score)), -score, np.repeat(first, length)))).all()
            score, label = score[order], (r.random(len(score)) < share).astype(np.int64)
            hits = np.where(np.arange(len(first)) % 4 > 0, np.add.reduceat(label, first), 0)
            for a, b in zip(lambdas.pair_pulls(first, length, score, label, hits, 10), lambdas.pulls(first, length, score, label, hits, 10)):
                assert (a == b).all()


def test_rates_are_counted_from_rows_alike(spark):
    """A digest is taken for every row, not for every column of it, before rows become pairs."""
    rows = spark.createDataFrame([(1, "a", "x", None, 1), (2, "a", "y", "b", 0), (1, "a", "x", None, 0)], "qid long, user_gender string, user_country string, brand string, target_label int")
    rates = fit_rates(rows, "target_label", prior=0.0)
    assert {(r["column"], r["value"]): r["rate"] for r in rates.collect() if r["value"]} == {
        ("user_gender", "a"): pytest.approx(1 / 3), ("user_country", "x"): 0.5, ("user_country", "y"): 0.0, ("brand", "Unknown"): 0.5, ("brand", "b"): 0.0,
    }
    plan = rates._jdf.queryExecution().optimizedPlan().toString()
    assert plan.rindex("Generate explode") < plan.rindex("Aggregate")  # the lowest step is the count of rows alike
