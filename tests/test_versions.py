"""Tables that outlive their catalog, writers that die or race, and fits that go on."""

import json
import os
import subprocess
import sys
import threading

import pytest
from conftest import SMALL
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from rankwright.config import StoreConfig
from rankwright.operators.ndcg import session_totals
from rankwright.operators.split import group_sizes
from rankwright.sources import files, store, tables, versions

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture(scope="module")
def target(spark):
    config = StoreConfig(database="version_store")
    store.create_database(spark, config)
    return config


def test_a_text_is_published_once(spark, tmp_path):
    path = f"{tmp_path}/deep/one.json"
    assert files.publish_text(spark, path, "first é") and not files.publish_text(spark, path, "second")
    assert files.read_text(spark, path) == "first é" and files.file_names(spark, f"{tmp_path}/deep") == ["one.json"]
    assert files.file_names(spark, f"{tmp_path}/none") == []


def test_a_writer_that_dies_leaves_the_old_rows(spark, target, monkeypatch):
    ref = target.table_ref("dying")
    store.save_table(spark.range(3), ref)
    monkeypatch.setattr(versions, "_publish", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
    for disposition in ("WRITE_TRUNCATE", "WRITE_APPEND"):
        with pytest.raises(RuntimeError, match="killed"):
            store.save_table(spark.range(10), ref, disposition)
    monkeypatch.undo()
    assert store.load_table(spark, ref).count() == 3 == spark.table(ref).count()
    assert versions.drop_old(spark, ref) == 2 and spark.table(ref).count() == 3


def test_a_reader_keeps_its_version(spark, target):
    ref = target.table_ref("read")
    store.save_table(spark.range(3), ref)
    before = store.load_table(spark, ref)
    store.save_table(before.select((F.col("id") + 5).alias("id")), ref)  # may read what it replaces
    assert sorted(r.id for r in before.collect()) == [0, 1, 2] and sorted(r.id for r in spark.table(ref).collect()) == [5, 6, 7]
    store.save_table(spark.range(1), ref, "WRITE_APPEND")
    assert versions.drop_old(spark, ref, keep=1) == 1 and spark.table(ref).count() == 4


def test_appended_rows_must_fit(spark, target):
    ref = target.table_ref("fits")
    store.save_table(spark.createDataFrame([(1, "a")], "n int, s string"), ref)
    store.save_table(spark.createDataFrame([("b", 2)], "s string, n int"), ref, "WRITE_APPEND")
    assert sorted(map(tuple, store.load_table(spark, ref).collect())) == [(1, "a"), (2, "b")]
    for wrong in ("n int", "n int, s string, more int", "n int, s array<int>"):
        with pytest.raises(AnalysisException):
            store.save_table(spark.createDataFrame([], wrong), ref, "WRITE_APPEND")


def test_racing_writers_lose_nothing(spark, target, monkeypatch):
    ref = target.table_ref("race")
    publish, turns, barrier = versions._publish, [], threading.Barrier(3)

    def together(spark_, folder, version):
        if len(turns) < 3:
            turns.append(version.number)
            barrier.wait(60)  # all have read the same version
        return publish(spark_, folder, version)

    monkeypatch.setattr(versions, "_publish", together)
    writers = [threading.Thread(target=store.save_table, args=(spark.range(k, k + 2), ref, "WRITE_APPEND")) for k in (0, 10, 20)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    assert turns == [1, 1, 1]
    assert sorted(r.id for r in store.load_table(spark, ref).collect()) == [0, 1, 10, 11, 20, 21]


def test_two_registrations_leave_one_entry_per_feature(spark, target, training, monkeypatch):
    publish, waiting, barrier = versions._publish, [], threading.Barrier(2)

    def together(spark_, folder, version):
        if "feature_catalog" in folder and len(waiting) < 2:
            waiting.append(folder)
            barrier.wait(120)
        return publish(spark_, folder, version)

    monkeypatch.setattr(versions, "_publish", together)
    both = [threading.Thread(target=store.register_features, args=(training, "demo", target)) for _ in range(2)]
    for t in both:
        t.start()
    for t in both:
        t.join()
    monkeypatch.undo()
    assert store.feature_catalog(spark, target).count() == 8
    store.register_features(training, "other", target)
    entries = store.feature_catalog(spark, target)
    told = entries.where("feature_group = 'demo'").withColumn("description", F.lit("told anew"))
    store.describe_features(told, "demo", target)
    found = {(r.feature_group, r.feature): r.description for r in store.feature_catalog(spark, target).collect()}
    assert len(found) == 16 and found["demo", "brand"] == "told anew" and found["other", "brand"] == "Feature brand of group other"


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def test_sessions_are_stored_so_that_grouping_moves_no_rows(spark, target, training):
    ref = target.table_ref("sessions")
    store.save_sessions(training, ref)
    grouped, hot = store.load_sessions(spark, ref)
    assert hot is None and grouped.count() == training.count() == spark.table(ref).count()
    sizes = group_sizes(grouped)
    assert "Exchange" not in plan_of(sizes) and "Bucketed: true" in plan_of(sizes).replace("SelectedBucketsCount", "Bucketed: true SelectedBucketsCount")
    assert "Exchange" not in plan_of(session_totals(grouped))
    assert sizes.exceptAll(group_sizes(training)).isEmpty() and sizes.count() == training.select("qid").distinct().count()
    # An application whose catalog has never seen it.
    for table in spark.catalog.listTables(target.database):
        if "sessions" in table.name:
            spark.sql(f"DROP {'VIEW' if table.tableType == 'VIEW' else 'TABLE'} {target.database}.{table.name}")
    again, _ = store.load_sessions(spark, ref)
    assert "Exchange" not in plan_of(group_sizes(again)) and again.exceptAll(training).isEmpty()


def test_long_sessions_are_not_put_into_a_bucket(spark, target, training):
    ref = target.table_ref("long_sessions")
    longest = training.groupBy("qid").count().agg(F.max("count")).first()[0]
    store.save_sessions(training, ref, rows_per_bucket=longest - 1)
    grouped, hot = store.load_sessions(spark, ref)
    counted = group_sizes(grouped).unionByName(group_sizes(hot))
    assert hot.count() >= longest and counted.exceptAll(group_sizes(training)).isEmpty()
    assert counted.count() == training.select("qid").distinct().count()
    store.save_sessions(training.limit(0), ref)
    assert store.load_sessions(spark, ref)[0].count() == 0


APPLICATION = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from rankwright.config import RankerParams, RunConfig, StoreConfig
from rankwright.plans.end_to_end import run_end_to_end
from rankwright.plans.queries import queries
from rankwright.sources import store, tables
from rankwright.sources.fixtures import fixture_tables
folder, sf_dir = sys.argv[2:4]
spark = (SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
         .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g")
         .config("spark.sql.warehouse.dir", folder + "/warehouse").config("spark.checkpoint.dir", folder + "/shared").getOrCreate())
known = queries()
counts = {name: known[name](spark, sf_dir).count() for name in ("feature_table_read", "store_truncate", "store_append", "feature_catalog")}
config = RunConfig(ranker=RankerParams(n_trees=2), store=StoreConfig(database="both"), ndcg_threshold=1e-6)
store.create_database(spark, config.store)
counts["there_before"] = tables.table_exists(spark, config.store.table_ref("training_dataset"))
counts["rows_before"] = store.load_table(spark, config.store.table_ref("training_dataset")).count() if counts["there_before"] else 0
run = run_end_to_end(fixture_tables(spark, sf_dir), config, "2001-01-01", on_fail="report").first()
counts["decision"] = run["decision"]
counts["models"] = store.load_table(spark, config.store.table_ref("models")).count()
counts["entries"] = store.feature_catalog(spark, config.store).count()
counts["metrics"] = store.load_table(spark, config.store.table_ref("run_metrics")).count()
import json
print("COUNTS " + json.dumps(counts))
"""


def test_two_applications_on_one_warehouse(tmp_path):
    found = []
    for _ in range(2):
        done = subprocess.run(
            [sys.executable, "-c", APPLICATION, ROOT, str(tmp_path), SMALL], capture_output=True, text=True, timeout=500, check=False
        )
        assert done.returncode == 0, done.stderr[-3000:]
        found.append(json.loads(done.stdout.split("COUNTS ")[1]))
    first, second = found
    for counts in found:
        assert counts["feature_table_read"] == counts["store_truncate"] == 7617 and counts["store_append"] == 2 * 7617
        assert counts["feature_catalog"] == counts["entries"] == 8 and counts["decision"] == "approve"
    assert not first["there_before"] and (second["there_before"], second["rows_before"]) == (True, 7617)
    assert (first["models"], second["models"], first["metrics"], second["metrics"]) == (1, 2, 11, 22)


def test_tables_are_found_without_the_catalog(spark, target):
    ref = target.table_ref("forgotten")
    store.save_table(spark.range(4), ref)
    spark.sql(f"DROP VIEW {ref}")
    assert tables.table_exists(spark, ref) and not tables.table_exists(spark, target.table_ref("never"))
    assert store.read_feature_table(spark, store.table_uri(ref)).count() == 4 == spark.table(ref).count()
