"""Checks, gate and report on clean and defective data."""

import json

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from rankwright.operators.validation import (
    CHECKS,
    broken_relations,
    orders_without_items,
    schema_check,
    schema_violations,
    validated_order_items,
    validation_checks,
    validation_stats,
    violations,
)
from rankwright.plans.gate import ValidationError, report_json, run_gate, validation_report
from rankwright.sources.fixtures import fixture_tables
from rankwright.sources.tables import Tables

ITEMS = (
    "id long, order_id long, user_id long, product_id long, sale_price double, status string, created_at timestamp,"
    " returned_at timestamp, shipped_at timestamp, delivered_at timestamp, inventory_item_id long"
)


def tables(spark, items, users=((1, 30),), products=((1, "hat", 2.0, 1.0),), orders=(1,)):
    return Tables(
        users=spark.createDataFrame(list(users), "id long, age int"),
        products=spark.createDataFrame(list(products), "id long, name string, retail_price double, cost double"),
        orders=spark.createDataFrame([(o,) for o in orders], "order_id long").selectExpr("order_id", "timestamp_ntz'2020-01-01' as created_at"),
        order_items=spark.createDataFrame([(i, o, u, p, price, "ok", *[None] * 5) for i, o, u, p, price in items], ITEMS),
        events=spark.createDataFrame([], "session_id long"),
    )


def failed(spark, found, max_nulls=100):
    return {r.check_name for r in validation_checks(validation_stats(found, "2021-01-01"), max_nulls).collect() if not r.passed}


def test_clean_tables_open_the_gate(spark):
    found = tables(spark, [(1, 1, 1, 1, 5.0)])
    assert failed(spark, found) == set()
    gate = run_gate(found, as_of="2021-01-01")
    assert gate.passed and gate.report["errors"] == [] and gate.report["warnings"] == []
    assert gate.require().count() == 1 == gate.report["stats"]["final_validated_records"]
    assert {r.metric: r.value for r in gate.metrics.collect()} == {
        "total_missing_values": 0, "duplicate_records": 0, "broken_relations_total": 0, "validation_status": 1,
    }


@pytest.mark.parametrize(
    ("check", "change"),
    [
        ("duplicate_records", {"items": [(1, 1, 1, 1, 5.0), (2, 1, 1, 1, 6.0)]}),
        ("negative_prices", {"items": [(1, 1, 1, 1, -5.0)]}),
        ("invalid_ages", {"users": [(1, 30), (2, 101), (3, None)]}),
        ("broken_product_relations", {"items": [(1, 1, 1, 7, 5.0)]}),
        ("broken_user_relations", {"items": [(1, 1, 7, 1, 5.0)]}),
        ("empty_product_names", {"products": [(1, " ", 2.0, 1.0)]}),
        ("invalid_product_prices", {"products": [(1, "hat", 0.0, 1.0)]}),
        ("orders_without_items", {"orders": [1, 2]}),
    ],
)
def test_each_defect_fails_its_own_check_only(spark, check, change):
    found = tables(spark, **{"items": [(1, 1, 1, 1, 5.0)], **change})
    assert failed(spark, found) == {check}
    assert violations(check, found).count() == 1
    with pytest.raises(ValidationError) as caught:
        run_gate(found, as_of="2021-01-01").require()
    assert [check in text for text in caught.value.report["errors"]] == [True]


def test_future_orders_depend_on_as_of(spark):
    found = tables(spark, [(1, 1, 1, 1, 5.0)])
    checks = validation_checks(validation_stats(found, "2019-01-01"))
    assert {r.check_name for r in checks.collect() if not r.passed} == {"data_leakage"}
    assert violations("data_leakage", found).count() == 0


@pytest.mark.parametrize(("nulls", "fails"), [(100, False), (101, True)])
def test_null_limit_is_a_count(spark, nulls, fails):
    found = tables(spark, [(1, 1, 1, 1, None)] * nulls, orders=[1])
    stats = validation_stats(found, "2021-01-01").first()
    assert stats["total_missing"] == nulls and stats["missing_rate"] == pytest.approx(1 / 3)
    assert ("missing_values" in failed(spark, found)) is fails


def test_null_keys_are_broken_unless_ignored(spark):
    found = tables(spark, [(1, 1, 1, None, 5.0), (2, 1, 2, None, 5.0)])
    broken = broken_relations(found.order_items, found.products, "product_id")
    assert [tuple(r) for r in broken.collect()] == [(None, 2)]
    assert broken_relations(found.order_items, found.products, "product_id", ignore_null_keys=True).count() == 0
    assert orders_without_items(found.orders, found.order_items).count() == 0


def test_dirty_fixture_counts(spark):
    """Injected defects of the smallest scale, as measured in FIXTURES.md."""
    stats = validation_stats(fixture_tables(spark, SMALL, dirty=True), "2001-01-01").first().asDict()
    expected = {
        "missing_users": 9, "missing_products": 11, "missing_prices": 3, "duplicate_records": 60, "negative_prices": 16,
        "invalid_ages": 23, "broken_product_relations": 10, "broken_user_relations": 8, "data_leakage": 122,
        "empty_product_names": 8, "invalid_product_prices": 5, "orders_without_items": 27, "validated_records": 5961,
        "schema_validation": 4,
    }
    assert {name: stats[name] for name in expected} == expected


def test_report_names_every_failed_check(spark):
    stats = validation_stats(fixture_tables(spark, SMALL, dirty=True), "2001-01-01")
    report = json.loads(report_json(validation_report(stats)).first()["report"])
    assert not report["passed"] and len(report["checks"]) == len(CHECKS)
    wrong = [name for name, passed in report["checks"].items() if not passed]
    assert [text.split("]")[0][1:] for text in report["errors"]] == wrong
    assert "final_validated_records" not in report["stats"] and len(report["warnings"]) == 1


def test_schema_check_normalises_type_names(spark):
    found = tables(spark, [(1, 1, 1, 1, 5.0)])
    assert schema_violations(found.order_items) == [] and schema_check(found.order_items).count() == 0
    other = found.order_items.withColumn("sale_price", found.order_items.sale_price.cast("string")).drop("status")
    assert schema_violations(other) == [("sale_price", "double", "string"), ("status", "string", None)]
    assert [r.affected_rows for r in schema_check(other).collect()] == [1, 1]


def test_items_are_parted_in_one_write_and_read_twice(spark):
    from rankwright.operators import quarantine as q
    from rankwright.sources.scratch import new_path

    tables = fixture_tables(spark, SMALL, dirty=True)
    plan = q.judged_items(tables.order_items, tables.users, tables.products)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("lineitem.parquet") <= 2
    parted = q.part_items(tables, new_path(spark, "parted"))
    valid, held = q.valid_items(parted, tables.order_items), q.quarantined_items(parted, tables.order_items)
    assert valid.columns == tables.order_items.columns
    expected = validated_order_items(tables.order_items)
    assert valid.exceptAll(expected).isEmpty() and valid.count() == expected.count() == 5961
    assert parted.counts["order_items"] == valid.count() + held.count() and parted.counts["quarantined"] == held.count()
    both = valid.count() + held.count()
    assert both == tables.order_items.count()
    masks = {r.broken: list(r.rules) for r in held.select("broken", q.rule_names(F.col("broken")).alias("rules")).distinct().collect()}
    assert all(sum(1 << q.RULES.index(x) for x in names) == mask for mask, names in masks.items())
    part = held._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(quarantined" in part


def test_no_item_is_quarantined_where_all_are_valid(spark):
    from rankwright.operators import quarantine as q
    from rankwright.sources.fixtures import repaired_tables
    from rankwright.sources.scratch import new_path

    tables = repaired_tables(spark, SMALL)
    parted = q.part_items(tables, new_path(spark, "parted"))
    assert q.quarantined_items(parted, tables.order_items).count() == 0
    assert {name for name, n in parted.counts.items() if n} == {"order_items"}
    gate = run_gate(tables, as_of="2002-01-01")
    assert gate.passed and gate.require().count() == parted.counts["order_items"] and gate.report["schema_errors"] == []
    nothing = q.part_items(Tables(tables.users, tables.products, tables.orders, tables.order_items.limit(0), tables.events), new_path(spark, "none"))
    assert nothing.counts["order_items"] == 0


def test_many_order_lines_are_cut_by_rows(spark, tmp_path, monkeypatch):
    """Above so many rows per core the tasks that join and count lines are numbered by rows; the rows stay the same."""
    from rankwright.sources import fixtures

    day = "timestamp_ntz'2024-01-05'"
    lines = spark.range(4000).selectExpr(
        "id div 4 as l_orderkey", "id % 7 as l_partkey", "id % 3 as l_suppkey", "int(id % 4) as l_linenumber", "1D as l_quantity",
        "double(id) as l_extendedprice", "0D as l_discount", "0D as l_tax", "'N' as l_returnflag", "'O' as l_linestatus", f"{day} as l_shipdate",
    )
    orders = spark.range(1000).selectExpr(
        "id as o_orderkey", "id % 50 as o_custkey", "'O' as o_orderstatus", "1D as o_totalprice", f"{day} as o_orderdate", "'1' as o_orderpriority"
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    before = fixtures.fx_order_items(spark, str(tmp_path))
    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 100)
    with_hint = fixtures.fx_order_items(spark, str(tmp_path))
    assert fixtures._by_order(spark.read.parquet(f"{tmp_path}/lineitem.parquet")).rdd.getNumPartitions() == 40
    assert before.exceptAll(with_hint).isEmpty() and with_hint.exceptAll(before).isEmpty()


def test_many_order_lines_meet_their_orders_unsorted(spark, monkeypatch):
    from rankwright.sources import fixtures

    before = fixtures.fx_order_items(spark, SMALL)
    monkeypatch.setattr(fixtures, "ROWS_PER_TASK", 100)
    after = fixtures.fx_order_items(spark, SMALL)
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "Sort [" not in plan
    assert before.exceptAll(after).isEmpty() and after.exceptAll(before).isEmpty()
