"""Properties of the training set and of what is derived from it."""

from conftest import SMALL
from pyspark.sql import functions as F

from rankwright.config import POSITIVE_EVENTS
from rankwright.operators.candidates import combined_candidates, final_deduped, labelled_samples
from rankwright.operators.sessions import met_products
from rankwright.plans.training_set import dated_positives, top_products, training_set
from rankwright.sources.fixtures import fixture_tables
from rankwright.sources.tables import Tables, load_tables

COLUMNS = [
    "qid", "user_id", "product_id", "user_age", "user_gender", "user_country", "retail_price", "cost", "profit_margin",
    "brand", "target_label", "session_start_time",
]


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_shape_and_counts(training):
    assert training.columns == COLUMNS
    row = training.agg(F.count("*"), F.sum("target_label"), F.countDistinct("qid")).first()
    assert tuple(row) == (7617, 407, 262)


def test_rows_are_unique_and_every_session_has_a_positive(training):
    assert training.select("qid", "user_id", "product_id").distinct().count() == training.count()
    assert training.groupBy("qid").agg(F.sum("target_label").alias("n")).where("n = 0").count() == 0


def test_input_order_does_not_matter(spark, training):
    tables = fixture_tables(spark, SMALL)
    mixed = Tables(*[t.repartition(5).orderBy(F.rand(3)) for t in vars(tables).values()])
    assert same(training_set(mixed), training)


def test_later_sales_do_not_leak(spark, training):
    """A flood of sales at or after the last session start must change nothing."""
    tables = fixture_tables(spark, SMALL)
    last = training.agg(F.max("session_start_time")).first()[0]
    late = tables.order_items.withColumn("created_at", F.lit(last).cast("timestamp_ntz")).withColumn("product_id", F.lit(7).cast("bigint"))
    earlier = tables.order_items.where(F.col("created_at") < F.lit(last))
    changed = Tables(tables.users, tables.products, tables.orders, earlier.unionByName(late), tables.events)
    assert same(training_set(changed), training)


def test_short_and_long_way_agree(spark):
    from rankwright.operators.candidates import candidate_generation

    tables = fixture_tables(spark, SMALL)
    positives = dated_positives(tables)
    tops = top_products(positives, tables)
    assert tops.groupBy("category", "session_start_time").count().where("count > 20").count() == 0
    long_way = final_deduped(combined_candidates(positives, candidate_generation(positives, tops)))
    assert same(labelled_samples(positives, tops), long_way)


def test_a_positive_that_is_also_popular_stays_positive(spark):
    def frame(rows, schema):
        return spark.createDataFrame(rows, schema)

    events = [(1, 5, kind, 1, f"2024-01-0{day} 00:00:00") for day, kind in enumerate(("product", *POSITIVE_EVENTS), 2)]
    events += [(2, None, "cart", 2, "2024-01-03 00:00:00"), (None, 5, "cart", 2, "2024-01-03 00:00:00")]
    tables = Tables(
        users=frame([(5, 30, "F", "X")], "id long, age int, gender string, country string"),
        products=frame([(1, "a", "b", "c", 3.0, 1.0), (2, "a", "b", "c", 3.0, 1.0)],
                       "id long, name string, brand string, category string, retail_price double, cost double"),
        orders=frame([], "order_id long"),
        order_items=frame([(1, 2, "2024-01-01 00:00:00")], "id long, product_id long, t string").selectExpr(
            "id", "product_id", "cast(t as timestamp_ntz) created_at"),
        events=frame(events, "session_id long, user_id long, event_type string, product_id long, t string").selectExpr(
            "session_id", "user_id", "event_type", "product_id", "cast(t as timestamp_ntz) created_at"),
    )
    rows = {r.product_id: r for r in training_set(tables).collect()}
    assert {p: r.target_label for p, r in rows.items()} == {1: 1, 2: 0}
    assert {str(r.session_start_time) for r in rows.values()} == {"2024-01-02 00:00:00"}
    assert rows[1].profit_margin == 2.0 and rows[1].qid == 1


def scans(plan, name):
    """The scan lines of one table's files in a physical plan."""
    return [line for line in plan.splitlines() if "FileScan" in line and f"/{name}" in line]


def test_scans_read_only_what_is_needed(spark, tmp_path):
    """With the real schema, filters and column choice reach the Parquet scans."""
    source = fixture_tables(spark, SMALL)
    for name, df in vars(source).items():
        df.withColumn("unused", F.lit("x")).write.parquet(f"{tmp_path}/{name}")
    spark.conf.set("spark.sql.maxMetadataStringLength", 10_000)
    tables = load_tables(spark, str(tmp_path))
    plan = met_products(tables.events, tables.products)._jdf.queryExecution().executedPlan().toString()
    (events,) = scans(plan, "events")  # positives and session starts share one pass
    columns = events.split("ReadSchema")[1]
    assert "unused" not in columns and all(c in columns for c in ("session_id", "user_id", "event_type", "product_id", "created_at"))
    assert "IsNotNull(session_id)" in events and "IsNotNull(product_id)" in events
    assert not scans(dated_positives(tables)._jdf.queryExecution().executedPlan().toString(), "events")  # read once, then stored
    assert all("retail_price" not in line.split("ReadSchema")[1] for line in scans(plan, "products"))


def test_a_day_of_one_user_is_spread_over_tasks(spark):
    from rankwright.operators.feature_tables import temporal_features
    from rankwright.operators.ordinals import with_previous

    n = 60_000
    moment = F.timestamp_micros(F.lit(1_704_067_200_000_000) + F.col("id") * 1_400_000).cast("timestamp_ntz")
    columns = [F.lit(7).alias("user_id"), F.col("id").alias("session_id"), F.lit("cart").alias("event_type"), F.col("id").alias("product_id")]
    events = spark.range(n).repartition(5).select(*columns, moment.alias("created_at"))
    events = events.unionByName(events.limit(1).withColumn("user_id", F.lit(8)))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = with_previous(events, ["user_id"], ["created_at", "session_id"], "session_id", "before").collect()
        gaps = temporal_features(events)
        got = gaps.groupBy("gap_seconds").count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert all(r.before == (r.session_id - 1 if r.session_id else None) for r in found if r.user_id == 7) and len(found) == n + 1
    assert {r.gap_seconds: r["count"] for r in got} == {None: 2, 1: n - 1}
    plan = gaps._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" in plan and "hashpartitioning(user_id" in plan.replace("user_id#", "user_id ") or "_part" in plan


def test_events_are_counted_before_they_meet_the_catalog(spark):
    from rankwright.operators import feature_tables as of

    tables = fixture_tables(spark, SMALL)
    plans = (
        of.interaction_scores(tables.events, tables.products),
        of.user_item_matrix(tables.events, tables.order_items, tables.products),
        of.interaction_features(tables.events, tables.order_items, tables.products),
    )
    for frame in plans:
        lines = frame._jdf.queryExecution().optimizedPlan().toString().splitlines()
        join = next(i for i, line in enumerate(lines) if "Join Inner" in line)
        assert any("Aggregate [user_id" in line for line in lines[join:])


def test_many_samples_are_cut_by_rows(spark, training, monkeypatch):
    """Above so many samples per core they are dealt before any of them are counted; the rows stay the same."""
    from rankwright.operators import candidates

    tables = fixture_tables(spark, SMALL)
    positives = dated_positives(tables)
    tops = top_products(positives, tables)
    before = labelled_samples(positives, tops)
    monkeypatch.setattr(candidates, "ROWS_PER_TASK", 300)
    after = labelled_samples(positives, tops)
    assert after.rdd.getNumPartitions() == -(-positives.count() * 21 // 300)
    assert same(before, after) and same(training_set(tables), training)
