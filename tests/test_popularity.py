"""Point-in-time popularity against brute force on small, awkward data."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from rankwright.functions.timeline import micros
from rankwright.operators import popularity
from rankwright.operators.ordinals import with_total_before
from rankwright.operators.popularity import depth_for, popularity_global, sales_as_of, top_products_as_of
from rankwright.sources.scratch import materialize

BASE = datetime(2024, 1, 1)
ITEMS = "id long, product_id long, created_at {ts}"


def world(seed, n_products=30, n_sales=400, n_moments=60, hot=False):
    """Products in three categories, clustered sale times, moments on and off them."""
    rng = random.Random(seed)
    products = [(p, "abc"[p % 3] if p % 11 else None) for p in range(n_products)]
    ticks = [rng.choice([0, 1, 2, 999_999, 1_000_000]) + rng.randrange(40) * 1_000_003 for _ in range(50)]
    sales = []
    for i in range(n_sales):
        product = 4 if hot and rng.random() < 0.5 else rng.choice([rng.randrange(n_products), rng.randrange(5), 999])
        sales.append((i if i % 37 else None, product if i % 41 else None, rng.choice(ticks) if i % 43 else None))
    moments = [(rng.choice("abc"), rng.choice([rng.choice(ticks), rng.choice(ticks) + 1, -5, 10**9])) for _ in range(n_moments)]
    return products, sales, moments


def at(tick):
    return None if tick is None else BASE + timedelta(microseconds=tick)


def counted(sales, product, tick):
    return sum(1 for i, p, t in sales if i is not None and p == product and t is not None and t < tick)


def brute_top(products, sales, moments, k):
    rows = set()
    for category, tick in set(moments):
        ranked = sorted((-counted(sales, p, tick), p) for p, c in products if c == category)[:k]
        rows |= {(category, at(tick), p, -n, r) for r, (n, p) in enumerate(ranked, 1)}
    return rows


def frames(spark, products, sales, moments, ts):
    return (
        spark.createDataFrame(products, "id long, category string"),
        spark.createDataFrame([(i, p, at(t)) for i, p, t in sales], ITEMS.format(ts=ts)),
        spark.createDataFrame([(c, at(t)) for c, t in moments], f"category string, start {ts}"),
    )


@pytest.mark.parametrize(
    ("seed", "k", "fanout", "depth", "ts", "hot"),
    [
        (1, 3, 128, None, "timestamp_ntz", False),
        (2, 3, 4, 2, "timestamp_ntz", True),
        (3, 2, 3, 3, "timestamp_ntz", False),
        (4, 20, 4, 2, "timestamp", False),
        (5, 1, 2, 3, "timestamp_ntz", True),
    ],
)
def test_top_products_equal_brute_force(spark, seed, k, fanout, depth, ts, hot):
    data = world(seed, hot=hot)
    products, items, moments = frames(spark, *data, ts)
    got = top_products_as_of(moments, products, items, "start", k, fanout, depth)
    assert {tuple(r) for r in got.collect()} == brute_top(*data, k)
    assert got.count() == len(brute_top(*data, k))


@pytest.mark.parametrize("crowded", [False, True])
def test_stray_dates_and_crowded_minutes_change_nothing(spark, crowded):
    """Sales dated 1900 and 9999, and nine tenths of all sales in one minute."""
    products, sales, moments = world(6)
    if crowded:
        sales = [(i, p, 7_000_000 + (t or 0) % 60_000_000 if (i or 0) % 10 else t) for i, p, t in sales]
        moments += [("abc"[i % 3], 7_000_000 + i * 1_500_000) for i in range(40)]
    far = [int((datetime(year, 1, 1) - BASE) / timedelta(microseconds=1)) for year in (1900, 9999)]
    sales += [(10_000 + i, i % 9, t) for i, t in enumerate(far * 3)]
    moments += [("a", far[0]), ("b", far[1]), ("c", far[0] + 1)]
    data = (products, sales, moments)
    products_, items, moments_ = frames(spark, *data, "timestamp_ntz")
    got = top_products_as_of(moments_, products_, items, "start", 3, 4, 3)
    assert {tuple(r) for r in got.collect()} == brute_top(*data, 3)


def test_buckets_hold_equal_numbers_of_sales_whatever_the_dates(spark):
    rows = [(i, 1) for i in range(1000)] + [(-(10**15), 1), (10**15, 3)]
    told = with_total_before(spark.createDataFrame(rows, "clock long, n long").repartition(7), "clock", "n", "tick")
    got = {r.clock: r.tick for r in told.collect()}
    assert got[-(10**15)] == 0 and got[10**15] == 1001 and all(got[i] == i + 1 for i in range(1000))


def test_no_sales_ranks_by_id(spark):
    products, items, moments = frames(spark, [(5, "a"), (3, "a"), (9, "b")], [], [("a", 10), ("z", 10)], "timestamp_ntz")
    got = top_products_as_of(moments, products, items, "start", 20)
    assert sorted((r.product_id, r.sales_count, r.product_rank) for r in got.collect()) == [(3, 0, 1), (5, 0, 2)]


@pytest.mark.parametrize("bucket", [7, 1_000_000, 3_600_000_000])
def test_sales_as_of_equals_brute_force(spark, bucket):
    products, sales, moments = world(7, hot=True)
    _, items, _ = frames(spark, products, sales, moments, "timestamp_ntz")
    points = [(p % 12, t) for p, (_, t) in enumerate(moments)]
    asked = spark.createDataFrame([(p, at(t)) for p, t in points], "product_id long, start timestamp_ntz")
    got = sales_as_of(asked, items, "start", bucket)
    assert sorted(map(tuple, got.collect())) == sorted({(p, at(t), counted(sales, p, t)) for p, t in points})


def test_popularity_global_keeps_unsold_products(spark):
    products, items, _ = frames(spark, [(1, "a"), (2, "a")], [(1, 1, 5), (2, 1, 6), (None, 1, 7), (3, 77, 1)], [], "timestamp_ntz")
    assert sorted(map(tuple, popularity_global(products, items).collect())) == [(1, "a", 2), (2, "a", 0)]


def test_depth_grows_with_the_logarithm_of_sales():
    assert [depth_for(n) for n in (0, 10, 1_000_000, 100_000_000, 10**10, 10**12)] == [1, 1, 1, 2, 3, 4]


def test_micros_are_exact_and_free_of_the_session_zone(spark):
    texts = ["1969-12-31 23:59:59.999999", "2024-03-31 02:30:00.000001", "2024-10-27 02:30:00.5", "0500-01-01 00:00:00"]
    expected = [int((datetime.fromisoformat(x) - datetime(1970, 1, 1)) / timedelta(microseconds=1)) for x in texts]
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for name in ("UTC", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = spark.createDataFrame([(x,) for x in texts], "x string").select(F.col("x").cast("timestamp_ntz").alias("t"))
            assert [r[0] for r in df.select(micros(df, "t")).collect()] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


@pytest.mark.parametrize("late", [False, True])
def test_bounds_keep_most_products_out_and_lose_none(spark, late):
    """What the best of the end have keeps the rest from being unfolded, also where others led for long."""
    rng = random.Random(8)
    products = [(p, "a") for p in range(400)] + [(1000, "b")]
    sales = [(i, min(int(rng.expovariate(0.02)), 399), i) for i in range(6000)]
    if late:  # the best of the end sold nothing before the last tenth
        sales = [(i, p if t < 5400 else 399 - p, t) for i, p, t in sales]
    moments = [("a", t) for t in range(0, 6100, 61)] + [("b", 77)]
    frames_ = frames(spark, products, sales, moments, "timestamp_ntz")
    seen = []
    unfolded = popularity._tops_of_children

    def kept(states, *others):
        seen.append(states.where(F.col("since") < F.col("until")).count())
        return unfolded(states, *others)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(popularity, "_tops_of_children", kept)
        patch.setattr(popularity, "BOUNDING", 2)
        got = popularity.top_products_as_of(frames_[2], frames_[0], frames_[1], "start", 5, 16, 1)
        assert {tuple(r) for r in got.collect()} == brute_top(products, sales, moments, 5)
    steps = len({(p, t * 16 // 6000) for _, p, t in sales})
    assert seen[0] < steps * (1 if late else 0.25)


def test_moments_and_tops_join_to_the_top_products(spark):
    products, sales, moments = world(9)
    products, items, moments = frames(spark, products, sales, moments, "timestamp_ntz")
    asked, tops = popularity.top_products_by_moment(moments, products, items, "start", 3, 4, 2)
    joined = asked.join(tops, ["category", "moment"]).select("category", "start", "product_id", "sales_count", "product_rank")
    whole = top_products_as_of(moments, products, items, "start", 3, 4, 2)
    assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, whole.collect()))
    assert tops.count() < whole.count()


def test_a_timeline_is_written_once(spark):
    """Buckets and times inside them are counted from one written timeline; the items are read for nothing else."""
    products, sales, moments = world(10)
    _, items, _ = frames(spark, products, sales, moments, "timestamp_ntz")
    asked = spark.createDataFrame([(p % 12, at(t)) for p, (_, t) in enumerate(moments)], "product_id long, start timestamp_ntz")
    written = []

    def once(df, label):
        written.append(label)
        return materialize(df, label)

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(popularity, "materialize", once)
        assert sales_as_of(asked, items, "start").count() == asked.distinct().count()
    assert written == ["timeline"]
