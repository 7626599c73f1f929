"""Adapters that show the star-schema test data as the e-commerce tables.

The expressions are the ones the DuckDB views in ``plans.oracles`` use, so both
engines see the same rows.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankwright.sources.tables import Tables


# The schemas of the test tables. Given up front, they save a job
# per table that would open files only to find them.
SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


ROWS_PER_TASK = 1 << 18
#: Added to an order's id for each time a product comes again in it.
REPEATED = 1_000_000_000


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def fx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    n_products = _read(spark, sf_dir, "part").select(F.count("*")).scalar()
    event = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    renamed = {"click": "cart", "view": "product", "signup": "home", "error": "cancel", "purchase": "purchase"}
    event_type = F.create_map(*[F.lit(text) for pair in renamed.items() for text in pair])
    return _read(spark, sf_dir, "events").select(
        F.when(event % 307 != 0, F.col("user_id") * 100 + F.dayofmonth("ts")).alias("session_id"),
        F.when(event % 401 != 0, F.col("user_id")).alias("user_id"),
        event_type[F.col("event_type")].alias("event_type"),
        F.when(event % 211 == 0, F.lit(None).cast("bigint"))
        .when(event % 223 == 0, F.lit(-1).cast("bigint"))
        .otherwise((event * 100 + k) % n_products)
        .alias("product_id"),
        F.col("ts").alias("created_at"),
    )


def _by_order(lines: DataFrame) -> DataFrame:
    """``lines`` cut by rows, where there are more than the cores can take in tasks of ROWS_PER_TASK.

    Adaptive execution would join them with their orders in tasks of so many bytes shuffled. These
    rows take few: one task then sorts and counts millions, in memory that grows with them.
    """
    n_rows = lines.count()
    if n_rows <= ROWS_PER_TASK * lines.sparkSession.sparkContext.defaultParallelism:
        return lines
    # Not below the number of shuffle partitions, or the join would deal them out again.
    shuffled = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return lines.repartition(max(shuffled, math.ceil(n_rows / ROWS_PER_TASK)), "l_orderkey")


def fx_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = _read(spark, sf_dir, "lineitem")
    lines = _by_order(given)
    orders = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    if lines is not given:
        # Tasks have few rows, so their orders fit a hash table, and the lines are not sorted.
        orders = orders.hint("shuffle_hash")
    hours = (
        F.pmod(F.datediff("l_shipdate", F.lit("1995-01-01").cast("date")), F.lit(30)) * 24 + F.col("l_orderkey") % 24
    ).cast("int")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_extendedprice").alias("sale_price"),
        F.col("l_returnflag").alias("status"),
        (F.expr("timestamp_ntz'2024-01-01'") + F.expr("interval '1' hour") * hours).alias("created_at"),
    )


def fx_order_items_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items with a known number of NULL keys, broken keys and bad prices."""
    key = F.col("id")
    return fx_order_items(spark, sf_dir).withColumns(
        {
            "user_id": F.when(key % 997 == 0, None).when(key % 499 == 0, -F.col("user_id") - 1).otherwise(F.col("user_id")),
            "product_id": F.when(key % 991 == 0, None)
            .when(key % 503 == 0, F.col("product_id") + 1000000)
            .otherwise(F.col("product_id")),
            "sale_price": F.when(key % 983 == 0, None)
            .when(key % 509 == 0, -F.col("sale_price"))
            .otherwise(F.col("sale_price")),
        }
    )


def fx_order_items_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order items that pass every check; none is left out.

    A line that repeats its order's product becomes an order of its own, an order without
    lines gets one, and the dates and the inventory id that were missing are added.
    """
    items = fx_order_items(spark, sf_dir)
    order = Window.partitionBy("order_id", "product_id", "user_id").orderBy("id", "sale_price", "status", "created_at")
    lines = items.withColumn("order_id", F.col("order_id") + (F.row_number().over(order) - 1).cast("bigint") * REPEATED)
    orders, parts = _read(spark, sf_dir, "orders"), _read(spark, sf_dir, "part")
    n_products = parts.select(F.count("*")).scalar()
    lonely = orders.join(_read(spark, sf_dir, "lineitem").select("l_orderkey").distinct(), F.col("o_orderkey") == F.col("l_orderkey"), "left_anti")
    given = lonely.withColumn("_part", F.col("o_orderkey") % n_products).join(parts, F.col("_part") == F.col("p_partkey"))
    hours = F.col("o_orderkey") % 720
    added = given.select(
        (-F.col("o_orderkey") - 1).alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("p_partkey").alias("product_id"),
        F.col("p_retailprice").alias("sale_price"),
        F.lit("O").alias("status"),
        (F.expr("timestamp_ntz'2024-01-01'") + F.expr("interval '1' hour") * hours.cast("int")).alias("created_at"),
    )
    day = F.expr("interval '1' day")
    return lines.unionByName(added).withColumns(
        {
            "returned_at": F.when(F.col("status") == "R", F.col("created_at") + day * 14),
            "shipped_at": F.col("created_at") + day,
            "delivered_at": F.col("created_at") + day * 3,
            "inventory_item_id": F.col("id"),
        }
    )


def repaired_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """All five tables so that every check passes: ages within limits, orders for the lines that were split off."""
    clean, items = fixture_tables(spark, sf_dir), fx_order_items_repaired(spark, sf_dir)
    split = items.where(F.col("order_id") >= REPEATED).select("order_id").distinct()
    moment = F.lit("1998-01-01").cast("timestamp_ntz").alias("created_at")
    return Tables(
        users=clean.users.withColumn("age", F.greatest(F.lit(0), F.least(F.lit(100), F.col("age")))),
        products=clean.products,
        orders=clean.orders.unionByName(split.select("order_id", moment)),
        order_items=items,
        events=clean.events,
    )


def fx_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    people = _read(spark, sf_dir, "customer")
    nations = _read(spark, sf_dir, "nation")
    return people.join(nations, people.c_nationkey == nations.n_nationkey, "left").select(
        F.col("c_custkey").alias("id"),
        F.floor(F.col("c_acctbal") / 90).cast("int").alias("age"),
        F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("gender"),
        F.col("n_name").alias("country"),
    )


def fx_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("retail_price"),
        (F.col("p_retailprice") * 6e-1).alias("cost"),
    )


def fx_products_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a known number of blank names and impossible prices."""
    key = F.col("id")
    return fx_products(spark, sf_dir).withColumns(
        {
            "name": F.when(key % 50 == 0, "  ").when(key % 50 == 1, None).otherwise(F.col("name")),
            "retail_price": F.when(key % 97 == 0, 0.0).otherwise(F.col("retail_price")),
            "cost": F.when(key % 89 == 0, -1.0).otherwise(F.col("cost")),
        }
    )


def fx_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("created_at")
    )


def fixture_tables(spark: SparkSession, sf_dir: str, dirty: bool = False) -> Tables:
    return Tables(
        users=fx_users(spark, sf_dir),
        products=(fx_products_dirty if dirty else fx_products)(spark, sf_dir),
        orders=fx_orders(spark, sf_dir),
        order_items=(fx_order_items_dirty if dirty else fx_order_items)(spark, sf_dir),
        events=fx_events(spark, sf_dir),
    )
