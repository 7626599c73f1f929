"""Data-quality checks: the offending rows of each, and counts in few passes."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwright.config import EXPECTED_ORDER_ITEMS, MAX_NULLS
from rankwright.sources.tables import Tables

# The checks in report order.
CHECKS = (
    "missing_values",
    "duplicate_records",
    "negative_prices",
    "invalid_ages",
    "broken_product_relations",
    "broken_user_relations",
    "data_leakage",
    "empty_product_names",
    "invalid_product_prices",
    "orders_without_items",
    "schema_validation",
)
# Spellings of one type, by the name Spark gives it.
TYPE_ALIASES = {
    "INTEGER": "bigint",
    "INT64": "bigint",
    "FLOAT": "double",
    "FLOAT64": "double",
    "STRING": "string",
    "TIMESTAMP": "timestamp",
    "timestamp_ntz": "timestamp",
}
DUPLICATE_KEY = ("order_id", "product_id", "user_id")


def as_of_column(orders: DataFrame, as_of: str | None) -> Column:
    """The moment after which a record lies in the future: now, unless given.

    Zone-less times are taken as UTC, so now is UTC there, whatever the session's zone.
    """
    if as_of is not None:
        return F.lit(as_of).cast("timestamp_ntz")
    if orders.schema["created_at"].dataType.simpleString() == "timestamp_ntz":
        return F.expr("convert_timezone(current_timezone(), 'UTC', cast(current_timestamp() as timestamp_ntz))")
    return F.current_timestamp()


def _negative_price() -> Column:
    return F.col("sale_price") < 0


def _invalid_age() -> Column:
    return (F.col("age") < 0) | (F.col("age") > 100)


def _empty_name() -> Column:
    return F.col("name").isNull() | (F.trim("name") == "")


def _invalid_product_price() -> Column:
    return (F.col("retail_price") <= 0) | (F.col("cost") < 0)


def _valid_item() -> Column:
    return F.col("user_id").isNotNull() & F.col("product_id").isNotNull() & (F.col("sale_price") >= 0)


def missing_values(order_items: DataFrame) -> DataFrame:
    """One row: NULL counts of the critical columns."""
    nulls = {
        "missing_users": F.count_if(F.col("user_id").isNull()),
        "missing_products": F.count_if(F.col("product_id").isNull()),
        "missing_price": F.count_if(F.col("sale_price").isNull()),
    }
    return order_items.agg(*[count.alias(name) for name, count in nulls.items()])


def duplicate_records(order_items: DataFrame) -> DataFrame:
    """Keys that occur more than once; NULLs count as one value."""
    return (
        order_items.groupBy(*DUPLICATE_KEY)
        .agg(F.count("*").alias("duplicates"))
        .where(F.col("duplicates") > 1)
    )


def negative_prices(order_items: DataFrame) -> DataFrame:
    return order_items.where(_negative_price())


def invalid_ages(users: DataFrame) -> DataFrame:
    return users.where(_invalid_age())


def broken_relations(order_items: DataFrame, parents: DataFrame, key: str, ignore_null_keys: bool = False) -> DataFrame:
    """Values of ``key`` without a parent row, with the order items that hold them.

    Items are counted per key before the join: a hot key reaches it as one row.
    A NULL key has no parent either and counts, unless told otherwise.
    """
    keys = order_items.groupBy(key).agg(F.count("*").alias("items"))
    if ignore_null_keys:
        keys = keys.where(F.col(key).isNotNull())
    return keys.join(parents.select(F.col("id").alias(key)), key, "left_anti")


def future_orders(orders: DataFrame, as_of: str | None = None) -> DataFrame:
    return orders.where(F.col("created_at") > as_of_column(orders, as_of))


def empty_names(products: DataFrame) -> DataFrame:
    return products.where(_empty_name())


def invalid_product_prices(products: DataFrame) -> DataFrame:
    return products.where(_invalid_product_price())


def orders_without_items(orders: DataFrame, order_items: DataFrame) -> DataFrame:
    """Orders no item refers to; item keys are made distinct before the join."""
    return orders.select("order_id").join(order_items.select("order_id").distinct(), "order_id", "left_anti")


def normal_type(name: str) -> str:
    return TYPE_ALIASES.get(name, name)


def schema_violations(df: DataFrame, expected: Mapping[str, str] = EXPECTED_ORDER_ITEMS) -> list[tuple[str, str, str | None]]:
    """(column, expected type, actual type or None) where they differ.

    Columns beyond the expected ones are fine.
    """
    actual = {name: normal_type(kind) for name, kind in df.dtypes}
    wanted = {name: normal_type(kind) for name, kind in expected.items()}
    return [(name, kind, actual.get(name)) for name, kind in wanted.items() if actual.get(name) != kind]


def schema_check(df: DataFrame, expected: Mapping[str, str] = EXPECTED_ORDER_ITEMS) -> DataFrame:
    """The violations as rows, each with the number of table rows it affects."""
    found = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.lit(kind).alias("expected_type"),
            F.lit(actual).cast("string").alias("actual_type"),
        )
        for name, kind, actual in schema_violations(df, expected)
    ]
    empty = F.array().cast("array<struct<column_name:string,expected_type:string,actual_type:string>>")
    return (
        df.agg(F.count("*").alias("affected_rows"))
        .select("affected_rows", F.explode(F.array(*found) if found else empty).alias("v"))
        .select("v.*", "affected_rows")
    )


def validated_order_items(order_items: DataFrame) -> DataFrame:
    """Items with a user, a product and a non-negative price."""
    return order_items.where(_valid_item())


def violations(check: str, tables: Tables, as_of: str | None = None) -> DataFrame:
    """The rows (or keys) that fail one check, lazily."""
    items = tables.order_items
    found: dict[str, Callable[[], DataFrame]] = {
        "missing_values": lambda: items.where(
            F.col("user_id").isNull() | F.col("product_id").isNull() | F.col("sale_price").isNull()
        ),
        "duplicate_records": lambda: duplicate_records(items),
        "negative_prices": lambda: negative_prices(items),
        "invalid_ages": lambda: invalid_ages(tables.users),
        "broken_product_relations": lambda: broken_relations(items, tables.products, "product_id"),
        "broken_user_relations": lambda: broken_relations(items, tables.users, "user_id"),
        "data_leakage": lambda: future_orders(tables.orders, as_of),
        "empty_product_names": lambda: empty_names(tables.products),
        "invalid_product_prices": lambda: invalid_product_prices(tables.products),
        "orders_without_items": lambda: orders_without_items(tables.orders, items),
        "schema_validation": lambda: schema_check(items),
    }
    return found[check]()


def validation_stats(tables: Tables, as_of: str | None = None, ignore_null_keys: bool = False) -> DataFrame:
    """One row with every count the gate needs, as one plan.

    Counts over one table share its pass; each of the other one-row results
    joins the first as a scalar subquery.
    """
    items = tables.order_items
    count = F.count("*")

    def broken(parents: DataFrame, key: str, name: str) -> DataFrame:
        keys = broken_relations(items, parents, key, ignore_null_keys)
        return keys.agg(count.alias(name), F.coalesce(F.sum("items"), F.lit(0)).alias(f"{name}_items"))

    parts = [
        items.agg(
            count.alias("order_items"),
            F.count_if(F.col("user_id").isNull()).alias("missing_users"),
            F.count_if(F.col("product_id").isNull()).alias("missing_products"),
            F.count_if(F.col("sale_price").isNull()).alias("missing_prices"),
            F.count_if(_negative_price()).alias("negative_prices"),
            F.count_if(_valid_item()).alias("validated_records"),
        ),
        duplicate_records(items).agg(count.alias("duplicate_records")),
        tables.users.agg(F.count_if(_invalid_age()).alias("invalid_ages")),
        broken(tables.products, "product_id", "broken_product_relations"),
        broken(tables.users, "user_id", "broken_user_relations"),
        tables.orders.agg(F.count_if(F.col("created_at") > as_of_column(tables.orders, as_of)).alias("data_leakage")),
        tables.products.agg(
            F.count_if(_empty_name()).alias("empty_product_names"),
            F.count_if(_invalid_product_price()).alias("invalid_product_prices"),
        ),
        orders_without_items(tables.orders, items).agg(count.alias("orders_without_items")),
    ]
    row = parts[0]
    for number, part in enumerate(parts[1:]):
        name = f"_part{number}"
        row = row.withColumn(name, part.select(F.struct("*")).scalar()).select("*", f"{name}.*").drop(name)
    missing = F.col("missing_users") + F.col("missing_products") + F.col("missing_prices")
    return row.withColumns(
        {
            "total_missing": missing,
            "missing_rate": F.when(F.col("order_items") > 0, missing / (3 * F.col("order_items"))).otherwise(F.lit(0.0)),
            "schema_validation": F.lit(len(schema_violations(items))).cast("bigint"),
        }
    )


def validation_checks(stats: DataFrame, max_nulls: int = MAX_NULLS) -> DataFrame:
    """One row per check: its number, name, violations, limit and outcome."""
    rows = [
        F.struct(
            F.lit(number).alias("check_no"),
            F.lit(name).alias("check_name"),
            F.col("total_missing" if name == "missing_values" else name).alias("violations"),
            F.lit(max_nulls if name == "missing_values" else 0).cast("bigint").alias("allowed"),
        )
        for number, name in enumerate(CHECKS, start=1)
    ]
    return stats.select(F.inline(F.array(*rows))).withColumn("passed", F.col("violations") <= F.col("allowed"))
