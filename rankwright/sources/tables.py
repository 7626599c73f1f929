"""The named input tables, and the way from a name or SQL text to a frame."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from rankwright.sources import versions


@dataclass(frozen=True)
class Tables:
    """The five tables that are read. Frames stay lazy."""

    users: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    events: DataFrame


# The names of the input tables, the last two declared but not read.
TABLE_NAMES = (
    "users",
    "products",
    "orders",
    "order_items",
    "events",
    "inventory_items",
    "distribution_centers",
)


def scan(spark: SparkSession, name: str, location: str | None = None) -> DataFrame:
    """A table by name: a Parquet directory under ``location``, else the catalog."""
    if name not in TABLE_NAMES:
        raise KeyError(f"unknown table {name!r}; known: {', '.join(TABLE_NAMES)}")
    return spark.read.parquet(f"{location}/{name}") if location else spark.table(name)


def load_tables(spark: SparkSession, location: str | None = None) -> Tables:
    """All tables a run reads, from Parquet directories or from the catalog."""
    return Tables(*(scan(spark, name, location) for name in TABLE_NAMES[:5]))


def run_sql(spark: SparkSession, text: str, args: Mapping[str, object] | None = None) -> DataFrame:
    """A parameterised query as a lazy frame."""
    return spark.sql(text, args=dict(args or {}))


def run_ddl(spark: SparkSession, text: str) -> None:
    spark.sql(text)


def table_exists(spark: SparkSession, ref: str) -> bool:
    """Whether ``ref`` names a table the catalog knows or one that lies in its database's folder.

    Errors other than absence are raised.
    """
    if spark.catalog.tableExists(ref):
        return True
    database = ref.rpartition(".")[0] or spark.catalog.currentDatabase()
    return spark.catalog.databaseExists(database) and versions.current(spark, versions.table_folder(spark, ref)) is not None
