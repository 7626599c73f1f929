"""Feature tables, the feature catalog, run metrics and published models."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rankwright.config import IDENTITY, SESSION_START, StoreConfig
from rankwright.sources import versions
from rankwright.sources.scratch import materialize, shared_root

# Write dispositions and the columns entities are looked up by.
DISPOSITIONS = {"WRITE_TRUNCATE": versions.replaced(), "WRITE_APPEND": versions.appended, "WRITE_EMPTY": versions.first_only}
ENTITY_KEYS = ("user_id", "product_id")
ROWS_PER_TASK = 1 << 20

_CATALOG = "feature_group string, feature string, description string, entity_keys array<string>, source string, schema_version int"
_METRICS = "run_id string, stage string, metric string, value double"
_MODELS = "model string, path string, run_id string, metric string, value double, decision string"


def _durable(spark: SparkSession, path: str) -> str:
    """``path``, unless it lies in the folder that goes with the application."""
    if strip_scheme(path).startswith(strip_scheme(shared_root(spark))):
        raise ValueError(f"{path} lies in the scratch folder and would go with it")
    return path.rstrip("/")


def create_database(spark: SparkSession, store: StoreConfig) -> None:
    """The database at its location, by default in the catalog's warehouse."""
    place = f" LOCATION '{_durable(spark, store.location)}'" if store.location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{store.database}`{place}")


def model_path(spark: SparkSession, model: str, run_id: str, store: StoreConfig) -> str:
    """Where a run's model is kept: under the model root, or beside the database's tables."""
    root = store.model_root
    if root is None:
        create_database(spark, store)
        root = f"{spark.catalog.getDatabase(store.database).locationUri.rstrip('/')}_models"
    return f"{_durable(spark, root)}/{model}/{run_id}"


def save_table(
    df: DataFrame, ref: str, write_disposition: str = "WRITE_TRUNCATE", schema: T.StructType | None = None
) -> None:
    """Load ``df`` into a table, under its own schema or one it must fit.

    The rows become visible as the table's next version, all at once. Appended rows must
    have the table's columns. What a reader began with stays until ``versions.drop_old``.
    """
    change = DISPOSITIONS[write_disposition]
    rows = df.to(schema) if schema else df
    spark = df.sparkSession
    folder = versions.table_folder(spark, ref)
    versions.write(rows, folder, change, fits=write_disposition == "WRITE_APPEND")
    versions.attach(spark, ref)


def load_table(spark: SparkSession, ref: str) -> DataFrame:
    """The latest version of a stored table, also one another application has written."""
    if versions.attach(spark, ref):
        return versions.read(spark, versions.table_folder(spark, ref))
    return spark.table(ref)


def save_sessions(training: DataFrame, ref: str, rows_per_bucket: int = 1 << 20) -> None:
    """Load training rows into a table bucketed and sorted by session.

    Whoever groups or joins it by ``qid`` then moves no rows. Sessions with more rows than a
    bucket should hold are stored beside the buckets, spread as they came.
    """
    spark = training.sparkSession
    sizes = materialize(training.groupBy("qid").agg(F.count("*").alias("_n")), "session-sizes")
    n_rows, longest = sizes.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.max("_n")).first()
    buckets = max(spark.sparkContext.defaultParallelism, math.ceil(n_rows / rows_per_bucket))
    hot = None
    if longest and longest > rows_per_bucket:
        large = sizes.where(F.col("_n") > rows_per_bucket).select("qid")  # fewer than there are buckets
        training, hot = training.join(large, "qid", "left_anti"), training.join(large, "qid", "left_semi")
    versions.write_grouped(training, hot, ref, "qid", buckets)
    versions.attach(spark, ref)


def load_sessions(spark: SparkSession, ref: str) -> tuple[DataFrame, DataFrame | None]:
    """The bucketed sessions, and the rows of those too long for a bucket, if there are any."""
    return versions.read_grouped(spark, ref)


def save_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def save_by_day(training: DataFrame, path: str) -> None:
    """Training rows as Parquet, one folder per session day, in session order.

    Rows are spread by ranges of (start, qid, user, product): a folder gets few
    files, and a busy day is still written by many tasks. Many rows are cut by their number:
    by bytes shuffled, of which they take few, a task would sort millions. They are counted for that, so they should be stored.
    """
    order = [SESSION_START, "qid", "user_id", "product_id"]
    n_rows = training.count()
    many = n_rows > ROWS_PER_TASK * training.sparkSession.sparkContext.defaultParallelism
    (
        training.repartitionByRange(*([math.ceil(n_rows / ROWS_PER_TASK)] if many else []), *order)
        .sortWithinPartitions(*order)
        .withColumn("session_day", F.to_date(SESSION_START))
        .write.mode("overwrite")
        .partitionBy("session_day")
        .parquet(path)
    )


def table_uri(ref: str) -> str:
    return f"table://{ref}"


def strip_scheme(uri: str) -> str:
    """``table://db.name`` and the like without the scheme."""
    return uri.split("://", 1)[-1]


def parent_uri(uri: str) -> str:
    """The directory a file URI lies in."""
    return uri.rsplit("/", 1)[0]


def read_feature_table(spark: SparkSession, uri: str, order: tuple[str, ...] = ()) -> DataFrame:
    """A feature table by URI, globally ordered only where a consumer needs it."""
    table = load_table(spark, strip_scheme(uri))
    return table.orderBy(*order) if order else table


def register_features(training: DataFrame, group: str, store: StoreConfig = StoreConfig()) -> str:
    """Load the feature table (replacing it), write the group's catalog entries, return its URI.

    A group's entries are one part of the catalog and are replaced as one: whoever
    registers a group last has described it, and other groups are left alone.
    """
    spark = training.sparkSession
    create_database(spark, store)
    ref = store.table_ref(group)
    save_table(training, ref)
    entries = [
        (group, c, f"Feature {c} of group {group}", list(ENTITY_KEYS), table_uri(ref), store.schema_version)
        for c in training.columns
        if c not in IDENTITY
    ]
    describe_features(spark.createDataFrame(entries, _CATALOG), group, store)
    return table_uri(ref)


def describe_features(entries: DataFrame, group: str, store: StoreConfig = StoreConfig()) -> None:
    """Replace the catalog's entries of one group."""
    spark = entries.sparkSession
    create_database(spark, store)
    catalog = store.table_ref("feature_catalog")
    rows = entries.to(T.StructType.fromDDL(_CATALOG))
    versions.write(rows, versions.table_folder(spark, catalog), versions.replaced(group))
    versions.attach(spark, catalog)


def feature_catalog(spark: SparkSession, store: StoreConfig = StoreConfig()) -> DataFrame:
    return load_table(spark, store.table_ref("feature_catalog"))


def append_metrics(metrics: DataFrame, run_id: str, store: StoreConfig = StoreConfig()) -> None:
    """Add (stage, metric, value) rows of a run to the metrics table."""
    spark = metrics.sparkSession
    create_database(spark, store)
    rows = metrics.select(F.lit(run_id).alias("run_id"), "stage", "metric", F.col("value").cast("double").alias("value"))
    save_table(rows, store.table_ref("run_metrics"), "WRITE_APPEND", T.StructType.fromDDL(_METRICS))


def publish_model(
    spark: SparkSession, model: str, path: str, run_id: str, value: float, decision: str, store: StoreConfig = StoreConfig()
) -> None:
    """Add a model version to the model table."""
    create_database(spark, store)
    row = spark.createDataFrame([(model, path, run_id, "mean_ndcg_5", value, decision)], _MODELS)
    save_table(row, store.table_ref("models"), "WRITE_APPEND", T.StructType.fromDDL(_MODELS))
