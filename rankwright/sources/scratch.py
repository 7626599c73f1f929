"""Intermediate results written to the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """This application's folder under ``spark.checkpoint.dir``.

    Where the setting is absent, a temporary folder is used in local mode only;
    on a cluster other machines could not read it.
    """
    app = spark.sparkContext.applicationId
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if app not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[app] = tempfile.mkdtemp(prefix="rankwright-")
        root = _LOCAL_FALLBACK[app]
    return f"{root.rstrip('/')}/rankwright/{app}"


def new_name() -> str:
    """A name no other writer uses."""
    return uuid.uuid4().hex


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/{label}-{new_name()}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not a recomputation, and
    every consumer sees the same rows.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def materialize_once(df: DataFrame, label: str) -> DataFrame:
    """As ``materialize``, for a frame that is not run again: what it shuffled goes as soon as it is written.

    Otherwise shuffled rows lie beside the written ones until the driver collects garbage.
    """
    conf = df.sparkSession.conf
    before = conf.get(_FREE_SHUFFLES, "false")
    conf.set(_FREE_SHUFFLES, "true")
    try:
        return materialize(df, label)
    finally:
        conf.set(_FREE_SHUFFLES, before)


def materialize_anew(df: DataFrame, label: str, previous: str | None) -> tuple[DataFrame, str]:
    """As ``materialize``, dropping the version written before; also the new version's path."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.parquet(path)
    if previous and previous.startswith(shared_root(spark)):
        old = spark._jvm.org.apache.hadoop.fs.Path(previous)
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return spark.read.schema(df.schema).parquet(path), path
