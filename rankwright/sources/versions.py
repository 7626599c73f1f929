"""Tables as folders of rows and a log of versions, which outlive the catalog.

A write puts its rows into a folder of their own and then publishes the next version, a
small file that names the folders the table consists of. Until then nobody sees the
rows, so a writer that dies leaves the table as it was; two writers that race publish
one after the other. Readers keep the folders of the version they began with.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from rankwright.sources import files

#: The part of a table that is written without naming one.
WHOLE = ""


@dataclass(frozen=True)
class Version:
    """A number, the schema, the folders of each part of the table, and how many buckets by what some have."""

    number: int
    schema: T.StructType
    parts: dict[str, list[str]] = field(default_factory=dict)
    buckets: dict[str, list] = field(default_factory=dict)

    def folders(self) -> list[str]:
        return [folder for _, part in sorted(self.parts.items()) for folder in part]


def table_folder(spark: SparkSession, ref: str) -> str:
    """Where a table of a database the catalog knows lies, whether or not the catalog knows the table."""
    database, _, table = ref.rpartition(".")
    place = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{place.rstrip('/')}/{table.strip('`')}"


def current(spark: SparkSession, folder: str) -> Version | None:
    """The latest version of the table in a folder, if there is one."""
    log = [name for name in files.file_names(spark, f"{folder}/_versions") if name.endswith(".json")]
    if not log:
        return None
    found = json.loads(files.read_text(spark, f"{folder}/_versions/{log[-1]}"))
    return Version(int(log[-1].split(".")[0]), T.StructType.fromJson(found["schema"]), found["parts"], found.get("buckets", {}))


def _publish(spark: SparkSession, folder: str, version: Version) -> bool:
    text = json.dumps({"schema": version.schema.jsonValue(), "parts": version.parts, "buckets": version.buckets})
    return files.publish_text(spark, f"{folder}/_versions/{version.number:012d}.json", text)


def _nullable(schema: T.StructType) -> T.StructType:
    """The schema as Parquet gives it back."""
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def write(rows: DataFrame, folder: str, change: Callable[[Version | None, str], dict[str, list[str]]], fits: bool = False) -> Version:
    """Write rows beside the table and publish the version that ``change`` makes of the latest one.

    ``fits`` asks the rows to have the table's columns; they are put in its order.
    """
    spark = rows.sparkSession
    latest = current(spark, folder)
    if fits and latest:
        if set(rows.columns) != set(latest.schema.names):
            raise AnalysisException(f"the table has the columns {latest.schema.names}, the rows {rows.columns}")
        rows = rows.to(latest.schema)
    name = f"rows-{uuid.uuid4().hex}"
    change(latest, name)  # refused before anything is written, if it is
    rows.write.parquet(f"{folder}/{name}")
    while True:
        parts = change(latest, name)
        buckets = {f: found for f, found in (latest.buckets if latest else {}).items() if any(f in part for part in parts.values())}
        version = Version(latest.number + 1 if latest else 1, _nullable(rows.schema), parts, buckets)
        if _publish(spark, folder, version):
            return version
        latest = current(spark, folder)


def write_grouped(rows: DataFrame, hot: DataFrame | None, ref: str, by: str, buckets: int) -> Version:
    """Replace a table by rows bucketed and sorted by a column, and by others as they are.

    ``hot`` are the rows of keys with too many rows for one bucket.
    """
    spark = rows.sparkSession
    folder, name = table_folder(spark, ref), f"rows-{uuid.uuid4().hex}"
    rows.repartition(buckets, by).write.bucketBy(buckets, by).sortBy(by).format("parquet").option("path", f"{folder}/{name}").saveAsTable(
        _physical(ref, name)
    )
    parts = {WHOLE: [name]}
    if hot is not None:
        parts["hot"] = [f"rows-{uuid.uuid4().hex}"]
        hot.write.parquet(f"{folder}/{parts['hot'][0]}")
    while True:
        latest = current(spark, folder)
        version = Version(latest.number + 1 if latest else 1, _nullable(rows.schema), parts, {name: [by, buckets]})
        if _publish(spark, folder, version):
            return version


def _physical(ref: str, folder: str) -> str:
    """The catalog's name for one bucketed folder of a table."""
    return f"{ref}_{folder.replace('-', '_')}"


def _know(spark: SparkSession, ref: str, folder: str, version: Version, name: str) -> None:
    """Tell the catalog of a bucketed folder, if it does not know it yet."""
    by, buckets = version.buckets[name]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in version.schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {_physical(ref, name)} ({columns}) USING parquet "
        f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {buckets} BUCKETS LOCATION '{folder}/{name}'"
    )


def read_grouped(spark: SparkSession, ref: str) -> tuple[DataFrame, DataFrame | None]:
    """The latest bucketed rows, whose buckets Spark knows, and the rows beside them, if there are any."""
    folder = table_folder(spark, ref)
    version = current(spark, folder)
    if version is None or not version.buckets:
        raise AnalysisException(f"there is no bucketed table in {folder}")
    [name] = version.buckets
    _know(spark, ref, folder, version, name)
    rest = [f"{folder}/{other}" for other in version.folders() if other != name]
    return spark.table(_physical(ref, name)), spark.read.schema(version.schema).parquet(*rest) if rest else None


def replaced(part: str = WHOLE) -> Callable[[Version | None, str], dict[str, list[str]]]:
    """The rows take the place of one part, or of all rows if no part is named."""
    return lambda latest, name: {**(latest.parts if latest and part else {}), part: [name]}


def appended(latest: Version | None, name: str) -> dict[str, list[str]]:
    before = latest.parts if latest else {}
    return {**before, WHOLE: [*before.get(WHOLE, []), name]}


def first_only(latest: Version | None, name: str) -> dict[str, list[str]]:
    if latest:
        raise AnalysisException("the table exists already")
    return {WHOLE: [name]}


def read(spark: SparkSession, folder: str, version: Version | None = None) -> DataFrame:
    """The rows of a version, the latest unless given."""
    version = version or current(spark, folder)
    if version is None:
        raise AnalysisException(f"there is no table in {folder}")
    return spark.read.schema(version.schema).parquet(*[f"{folder}/{name}" for name in version.folders()])


def attach(spark: SparkSession, ref: str) -> bool:
    """Make the catalog's name for a table mean its latest version; False if there is none.

    The name becomes a view over the version's folders, so SQL reads it like a table.
    """
    folder = table_folder(spark, ref)
    version = current(spark, folder)
    if version is None:
        return False
    columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in version.schema)
    for name in version.buckets:
        _know(spark, ref, folder, version, name)
    places = [_physical(ref, name) if name in version.buckets else f"parquet.`{folder}/{name}`" for name in version.folders()]
    scans = [f"SELECT {columns} FROM {place}" for place in places]
    spark.sql(f"CREATE OR REPLACE VIEW {ref} AS {' UNION ALL '.join(scans)}")
    return True


def drop_old(spark: SparkSession, ref: str, keep: int = 2) -> int:
    """Delete the folders that none of the last ``keep`` versions has; how many.

    For a time when no reader is on an older version and no writer is at work.
    """
    folder = table_folder(spark, ref)
    log = [name for name in files.file_names(spark, f"{folder}/_versions") if name.endswith(".json")]
    held: set[str] = set()
    for name in log[-keep:]:
        for part in json.loads(files.read_text(spark, f"{folder}/_versions/{name}"))["parts"].values():
            held.update(part)
    old = [name for name in files.file_names(spark, folder) if name.startswith("rows-") and name not in held]
    for name in old:
        files.delete_folder(spark, f"{folder}/{name}")
    return len(old)
