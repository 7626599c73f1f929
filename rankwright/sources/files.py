"""Small text files in any folder Spark can write, published whole or not at all."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _hadoop(spark: SparkSession):
    return spark._jvm.org.apache.hadoop.fs


def _path(spark: SparkSession, path: str):
    """A Hadoop path with its file system."""
    found = _hadoop(spark).Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def file_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder; none if there is no folder."""
    path, system = _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def read_text(spark: SparkSession, path: str) -> str:
    found, system = _path(spark, path)
    stream = system.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that is not there yet; False if another writer was first.

    The text is written beside its place and renamed, so readers never see a part of it.
    """
    target, system = _path(spark, path)
    system.mkdirs(target.getParent())
    draft = _hadoop(spark).Path(target.getParent(), f".{uuid.uuid4().hex}.draft")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = _hadoop(spark).FileContext.getFileContext(draft.toUri(), spark._jsc.hadoopConfiguration())
    options = spark._jvm.java.lang.reflect.Array.newInstance(spark._jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(draft), context.makeQualified(target), options)
    except Py4JJavaError as error:
        system.delete(draft, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def delete_folder(spark: SparkSession, path: str) -> None:
    found, system = _path(spark, path)
    system.delete(found, True)
