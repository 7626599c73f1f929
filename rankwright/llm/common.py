"""What the operators share: input tables, word patterns, and the tokenizer's place."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, as a Java pattern; everything else belongs to a word.
BLANK = "[\\x20\\x09-\\x0D]"
NOT_BLANK = "[^\\x20\\x09-\\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order; no words give an empty array."""
    return F.array_remove(F.split(text, f"{BLANK}+"), "")


def word_bpe_path() -> str:
    """The vocabulary file the queries use; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def settled(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with the named columns computed once, before anything that reads them.

    Filters on computed columns are otherwise pushed below their computation, which
    then runs once per mention. A generator is a line they do not cross.
    """
    rest = [F.col(c) for c in df.columns if c not in names]
    return df.select(*rest, F.inline(F.array(F.struct(*names))))


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's modules to the Python workers, once per application.

    Workers import them by name, which lets them keep encoders between tasks even
    where the package is installed on the driver alone.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = os.path.join(tempfile.mkdtemp(prefix="rankwright-ship-"), "rankwright_modules.zip")
    with zipfile.ZipFile(path, "w") as out:
        for folder, _, files in os.walk(os.path.join(top, "rankwright")):
            for name in (n for n in files if n.endswith(".py")):
                full = os.path.join(folder, name)
                out.write(full, os.path.relpath(full, top))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)
