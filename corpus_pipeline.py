"""The corpus pipeline: quality rules, near-duplicates, repeated passages, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwright.llm.common import word_bpe_path
from rankwright.llm.minhash import near_duplicates
from rankwright.llm.packing import pack_documents
from rankwright.llm.quality import CORPUS_RULES, judge_documents
from rankwright.llm.spans import remove_repeats
from rankwright.operators.ordinals import with_ordinal
from rankwright.sources.scratch import materialize

#: The columns of documents, which all stages but the last return.
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _with_text(docs: DataFrame, column: str) -> DataFrame:
    text = F.col(column)
    return docs.withColumns({"text": text, "n_chars": F.length(text).cast("long")}).select(*COLUMNS)


def _numbered(docs: DataFrame) -> DataFrame:
    """``docs`` with a number ``_row`` for every row, ascending with doc_id (null first), by which rows are told apart.

    The doc_id itself where each row has one of its own; else the position in the order of
    doc_ids, for rows that repeat a doc_id or have none.
    """
    rows = docs.select(*COLUMNS)
    if rows.groupBy("doc_id").count().filter("doc_id is null or count > 1").isEmpty():
        return rows.withColumn("_row", F.col("doc_id").cast("long"))
    return with_ordinal(rows.withColumn("_tie", F.monotonically_increasing_id()), ["doc_id", "_tie"], "_row").drop("_tie")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass, with the lines that passed."""
    return _with_text(judge_documents(docs.select(*COLUMNS), CORPUS_RULES).filter("kept"), "clean_text")


def near_duplicate_groups(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group: five-word shingles, a similarity of 0.8 or more.

    The first stays, by doc_id. Rows that repeat a doc_id or have none are members like
    others; rows without words are alone and stay. Empty tables give no rows.
    """
    rows = _numbered(docs)
    gone = near_duplicates(rows, key="_row").filter(~F.col("kept")).select("_row")
    return rows.join(gone, "_row", "left_anti").select(*COLUMNS)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier row, or an earlier place, has, whatever the rows' doc_ids."""
    return _with_text(remove_repeats(_numbered(docs), key="_row"), "clean_text")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences of at most 2048 ids."""
    return pack_documents(docs, word_bpe_path())


STAGES = [
    ("quality rules", quality_rules),
    ("near-duplicates", near_duplicate_groups),
    ("repeated passages", repeated_passages),
    ("packing", packed_sequences),
]

#: Hashed sketches, digests and a tokenizer: no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
