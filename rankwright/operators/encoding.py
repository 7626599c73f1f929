"""Categories as integer codes or as mean labels, from a dictionary fitted once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rankwright.config import CATEGORICAL
from rankwright.operators.features import fill_categories
from rankwright.operators.ordinals import with_ordinal
from rankwright.sources.scratch import materialize


def fit_codes(df: DataFrame, columns: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """(column, value, code): values of each column numbered in sorted order from 0.

    One pass finds the distinct values of all columns; the numbering is a
    distributed one, so a column may have any number of values.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    values = fill_categories(df).select(pairs.alias("p")).select("p.*").where(F.col("value").isNotNull()).distinct()
    numbered = with_ordinal(values, ["column", "value"], "position")
    first = numbered.groupBy("column").agg(F.min("position").alias("first"))
    return numbered.join(F.broadcast(first), "column").select(
        "column", "value", (F.col("position") - F.col("first")).alias("code")
    )


def apply_codes(df: DataFrame, codes: DataFrame, columns: tuple[str, ...] = CATEGORICAL) -> DataFrame:
    """``df`` with a ``<column>_code`` per category; unseen values share one extra code.

    The dictionary is joined; Spark broadcasts it as long as its measured size
    is under the session's limit.
    """
    coded = fill_categories(df)
    for column in columns:
        own = codes.where(F.col("column") == column)
        extra = own.select(F.coalesce(F.max("code") + 1, F.lit(0))).scalar()
        known = own.select(F.col("value").alias(column), F.col("code").alias(f"{column}_code"))
        coded = coded.join(known, column, "left").withColumn(f"{column}_code", F.coalesce(f"{column}_code", extra))
    return coded


def fold_of(key: str, folds: int) -> Column:
    """One of ``folds`` parts, by a digest of a key: rows of one key are in one part."""
    digest = F.conv(F.substring(F.sha2(F.coalesce(F.col(key).cast("string"), F.lit("")), 256), 1, 8), 16, 10)
    return (digest.cast("long") % folds).cast("int")


def fit_rates(
    df: DataFrame,
    label: str,
    columns: tuple[str, ...] = CATEGORICAL,
    prior: float = 20.0,
    folds: int = 0,
    key: str = "qid",
) -> DataFrame:
    """(column, value, fold, rate): the mean label of each value, drawn to the overall mean.

    ``prior`` is the number of average rows that are added to each value, so rare values
    stay near the mean. The row with a NULL value holds the overall mean, for unseen
    values. One rule for columns of any size, and one pass for all of them.

    Rows with a NULL fold hold the rates of all rows. With ``folds``, each part of the
    keys has rates of its own, from the rows of the other parts: given to the rows the
    rates were fitted on, they keep a row's label, and its session's, out of its features.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    fold = fold_of(key, folds) if folds else F.lit(None).cast("int")
    # Rows alike in all columns are counted first: the digest is taken once a row, and only counts become pairs.
    alike = (
        fill_categories(df)
        .select(*columns, F.col(label).cast("double").alias("_label"), fold.alias("_fold"))
        .groupBy(*columns, "_fold")
        .agg(F.count("*").alias("_n"), F.sum("_label").alias("_hits"))
    )
    counts = (
        alike.select(pairs.alias("p"), F.col("_fold").alias("fold"), "_n", "_hits")
        .groupBy("p.column", "p.value", "fold")
        .agg(F.sum("_n").alias("n"), F.sum("_hits").alias("hits"))
    )
    if folds:
        counts = _left_out(materialize(counts, "rate-counts"), folds)
    overall = counts.groupBy("column", "fold").agg((F.sum("hits") / F.sum("n")).alias("mean"))
    # One row per column and fold: small enough to broadcast, always.
    rates = (
        counts.where(F.col("value").isNotNull())
        .join(F.broadcast(overall.withColumnsRenamed({"column": "_column", "fold": "_fold"})), F.col("column").eqNullSafe(F.col("_column")) & F.col("fold").eqNullSafe(F.col("_fold")))
        .select("column", "value", "fold", ((F.col("hits") + prior * F.col("mean")) / (F.col("n") + prior)).alias("rate"))
    )
    unseen = overall.where(F.col("mean").isNotNull()).select("column", F.lit(None).cast("string").alias("value"), "fold", F.col("mean").alias("rate"))
    return rates.unionByName(unseen)


def _left_out(counts: DataFrame, folds: int) -> DataFrame:
    """Counts per fold as counts of all (fold NULL) and of all but one fold."""
    whole = counts.groupBy("column", "value").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    own = counts.withColumnsRenamed({"n": "_n", "hits": "_hits", "value": "_value"}).withColumnRenamed("column", "_column")
    every = whole.withColumn("fold", F.explode(F.array(*[F.lit(i) for i in range(folds)])))
    same = F.col("column").eqNullSafe(F.col("_column")) & F.col("value").eqNullSafe(F.col("_value"))
    rest = every.join(own.withColumnRenamed("fold", "_fold"), same & (F.col("fold") == F.col("_fold")), "left").select(
        "column", "value", "fold",
        (F.col("n") - F.coalesce("_n", F.lit(0))).alias("n"), (F.col("hits") - F.coalesce("_hits", F.lit(0.0))).alias("hits"),
    )
    return rest.where("n > 0").unionByName(whole.withColumn("fold", F.lit(None).cast("int")).select("column", "value", "fold", "n", "hits"))


def apply_rates(
    df: DataFrame, rates: DataFrame, columns: tuple[str, ...] = CATEGORICAL, fold: Column | None = None
) -> DataFrame:
    """``df`` with a ``<column>_rate`` per category; unseen values get the overall mean.

    ``fold`` gives the part a row belongs to, for rows the rates were fitted on, and NULL
    for others.
    """
    rated = fill_categories(df).withColumn("_fold", fold if fold is not None else F.lit(None).cast("int"))
    for column in columns:
        own = rates.where(F.col("column") == column)
        known = own.where(F.col("value").isNotNull()).select(
            F.col("value").alias("_value"), F.col("fold").alias("_of"), F.col("rate").alias(f"{column}_rate")
        )
        # One row per fold.
        means = own.where(F.col("value").isNull()).select(F.col("fold").alias("_of"), F.col("rate").alias("_mean"))
        same = (F.col(column) == F.col("_value")) & F.col("_fold").eqNullSafe(F.col("_of"))
        rated = rated.join(known, same, "left").drop("_value", "_of")
        rated = rated.join(F.broadcast(means), F.col("_fold").eqNullSafe(F.col("_of")), "left").drop("_of")
        rated = rated.withColumn(f"{column}_rate", F.coalesce(f"{column}_rate", "_mean", F.lit(0.0))).drop("_mean")
    return rated.drop("_fold")
