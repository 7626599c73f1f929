"""Train and validation sessions in time order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.config import SESSION_START, VALIDATION_SHARE
from rankwright.operators.ordinals import with_ordinal


def session_order(training: DataFrame) -> DataFrame:
    """(qid, session_start_time, position): sessions numbered by start, then qid."""
    sessions = training.groupBy("qid").agg(F.min(SESSION_START).alias(SESSION_START))
    return with_ordinal(sessions, [SESSION_START, "qid"], "position")


def split_by_time(training: DataFrame, validation_share: float = VALIDATION_SHARE) -> DataFrame:
    """``training`` with ``is_train``: the first int(n * (1 - share)) sessions in time.

    The cut is one session; every row compares its own (start, qid) with it, so
    no list of sessions is joined or held anywhere.
    """
    order = session_order(training)
    cut = int(order.count() * (1 - validation_share))
    if cut == 0:
        return training.withColumn("is_train", F.lit(False))
    last = order.where(F.col("position") == cut - 1)
    cut_start, cut_qid = last.select(SESSION_START).scalar(), last.select("qid").scalar()
    earlier = F.col(SESSION_START) < cut_start
    return training.withColumn("is_train", earlier | ((F.col(SESSION_START) == cut_start) & (F.col("qid") <= cut_qid)))


def group_sizes(training: DataFrame) -> DataFrame:
    """Rows per session."""
    return training.groupBy("qid").agg(F.count("*").alias("group_size"))
