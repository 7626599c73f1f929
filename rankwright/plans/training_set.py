"""The training set: from events, sales and dimensions to labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rankwright.config import CANDIDATES_PER_CATEGORY, SESSION_START
from rankwright.operators.candidates import labelled_samples
from rankwright.operators.features import attach_features
from rankwright.operators.popularity import top_products_as_of, top_products_by_moment
from rankwright.operators.sessions import met_products, positive_samples, session_starts
from rankwright.sources.scratch import materialize
from rankwright.sources.tables import Tables


def dated_positives(tables: Tables) -> DataFrame:
    """Positive samples with their session's start, from one pass over the events.

    What a session met is written once: its positives and its start are read from there.
    """
    met = materialize(met_products(tables.events, tables.products), "met-products")
    return positive_samples(met).join(session_starts(met), "session_id")


def _moments(positives: DataFrame) -> DataFrame:
    return positives.select(F.col("current_session_category").alias("category"), SESSION_START)


def top_products(positives: DataFrame, tables: Tables, k: int = CANDIDATES_PER_CATEGORY) -> DataFrame:
    """The top products at the start of every session, in its positives' categories."""
    return top_products_as_of(_moments(positives), tables.products, tables.order_items, SESSION_START, k)


def moments_and_tops(positives: DataFrame, tables: Tables, k: int = CANDIDATES_PER_CATEGORY) -> tuple[DataFrame, DataFrame]:
    """``top_products`` in two frames: the moment of every session start, and the top products by moment."""
    return top_products_by_moment(_moments(positives), tables.products, tables.order_items, SESSION_START, k)


def training_set(tables: Tables, k: int = CANDIDATES_PER_CATEGORY) -> DataFrame:
    """Session-grouped rows with label and features, free of later information.

    The positives feed three consumers, so they are written once: re-deriving
    them would read and shuffle the events again each time.
    """
    positives = materialize(dated_positives(tables), "positives")
    asked, tops = moments_and_tops(positives, tables, k)
    samples = labelled_samples(positives, tops, asked, k)
    return attach_features(samples, tables.users, tables.products)
