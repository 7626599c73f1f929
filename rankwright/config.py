"""Settings of a run, as immutable dataclasses."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Names, limits and defaults that results depend on.
EXPECTED_ORDER_ITEMS = {
    "id": "INTEGER",
    "order_id": "INTEGER",
    "user_id": "INTEGER",
    "product_id": "INTEGER",
    "sale_price": "FLOAT",
    "status": "STRING",
    "created_at": "TIMESTAMP",
    "returned_at": "TIMESTAMP",
    "shipped_at": "TIMESTAMP",
    "delivered_at": "TIMESTAMP",
    "inventory_item_id": "INTEGER",
}
POSITIVE_EVENTS = ("cart", "purchase")
CATEGORICAL = ("user_gender", "user_country", "brand")
IDENTITY = ("qid", "user_id", "product_id", "target_label")
SESSION_START = "session_start_time"
UNKNOWN = "Unknown"
MAX_NULLS = 100
CANDIDATES_PER_CATEGORY = 20
VALIDATION_SHARE = 0.2
NDCG_THRESHOLD = 0.65
TREES, LEARNING_RATE, TREE_DEPTH = 150, 0.1, 5
PATIENCE = 15
NDCG_CUTS = (5, 10)
MODEL_NAME = "product-ranker"
ROLLING_WINDOWS = (7, 30, 90, 365)
INTERACTION_WEIGHTS = {"purchase": 5.0, "cart": 3.0, "product": 1.0, "department": 0.5, "home": 0.1, "cancel": -1.0}


@dataclass(frozen=True)
class RankerParams:
    """Boosting settings; ``override`` applies the positive arguments only.

    ``l2`` is added to a leaf's hessian, which shrinks steps of little curvature; a leaf
    holds a hessian of ``min_hessian`` at least. ``folds`` is the number of parts of the
    sessions whose category rates are fitted on the other parts; 0 fits them on all.
    """

    n_trees: int = TREES
    learning_rate: float = LEARNING_RATE
    max_depth: int = TREE_DEPTH
    patience: int = PATIENCE
    seed: int = 42
    l2: float = 1.0
    min_hessian: float = 1e-3
    folds: int = 5

    def override(self, n_trees: int = 0, learning_rate: float = 0.0, max_depth: int = 0) -> RankerParams:
        given = {"n_trees": n_trees, "learning_rate": learning_rate, "max_depth": max_depth}
        return replace(self, **{name: value for name, value in given.items() if value > 0})


@dataclass(frozen=True)
class StoreConfig:
    """Where feature tables and models live and how their versioned names are built.

    Without a ``location`` the database lies in the catalog's warehouse, and without
    a ``model_root`` models lie beside it. Neither may lie in the scratch folder.
    """

    database: str = "rankwright_features"
    version: str = "v1"
    schema_version: int = 1
    location: str | None = None
    model_root: str | None = None

    def table_ref(self, name: str) -> str:
        return f"{self.database}.{name}_{self.version}"


@dataclass(frozen=True)
class RunConfig:
    """Everything one end-to-end run can be told."""

    max_nulls: int = MAX_NULLS
    ignore_null_keys: bool = False
    top_k: int = CANDIDATES_PER_CATEGORY
    validation_share: float = VALIDATION_SHARE
    ndcg_threshold: float = NDCG_THRESHOLD
    feature_group: str = "training_dataset"
    model_name: str = MODEL_NAME
    ranker: RankerParams = field(default_factory=RankerParams)
    store: StoreConfig = field(default_factory=StoreConfig)


def choose_threshold(override: float, default: float = NDCG_THRESHOLD) -> float:
    """An override of zero or less means "use the configured threshold"."""
    return override if override > 0.0 else default
