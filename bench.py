"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINES = (
    "validation_checks",
    "positive_samples",
    "popularity_asof",
    "top_products_per_category",
    "training_set",
    "validation_stats",
    "interaction_scores",
    "rolling_user_activity",
    "user_features",
    "product_features",
    "interaction_features",
    "temporal_features",
    "user_item_matrix",
    "split_train",
    "ndcg_at_5",
    "recommend_top_k",
    "categorical_encode",
    "ranker_lambdas",
    "early_stop",
    "ranker_rounds",
)
ROUNDS = 10


def main() -> None:
    from pyspark.sql import SparkSession

    from rankwright.config import RankerParams
    from rankwright.operators.ranker import fit_ranker
    from rankwright.operators.split import split_by_time
    from rankwright.plans.queries import queries

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    scratch = tempfile.mkdtemp(prefix="rankwright-bench-")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .config("spark.checkpoint.dir", f"{scratch}/shared")
        # Kilobytes of input unfold into millions of rows here; keep all cores busy.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    known["session_start"](spark, sf_dir).count()  # start-up cost belongs to no query
    seconds = {}

    def timed(name: str, run) -> None:
        begin = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - begin, 3)

    def drain(name: str):
        return known[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    def rounds():
        """A fixed number of boosting rounds, stopping aside."""
        split = split_by_time(known["training_set"](spark, sf_dir))
        fit_ranker(split, RankerParams(n_trees=ROUNDS, patience=ROUNDS))

    for name in HEADLINES:
        if name == "ranker_rounds":
            timed(f"ranker_{ROUNDS}_rounds", rounds)
        else:
            if name == "split_train":  # what the queries from here on share is a time of its own
                timed("shared_training_set", lambda: known["group_sizes"](spark, sf_dir).count())
            timed(name, lambda name=name: drain(name))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
