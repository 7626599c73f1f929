"""Exact top-k inner products by aggregation without random access.

Each dimension is a list of the vectors sorted by their value there. For a query, a
list is read from the end its weight favours, so contributions fall. All lists are
read to the same depth at a time. A vector's lower bound takes the smallest
contribution for each list it has not appeared in, its upper bound the last one read
there. Reading stops when no vector outside the best k can still reach them; then
only the remaining candidates are read on until their scores are exact.

Vectors and queries are dealt out in blocks of bounded size. Within a pair of blocks,
"read so far" is a comparison of ranks with the depth, so the bounds of all queries
and vectors are a few matrix products per depth, exact in doubles for integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rankwright.llm.common import ship_package

#: Vectors and queries of a block.
VECTOR_BLOCK, QUERY_BLOCK = 4096, 1024
#: Shares of the lists read before the bounds are compared, to their end.
DEPTHS = (0.3, 0.6, 0.8, 0.9, 0.95, 1.0)


def _best(score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -score))[:k]


def block_top_k(
    queries: np.ndarray, query_ids: np.ndarray, vectors: np.ndarray, ids: np.ndarray, k: int, closed: dict[float, int] | None = None
):
    """(query position, vector position, score) of each query's best k in the block, its own row aside.

    ``closed`` counts the queries by the share of the lists that was read when only few
    candidates were left. At the lists' end the bounds are the scores.
    """
    n, d = vectors.shape
    x, q = vectors.astype(np.float64), queries.astype(np.float64)
    up, down = np.maximum(q, 0), np.minimum(q, 0)
    order = np.argsort(x, axis=0, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.arange(n)[:, None], axis=0)
    ordered = np.take_along_axis(x, order, axis=0)
    # The least any list can still give: its far end.
    least = up @ ordered[0] + down @ ordered[-1]
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    open_ = np.arange(len(q))
    alive: dict[int, np.ndarray] = {}
    for share in DEPTHS:
        depth = int(n * share)
        if depth < 1 or not len(open_):
            continue
        high, low = rank >= n - depth, rank < depth  # read from the top, from the bottom
        top, bottom = ordered[n - depth], ordered[depth - 1]  # the last values read
        u, w = up[open_], down[open_]
        # Bounds are seen contributions plus, per unseen list, its limit: subtract the limit where seen.
        upper = u @ (np.where(high, x, top)).T + w @ (np.where(low, x, bottom)).T
        lower = u @ (np.where(high, x, ordered[0])).T + w @ (np.where(low, x, ordered[-1])).T
        own = query_ids[open_][:, None] == ids[None, :]
        lower[own], upper[own] = -np.inf, -np.inf
        if n > k:
            kth = np.partition(lower, n - k, axis=1)[:, n - k]
        else:
            kth = np.full(len(open_), -np.inf)
        can = (upper >= kth[:, None]) & ~own
        few = (can.sum(axis=1) <= max(4 * k, n // 50)) | (depth == n)
        for i in np.flatnonzero(few):
            alive[int(open_[i])] = np.flatnonzero(can[i])
        if closed is not None:
            closed[share] = closed.get(share, 0) + int(few.sum())
        open_ = open_[~few]
    for i, candidates in alive.items():  # only these are read on
        row = x[candidates] @ q[i]
        at = _best(row, ids[candidates], k)
        out.append((np.full(len(at), i), candidates[at], row[at]))
    return out


def top_k(
    vectors: DataFrame, is_query: str, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: int = 256
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``key`` and ``score`` of every query's best ``k`` other rows.

    Components become ``floor(scale * x)``; the score is the integer inner product, ties
    go to the smaller key. Vectors that are null or hold a null or non-finite component,
    and rows with a null key, take no part, neither do vectors of another length than
    the query's. Keys are integers; rows that repeat a key are one row (the greatest
    vector of it). A query with fewer than ``k`` other rows gets all of them. An empty
    table gives no rows; other columns are ignored.
    """
    ship_package(vectors.sparkSession)
    whole = F.transform(F.col(vector), lambda v: F.floor(F.lit(scale) * v.cast("double")).cast("long"))
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    rows = (
        vectors.filter(F.col(vector).isNotNull() & fine & F.col(key).isNotNull())
        .select(F.col(key).cast("long").alias("id"), whole.alias("v"), F.expr(is_query).alias("ask"))
        .groupBy("id").agg(F.max("v").alias("v"), F.max("ask").alias("ask"))
        .withColumn("size", F.size("v"))
    )
    counts = rows.agg(F.count("*"), F.count_if("ask")).first()
    vector_blocks = max(1, -(-counts[0] // VECTOR_BLOCK))
    query_blocks = max(1, -(-counts[1] // QUERY_BLOCK))
    # Every pair of blocks is a group: at most a block of each, give or take the hash's spread.
    candidates = rows.select(
        "id", "v", "size", F.lit(False).alias("query"),
        F.pmod(F.xxhash64("id"), F.lit(vector_blocks)).cast("int").alias("vb"),
        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"),
    )
    asked = rows.filter("ask").select(
        "id", "v", "size", F.lit(True).alias("query"),
        F.explode(F.sequence(F.lit(0), F.lit(vector_blocks - 1))).alias("vb"),
        F.pmod(F.xxhash64("id"), F.lit(query_blocks)).cast("int").alias("qb"),
    )

    def search(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        query = table.column("query").to_numpy(zero_copy_only=False).astype(bool)
        flat = table.column("v").combine_chunks()
        data = flat.flatten().to_numpy().reshape(len(ids), -1)
        qi, vi = np.flatnonzero(query), np.flatnonzero(~query)
        found: list[list] = [[], [], []]
        if len(qi) and len(vi):
            vi = vi[np.argsort(ids[vi])]
            for a, b, score in block_top_k(data[qi], ids[qi], data[vi], ids[vi], k):
                for column, x in zip(found, (ids[qi[a]], ids[vi[b]], score.astype(np.int64)), strict=True):
                    column.append(x)
        columns = [np.concatenate(x) if x else np.empty(0, np.int64) for x in found]
        return pa.table(dict(zip(("query_id", "id", "score"), map(pa.array, columns), strict=True)))

    groups = candidates.unionByName(asked).groupBy("size", "vb", "qb")
    best = groups.applyInArrow(search, "query_id long, id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias(key), "score")
