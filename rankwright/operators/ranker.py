"""A LambdaMART ranker for NDCG, boosted on DataFrames.

Each round compares a session's rows with its k leaders under the current
score, turns the NDCG@k changes of the swaps into gradients (Burges, "From
RankNet to LambdaRank to LambdaMART", 2010), and grows a tree on histograms of
features that were binned once, with Newton steps in its leaves.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rankwright.config import CATEGORICAL, NDCG_CUTS, RankerParams
from rankwright.operators import blocks
from rankwright.operators.encoding import apply_rates, fit_rates, fold_of
from rankwright.operators.histogram import Tree, fit_bounds, grow_tree, with_bins, with_step
from rankwright.operators.lambdas import PAIR_UNIT, ROW_UNIT
from rankwright.operators.ndcg import discount_sum, session_ndcg, session_totals
from rankwright.operators.trees import TREE_TABLE, read_trees, tree_rows, tree_score, tree_table
from rankwright.sources import files
from rankwright.sources.scratch import materialize, new_name, new_path

NUMERIC = ("user_age", "retail_price", "cost", "profit_margin")
FEATURES = NUMERIC + tuple(f"{c}_rate" for c in CATEGORICAL)
ROWS_PER_SALT = 1 << 20
ROWS_PER_TASK = 1 << 20
ROUNDS_PER_WRITE = 10
TASKS_ADDED = 64
KEYS = ("qid", "user_id", "product_id")


@dataclass(frozen=True)
class Ranker:
    """Trees, their common rate, and the category rates they were grown on."""

    trees: tuple[Tree, ...]
    learning_rate: float
    rates: DataFrame

    def score(self, rows: DataFrame) -> DataFrame:
        """``rows`` with a ``score``: all trees in one expression over the features."""
        known = assemble(rows, self.rates)
        score = tree_score(self.trees, self.learning_rate, [F.col(f"_{c}") for c in FEATURES])
        return known.withColumn("score", score).drop(*[f"_{c}" for c in FEATURES])

    def table(self) -> DataFrame:
        """The trees as rows, one per node."""
        return tree_table(self.rates.sparkSession, self.trees, FEATURES)

    def save(self, path: str) -> None:
        """The table of trees, the category rates and the learning rate, under one folder."""
        spark = self.rates.sparkSession
        self.table().write.mode("overwrite").parquet(f"{path}/trees")
        self.rates.write.mode("overwrite").parquet(f"{path}/rates")
        settings = json.dumps({"learning_rate": self.learning_rate})
        spark.createDataFrame([(settings,)], "settings string").write.mode("overwrite").json(f"{path}/settings")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Ranker:
        settings = json.loads(spark.read.json(f"{path}/settings").first()["settings"])
        trees = read_trees(spark.read.schema(TREE_TABLE).parquet(f"{path}/trees").collect(), FEATURES)
        return Ranker(trees, settings["learning_rate"], spark.read.parquet(f"{path}/rates"))


@dataclass(frozen=True)
class Training:
    """A fitted ranker with its learning curve, one entry per round."""

    ranker: Ranker
    curve: list[dict]
    best_round: int


_PARTS = ("is_train", "qid")


def assemble(rows: DataFrame, rates: DataFrame, fold: Column | None = None) -> DataFrame:
    """``rows`` with a double ``_<feature>`` each: numbers, and each category's mean label in training.

    Every category is treated alike, whatever its number of values. ``fold`` is for the
    rows the rates were fitted on: it names the part of them a row's rates leave out.
    """
    rated = apply_rates(rows, rates, fold=fold)
    missing = F.lit(-1.0)
    numbers = {f"_{c}": F.coalesce(F.nanvl(F.col(c).cast("double"), missing), missing) for c in NUMERIC}
    return rated.withColumns(numbers).withColumnsRenamed({f"{c}_rate": f"_{c}_rate" for c in CATEGORICAL})


def _with_salt(rows: DataFrame) -> DataFrame:
    """``rows`` with a salt that splits sessions of more than ROWS_PER_SALT rows."""
    sizes = rows.groupBy("qid").agg(F.ceil(F.count("*") / ROWS_PER_SALT).alias("_parts"))
    spread = F.pmod(F.xxhash64("user_id", "product_id"), F.col("_parts"))
    return rows.join(sizes, "qid").withColumn("salt", spread).drop("_parts")


def _leaders(scored: DataFrame, k: int, keys: list[str]) -> DataFrame:
    """The k best-scored rows of every session, as bounded arrays.

    ``ids`` holds their (product, user) in rank order; ``hits`` and ``misses``
    hold rank and score of the positive ones and of the others.
    """
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "product_id", "user_id")
    ranked = scored.select(*keys, "product_id", "user_id", "score", "target_label", F.row_number().over(order).alias("rank"))
    row = F.struct("rank", "score", "product_id", "user_id", "target_label")
    top = ranked.where(F.col("rank") <= k).groupBy(*keys).agg(F.array_sort(F.collect_list(row)).alias("top"))

    def of_label(value: int) -> Column:
        return F.transform(F.filter("top", lambda r: r.target_label == value), lambda r: F.struct(r["rank"], r.score))

    return top.select(
        *keys,
        F.transform("top", lambda r: F.struct(r.product_id, r.user_id)).alias("ids"),
        of_label(1).alias("hits"),
        of_label(0).alias("misses"),
    )


def _discount(rank: Column) -> Column:
    """1 / log2(1 + rank); 0 for rank 0, which stands for "below the cut"."""
    return F.when(rank > 0, 1.0 / F.log2(1.0 + rank)).otherwise(0.0)


def _exact(value: Column) -> Column:
    return F.rint(value * PAIR_UNIT).cast("long")


def _total(pairs: Column, name: str) -> Column:
    return F.aggregate(pairs, F.lit(0).cast("long"), lambda sum_, pair: sum_ + pair[name])


def _session_keys(split: bool) -> list[str]:
    """What names a session: with its salt, by which rows are laid out, unless one is split."""
    return ["qid"] if split else ["qid", "salt"]


def compare_with_leaders(scored: DataFrame, parts: DataFrame, k: int, split: bool = True) -> DataFrame:
    """Every row against the k leaders of its session whose label differs.

    Swapping two rows changes NDCG@k only if one of them is among the session's
    first k, so comparing each row with those k and no others is exact, and
    linear in the rows. ``parts`` has (qid, salt, idcg) of sessions that count; ``split``
    says that some have several salts. Adds the row's own ``pull`` (negative gradient)
    and ``hessian`` in whole numbers of 1 / PAIR_UNIT, its ``rank`` (0 below the cut)
    and, for rows below the cut, the ``pairs`` they had.
    """
    keys = _session_keys(split)
    placed = parts.join(_leaders(scored, k, keys), keys)
    positive = F.col("target_label") == 1
    wants = F.when(positive, 1.0).otherwise(-1.0)

    def against(row: Column) -> Column:
        wrong = 1.0 / (1.0 + F.exp(wants * (F.col("score") - row.score)))
        weight = F.abs(_discount(row["rank"]) - F.col("own_discount")) / F.col("idcg")
        return F.struct(
            row["rank"].alias("rank"),
            _exact(wants * wrong * weight).alias("pull"),
            _exact(wrong * (1.0 - wrong) * weight).alias("hessian"),
        )

    return (
        scored.join(placed, ["qid", "salt"])
        .withColumn("rank", F.array_position("ids", F.struct("product_id", "user_id")).cast("int"))
        .withColumn("own_discount", _discount(F.col("rank")))
        .withColumn("pairs", F.transform(F.when(positive, F.col("misses")).otherwise(F.col("hits")), against))
        .withColumns({c: _total(F.col("pairs"), c) for c in ("pull", "hessian")})
        .withColumn("pairs", F.when(F.col("rank") == 0, F.col("pairs")))
        .drop("ids", "hits", "misses", "idcg", "own_discount")
    )


def gather_lambdas(compared: DataFrame, parts: DataFrame, split: bool = True) -> DataFrame:
    """``compared`` with the pulls that leaders get from rows below the cut, and all as doubles.

    Those pairs are known to the lower row only; it sends the opposite pull
    back, summed per leader before any shuffle.
    """
    keys = _session_keys(split)
    returned = (
        compared.where(F.col("rank") == 0)
        .select(*keys, F.explode("pairs").alias("pair"))
        .groupBy(*keys, "pair.rank")
        .agg(-F.sum("pair.pull"), F.sum("pair.hessian"))
        .toDF(*keys, "rank", "pull", "hessian")
        .groupBy(*keys)
        .agg(F.collect_list(F.struct("rank", "pull", "hessian")).alias("returned"))
    )
    if split:
        returned = parts.join(returned, "qid").drop("idcg")
    back = F.get(F.filter("returned", lambda row: row["rank"] == F.col("rank")), 0)
    received = {c: (F.col(c) + F.coalesce(back[c], F.lit(0))) / PAIR_UNIT for c in ("pull", "hessian")}
    return compared.join(returned, ["qid", "salt"], "left").withColumns(received).drop("pairs", "returned", "rank")


def session_lambdas(scored: DataFrame, k: int) -> DataFrame:
    """``pull`` and ``hessian`` of every row of sessions with a positive, under a given score.

    Where no session is split, ids are numbers and none is missing, whole sessions meet in tasks of so many
    rows and are compared on arrays; otherwise joins and windows find the same values.
    """
    known = F.col("score").isNotNull() & ~F.isnan("score") & F.col("target_label").isin(0, 1)
    known = known & F.col("product_id").isNotNull() & F.col("user_id").isNotNull()
    sizes = scored.where("qid is not null").groupBy("qid").agg(F.count("*").alias("n"), F.count_if(~F.coalesce(known, F.lit(False))).alias("odd"))
    n_rows, longest, odd = sizes.agg(F.sum("n"), F.max("n"), F.sum("odd")).first()
    numbered = all(scored.schema[c].dataType.simpleString() in ("bigint", "int") for c in (*KEYS, "target_label"))
    if n_rows and longest <= ROWS_PER_SALT and not odd and numbered and dict(scored.dtypes)["score"] == "double":
        whole = scored.where("qid is not null").repartition(_task_count(scored.sparkSession, n_rows), "qid")
        return blocks.with_lambdas(whole, k)
    rows = _with_salt(scored).withColumn("is_train", F.lit(True))
    stored = materialize(rows, "lambda-rows")
    parts = materialize(_parts(stored, session_totals(stored, by=_PARTS), k), "lambda-parts")
    return gather_lambdas(compare_with_leaders(stored, parts, k), parts).drop("salt", "is_train")


def _parts(rows: DataFrame, totals: DataFrame, k: int) -> DataFrame:
    """(qid, salt, idcg) of every part of the training sessions with a positive."""
    counted = totals.where(F.col("is_train") & (F.col("positives") > 0))
    ideal = counted.select("qid", discount_sum(k, F.col("positives")).alias("idcg"))
    return rows.where("is_train").select("qid", "salt").distinct().join(ideal, "qid")


def _task_count(spark: SparkSession, n_rows: int) -> int:
    """Partitions are counted by rows, for every tree passes over all of them many times."""
    return max(spark.sparkContext.defaultParallelism, math.ceil(n_rows / ROWS_PER_TASK))


def _placed(rows: DataFrame, n_rows: int) -> DataFrame:
    """``rows`` held with each session part together.

    What is lost from memory is read again from the folder ``rows`` lie in. The layout
    serves all rounds: what they do per (session, salt) moves no rows.
    """
    return rows.repartition(_task_count(rows.sparkSession, n_rows), "qid", "salt").persist()


@dataclass
class _Fit:
    """What a fit needs to go on after a round."""

    rows: str  # folder of the rows with bins and score, or of their blocks
    rates: str  # folder of the category rates
    n_rows: int
    split: bool
    bounds: list[list[float]]
    params: dict
    cuts: list[int]
    trees: list[Tree]
    curve: list[dict]
    best: float = -1.0
    best_round: int = 0
    packed: bool = False  # whether ``rows`` holds blocks

    def text(self) -> str:
        return json.dumps({**{name: value for name, value in vars(self).items() if name != "trees"}, "trees": tree_rows(tuple(self.trees), FEATURES)})

    @staticmethod
    def read(text: str) -> _Fit:
        found = json.loads(text)
        names = [part.split()[0] for part in TREE_TABLE.split(", ")]
        rows = [dict(zip(names, row, strict=True)) for row in found.pop("trees")]
        return _Fit(trees=list(read_trees(rows, FEATURES)), **found)


def _latest(spark: SparkSession, state: str, params: RankerParams, cuts: tuple[int, ...]) -> _Fit | None:
    """The state of the last round that was published whole, if a fit was begun there."""
    names = [name for name in files.file_names(spark, state) if name.endswith(".json")]
    if not names:
        return None
    found = _Fit.read(files.read_text(spark, f"{state}/{names[-1]}"))
    if found.params != asdict(params) or found.cuts != list(cuts):
        raise ValueError(f"{state} holds a fit with other settings: {found.params}, {found.cuts}")
    return found


def _begin(training: DataFrame, params: RankerParams, cuts: tuple[int, ...], place: str) -> _Fit:
    """Rates, bins and the rows of a new fit, written under ``place``."""
    spark = training.sparkSession
    train = training.where("is_train")
    rates = fit_rates(train, "target_label", folds=params.folds)
    rates.write.parquet(f"{place}/rates")
    rates = spark.read.schema(rates.schema).parquet(f"{place}/rates")
    fold = F.when(F.col("is_train"), fold_of("qid", params.folds)) if params.folds else None
    named = training.where("qid is not null")
    longest = named.groupBy("qid").count().agg(F.max("count")).first()[0] or 0
    salted = _with_salt(named) if longest > ROWS_PER_SALT else named.withColumn("salt", F.lit(0).cast("long"))
    columns = [f"_{c}" for c in FEATURES]
    # Only what the fit reads is written, and sessions are moved once, to be packed.
    features = assemble(salted, rates, fold).select(*KEYS, "salt", "is_train", "target_label", *columns)
    known = materialize(features, "ranker-features")
    positive = F.col("target_label") == 1
    n_rows, salt, train_hits, hits = known.agg(
        F.count("*"), F.max("salt"), F.count_if(positive & F.col("is_train")), F.count_if(positive & ~F.col("is_train"))
    ).first()
    for part, found in (("training", train_hits), ("validation", hits)):
        if not found:
            raise ValueError(f"the {part} part has no session with a positive")
    bounds = fit_bounds(known.where("is_train"), columns)
    rows = with_bins(known, columns, bounds).select(*KEYS, "salt", "is_train", "target_label", "bins", F.lit(0.0).alias("score"))
    if not salt:
        rows = blocks.pack(rows.repartition(_task_count(spark, n_rows), "qid"))
    rows.write.parquet(f"{place}/rows-0")
    return _Fit(f"{place}/rows-0", f"{place}/rates", n_rows, bool(salt), bounds, asdict(params), list(cuts), [], [], packed=not salt)


def fit_ranker(
    training: DataFrame,
    params: RankerParams = RankerParams(),
    cuts: tuple[int, ...] = NDCG_CUTS,
    state: str | None = None,
) -> Training:
    """Boost until the validation NDCG of the last cut has not improved for ``patience`` rounds.

    ``training`` holds ``is_train``; both parts need a session with a positive. One row of
    metrics per round and the sums of a tree's level reach the driver. Each round adds one
    tree to the scores of the round before; every few rounds they are written and the
    version before goes, so neither plans, recomputation nor disk grow with the rounds.

    ``state`` is a folder that outlives the application. What is written every few rounds
    is published there, rows with scores, trees, curve and best round, and a fit that
    finds a state goes on from it: with the same rows it gives the trees and scores
    of an unbroken one. Without it the rows go to the application's scratch folder.
    """
    spark = training.sparkSession
    place = state.rstrip("/") if state else new_path(spark, "ranker")
    fit = _latest(spark, place, params, cuts) if state else None
    if fit and fit.n_rows != training.count():
        raise ValueError(f"{place} holds a fit on {fit.n_rows} rows")
    if fit is None:
        fit = _begin(training, params, cuts, f"{place}/{new_name()}")
        if state:
            files.publish_text(spark, f"{place}/{0:06d}.json", fit.text())
    folder = fit.rows.rsplit("/", 1)[0]
    rates = spark.read.parquet(fit.rates)
    # The loop's plans are small and their layout is given: nothing is left to find out while they run.
    quick = spark.newSession()
    quick.conf.set("spark.sql.adaptive.enabled", "false")
    quick.conf.set("spark.sql.shuffle.partitions", str(_task_count(spark, fit.n_rows)))
    # Blocks reach a worker one by one, and a file of them is a task, as it was written.
    quick.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "1m")
    quick.conf.set("spark.sql.files.maxPartitionBytes", "4g")
    quick.conf.set("spark.sql.files.openCostInBytes", "4g")
    make = _Rounds if fit.split else _BlockRounds
    rounds = make(quick, fit, cuts)

    def over() -> bool:
        return len(fit.curve) >= params.n_trees or len(fit.curve) - fit.best_round >= params.patience

    while not over():
        number = len(fit.curve) + 1
        tree, metrics = rounds.boost(params)
        fit.trees.append(tree)
        fit.curve.append({"round": number, **metrics})
        current = metrics[f"validation_ndcg_{cuts[-1]}"]
        if current > fit.best:
            fit.best, fit.best_round = current, number
        if number % ROUNDS_PER_WRITE == 0 or (state and over()):
            before, fit.rows, fit.packed = fit.rows, f"{folder}/rows-{number}-{new_name()}", not fit.split
            rounds.write(fit.rows)
            if state:
                files.publish_text(spark, f"{place}/{number:06d}.json", fit.text())
            files.delete_folder(spark, before)
            if not over():
                rounds.close()
                rounds = make(quick, fit, cuts)
    rounds.close()
    return Training(Ranker(tuple(fit.trees[: fit.best_round]), params.learning_rate, rates), fit.curve, fit.best_round)


class _BlockRounds:
    """Between two writes, the rows of a fit in which no session is split: one stored frame of blocks a round.

    A round is one job per level of its tree: the job that finds the gradients under a score
    also gives the metrics and the sums of the next tree's root. Its rows do not move.
    """

    def __init__(self, spark: SparkSession, fit: _Fit, cuts: tuple[int, ...]):
        self.fit, self.cuts = fit, cuts
        self.width = max(len(found) for found in fit.bounds) + 1
        # Few tasks' sums are added up by the driver: a shuffle would take longer than they do.
        self.sums_of = blocks.task_sums if _task_count(spark, fit.n_rows) <= TASKS_ADDED else blocks.tree_sums
        self._value(blocks.with_values(spark.read.parquet(fit.rows), cuts))

    def _value(self, valued: DataFrame) -> None:
        """Rows under a new score, with the sums of their NDCGs and of the next tree's root."""
        self.current = valued.persist()
        root = Tree((0,), (self.width,), (0.0,), (0,), (0,), (0.0,))
        self.root = self.sums_of(self.current, root, 0, [0], self.width, len(self.cuts)).toArrow()

    def _sums(self, tree: Tree, steps: int, wanted: list[int], width: int) -> pa.Table:
        if steps == 0:
            return self.root.filter(pa.compute.equal(self.root["node"], 0))
        return self.sums_of(self.current, tree, steps, wanted, width).toArrow()

    def boost(self, params: RankerParams) -> tuple[Tree, dict]:
        """One more tree, and the metrics with it."""
        tree = grow_tree(self._sums, self.fit.bounds, params.max_depth, params.l2, params.min_hessian)
        before = self.current
        self._value(blocks.with_values(before, self.cuts, tree, params.learning_rate))
        before.unpersist()
        return tree, _mean_ndcgs(self.cuts, blocks.ndcg_means(self.root, PAIR_UNIT))

    def write(self, path: str) -> None:
        self.current.select(*blocks.KEPT).write.parquet(path)

    def close(self) -> None:
        self.current.unpersist()


class _Rounds:
    """As ``_BlockRounds``, for sessions of any size: joins and windows find their gradients and NDCG."""

    def __init__(self, spark: SparkSession, fit: _Fit, cuts: tuple[int, ...]):
        self.fit, self.k, self.cuts = fit, max(cuts), cuts
        placed = _placed(spark.read.schema(_ROWS).parquet(fit.rows), fit.n_rows)
        self.held = [placed]
        self.totals = materialize(session_totals(placed, by=_PARTS), "session-totals")
        self.parts = materialize(_parts(placed, self.totals, self.k), "session-parts")
        self.current = self._valued(placed)

    def _valued(self, scored: DataFrame) -> DataFrame:
        scored = scored.select(*[c.split()[0] for c in _ROWS.split(", ")]).persist()
        compared = compare_with_leaders(scored.where("is_train"), self.parts, self.k).persist()
        exact = {c: F.rint(F.col(c) * ROW_UNIT).cast("long") for c in ("pull", "hessian")}
        pulled = gather_lambdas(compared, self.parts).withColumns(exact)
        rest = scored.where("not is_train").withColumns({c: F.lit(0).cast("long") for c in exact})
        # Training sessions without a positive have no gradients, but a score.
        other = scored.where("is_train").join(self.parts.select("qid", "salt"), ["qid", "salt"], "left_anti")
        other = other.withColumns({c: F.lit(0).cast("long") for c in exact})
        found = pulled.select(*rest.columns).unionByName(rest).unionByName(other.select(*rest.columns)).persist()
        self.held += [scored, compared]
        return found

    def boost(self, params: RankerParams) -> tuple[Tree, dict]:
        """One more tree, and the metrics with it."""
        tree = grow_tree(self.current.where("is_train"), self.fit.bounds, params.max_depth, params.l2, params.min_hessian)
        stepped = self._valued(with_step(self.current, tree, params.learning_rate))
        metrics = _round_metrics(stepped, self.cuts, self.totals)
        self.current.unpersist()
        for frame in self.held[:-2]:
            frame.unpersist()
        self.held = self.held[-2:]
        self.current = stepped
        return tree, metrics

    def write(self, path: str) -> None:
        self.current.select(*[c.split()[0] for c in _ROWS.split(", ")]).write.parquet(path)

    def close(self) -> None:
        for frame in (*self.held, self.current):
            frame.unpersist()


_ROWS = (
    "qid long, user_id long, product_id long, salt long, is_train boolean, target_label int, bins array<int>, score double"
)


def _round_metrics(scored: DataFrame, cuts: tuple[int, ...], totals: DataFrame) -> dict:
    """Mean NDCGs of both parts, as one job. Sessions are summed in whole numbers, in any order alike."""
    found = session_ndcg(scored, cuts, by=_PARTS, totals=totals)
    per_session = found.select("is_train", *[_exact(F.col(f"ndcg_{k}")).cast("decimal(20,0)").alias(f"ndcg_{k}") for k in cuts])
    rows = per_session.groupBy("is_train").agg(
        *[F.sum(f"ndcg_{k}").alias(f"sum_{k}") for k in cuts], *[F.count(f"ndcg_{k}").alias(f"n_{k}") for k in cuts]
    )
    means = {row["is_train"]: row for row in rows.collect()}

    def mean(flag: bool, cut: int) -> float:
        row, k = means.get(flag), cuts[cut]
        return int(row[f"sum_{k}"]) / row[f"n_{k}"] / PAIR_UNIT if row and row[f"n_{k}"] else 0.0

    return _mean_ndcgs(cuts, mean)


def _mean_ndcgs(cuts: tuple[int, ...], mean: Callable[[bool, int], float]) -> dict:
    """The metrics of a round, from the mean of a part at the place of a cut."""
    return {f"{part}_ndcg_{k}": mean(flag, i) for part, flag in (("train", True), ("validation", False)) for i, k in enumerate(cuts)}
