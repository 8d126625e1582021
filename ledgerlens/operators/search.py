"""Cross-validated grid search over random forests.

Settings that only cut a forest back are read from one grown forest: fewer trees are its first trees, a smaller depth or a larger
split size end the walk down a tree earlier, since a node's split does not depend on what may come below it. Forests are grown
only for what changes a split: the smallest leaf, the class weights and the fold. The rows of a fold are scored for all settings in
one pass and the areas under the curves come from one aggregate.

Depth None is the deepest MLlib grows (30). ``balanced_subsample`` takes the class weights of a bootstrap resample of the training
rows, drawn per forest; ``balanced`` those of the training rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast, inheritable_thread_target
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.session import cut
from ledgerlens.sources import files

from . import evaluation

#: The settings searched (fixed values), in the order in which ties are settled.
GRID = {
    "class_weight": ["balanced", "balanced_subsample"],
    "max_depth": [5, 10, 15, None],
    "min_samples_leaf": [1, 2, 4],
    "min_samples_split": [2, 5, 10],
    "n_estimators": [50, 100, 200],
}
NAMES = list(GRID)
DEEPEST = 30

#: Rows of a batch that walk down all trees at once.
WALK = 1000

#: Forests grown at once where the tasks of one fill the cores: while the driver settles a level of one, the others use them.
OVERLAP = 3


@dataclass(frozen=True)
class Setting:
    class_weight: str
    max_depth: int | None
    min_samples_leaf: int
    min_samples_split: int
    n_estimators: int

    @property
    def depth(self) -> int:
        return DEEPEST if self.max_depth is None else self.max_depth


def settings(grid: dict[str, list] = GRID) -> list[Setting]:
    return [Setting(**dict(zip(NAMES, values))) for values in itertools.product(*[grid[n] for n in NAMES])]


@dataclass
class Forest:
    """The nodes of all trees as arrays; a leaf has feature -1."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    low: np.ndarray
    high: np.ndarray
    rows: np.ndarray
    risk: np.ndarray

    def scores(self, x: np.ndarray, wanted: Sequence[Setting]) -> np.ndarray:
        """Mean probability of the risky class: rows x settings.

        One walk serves all settings: rows go on as far as the smallest split size lets them, and what a larger one holds stays
        behind for good, since a node has no more rows than the one above it. Only pairs of row and tree that still move are looked at.
        """
        out = np.empty((len(x), len(wanted)))
        trees, splits = len(self.roots), sorted({s.min_samples_split for s in wanted})
        for begin in range(0, len(x), WALK):
            part = x[begin : begin + WALK]
            at = {split: np.tile(self.roots, len(part)) for split in splits}
            moving, depth = np.arange(len(part) * trees), 0
            ends = {s.depth for s in wanted}
            while ends:
                here = at[splits[0]][moving]
                inner = (self.feature[here] >= 0) & (self.rows[here] >= splits[0])
                moving, here = moving[inner], here[inner]
                done = {e for e in ends if e == depth or not len(moving)}
                for split in splits if done else ():
                    risk = np.cumsum(self.risk[at[split]].reshape(len(part), trees), axis=1)
                    for i, s in enumerate(wanted):
                        if s.min_samples_split == split and s.depth in done:
                            out[begin : begin + WALK, i] = risk[:, s.n_estimators - 1] / s.n_estimators
                ends -= done
                after = np.where(part[moving // trees, self.feature[here]] <= self.threshold[here], self.low[here], self.high[here])
                for split in splits:
                    on = self.rows[here] >= split
                    at[split][moving[on]] = after[on]
                depth += 1
        return out


def grow(vectors: DataFrame, label: str, classifier: Callable, trees: int, depth: int, leaf: int) -> Forest:
    """Fit a forest with MLlib and read its nodes from the saved model.

    Node ids are not written every ten levels: a number for every row and tree is more than a forest's other work, and each level's are kept
    in memory or on disk anyway.
    """
    model = classifier("random_forest", numTrees=trees, maxDepth=depth, minInstancesPerNode=leaf, cacheNodeIds=True, maxMemoryInMB=512, checkpointInterval=-1).fit(vectors)
    path = files.scratch(vectors.sparkSession, "forest")
    model.write().save(path)
    # as many rows as the model has nodes, which the driver holds already
    n = vectors.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*").select(
        "treeID", "id", "leftChild", "rightChild", "rawCount", F.get("impurityStats", F.lit(0)).alias("safe"), F.coalesce(F.get("impurityStats", F.lit(1)), F.lit(0.0)).alias("risky"),
        F.col("split.featureIndex").alias("feature"),
        F.get(F.col("split.leftCategoriesOrThreshold"), F.lit(0)).alias("threshold"),
    ).toPandas().sort_values(["treeID", "id"], ignore_index=True)
    first = n.groupby("treeID")["id"].idxmin().sort_index().to_numpy()
    begin = n["treeID"].map(dict(zip(sorted(n["treeID"].unique()), first))).to_numpy()
    inner = (n["leftChild"] >= 0).to_numpy()
    safe, risky = n["safe"].to_numpy(), n["risky"].to_numpy()
    low, high = n["leftChild"].to_numpy() + begin, n["rightChild"].to_numpy() + begin
    return Forest(
        first, np.where(inner, n["feature"].to_numpy(), -1), np.where(inner, n["threshold"].astype(float).to_numpy(), 0.0), np.where(inner, low, 0), np.where(inner, high, 0),
        n["rawCount"].to_numpy(), risky / np.maximum(safe + risky, 1e-300),
    )


def _poisson(*parts: Column) -> Column:
    """How often a row is in a bootstrap resample: a Poisson draw of mean 1 by hash."""
    u = F.pmod(F.xxhash64(*parts), F.lit(1 << 40)) / F.lit(float(1 << 40))
    total, term, draw = 0.0, float(np.exp(-1.0)), F.lit(0)
    for k in range(1, 12):
        total += term
        draw = draw + F.when(u > total, 1).otherwise(0)
        term /= k
    return draw


def weighted(rows: DataFrame, label: str, key: str, class_weight: str, seed: int) -> DataFrame:
    """Rows with ``weight``: all rows over twice the rows of the class."""
    counted = rows.withColumn("__m", F.lit(1) if class_weight == "balanced" else _poisson(F.col(key), F.lit(seed)))
    n = {int(r[label]): float(r["n"]) for r in counted.groupBy(label).agg(F.sum("__m").alias("n")).collect()}
    total = sum(n.values())
    each = {y: total / (2 * c) if c else 0.0 for y, c in n.items()}
    weight = F.lit(1.0)
    for y, w in each.items():
        weight = F.when(F.col(label) == y, F.lit(w)).otherwise(weight)
    return rows.withColumn("weight", weight)


def _scored(rows: DataFrame, keep: list[str], shared: Broadcast, pick: Callable[[dict], list[tuple[int, list[Setting], Forest]]]) -> DataFrame:
    """Long scores (keep, setting, risk_score); ``pick`` names the forests (of ``shared``) and settings a group of rows is scored with."""
    types = dict(rows.dtypes)
    out = ", ".join([*(f"`{c}` {types[c]}" for c in keep), "setting int", "risk_score double"])

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for fold, part in pdf.groupby("fold"):
                x = np.array(part["x"].tolist(), dtype=float)
                for numbers, wanted, name in pick(fold):
                    got = shared.value[name].scores(x, wanted)
                    # a block of rows at a time, so that no frame holds all settings of a large batch
                    for a in range(0, len(part), WALK):
                        block = part.iloc[a : a + WALK]
                        long = pd.DataFrame(np.repeat(block[keep].to_numpy(dtype=object), len(wanted), axis=0), columns=keep)
                        yield long.assign(setting=np.tile(numbers, len(block)), risk_score=got[a : a + WALK].ravel())

    return rows.mapInPandas(score, out)


def grid_search(table: DataFrame, features: list[str], label: str, key: str, classifier: Callable, grid: dict[str, list] = GRID, folds: int = 5, parallelism: int = 6, seed: int = 42) -> DataFrame:
    """One row per setting: its values, the mean and deviation of the folds' areas under the curve, its rank and whether it is best.

    Folds are dealt per class and stored once. Of equal means the setting listed first is best.
    """
    listed = settings(grid)
    parts = {str(i): 100 // folds for i in range(folds)}
    train = evaluation.stratified_split(table.where(F.col("split") == "train").drop("split"), label, key, parts)
    packed = VectorAssembler(inputCols=features, outputCol="features").transform(train)
    rows = cut(packed.select(key, label, "features", F.col("split").cast("int").alias("fold")))
    n = rows.count()
    leaves, weights = grid["min_samples_leaf"], grid["class_weight"]
    trees, depth = max(grid["n_estimators"]), max(s.depth for s in listed)

    groups = {}
    for i, s in enumerate(listed):
        groups.setdefault((s.class_weight, s.min_samples_leaf), []).append((i, s))

    def make(what: tuple[str, int, int]) -> str:
        """Grow a forest, write the scores of its fold and let go of it: the driver holds as many forests as are grown at once."""
        weight, leaf, fold = what
        some = weighted(rows.where(F.col("fold") != fold), label, key, weight, seed + fold).select(label, "weight", "features")
        members = groups[weight, leaf]
        shared = rows.sparkSession.sparkContext.broadcast({what: grow(few(some, n), label, classifier, trees, depth, leaf)})
        held = rows.where(F.col("fold") == fold).select(label, "fold", vector_to_array("features").alias("x"))
        scores = _scored(held, [label, "fold"], shared, lambda _: [([i for i, _ in members], [s for _, s in members], what)])
        path = files.write(scores, files.scratch(rows.sparkSession, "scores"))
        shared.destroy()
        return path

    jobs = list(itertools.product(weights, leaves, range(folds)))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    with ThreadPoolExecutor(_at_once(parallelism, cores, _tasks(n, cores))) as pool:
        paths = list(pool.map(inheritable_thread_target(rows.sparkSession)(make), jobs))
    types = dict(rows.dtypes)
    scores = rows.sparkSession.read.schema(f"`{label}` {types[label]}, fold int, setting int, risk_score double").parquet(*paths)
    auc = evaluation.roc_auc(scores, ["setting", "fold"], label)
    means = auc.groupBy("setting").agg(F.avg("roc_auc").alias("mean_auc"), F.stddev_pop("roc_auc").alias("std_auc"))
    values = [(i, *[None if v is None else str(v) for v in (getattr(s, c) for c in NAMES)]) for i, s in enumerate(listed)]
    named = table.sparkSession.createDataFrame(values, "setting int, " + ", ".join(f"{c} string" for c in NAMES))
    return best_first(means.join(F.broadcast(named), "setting"))


def _at_once(parallelism: int, cores: int, tasks: int) -> int:
    """Forests grown at once: enough to fill the cores twice over, and no more, since the driver and the executors hold them all."""
    return max(1, min(parallelism, max(OVERLAP, 2 * cores // tasks)))


#: Rows of a task beyond which a pass takes another round of tasks.
MOST_ROWS = 100_000


def _tasks(rows: int, cores: int, per_task: int = 50_000) -> int:
    """One task for so many rows, but no more than cores; beyond ``MOST_ROWS`` each, whole rounds of tasks, so that none waits for a last few."""
    return max(1, min(-(-rows // per_task), cores * -(-rows // (cores * MOST_ROWS))))


def few(df: DataFrame, rows: int, per_task: int = 50_000, key: str | None = None) -> DataFrame:
    """As many partitions as the rows need: iterative fits pay for every task in every pass.

    Where the table has fewer, rows are dealt out by ``key``, if given, in an order that reruns repeat.
    """
    wanted = _tasks(rows, df.sparkSession.sparkContext.defaultParallelism, per_task)
    if key is None or wanted == 1 or df.rdd.getNumPartitions() >= wanted:
        return df.coalesce(wanted)
    return df.repartition(wanted, key).sortWithinPartitions(key)


def best_first(means: DataFrame) -> DataFrame:
    """Attach ``rank`` (1 for the highest mean; equal means share it) and ``best``, the first listed of rank 1."""
    # one row per setting
    down = W.partitionBy(F.lit(0)).orderBy(F.desc("mean_auc"))
    ranked = means.withColumns({"rank": F.rank().over(down), "__n": F.row_number().over(down.orderBy(F.desc("mean_auc"), "setting"))})
    return ranked.withColumn("best", F.col("__n") == 1).drop("__n")


def refit(table: DataFrame, features: list[str], label: str, key: str, classifier: Callable, chosen: Setting, seed: int = 42) -> DataFrame:
    """Scores of all rows (key, label, split, risk_score) by a forest with the chosen setting, grown on the whole training split."""
    packed = VectorAssembler(inputCols=features, outputCol="features").transform(table)
    rows = cut(packed.select(key, label, "split", "features"))
    train = weighted(rows.where(F.col("split") == "train"), label, key, chosen.class_weight, seed).select(label, "weight", "features")
    forest = grow(few(train, rows.count()), label, classifier, chosen.n_estimators, chosen.depth, chosen.min_samples_leaf)
    held = rows.select(key, label, "split", F.lit(0).alias("fold"), vector_to_array("features").alias("x"))
    shared = table.sparkSession.sparkContext.broadcast({0: forest})
    return _scored(held, [key, label, "split"], shared, lambda _: [([0], [chosen], 0)]).drop("setting")


def best_setting(found: DataFrame) -> Setting:
    """The best row of a search as a setting."""
    r = found.where("best").first()
    number = lambda v: None if v is None else int(v)
    return Setting(r["class_weight"], number(r["max_depth"]), number(r["min_samples_leaf"]), number(r["min_samples_split"]), number(r["n_estimators"]))
