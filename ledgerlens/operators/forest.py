"""Isolation forest: bounded samples grow the trees, every row is scored."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.functions import scalars as X
from ledgerlens.session import cut, widen

from . import cleaning, neighbours, ordered

EULER = 0.5772156649015329
NODES = "tree int, node int, feature int, threshold double, low int, high int, size int"


def path_length(n: float) -> float:
    """Mean path length of an unsuccessful search among ``n`` points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (np.log(n - 1.0) + EULER) - 2.0 * (n - 1.0) / n


def tree_samples(df: DataFrame, key: str, cols: list[str], trees: int, size: int, seed: int) -> DataFrame:
    """``size`` rows per tree by hash order.

    About twice the rows needed are drawn. A drawn row goes to as many trees in a row as the table is too short
    for one tree each, starting at its hash; of the rows of a tree the first ``size`` by another hash stay.
    """
    rows = df.select(key, *cols)
    need = 2 * trees * size
    n = max(1, rows.count())
    copies = min(trees, -(-need // n))
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = rows.where(unit * F.lit(float(n * copies)) <= F.lit(float(need)))
    start = F.xxhash64(F.col(key), F.lit(seed + 1))
    picked = drawn.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).withColumn("tree", F.pmod(F.pmod(start, F.lit(trees)) + F.col("tree"), F.lit(trees)).cast("int"))
    order = F.xxhash64(F.lit(seed), F.col("tree"), F.col(key))
    w = W.partitionBy("tree").orderBy("h", key)
    return picked.withColumn("h", order).withColumn("r", F.row_number().over(w)).where(F.col("r") <= size)


def grow(sample: pd.DataFrame, cols: list[str], seed: int) -> pd.DataFrame:
    """Random splits of one sample down to depth log2(size); one row per node."""
    tree = int(sample["tree"].iloc[0])
    rng = np.random.default_rng([seed, tree])
    x = sample.sort_values("r")[cols].to_numpy()
    limit = int(np.ceil(np.log2(max(2, len(x)))))
    nodes: list[list] = []
    todo = [(np.arange(len(x)), 0, None)]
    while todo:
        idx, depth, parent = todo.pop()
        me = len(nodes)
        if parent is not None:
            nodes[parent[0]][parent[1]] = me
        span = x[idx].max(axis=0) - x[idx].min(axis=0) if len(idx) else np.zeros(len(cols))
        open_cols = np.flatnonzero(span > 0)
        if depth >= limit or len(idx) <= 1 or not len(open_cols):
            nodes.append([tree, me, -1, 0.0, -1, -1, len(idx)])
            continue
        f = int(rng.choice(open_cols))
        at = float(rng.uniform(x[idx, f].min(), x[idx, f].max()))
        nodes.append([tree, me, f, at, -1, -1, len(idx)])
        left = x[idx, f] <= at
        todo.append((idx[~left], depth + 1, (me, 5)))
        todo.append((idx[left], depth + 1, (me, 4)))
    return pd.DataFrame(nodes, columns=["tree", "node", "feature", "threshold", "low", "high", "size"])


def isolation_scores(df: DataFrame, key: str, cols: list[str], trees: int = 100, size: int = 256, seed: int = 42) -> DataFrame:
    """Anomaly score of every row, near 1 for points that are easy to isolate.

    Columns are standardised; a missing value counts as its column's mean, so that every row gets a score.
    """
    rows = neighbours.filled_with_means(df.select(key, *cols), cols)
    params = cleaning.fit_scaler(rows, cols)
    rows = rows.withColumns({c: (F.col(c) - F.lit(float(params[c][0] or 0.0))) / F.lit(float(params[c][1])) for c in cols})
    samples = tree_samples(rows, key, cols, trees, size, seed)
    grown = samples.groupBy("tree").applyInPandas(lambda part: grow(part, cols, seed), NODES)
    # at most trees * 2 * size rows
    nodes = grown.toPandas().sort_values(["tree", "node"], ignore_index=True)
    first = nodes.groupby("tree")["node"].idxmin().sort_index()
    start = nodes["tree"].map(first).to_numpy()
    forest = {
        "roots": first.to_numpy(),
        "feature": nodes["feature"].to_numpy(),
        "threshold": nodes["threshold"].to_numpy(),
        "low": nodes["low"].to_numpy() + start,
        "high": nodes["high"].to_numpy() + start,
        "rest": nodes["size"].map(path_length).to_numpy(),
    }
    norm = path_length(float(nodes.loc[first.to_numpy(), "size"].max()))
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def score(batches):
        m = shared.value
        for pdf in batches:
            x = pdf[cols].to_numpy(dtype=float)
            at = np.tile(m["roots"], (len(x), 1))  # rows x trees
            line = np.arange(len(x))[:, None]
            depth = np.zeros(at.shape)
            while True:
                feature = m["feature"][at]
                inner = feature >= 0
                if not inner.any():
                    break
                goes_low = x[line, np.maximum(feature, 0)] <= m["threshold"][at]
                at = np.where(inner, np.where(goes_low, m["low"][at], m["high"][at]), at)
                depth += inner
            mean = (depth + m["rest"][at]).mean(axis=1)
            yield pdf[[key]].assign(score=np.power(2.0, -mean / norm))

    kind = dict(df.dtypes)[key]
    return widen(rows).mapInPandas(score, f"`{key}` {kind}, score double")


def isolation_outliers(df: DataFrame, key: str, cols: list[str], contamination: float = 0.1, **options) -> DataFrame:
    """Scores with the top ``contamination`` share flagged."""
    scored = cut(isolation_scores(df, key, cols, **options))
    limit = ordered.quantile_values(scored, ["score"], [1 - contamination])["score"][0]
    return scored.withColumn("is_outlier", F.col("score") > F.lit(limit))
