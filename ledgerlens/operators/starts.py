"""K-means from many starts at once.

Every pass over the rows serves all starts of all numbers of clusters: a row is measured against all centers still moving, each
batch adds up counts and sums per start and cluster, and one aggregate joins the batches. A start that stands still drops out, so the
number of passes is that of the slowest start and not the sum over starts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that first centers are drawn from (k-means++); all later steps take every row.
DRAW = 10_000


@dataclass
class Run:
    """One start: its number of clusters, its centers, and their cost as of the last pass."""

    k: int
    start: int
    centers: np.ndarray
    cost: float = np.inf


def _spread_out(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """First centers: each next one is drawn with the squared distance to the nearest center so far."""
    picked = [x[rng.integers(len(x))]]
    far = ((x - picked[0]) ** 2).sum(axis=1)
    while len(picked) < k:
        total = far.sum()
        at = rng.choice(len(x), p=far / total) if total > 0 else rng.integers(len(x))
        picked.append(x[at])
        far = np.minimum(far, ((x - x[at]) ** 2).sum(axis=1))
    return np.array(picked)


def nearest_line(gap: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the first line with the least value in every column, and that value."""
    near, least = np.zeros(gap.shape[1], np.int64), gap[0]
    for j in range(1, len(gap)):
        near[gap[j] < least] = j
        least = np.minimum(least, gap[j])
    return near, least


def _totals(rows: DataFrame, runs: list[Run]) -> dict[tuple[int, int], tuple[float, float, np.ndarray]]:
    """Count, cost and coordinate sums of every cluster of every run, in one pass."""
    dims = runs[0].centers.shape[1]
    stacked = np.concatenate([r.centers for r in runs])
    at = np.cumsum([0, *(r.k for r in runs)])
    square = (stacked**2).sum(axis=1)

    def add_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, cost, sums = np.zeros(len(stacked)), np.zeros(len(stacked)), np.zeros((len(stacked), dims))
        for pdf in batches:
            x = np.array(pdf["x"].tolist(), dtype=float).reshape(-1, dims)
            own = (x**2).sum(axis=1)
            # a line for each center, so that the nearest is found by whole lines and not row by row
            gap = square[:, None] - stacked @ (2 * x).T
            for i in range(len(at) - 1):
                near, least = nearest_line(gap[at[i] : at[i + 1]])
                size = at[i + 1] - at[i]
                n[at[i] : at[i + 1]] += np.bincount(near, minlength=size)
                cost[at[i] : at[i + 1]] += np.bincount(near, weights=np.maximum(least + own, 0), minlength=size)
                for d in range(dims):
                    sums[at[i] : at[i + 1], d] += np.bincount(near, weights=x[:, d], minlength=size)
        yield pd.DataFrame({"cluster": np.arange(len(stacked)), "n": n, "cost": cost, **{f"s{d}": sums[:, d] for d in range(dims)}})

    columns = ["n", "cost", *[f"s{d}" for d in range(dims)]]
    partial = rows.mapInPandas(add_up, "cluster int, " + ", ".join(f"{c} double" for c in columns))
    # one row per center
    got = {r["cluster"]: r for r in partial.groupBy("cluster").agg(*[F.sum(c).alias(c) for c in columns]).collect()}
    out = {}
    for i in range(len(runs)):
        for j in range(runs[i].k):
            r = got[int(at[i]) + j]
            out[i, j] = (r["n"], r["cost"], np.array([r[f"s{d}"] for d in range(dims)]))
    return out


def run_all(vectors: DataFrame, ks: Sequence[int], starts: int, seed: int, max_iter: int = 300, tol: float = 1e-4, features: str = "features") -> list[Run]:
    """The cheapest run for every number of clusters.

    A run ends when its centers move by less than ``tol`` times the mean variance of the coordinates. A cluster that lost all rows
    keeps its center. Of equal costs the first start stays. Without rows there are no runs.
    """
    rows = vectors.select(vector_to_array(features).alias("x"))
    # DRAW rows
    drawn = np.array([r["x"] for r in rows.orderBy(F.xxhash64(F.col("x").cast("string"), F.lit(seed))).limit(DRAW).collect()], dtype=float)
    if not len(drawn):
        return []
    still = tol * float(drawn.var(axis=0).mean())
    runs = [Run(k, i, _spread_out(drawn, k, np.random.default_rng([seed, k, i]))) for k in ks for i in range(starts)]
    moving = runs
    for _ in range(max_iter):
        totals = _totals(rows, moving)
        rest = []
        for i, run in enumerate(moving):
            new = np.array([s / n if n else old for (n, _, s), old in ((totals[i, j], run.centers[j]) for j in range(run.k))])
            run.cost = sum(totals[i, j][1] for j in range(run.k))
            moved = float(((new - run.centers) ** 2).sum())
            run.centers = new
            if moved > still:
                rest.append(run)
        moving = rest
        if not moving:
            break
    # the cost of the centers as they are now
    totals = _totals(rows, runs)
    for i, run in enumerate(runs):
        run.cost = sum(totals[i, j][1] for j in range(run.k))
    return [min((r for r in runs if r.k == k), key=lambda r: (r.cost, r.start)) for k in ks]


def nearest_center(v: Column, centers: np.ndarray) -> Column:
    """Number of the nearest center, the first on ties."""
    home = F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in centers])
    gaps = F.transform(home, lambda c: F.aggregate(F.zip_with(v, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x))
    return (F.array_position(gaps, F.array_min(gaps)) - 1).cast("int")
