"""Iterative imputation: each column with gaps is regressed on the others, round after round.

A filled value is a linear function of the row's own present values, the same one for all rows with the same gaps. The
table is therefore read once for the cross products of the present values per pattern of gaps; all
rounds run on those small matrices, and the functions they end with fill the rows in one projection. Nothing is written in between.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass
class Patterns:
    """What the rounds need of a table: scale of every column and cross products per pattern of gaps.

    ``sums[p]`` holds the sums of products of (1, scaled values) over the rows with pattern ``p``, bit ``i`` of which
    says that column ``i`` is missing; missing values are 0 in it, which is their column's mean.
    """

    cols: list[str]
    mean: np.ndarray
    scale: np.ndarray
    sums: dict[int, np.ndarray] = field(default_factory=dict)

    def gaps(self) -> list[int]:
        """Columns with missing values, fewest first as far as they have values at all."""
        lost = [sum(s[0, 0] for p, s in self.sums.items() if p >> i & 1) for i in range(len(self.cols))]
        total = sum(s[0, 0] for s in self.sums.values())
        return sorted((i for i, n in enumerate(lost) if 0 < n < total), key=lambda i: (lost[i], i))


def _plain(c: str) -> Column:
    return F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double"))


def _pattern(cols: list[str]) -> Column:
    out = F.lit(0).cast("bigint")
    for i, c in enumerate(cols):
        out = out + F.when(_plain(c).isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    return out


def observe(df: DataFrame, cols: list[str]) -> Patterns:
    """Two aggregates: means and deviations, then the cross products (one row per pattern of gaps that occurs)."""
    stats = df.agg(*[e for i, c in enumerate(cols) for e in (F.avg(_plain(c)).alias(f"m{i}"), F.stddev_pop(_plain(c)).alias(f"s{i}"))]).first()
    mean = np.array([stats[f"m{i}"] or 0.0 for i in range(len(cols))])
    scale = np.array([stats[f"s{i}"] or 1.0 for i in range(len(cols))])
    scaled = [F.coalesce((_plain(c) - F.lit(float(m))) / F.lit(float(s)), F.lit(0.0)).alias(f"z{i}") for i, (c, m, s) in enumerate(zip(cols, mean, scale))]
    z = [F.lit(1.0), *[F.col(f"z{i}") for i in range(len(cols))]]
    pairs = [(i, j) for i in range(len(z)) for j in range(i, len(z))]
    rows = df.select(_pattern(cols).alias("p"), *scaled).groupBy("p").agg(*[F.sum(z[i] * z[j]).alias(f"c{k}") for k, (i, j) in enumerate(pairs)]).collect()
    out = Patterns(list(cols), mean, scale)
    for r in rows:
        m = np.zeros((len(z), len(z)))
        for k, (i, j) in enumerate(pairs):
            m[i, j] = m[j, i] = r[f"c{k}"]
        out.sums[r["p"]] = m
    return out


def settle(found: Patterns, rounds: int, tol: float) -> dict[int, np.ndarray]:
    """Per pattern the matrix that maps (1, scaled values with 0 in gaps) to the filled row, after the rounds.

    Each step regresses one column on the others by least squares over all rows that have it, with the other gaps filled as they
    stand. Rounds end early when no coefficient moves by more than ``tol``.
    """
    n = len(found.cols) + 1
    maps = {p: np.eye(n) for p in found.sums}
    last: dict[int, np.ndarray] = {}
    for _ in range(rounds):
        moved = 0.0
        for c in found.gaps():
            others = [i for i in range(n) if i != c + 1]
            cross = np.zeros((n, n))
            for p, s in found.sums.items():
                if not p >> c & 1:
                    cross += maps[p] @ s @ maps[p].T
            weights = np.linalg.lstsq(cross[np.ix_(others, others)], cross[others, c + 1], rcond=1e-12)[0]
            moved = max(moved, math.inf if c not in last else float(np.abs(weights - last[c]).max()))
            last[c] = weights
            for p, m in maps.items():
                if p >> c & 1:
                    m[c + 1] = weights @ m[others]
        if moved < tol:
            break
    return maps


def chained_impute(df: DataFrame, cols: list[str], rounds: int = 10, tol: float = 1e-3) -> DataFrame:
    """Start from column means, then refit and refill, fewest gaps first; every row comes back.

    A column without any value stays empty.
    """
    found = observe(df, cols)
    maps = settle(found, rounds, tol)
    gaps = found.gaps()
    if not gaps:
        return df.withColumns({c: F.col(c).cast("double") for c in cols})
    # one row per pattern of gaps, of which only those that occur are listed
    rows = [(int(p), [[float(v) for v in m[c + 1]] for c in gaps]) for p, m in maps.items()]
    table = df.sparkSession.createDataFrame(rows, "__pattern bigint, __maps array<array<double>>")
    inputs = F.array(F.lit(1.0), *[F.coalesce((_plain(c) - F.lit(float(m))) / F.lit(float(s)), F.lit(0.0)) for c, m, s in zip(found.cols, found.mean, found.scale)])
    marked = df.withColumns({"__pattern": _pattern(cols), "__row": inputs}).join(F.broadcast(table), "__pattern")
    made = {c: F.col(c).cast("double") for c in cols}
    for k, i in enumerate(gaps):
        dot = F.aggregate(F.zip_with(F.col("__maps")[k], F.col("__row"), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        made[cols[i]] = F.coalesce(_plain(cols[i]), dot * F.lit(float(found.scale[i])) + F.lit(float(found.mean[i])))
    return marked.withColumns(made).select(*df.columns)
