"""Quality rules with robust multivariate outliers.

Per document, statistics of the whole text are counted and turned into a vector: log of the word count, log of the mean
word length, shares of symbols, of repeated lines and of repeated words. For every language and source the minimum
covariance determinant is estimated: mean and covariance of the 75 % of its vectors that lie closest by their own
Mahalanobis distance, found by concentration steps from a start of medians and interquartile ranges, scaled to be
consistent, then reweighted once. A document whose squared distance exceeds ``cutoff`` is rejected.

Everything covers all rows and is summed by Spark: a concentration step is one aggregation of counts, sums and products
per group and fine distance bin; a group's subset is its bins up to the 75 % mark, so no group is ever
gathered or sorted. Shares that are constant in a group get a floor of spread, so that a harmless symbol is no outlier.

Defined cases: NULL, empty and short texts fail the base rule; groups with fewer than ``least`` usable rows are pooled per language,
then over all; with fewer than ``least`` in all nothing is rejected by distance. NULL language or source is a
value of its own. Repeated rows get the same verdict; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BLANK, gram_hashes, packed, stored, unpacked, whole, word_hashes, words_of

SYMBOLS = b"#*$%&|<>"
DIMS = 5
#: Smallest spread per dimension: log words, log word length, share of symbols, of repeated lines, of repeated words.
FLOOR = (0.5, 0.06, 0.02, 0.08, 0.08)
#: Share of a group's rows in the subset.
CORE = 0.75
#: Squared distance beyond which a vector is rejected.
CUTOFF = 30.0
LEAST = 60
STEPS = 6
#: Bins per doubling of the squared distance.
FINE = 32

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
PIECE = 1 << 18


def repeated_words(h: np.ndarray, window: int = 8) -> int:
    """Words inside windows whose word sequence occurs twice or more in the text."""
    g = gram_hashes(h, window)
    if len(g) < 2:
        return 0
    order = np.argsort(g, kind="stable")
    same = g[order][1:] == g[order][:-1]
    twice = np.zeros(len(g), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(len(h) + 1, np.int32)
    at = np.flatnonzero(twice)
    step[at] += 1
    np.subtract.at(step, at + window, 1)
    return int(np.count_nonzero(np.cumsum(step[:-1]) > 0))


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    raw = text.encode()
    if not raw:
        return 0, 0, 0, 0, 0
    b = np.frombuffer(raw, np.uint8)
    start, end = words_of(raw)
    chars = int(np.count_nonzero(((b & 0xC0) != 0x80) & ~BLANK[b]))
    symbols = int(np.count_nonzero(_SYMBOL[b]))
    seen: set[bytes] = set()
    dup = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup += 1
        elif line.strip(b" \t\x0b\x0c\r"):
            seen.add(line)
    parts = [word_hashes(raw[start[i] : end[min(i + PIECE, len(start)) - 1]], start[i : i + PIECE] - start[i], end[i : i + PIECE] - start[i]) for i in range(0, len(start), PIECE)]
    return len(start), chars, symbols, dup, repeated_words(np.concatenate(parts)) if parts else 0


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def statistics(docs: DataFrame) -> DataFrame:
    """key, doc_id, lang, source, the five counts and base_failed, per row; key tells rows of one doc_id apart by their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [counts(t.as_py()) for t in batch.column(4)]
            cols = [pa.array(c, pa.int64()) for c in zip(*got)] if got else [pa.array([], pa.int64())] * 5
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(4)), *cols], names=["key", "doc_id", "lang", "source", *NAMES])

    rows = docs.select(
        row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"), whole().alias("text")
    )
    out = rows.mapInArrow(run, "key long, doc_id long, lang string, source string, " + ", ".join(f"{n} long" for n in NAMES))
    return out.withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def row_key() -> Column:
    return F.xxhash64("doc_id", whole(), "lang", "source")


def vector() -> list[Column]:
    words, chars = F.col("n_words").cast("double"), F.col("word_chars").cast("double")
    return [
        F.log1p(words),
        F.log((chars + 1.0) / (words + 1.0)),
        F.col("n_symbols") / F.greatest(chars, F.lit(1.0)),
        F.col("n_dup_lines") / F.greatest(words / 10.0, F.lit(1.0)),
        F.col("n_repeat_words") / F.greatest(words, F.lit(1.0)),
    ]


X = [f"x{i}" for i in range(DIMS)]
PAIRS = [(i, j) for i in range(DIMS) for j in range(i, DIMS)]
MEAN = [f"m{i}" for i in range(DIMS)]
INVERSE = [f"w{i}{j}" for i, j in PAIRS]


def _chi(x: float, dof: int) -> float:
    """Chi-square distribution function for odd degrees of freedom."""
    total = math.erf(math.sqrt(x / 2))
    term = math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(1, dof, 2):
        total -= term
        term *= x / (k + 2)
    return total


def _quantile(p: float, dof: int) -> float:
    a, b = 0.0, 200.0
    for _ in range(80):
        mid = (a + b) / 2
        a, b = (mid, b) if _chi(mid, dof) < p else (a, mid)
    return a


def consistency(share: float) -> float:
    """What the covariance of the closest share of a normal sample must be multiplied by."""
    return share / _chi(_quantile(share, DIMS), DIMS + 2)


def _distance() -> Column:
    d = [F.col(x) - F.col(m) for x, m in zip(X, MEAN)]
    terms = [(1.0 if i == j else 2.0) * F.col(f"w{i}{j}") * d[i] * d[j] for i, j in PAIRS]
    total = terms[0]
    for t in terms[1:]:
        total = total + t
    return F.greatest(total, F.lit(0.0))


def _inverse(matrix: Column) -> Column:
    """Inverse of a positive definite matrix given as a flat array: one in-place elimination per diagonal element."""

    def pivot(m: Column, k: Column) -> Column:
        at = lambda i, j: F.get(m, i * DIMS + j)
        p = at(k, k)

        def cell(old: Column, place: Column) -> Column:
            i, j = F.floor(place / DIMS).cast("int"), place % DIMS
            return (
                F.when((i == k) & (j == k), 1.0 / p)
                .when(i == k, old / p)
                .when(j == k, -old / p)
                .otherwise(old - at(i, k) * at(k, j) / p)
            )

        return F.transform(m, cell)

    return F.aggregate(F.array(*(F.lit(k) for k in range(DIMS))), matrix, pivot)


def _solve(sums: DataFrame, factor: float) -> DataFrame:
    """Mean and inverse covariance of each group's sums (one row per group)."""
    n = F.col("n").cast("double")
    known = sums.select("grp", *((F.col(f"s{i}") / n).alias(MEAN[i]) for i in range(DIMS)), *((F.col(f"p{i}{j}") / n).alias(f"p{i}{j}") for i, j in PAIRS))

    def cell(i: int, j: int) -> Column:
        cov = F.lit(factor) * (F.col(f"p{min(i, j)}{max(i, j)}") - F.col(MEAN[i]) * F.col(MEAN[j]))
        # floors keep constant or nearly dependent statistics from blowing up distances
        return F.greatest(cov, F.lit(FLOOR[i] ** 2)) + 1e-9 if i == j else cov

    inverse = _inverse(F.array(*(cell(i, j) for i in range(DIMS) for j in range(DIMS)))).alias("inverse")
    return known.select("grp", *(F.round(m, 9).alias(m) for m in MEAN), inverse).select(
        "grp", *MEAN, *(F.round(F.get("inverse", F.lit(i * DIMS + j)), 6).alias(f"w{i}{j}") for i, j in PAIRS)
    )


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        *(F.sum(x).alias(f"s{i}") for i, x in enumerate(X)),
        *(F.sum(F.col(X[i]) * F.col(X[j])).alias(f"p{i}{j}") for i, j in PAIRS),
    ]


def _start(points: DataFrame) -> DataFrame:
    """Median and interquartile range per group and dimension, from counts in fine bins."""
    long = points.select("grp", F.posexplode(F.array(*X)).alias("dim", "x"))
    bins = long.groupBy("grp", "dim", F.floor(F.col("x") * 128).alias("bin")).agg(F.count(F.lit(1)).alias("c"))
    run = Window.partitionBy("grp", "dim").orderBy("bin")
    every = Window.partitionBy("grp", "dim")
    at = bins.withColumn("share", F.sum("c").over(run) / F.sum("c").over(every)).withColumn("x", (F.col("bin") + 0.5) / 128)
    q = lambda p: F.min(F.when(F.col("share") >= p, F.col("x")))
    per = at.groupBy("grp", "dim").agg(q(0.5).alias("med"), ((q(0.75) - q(0.25)) / 1.349).alias("spread"))
    wide = per.groupBy("grp").agg(
        *(F.max(F.when(F.col("dim") == i, F.col("med"))).alias(MEAN[i]) for i in range(DIMS)),
        *(F.max(F.when(F.col("dim") == i, F.greatest("spread", F.lit(FLOOR[i])))).alias(f"d{i}") for i in range(DIMS)),
    )
    zero = F.lit(0.0)
    return wide.select("grp", *MEAN, *((1.0 / (F.col(f"d{i}") * F.col(f"d{i}")) if i == j else zero).alias(f"w{i}{j}") for i, j in PAIRS))


def fit(points: DataFrame, steps: int = STEPS) -> DataFrame:
    """MCD per group of (grp, x0..x4): a row per group with mean and inverse covariance."""
    now = stored(_start(points), "mcd-0")
    fine = F.floor(F.log2(_distance() + 1e-6) * FINE).alias("bin")
    for step in range(steps):
        bins = points.join(now, "grp").groupBy("grp", fine).agg(*_sums())
        before = Window.partitionBy("grp").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
        every = Window.partitionBy("grp")
        core = bins.withColumn("below", F.coalesce(F.sum("n").over(before), F.lit(0))).withColumn("all", F.sum("n").over(every))
        core = core.where(F.col("below") < CORE * F.col("all"))
        names = ["n", *(f"s{i}" for i in range(DIMS)), *(f"p{i}{j}" for i, j in PAIRS)]
        now = stored(_solve(core.groupBy("grp").agg(*(F.sum(c).alias(c) for c in names)), consistency(CORE)), f"mcd-{step + 1}")
    near = points.join(now, "grp").where(_distance() <= _quantile(0.975, DIMS))
    return stored(_solve(near.groupBy("grp").agg(*_sums()), consistency(0.975)), "mcd-final")


def _grouped(stats: DataFrame, least: int) -> DataFrame:
    """Give every row its group: language and source, or a pool of what is too small."""
    usable = stats.where(~F.col("base_failed"))
    size = usable.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("c"))
    size = size.withColumn("own", F.col("c") >= least)
    per_lang = Window.partitionBy("lang")
    size = size.withColumn("pool", F.sum(F.when(~F.col("own"), F.col("c")).otherwise(0)).over(per_lang))
    text = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("NULL"))
    grp = F.when(F.col("own"), F.concat_ws("|", F.lit("s"), text("lang"), text("source"))).when(F.col("pool") >= least, F.concat_ws("|", F.lit("l"), text("lang"))).otherwise(F.lit("all"))
    named = size.select(F.col("lang").alias("gl"), F.col("source").alias("gs"), grp.alias("grp"))
    return stats.join(named, F.col("lang").eqNullSafe(F.col("gl")) & F.col("source").eqNullSafe(F.col("gs")), "left").drop("gl", "gs")


def judge(docs: DataFrame, cutoff: float = CUTOFF, least: int = LEAST) -> DataFrame:
    """doc_id, the counts, base_failed, distance and kept, per row of ``docs``."""
    return _judge(docs, cutoff, least).drop("key", "grp")


def _judge(docs: DataFrame, cutoff: float, least: int) -> DataFrame:
    stats = stored(statistics(docs), "quality-statistics")
    points = stored(_grouped(stats, least).select("*", *(v.alias(x) for v, x in zip(vector(), X))), "quality-points")
    usable = points.where(~F.col("base_failed")).select("grp", *X)
    models = fit(usable)
    crowd = usable.groupBy("grp").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= least).select("grp")
    scored = points.join(models.join(crowd, "grp", "left_semi"), "grp", "left")
    distance = _distance()
    kept = ~F.col("base_failed") & F.coalesce(distance <= cutoff, F.lit(True))
    return scored.select("key", "grp", "doc_id", *NAMES, "base_failed", distance.alias("distance"), kept.alias("kept"))


def keep(docs: DataFrame, cutoff: float = CUTOFF, least: int = LEAST) -> DataFrame:
    """The rows of ``docs`` that are kept."""
    good = _judge(docs, cutoff, least).where("kept").select("key").distinct()
    return unpacked(packed(docs, key=row_key()).join(good, "key", "left_semi"), docs)
