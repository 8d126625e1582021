"""Profiling: structure, descriptives, distributions, correlation."""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import scalars as X

from . import ordered, skew

FAMILIES = {
    "numeric": T.NumericType,
    "text": T.StringType,
    "datetime": (T.TimestampType, T.TimestampNTZType, T.DateType),
    "boolean": T.BooleanType,
}


def columns_of(df: DataFrame, family: str) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, FAMILIES[family])]


def describe(df: DataFrame, cols: list[str], probs=(0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, deviation, extremes, quartiles and adjusted shape per column, one row each."""
    long = ordered.long_form(df, cols, bucket=False)
    stats = long.groupBy("feature").agg(
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        X.adjusted_skew("value").alias("skewness"),
        X.adjusted_kurtosis("value").alias("kurtosis"),
        F.skewness("value").alias("pop_skewness"),
        F.kurtosis("value").alias("pop_kurtosis"),
    )
    q = ordered.quantiles(df, cols, probs).withColumnsRenamed({f"q{i}": f"q{round(p * 100)}" for i, p in enumerate(probs)})
    return stats.join(q, "feature")


def structure(df: DataFrame) -> DataFrame:
    """Rows, columns and number of columns per type family, in long form."""
    fixed = {"columns": len(df.columns)} | {f"{k}_columns": len(columns_of(df, k)) for k in FAMILIES}
    cells = [F.struct(F.lit("rows").alias("metric"), F.col("rows").alias("value"))]
    cells += [F.struct(F.lit(k).alias("metric"), F.lit(v).cast("bigint").alias("value")) for k, v in fixed.items()]
    return df.agg(F.count(F.lit(1)).alias("rows")).select(F.inline(F.array(*cells)))


def column_overview(df: DataFrame) -> DataFrame:
    """Non-null, null and distinct counts per column: two aggregation steps over (column, value)."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in df.columns])
    return (
        df.select(F.inline(cells))
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column")
        .agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("non_null"),
            F.count("value").alias("distinct_values"),
        )
        .withColumn("nulls", F.col("rows") - F.col("non_null"))
        .withColumn("null_pct", X.ratio("nulls", "rows") * 100)
    )


def distribution(df: DataFrame, cols: list[str]) -> DataFrame:
    d = describe(df, cols)
    normal = (F.abs("skewness") < 0.5) & (F.abs("kurtosis") < 1)
    return d.withColumns({"iqr": F.col("q75") - F.col("q25"), "is_normal": normal})


def shape_reading(df: DataFrame, cols: list[str]) -> DataFrame:
    """Words for skewness and kurtosis and whether a transform is advised."""
    sk, ku = F.abs("skewness"), F.col("kurtosis")
    return describe(df, cols).withColumns(
        {
            "skew_reading": X.bands(sk, [(0.5, "Approximately symmetric"), (1.0, "Moderately skewed")], "Highly skewed", closed="left"),
            "kurtosis_reading": F.when(ku > 0, "Leptokurtic").when(ku < 0, "Platykurtic").otherwise("Mesokurtic"),
            "transform": F.when(sk > 1, "Yes").otherwise("No"),
        }
    )


def category_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Distinct values, mode, its share of all rows (``mode_pct``) and of filled rows (``mode_freq``),
    and entropy in bits per categorical column."""
    from . import relations

    counts = relations.value_counts(df, cols)
    rows = df.select(F.count(F.lit(1))).scalar()
    totals = counts.groupBy("column").agg(F.sum("n").alias("total"))
    p = X.ratio("n", "total")
    return (
        counts.join(totals, "column")
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("distinct_values"),
            F.min(F.struct((-F.col("n")).alias("neg"), F.col("value").alias("value"))).alias("top"),
            F.max("total").alias("total"),
            (-F.sum(p * F.log2(p + F.lit(1e-10)))).alias("entropy"),
        )
        .select(
            "column",
            "distinct_values",
            F.col("top.value").alias("mode"),
            (X.ratio(-F.col("top.neg"), rows) * 100).alias("mode_pct"),
            X.ratio(-F.col("top.neg"), "total").alias("mode_freq"),
            "entropy",
        )
    )


def histogram(df: DataFrame, col: str, bins: int, keys: list[str] = ()) -> DataFrame:
    """Counts in ``bins`` equal bins between the smallest and largest value (per key)."""
    keys = list(keys)
    v = F.col(col).cast("double")
    rows = df.where(F.col(col).isNotNull())
    if keys:
        span = rows.groupBy(*keys).agg(F.min(v).alias("__lo"), F.max(v).alias("__hi"))
        rows = skew.lookup(rows, span, keys, "inner")
        lo, hi = F.col("__lo"), F.col("__hi")
    else:
        span = rows.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).select(F.struct("lo", "hi")).scalar()
        lo, hi = span["lo"], span["hi"]
    return rows.groupBy(*keys, X.equal_width_bin(col, lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def histogram_entropy(df: DataFrame, key: str, col: str, bins: int = 20) -> DataFrame:
    """Entropy in bits of each key's histogram."""
    h = histogram(df, col, bins, [key])
    totals = h.groupBy(key).agg(F.sum("n").alias("total"))
    p = X.ratio("n", "total")
    return h.join(totals, key).groupBy(key).agg((-F.sum(p * F.log2(p))).alias("entropy"))


# --- correlation --------------------------------------------------------------------------------


def _pairs_long(one: DataFrame, pairs: list[tuple[str, str]], extra: tuple[str, ...] = ()) -> DataFrame:
    cells = [
        F.struct(
            F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2"), F.col(f"r{i}").alias("correlation")
        )
        for i, (a, b) in enumerate(pairs)
    ]
    return one.select(*extra, F.inline(F.array(*cells)))


def pearson(df: DataFrame, cols: list[str], names: dict[str, str] | None = None) -> DataFrame:
    """Upper triangle of the correlation matrix: every pair in one aggregate."""
    pairs = list(combinations(cols, 2))
    src = names or {c: c for c in cols}
    one = df.agg(*[X.corr(F.col(src[a]).cast("double"), F.col(src[b]).cast("double")).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    return _pairs_long(one, pairs)


def spearman(df: DataFrame, cols: list[str]) -> DataFrame:
    """Correlation of average ranks."""
    ranked = ordered.rank_columns(df.select(*cols), cols)
    return pearson(ranked, cols, {c: f"{c}_rank" for c in cols})


def kendall(df: DataFrame, cols: list[str]) -> DataFrame:
    """Tie-corrected Kendall correlation (tau-b) of every pair."""
    out = None
    for a, b in combinations(cols, 2):
        c = ordered.concordance(df, a, b)
        all_pairs = F.col("rows") * (F.col("rows") - 1) / 2
        tau = X.ratio(
            F.col("concordant") - F.col("discordant"),
            F.sqrt((all_pairs - F.col("ties_x")) * (all_pairs - F.col("ties_y"))),
        )
        row = c.select(F.lit(a).alias("feature_1"), F.lit(b).alias("feature_2"), tau.alias("correlation"))
        out = row if out is None else out.unionByName(row)
    return out


def strong_pairs(pairs: DataFrame, limit: float = 0.7) -> DataFrame:
    size = F.abs("correlation")
    return pairs.where(size > limit).withColumn("strength", F.when(size > 0.8, "Very Strong").otherwise("Strong"))


def pair_risk(pairs: DataFrame) -> DataFrame:
    size = F.abs("correlation")
    return pairs.withColumn("risk", F.when(size > 0.7, 3).when(size > 0.3, 2).when(size > 0.1, 1).otherwise(0))


def with_target(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Correlation of each column with the target."""
    one = df.agg(*[X.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(f"r{i}") for i, c in enumerate(cols)])
    cells = [F.struct(F.lit(c).alias("feature"), F.col(f"r{i}").alias("correlation")) for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*cells)))


def stars(p: Column | str) -> Column:
    p = X.col(p)
    return F.when(p < 0.001, "***").when(p < 0.01, "**").when(p < 0.05, "*").otherwise("")


def significance(df: DataFrame, cols: list[str], target: str, method: str = "spearman") -> DataFrame:
    """Correlation with the target, pairwise complete, with its two-sided p-value and stars, one row per feature.

    ``pearson`` and ``spearman`` (of average ranks) are tested by Student's law, ``kendall`` (tau-b) by the normal law with the
    variance that ties leave. ``z`` is Fisher's transform of the first two, tau over its deviation of the third.
    """
    if method == "kendall":
        return _kendall_significance(df, cols, target)
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x"), F.col(target).cast("double").alias("y")) for c in cols]
    )
    both = df.select(F.inline(cells)).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    x, y = "x", "y"
    if method == "spearman":
        both, x, y = ordered.rank_columns(both, ["x", "y"], ["feature"]), "x_rank", "y_rank"
    elif method != "pearson":
        raise ValueError(method)
    out = both.groupBy("feature").agg(X.corr(x, y).alias("correlation"), F.count(F.lit(1)).alias("n"))
    z = F.atanh("correlation") * F.sqrt(F.greatest(F.col("n") - 3.0, F.lit(0.0)))
    out = out.withColumns({"z": z, "p_value": X.correlation_p("correlation", "n")})
    return out.withColumns({"significance": stars("p_value"), "method": F.lit(method)})


def _kendall_significance(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    out = None
    for c in cols:
        both = df.where(F.col(c).isNotNull() & F.col(target).isNotNull()).select(F.col(c).cast("double").alias("x"), F.col(target).cast("double").alias("y"))
        ties = lambda v, name: both.groupBy(v).agg(F.count(F.lit(1)).cast("double").alias("t")).agg(
            F.sum(F.col("t") * (F.col("t") - 1)).alias("pairs"), F.sum(F.col("t") * (F.col("t") - 1) * (F.col("t") - 2)).alias("triples"),
            F.sum(F.col("t") * (F.col("t") - 1) * (F.col("t") * 2 + 5)).alias("five"),
        ).select(F.struct("pairs", "triples", "five").alias(name)).scalar()
        row = ordered.concordance(both, "x", "y").withColumns({"a": ties("x", "a"), "b": ties("y", "b"), "feature": F.lit(c)})
        out = row if out is None else out.unionByName(row)
    n = F.col("rows")
    m = n * (n - 1)
    gap = F.col("concordant") - F.col("discordant")
    a, b = F.col("a"), F.col("b")
    spread = (m * (n * 2 + 5) - a["five"] - b["five"]) / 18 + X.ratio(a["pairs"] * b["pairs"], m * 2) + F.coalesce(X.ratio(a["triples"] * b["triples"], m * (n - 2) * 9), F.lit(0.0))
    out = out.select(
        "feature", X.ratio(gap, F.sqrt((m / 2 - a["pairs"] / 2) * (m / 2 - b["pairs"] / 2))).alias("correlation"), F.round(n).cast("bigint").alias("n"), X.ratio(gap, F.sqrt(spread)).alias("z")
    )
    out = out.withColumn("p_value", X.normal_p("z"))
    return out.withColumns({"significance": stars("p_value"), "method": F.lit("kendall")})


def correlation_matrix(df: DataFrame, cols: list[str]):
    """The p x p matrix on the driver; its size is the number of columns, not of rows."""
    rows = {(r.feature_1, r.feature_2): r.correlation for r in pearson(df.dropna(subset=cols), cols).collect()}
    return np.array([[1.0 if a == b else rows.get((a, b), rows.get((b, a))) for b in cols] for a in cols], dtype=float)


def vif(df: DataFrame, cols: list[str]) -> DataFrame:
    """Variance inflation factors: the diagonal of the inverse correlation matrix, banded."""
    inverse = np.linalg.pinv(correlation_matrix(df, cols))
    rows = [(c, float(inverse[i, i])) for i, c in enumerate(cols)]
    out = df.sparkSession.createDataFrame(rows, "feature string, vif double")
    return out.withColumn("risk", X.cut_left_open("vif", [0, 5, 10, 20, float("inf")], ["Low", "Medium", "High", "Very High"]))


def partial_correlation(df: DataFrame, x: str, y: str, controls: list[str]) -> DataFrame:
    """Correlation of ``x`` and ``y`` with the controls held fixed."""
    p = np.linalg.pinv(correlation_matrix(df, [x, y, *controls]))
    r = float(-p[0, 1] / math.sqrt(p[0, 0] * p[1, 1]))
    return df.sparkSession.createDataFrame(
        [(x, y, ",".join(controls), r)], "feature_1 string, feature_2 string, controls string, correlation double"
    )


def segment_spearman(df: DataFrame, segment: str, cols: list[str], min_rows: int = 100) -> DataFrame:
    """Spearman pairs inside each segment with more than ``min_rows`` rows."""
    pairs = list(combinations(cols, 2))
    ranked = ordered.rank_columns(df.select(segment, *cols), cols, [segment])
    one = ranked.groupBy(segment).agg(
        F.count(F.lit(1)).alias("n"),
        *[X.corr(f"{a}_rank", f"{b}_rank").alias(f"r{i}") for i, (a, b) in enumerate(pairs)],
    )
    return _pairs_long(one.where(F.col("n") > min_rows), pairs, (segment, "n"))


def correlation_graph(pairs: DataFrame, cols: list[str], limit: float = 0.3) -> DataFrame:
    """Degree and degree centrality of each feature over edges stronger than ``limit``."""
    edges = pairs.where(F.abs("correlation") > limit)
    ends = edges.select(F.explode(F.array("feature_1", "feature_2")).alias("feature"))
    degree = ends.groupBy("feature").agg(F.count(F.lit(1)).alias("degree"))
    nodes = pairs.select(F.explode(F.array("feature_1", "feature_2")).alias("feature")).distinct()
    return nodes.join(degree, "feature", "left").select(
        "feature",
        F.coalesce("degree", F.lit(0)).alias("degree"),
        (F.coalesce("degree", F.lit(0)) / F.lit(float(max(1, len(cols) - 1)))).alias("centrality"),
    )


def recommendations(df: DataFrame, cols: list[str], target: str, vif_cols: list[str]) -> DataFrame:
    """Priority per feature from its target correlation, null share and inflation factor."""
    nulls = column_overview(df.select(*cols)).select(F.col("column").alias("feature"), "null_pct")
    r = F.abs("target_correlation")
    base = with_target(df, cols, target).withColumnRenamed("correlation", "target_correlation").join(nulls, "feature")
    joined = base.join(vif(df, vif_cols), "feature", "left")
    return joined.withColumns(
        {
            "priority": F.when(r > 0.3, "high").when(r > 0.1, "medium").otherwise("low"),
            "drop": F.col("null_pct") > 30,
            "multicollinear": F.coalesce(F.col("vif") > 5, F.lit(False)),
        }
    )


def stability_index(base: DataFrame, actual: DataFrame, col: str, bins: int = 10, limit: float = 0.25) -> DataFrame:
    """Population stability index over the base's quantile bins."""
    probs = [i / bins for i in range(1, bins)]
    edges = ordered.quantile_row(base, [col], probs).select(F.array(*[f"{col}_q{i}" for i in range(len(probs))])).scalar()
    # edges are read once as literals: a list of bins - 1 numbers
    row = base.sparkSession.range(1).select(edges.alias("e")).first()
    below = lambda: sum(((F.col(col) > F.lit(e)).cast("int") for e in row.e), F.lit(0))
    both = base.select(below().alias("bin"), F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        actual.select(below().alias("bin"), F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    counts = both.groupBy("bin").agg(F.sum("b").alias("base_n"), F.sum("a").alias("actual_n"))
    tot = counts.agg(F.sum("base_n").alias("b"), F.sum("actual_n").alias("a")).select(F.struct("b", "a")).scalar()
    floor = F.lit(1e-10)
    b, a = F.greatest(X.ratio("base_n", tot["b"]), floor), F.greatest(X.ratio("actual_n", tot["a"]), floor)
    return counts.agg(F.sum((a - b) * F.log(a / b)).alias("psi")).withColumn("stable", F.col("psi") < limit)


def value_at_risk(df: DataFrame, col: str) -> DataFrame:
    """5 % and 1 % quantiles with the mean of the values at or below each."""
    narrow = df.select(col)
    q = ordered.quantile_row(narrow, [col], [0.05, 0.01])
    p = q.select(F.struct(F.col(f"{col}_q0").alias("v95"), F.col(f"{col}_q1").alias("v99"))).scalar()
    v = F.col(col)
    return narrow.agg(
        F.max(p["v95"]).alias("var_95"),
        F.max(p["v99"]).alias("var_99"),
        F.avg(F.when(v <= p["v95"], v)).alias("es_95"),
        F.avg(F.when(v <= p["v99"], v)).alias("es_99"),
    )


def volatility(df: DataFrame, col: str, periods: int = 252) -> DataFrame:
    year = math.sqrt(periods)
    return df.agg(
        F.stddev(col).alias("volatility"),
        (F.stddev(col) * year).alias("annualized_volatility"),
        (X.ratio(F.avg(col), F.stddev(col)) * year).alias("sharpe_ratio"),
        X.ratio(F.stddev(col), F.avg(col)).alias("coefficient_of_variation"),
    )


def normality(df: DataFrame, cols: list[str]) -> DataFrame:
    """Jarque-Bera statistic over all rows; normal while below the 5 % limit of chi-square(2)."""
    jb = F.col("n") / 6.0 * (F.col("pop_skewness") ** 2 + F.col("pop_kurtosis") ** 2 / 4.0)
    return describe(df, cols).withColumn("jarque_bera", jb).withColumn("looks_normal", F.col("jarque_bera") < 5.991464547107979)


def skew_transforms(df: DataFrame, col: str) -> DataFrame:
    """Population skewness and kurtosis of the raw, log, square-root and cube-root values."""
    low = df.select(F.min(col)).scalar()
    v = F.col(col)
    variants = {"original": v, "log": F.log1p(v - low + 1), "square_root": F.sqrt(v - low), "cube_root": F.cbrt(v)}
    cells = F.array(*[F.struct(F.lit(k).alias("transform"), e.alias("v")) for k, e in variants.items()])
    return df.select(F.inline(cells)).groupBy("transform").agg(F.skewness("v").alias("skewness"), F.kurtosis("v").alias("kurtosis"))


LAMBDAS = [round(-2 + 0.1 * i, 1) for i in range(41)]


def box_cox(log_v: Column, lam: float) -> Column:
    """Box-Cox value from the logarithm of a positive number."""
    return log_v if lam == 0 else F.expm1(F.lit(lam) * log_v) / F.lit(lam)


def yeo_johnson(v: Column, log_v: Column, lam: float) -> Column:
    """Yeo-Johnson value from a number and ``log1p`` of its size."""
    mirror = 2.0 - lam
    up = log_v if lam == 0 else F.expm1(F.lit(lam) * log_v) / F.lit(lam)
    low = -log_v if mirror == 0 else -F.expm1(F.lit(mirror) * log_v) / F.lit(mirror)
    return F.when(v >= 0, up).otherwise(low)


def power_transform(df: DataFrame, col: str, method: str, lambdas: list[float] = LAMBDAS) -> DataFrame:
    """Log-likelihood of each power on a grid, with the best one flagged: one pass over the rows.

    Box-Cox needs positive values throughout; otherwise every likelihood is NULL.
    """
    v = F.col("v")
    rows = df.select(F.col(col).cast("double").alias("v")).where(v.isNotNull())
    if method == "box_cox":
        rows = rows.withColumn("u", F.when(v > 0, F.log(F.when(v > 0, v))))
        jac, ok = F.sum("u"), F.min(v) > 0
        made = [box_cox(F.col("u"), float(lam)) for lam in lambdas]
    else:
        rows = rows.withColumn("u", F.log1p(F.abs(v)))
        jac, ok = F.sum(F.signum(v) * F.col("u")), F.lit(True)
        made = [yeo_johnson(v, F.col("u"), float(lam)) for lam in lambdas]
    one = rows.agg(
        ok.alias("ok"), jac.alias("jac"), F.count(F.lit(1)).cast("double").alias("n"),
        *[F.var_pop(m).alias(f"v{i}") for i, m in enumerate(made)],
    )
    cells = [
        F.struct(
            F.lit(float(lam)).alias("lambda"),
            F.when(F.col("ok"), (F.lit(float(lam)) - 1) * F.col("jac") - F.col("n") / 2 * F.log(f"v{i}")).alias("log_likelihood"),
        )
        for i, lam in enumerate(lambdas)
    ]
    grid = one.select(F.inline(F.array(*cells)))
    best = grid.agg(F.max_by("lambda", "log_likelihood")).scalar()
    return grid.withColumns({"method": F.lit(method), "best": F.col("lambda") == best})


def chi_square(df: DataFrame, a: Column, b: Column) -> DataFrame:
    """2 x 2 chi-square with continuity correction; significant above the 5 % limit."""
    t = df.agg(
        F.count_if(a & b).cast("double").alias("n11"),
        F.count_if(a & ~b).cast("double").alias("n10"),
        F.count_if(~a & b).cast("double").alias("n01"),
        F.count_if(~a & ~b).cast("double").alias("n00"),
    )
    n11, n10, n01, n00 = (F.col(c) for c in ("n11", "n10", "n01", "n00"))
    n = n11 + n10 + n01 + n00
    gap = F.abs(n11 * n00 - n10 * n01)
    edge = (n11 + n10) * (n01 + n00) * (n11 + n01) * (n10 + n00)
    shifted = F.greatest(gap - n / 2, F.lit(0.0))
    return t.withColumn("chi_square", X.ratio(n * shifted * shifted, edge)).withColumn(
        "significant", F.col("chi_square") > 3.841458820694124
    )
