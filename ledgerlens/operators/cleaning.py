"""Imputation, outliers and scaling: fit reads a few numbers per column, apply is a projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.functions import scalars as X

from . import ordered, reports

# --- simple imputation ----------------------------------------------------------------------------


def numeric_columns(df: DataFrame, cols: list[str]) -> list[str]:
    return [f.name for f in df.schema if f.name in cols and isinstance(f.dataType, T.NumericType)]


def fit_imputer(df: DataFrame, cols: list[str], numeric: str = "median", text: str = "most_frequent", constant=0.0, missing="missing") -> dict:
    """Fill value per column: mean, median or constant; most frequent or constant text."""
    nums = numeric_columns(df, cols)
    words = [c for c in cols if c not in nums]
    fills: dict = {}
    if nums:
        if numeric == "mean":
            fills |= df.agg(*[F.avg(c).alias(c) for c in nums]).first().asDict()
        elif numeric == "median":
            fills |= {c: q[0] for c, q in ordered.quantile_values(df, nums, [0.5]).items()}
        else:
            fills |= {c: float(constant) for c in nums}
    if words:
        if text == "most_frequent":
            row = ordered.modes(df, [], words).select(*words).first()
            fills |= row.asDict() if row else {}
        else:
            fills |= {c: missing for c in words}
    return fills


def impute(df: DataFrame, fills: dict) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in fills.items() if v is not None})


def missing_flags(df: DataFrame, cols: list[str]) -> DataFrame:
    """``<col>_missing`` for every listed column that has NULLs."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in cols if row[c]})


def imputation_summary(df: DataFrame, cols: list[str], fills: dict) -> DataFrame:
    one = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(c).alias("imputed"),
            X.ratio(F.col(c) * 100, "__n").alias("imputed_pct"),
            F.lit(None if fills.get(c) is None else str(fills[c]) if isinstance(fills[c], str) else None).cast("string").alias("fill_text"),
            F.lit(None if isinstance(fills.get(c), str) else fills.get(c)).cast("double").alias("fill_number"),
        )
        for c in cols
    ]
    return one.select(F.inline(F.array(*cells)))


# --- outliers -------------------------------------------------------------------------------------


def percentile_bounds(df: DataFrame, cols: list[str], lo: float = 0.01, hi: float = 0.99) -> dict[str, tuple[float, float]]:
    return {c: (q[0], q[1]) for c, q in ordered.quantile_values(df, cols, [lo, hi]).items()}


def iqr_bounds(df: DataFrame, cols: list[str], factor: float = 1.5) -> dict[str, tuple[float, float]]:
    out = {}
    for c, (q1, q3) in ordered.quantile_values(df, cols, [0.25, 0.75]).items():
        out[c] = (q1 - factor * (q3 - q1), q3 + factor * (q3 - q1))
    return out


def outside(c: str, bounds: tuple[float, float]) -> Column:
    return (F.col(c) < F.lit(bounds[0])) | (F.col(c) > F.lit(bounds[1]))


def treat_outliers(df: DataFrame, bounds: dict[str, tuple[float, float]], strategy: str = "cap") -> DataFrame:
    """Cap at the bounds, blank out, or leave alone; ``<col>_outlier`` marks the rows."""
    made: dict[str, Column] = {f"{c}_outlier": F.coalesce(outside(c, b).cast("int"), F.lit(0)) for c, b in bounds.items()}
    if strategy == "cap":
        made |= {c: X.clip(c, b[0], b[1]) for c, b in bounds.items()}
    elif strategy == "remove":
        made |= {c: F.when(~outside(c, b), F.col(c)) for c, b in bounds.items()}
    return df.withColumns(made)


def outlier_summary(df: DataFrame, bounds: dict[str, tuple[float, float]], *, of_filled: bool = False) -> DataFrame:
    """Bounds, count, share and extremes per column; the share is of all rows, or of filled ones."""
    one = df.agg(
        *[
            e
            for c, b in bounds.items()
            for e in (
                F.count_if(outside(c, b)).alias(f"{c}_n"),
                F.count(c if of_filled else F.lit(1)).alias(f"{c}_rows"),
                F.min(c).cast("double").alias(f"{c}_min"),
                F.max(c).cast("double").alias(f"{c}_max"),
            )
        ]
    )
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(float(b[0])).alias("lower_bound"),
            F.lit(float(b[1])).alias("upper_bound"),
            F.col(f"{c}_n").alias("outliers"),
            X.ratio(F.col(f"{c}_n") * 100, f"{c}_rows").alias("outlier_pct"),
            F.col(f"{c}_min").alias("min"),
            F.col(f"{c}_max").alias("max"),
        )
        for c, b in bounds.items()
    ]
    return one.select(F.inline(F.array(*cells)))


def z_params(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    row = df.agg(*[e for c in cols for e in (F.avg(c).alias(f"{c}_m"), F.stddev_pop(c).alias(f"{c}_s"))]).first()
    return {c: (row[f"{c}_m"], row[f"{c}_s"]) for c in cols}


def z_outlier(c: str, params: tuple[float, float], limit: float = 3.0) -> Column:
    mean, sd = params
    if not sd:
        return F.lit(False)
    return F.abs((F.col(c) - F.lit(mean)) / F.lit(sd)) > limit


def mad_params(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Median and median absolute deviation; a zero deviation falls back to 1.4826 times the mean one."""
    med = {c: q[0] for c, q in ordered.quantile_values(df, cols, [0.5]).items()}
    dev = df.select(*[F.abs(F.col(c) - F.lit(med[c])).alias(c) for c in cols])
    mad = {c: q[0] for c, q in ordered.quantile_values(dev, cols, [0.5]).items()}
    zero = [c for c in cols if mad[c] == 0]
    if zero:
        row = dev.agg(*[F.avg(c).alias(c) for c in zero]).first()
        mad |= {c: 1.4826 * row[c] for c in zero}
    return {c: (med[c], mad[c]) for c in cols}


def mad_outlier(c: str, params: tuple[float, float], limit: float = 3.5) -> Column:
    med, mad = params
    if not mad:
        return F.lit(False)
    return F.lit(0.6745) * F.abs(F.col(c) - F.lit(med)) / F.lit(mad) > limit


METHODS = ("zscore", "modified_zscore", "iqr", "percentile")


def outlier_tests(df: DataFrame, cols: list[str], methods: tuple[str, ...] = METHODS) -> dict[tuple[str, str], Column]:
    """Fitted predicate per (column, method)."""
    tests: dict[tuple[str, str], Column] = {}
    if "zscore" in methods:
        z = z_params(df, cols)
        tests |= {(c, "zscore"): z_outlier(c, z[c]) for c in cols}
    if "modified_zscore" in methods:
        m = mad_params(df, cols)
        tests |= {(c, "modified_zscore"): mad_outlier(c, m[c]) for c in cols}
    if "iqr" in methods:
        tests |= {(c, "iqr"): outside(c, b) for c, b in iqr_bounds(df, cols).items()}
    if "percentile" in methods:
        tests |= {(c, "percentile"): outside(c, b) for c, b in percentile_bounds(df, cols).items()}
    return tests


def outlier_counts(df: DataFrame, tests: dict[tuple[str, str], Column]) -> DataFrame:
    """Count and share per feature and method, all tests in one pass."""
    cols = sorted({c for c, _ in tests})
    one = df.agg(
        *[F.count(c).alias(f"n_{c}") for c in cols],
        *[F.count_if(t).alias(f"t{i}") for i, t in enumerate(tests.values())],
    )
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(m).alias("method"),
            F.col(f"t{i}").alias("outliers"),
            X.ratio(F.col(f"t{i}") * 100, f"n_{c}").alias("outlier_pct"),
        )
        for i, (c, m) in enumerate(tests)
    ]
    return one.select(F.inline(F.array(*cells)))


def outlier_contrast(df: DataFrame, flag: Column, cols: list[str]) -> DataFrame:
    """Mean of outliers against inliers in percent per column."""
    one = df.agg(
        *[e for c in cols for e in (F.avg(F.when(flag, F.col(c))).alias(f"{c}_o"), F.avg(F.when(~flag, F.col(c))).alias(f"{c}_i"))]
    )
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.col(f"{c}_o").alias("outlier_mean"),
            F.col(f"{c}_i").alias("inlier_mean"),
            (X.ratio(F.col(f"{c}_o") - F.col(f"{c}_i"), f"{c}_i") * 100).alias("difference_pct"),
        )
        for c in cols
    ]
    return one.select(F.inline(F.array(*cells)))


def outlier_days(df: DataFrame, value: str = "Amount", limit: float = 3.0) -> DataFrame:
    """Days whose total lies more than ``limit`` sample deviations from the daily mean."""
    days = reports.resample(df, "day", value)
    p = days.agg(F.avg("total").alias("m"), F.stddev("total").alias("s")).select(F.struct("m", "s")).scalar()
    z = F.abs(X.ratio(F.col("total") - p["m"], p["s"]))
    return days.withColumn("z_score", z).withColumn("is_outlier", F.coalesce(F.col("z_score") > limit, F.lit(False)))


def outlier_fraud(df: DataFrame, flag: Column) -> DataFrame:
    """Fraud rates inside and outside the outliers, risk ratio, capture rate and chi-square."""
    from . import profile

    fraud = F.col("FraudResult") == 1
    t = profile.chi_square(df, F.coalesce(flag, F.lit(False)), fraud)
    n11, n10, n01, n00 = (F.col(c) for c in ("n11", "n10", "n01", "n00"))
    out_rate = X.ratio_or_zero(n11, n11 + n10) * 100
    in_rate = X.ratio_or_zero(n01, n01 + n00) * 100
    return t.withColumns(
        {
            "outliers": n11 + n10,
            "rate_overall": X.ratio(n11 + n01, n11 + n10 + n01 + n00) * 100,
            "rate_outliers": out_rate,
            "rate_inliers": in_rate,
            "capture_rate": X.ratio_or_zero(n11, n11 + n01) * 100,
        }
    ).withColumn("risk_ratio", X.ratio("rate_outliers", "rate_inliers")).withColumn(
        "reading",
        F.when(F.col("risk_ratio") > 3, "HIGH").when(F.col("risk_ratio") > 2, "MEDIUM").when(F.col("risk_ratio") > 1, "LOW").otherwise("NONE"),
    )


def outlier_impact(df: DataFrame, flag: Column, value: str = "Amount") -> DataFrame:
    """Statistics with and without the flagged rows and their change in percent."""
    from . import profile

    kept = df.where(~F.coalesce(flag, F.lit(False)))
    a = profile.describe(df, [value])
    b = profile.describe(kept, [value])
    names = ["mean", "std", "min", "q25", "q50", "q75", "max"]

    def long(t: DataFrame, out: str) -> DataFrame:
        return t.select(F.inline(F.array(*[F.struct(F.lit(n).alias("statistic"), F.col(n).cast("double").alias(out)) for n in names])))

    joined = long(a, "with_outliers").join(long(b, "without_outliers"), "statistic")
    change = X.ratio(F.col("without_outliers") - F.col("with_outliers"), "with_outliers") * 100
    return joined.withColumn("change_pct", F.coalesce(change, F.lit(0.0)))


def impact_level(df: DataFrame, flag: Column) -> DataFrame:
    """Share of flagged rows in words."""
    pct = F.avg(F.coalesce(flag, F.lit(False)).cast("double")) * 100
    p = F.col("outlier_pct")
    level = X.bands(p, [(1, "Minimal impact"), (5, "Low impact"), (10, "Moderate impact")], "High impact", closed="left")
    return df.agg(pct.alias("outlier_pct")).withColumns(
        {"impact": level, "documentation": F.when(p > 10, "Justification").when(p > 5, "Document").otherwise("Within limits")}
    )


def treatment_advice(df: DataFrame, flag: Column, value: str = "Amount") -> DataFrame:
    """Treatment rows from the share, size and fraud rate of the flagged rows."""
    f = F.coalesce(flag, F.lit(False))
    one = df.agg(
        (F.avg(f.cast("double")) * 100).alias("pct"),
        F.avg(F.when(f, F.col(value))).alias("om"),
        F.avg(value).alias("am"),
        (F.avg(F.when(f, F.col("FraudResult"))) * 100).alias("orate"),
        (F.avg("FraudResult") * 100).alias("arate"),
    )
    pct, extreme = F.col("pct"), F.col("om") > F.col("am") * 10
    small = F.struct(F.lit("Low").alias("priority"), F.lit("leave as they are").alias("treatment"))
    capped = F.struct(F.lit("High").alias("priority"), F.lit("cap at the 0.99 quantile").alias("treatment"))
    robust = F.struct(F.lit("Medium").alias("priority"), F.lit("scale by quartiles").alias("treatment"))
    look = F.struct(F.lit("High").alias("priority"), F.lit("trace the origin").alias("treatment"))
    gone = F.struct(F.lit("Critical").alias("priority"), F.lit("leave out with a note").alias("treatment"))
    first = F.when(pct < 1, small).when((pct < 5) & extreme, capped).when(pct < 5, robust).when(pct < 10, look).otherwise(gone)
    second = F.when(
        F.col("orate") > F.col("arate") * 3,
        F.struct(F.lit("Critical").alias("priority"), F.lit("model flagged rows apart").alias("treatment")),
    )
    return one.select("pct", F.explode(F.array_compact(F.array(first, second))).alias("r")).select("pct", "r.priority", "r.treatment")


# --- scaling --------------------------------------------------------------------------------------


def fit_scaler(df: DataFrame, cols: list[str], kind: str = "standard", *, center: bool = True, spread: bool = True, lo: float = 0.0, hi: float = 1.0) -> dict[str, tuple[float, float]]:
    """``(offset, divisor)`` per column so that ``scaled = (x - offset) / divisor``.

    Kinds: ``standard`` (population deviation), ``minmax`` to ``[lo, hi]``, ``robust`` (median and
    interquartile range) and ``maxabs``. A zero divisor becomes one.
    """
    if kind == "robust":
        q = ordered.quantile_values(df, cols, [0.25, 0.5, 0.75])
        return {c: (q[c][1], (q[c][2] - q[c][0]) or 1.0) for c in cols}
    if kind == "standard":
        aggs = [e for c in cols for e in (F.avg(c).alias(f"{c}_a"), F.stddev_pop(c).alias(f"{c}_b"))]
    elif kind == "minmax":
        aggs = [e for c in cols for e in (F.min(c).cast("double").alias(f"{c}_a"), F.max(c).cast("double").alias(f"{c}_b"))]
    else:
        aggs = [e for c in cols for e in (F.lit(0.0).alias(f"{c}_a"), F.max(F.abs(c)).cast("double").alias(f"{c}_b"))]
    row = df.agg(*aggs).first()
    out = {}
    for c in cols:
        a, b = row[f"{c}_a"], row[f"{c}_b"]
        if kind == "standard":
            out[c] = (a if center else 0.0, (b or 1.0) if spread else 1.0)
        elif kind == "minmax":
            width = ((b - a) or 1.0) / (hi - lo)
            out[c] = (a - lo * width, width)
        else:
            out[c] = (0.0, b or 1.0)
    return out


def scale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(float(o))) / F.lit(float(d)) for c, (o, d) in params.items()})


def unscale(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: F.col(c) * F.lit(float(d)) + F.lit(float(o)) for c, (o, d) in params.items()})


def scaling_summary(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """Offset, divisor and the scaled column's mean and deviation."""
    one = scale(df, params).agg(*[e for c in params for e in (F.avg(c).alias(f"{c}_m"), F.stddev_pop(c).alias(f"{c}_s"))])
    cells = [
        F.struct(
            F.lit(c).alias("feature"),
            F.lit(float(o)).alias("offset"),
            F.lit(float(d)).alias("divisor"),
            F.col(f"{c}_m").alias("scaled_mean"),
            F.col(f"{c}_s").alias("scaled_std"),
        )
        for c, (o, d) in params.items()
    ]
    return one.select(F.inline(F.array(*cells)))
