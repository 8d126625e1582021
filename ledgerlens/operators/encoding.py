"""Binning, categorical encoders and weight of evidence.

Fitting returns either a small table (one row per category or bin) or plain numbers; applying is a
projection or a join on that table.
"""

from __future__ import annotations

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.functions import scalars as X

from . import ordered, skew

# --- bins ---------------------------------------------------------------------------------------


def inner_edges(edges: list[float]) -> list[float]:
    """Distinct edges without the outermost two."""
    distinct = sorted({e for e in edges if e is not None})
    return distinct[1:-1]


def quantile_bin(c: Column | str, inner: list[float]) -> Column:
    """Number of inner edges strictly below the value: right-closed bins, the lowest value in bin 0."""
    v = X.col(c)
    below = sum(((v > F.lit(float(e))).cast("int") for e in inner), F.lit(0))
    return F.when(v.isNotNull(), below)


def quantile_bins(df: DataFrame, col: str, q: int, out: str = "bin") -> DataFrame:
    edges = ordered.quantile_values(df, [col], [i / q for i in range(q + 1)])[col]
    return df.withColumn(out, quantile_bin(col, inner_edges(edges)))


def equal_width_bins(df: DataFrame, col: str, n: int, out: str = "bin") -> DataFrame:
    """Equal-width right-closed bins between the extremes, 0-based."""
    span = df.agg(F.min(col).cast("double").alias("lo"), F.max(col).cast("double").alias("hi")).select(F.struct("lo", "hi")).scalar()
    v = F.col(col).cast("double")
    step = F.try_divide((v - span["lo"]) * n, span["hi"] - span["lo"])
    index = F.greatest(F.ceil(step) - 1, F.lit(0))
    return df.withColumn(out, F.when(v.isNotNull(), F.least(F.coalesce(index, F.lit(0)), F.lit(n - 1))).cast("int"))


# --- encoders -----------------------------------------------------------------------------------

#: Most categories that become a column each.
MOST_COLUMNS = 1000


def categories(df: DataFrame, col: str, limit: int = MOST_COLUMNS) -> list:
    """The sorted categories as a list, one future column each; more than ``limit`` belong into ``sparse_one_hot``."""
    found = df.select(col).where(F.col(col).isNotNull()).distinct()
    rows = found.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"{col} has more than {limit} categories; use sparse_one_hot")
    return sorted(r[0] for r in rows)


def one_hot(df: DataFrame, fitted: dict[str, list]) -> DataFrame:
    """0/1 column per category known at fit time; unknown and NULL give zeros."""
    made = {
        f"{c}_{v}": F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)) for c, values in fitted.items() for v in values
    }
    return df.withColumns(made).drop(*fitted)


def one_hot_places(df: DataFrame, codes: dict[str, DataFrame], out: str = "places") -> tuple[DataFrame, int]:
    """Where the ones of a row's 0/1 vector stand (ascending array), and the vector's length.

    ``codes`` holds the table of ``fit_labels`` for each column: a category's place is its rank, found by a distributed sort, behind
    the categories of the columns before. Rows meet their places by a join and no list of categories exists anywhere. Unknown and
    NULL have no place.
    """
    joined, width = df, 0
    for col, table in codes.items():
        # one number per column
        size = table.agg(F.max(f"{col}_code")).first()[0]
        joined = skew.lookup(joined, table, [col]).withColumn(f"{col}_code", F.col(f"{col}_code") + F.lit(width))
        width += 0 if size is None else int(size) + 1
    places = F.array_compact(F.array(*[F.col(f"{c}_code").cast("int") for c in codes]))
    return joined.withColumn(out, places).drop(*[f"{c}_code" for c in codes], *codes), width


def sparse_one_hot(df: DataFrame, codes: dict[str, DataFrame], out: str = "one_hot") -> DataFrame:
    """The same as sparse vectors for MLlib, one for all encoded columns, however many categories they have."""
    joined, parts = df, []
    for col, table in codes.items():
        size = table.agg(F.max(f"{col}_code")).first()[0]
        size = 0 if size is None else int(size) + 1
        joined = skew.lookup(joined, table, [col])
        # the encoder drops the place after the last, so that what has no code gives zeros
        joined = joined.withColumn(f"__{col}", F.coalesce(F.col(f"{col}_code").cast("double"), F.lit(float(size)))).drop(f"{col}_code")
        joined = joined.withMetadata(f"__{col}", {"ml_attr": {"type": "nominal", "num_vals": size + 1}})
        parts.append(f"__{col}")
    encoder = OneHotEncoder(inputCols=parts, outputCols=[f"{p}_v" for p in parts], dropLast=True)
    made = encoder.fit(joined).transform(joined)
    packed = VectorAssembler(inputCols=[f"{p}_v" for p in parts], outputCol=out).transform(made)
    return packed.drop(*parts, *[f"{p}_v" for p in parts], *codes)


def fit_labels(df: DataFrame, col: str) -> DataFrame:
    """Alphabetical code per category."""
    known = df.select(col).where(F.col(col).isNotNull()).distinct()
    return ordered.positions(known, col, f"{col}_code")


def label_encode(df: DataFrame, codes: DataFrame, col: str, unknown: str = "encode") -> DataFrame:
    """Codes by join: NULL gives -1; unknown raises, gets the next free code, or gives -1."""
    code = f"{col}_code"
    if unknown == "error":
        stray = df.where(F.col(col).isNotNull()).join(codes, col, "left_anti").limit(1).collect()
        if stray:
            raise ValueError(f"unknown category in column {col}")
    joined = skew.lookup(df, codes, [col])
    fallback = codes.select(F.count(F.lit(1))).scalar() if unknown == "encode" else F.lit(-1)
    return joined.withColumn(code, F.when(F.col(col).isNull(), F.lit(-1)).otherwise(F.coalesce(code, fallback)))


def fit_frequencies(df: DataFrame, col: str) -> DataFrame:
    known = df.where(F.col(col).isNotNull())
    total = known.select(F.count(F.lit(1))).scalar()
    return known.groupBy(col).agg(F.count(F.lit(1)).alias("n")).select(col, "n", X.ratio("n", total).alias(f"{col}_freq"))


def frequency_encode(df: DataFrame, shares: DataFrame, col: str) -> DataFrame:
    """Share of each category at fit time; NULL and unknown give 0."""
    joined = skew.lookup(df, shares.select(col, f"{col}_freq"), [col])
    return joined.withColumn(f"{col}_freq", F.coalesce(f"{col}_freq", F.lit(0.0)))


def binary_encode(df: DataFrame, codes: DataFrame, col: str) -> DataFrame:
    """Bits of the 1-based ordinal, highest first; NULL and unknown give zeros."""
    k = codes.count()
    width = max(1, int(k).bit_length())
    joined = skew.lookup(df, codes, [col]).withColumn("__o", F.coalesce(F.col(f"{col}_code") + 1, F.lit(0)))
    bits = {
        f"{col}_{i}": F.expr(f"cast(shiftright(__o, {width - 1 - i}) & 1 as int)") for i in range(width)
    }
    return joined.withColumns(bits).drop("__o", f"{col}_code")


def rare_categories(df: DataFrame, col: str, limit: float = 0.01) -> DataFrame:
    return fit_frequencies(df, col).where(F.col(f"{col}_freq") < limit)


def encoding_plan(df: DataFrame, cols: list[str], max_one_hot: int = 15) -> DataFrame:
    """Chosen encoder per column: two categories label, few one-hot, many frequency."""
    from . import profile

    k = F.col("distinct_values")
    strategy = F.when(k <= 2, "label").when(k <= max_one_hot, "onehot").otherwise("frequency")
    return profile.category_summary(df, cols).select(
        "column", F.col("distinct_values").alias("n_unique"), strategy.alias("strategy"), "mode", "mode_freq"
    )


def smart_encode(df: DataFrame, cols: list[str], max_one_hot: int = 15) -> DataFrame:
    """Encode every column the way ``encoding_plan`` chooses (one row per column is read)."""
    chosen = {r["column"]: r["strategy"] for r in encoding_plan(df, cols, max_one_hot).collect()}
    out = df
    for c in cols:
        if chosen.get(c) == "label":
            out = label_encode(out, fit_labels(df, c), c, "ignore").drop(c)
        elif chosen.get(c) == "onehot":
            out = one_hot(out, {c: categories(df, c)})
        else:
            out = frequency_encode(out, fit_frequencies(df, c), c).drop(c)
    return out


def encoding_summary(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """Number of categories and the first ``k`` names per column."""
    from . import relations

    counts = relations.value_counts(df, cols)
    n = counts.groupBy("column").agg(F.count(F.lit(1)).alias("n_categories"))
    w = W.partitionBy("column").orderBy("value")
    first = counts.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k)
    names = first.groupBy("column").agg(F.concat_ws(",", F.sort_array(F.collect_list("value"))).alias("categories"))
    return n.join(names, "column")


# --- weight of evidence ---------------------------------------------------------------------------

STRENGTH = [(0.02, "Useless"), (0.1, "Weak"), (0.3, "Medium"), (0.5, "Strong")]


def _target_long(df: DataFrame, features: list[str], target: str) -> DataFrame:
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in features])
    return (
        df.select(F.col(target).cast("int").alias("y"), F.inline(cells))
        .where(F.col("value").isNotNull() & F.col("y").isNotNull())
    )


def _weights(counts: DataFrame, smoothing: str) -> DataFrame:
    """Shares, weight and information value per bin; three ways to treat an empty class.

    ``floor`` lifts shares to 1e-10, ``half`` counts an absent class as 0.5, ``epsilon`` adds 1e-10
    inside the logarithm.
    """
    good, bad = F.col("good").cast("double"), F.col("bad").cast("double")
    if smoothing == "half":
        good = F.when(good == 0, 0.5).otherwise(good)
        bad = F.when(bad == 0, 0.5).otherwise(bad)
    rows = counts.withColumns({"__g": good, "__b": bad})
    totals = rows.groupBy("feature").agg(F.sum("__g").alias("__tg"), F.sum("__b").alias("__tb"))
    shared = rows.join(totals, "feature").withColumns(
        {"good_dist": X.ratio("__g", "__tg"), "bad_dist": X.ratio("__b", "__tb")}
    )
    if smoothing == "floor":
        floor = F.lit(1e-10)
        shared = shared.withColumns(
            {"good_dist": F.greatest("good_dist", floor), "bad_dist": F.greatest("bad_dist", floor)}
        )
    eps = F.lit(1e-10 if smoothing == "epsilon" else 0.0)
    woe = F.log(F.try_divide(F.col("bad_dist") + eps, F.col("good_dist") + eps))
    return shared.withColumn("woe", woe).withColumn(
        "iv", (F.col("bad_dist") - F.col("good_dist")) * F.col("woe")
    ).drop("__g", "__b", "__tg", "__tb")


def fit_woe(df: DataFrame, features: list[str], target: str, max_bins: int = 10, smoothing: str = "floor") -> DataFrame:
    """Bin table ``(feature, bin, lo, hi, binned, good, bad, good_dist, bad_dist, woe, iv)``.

    Features with more than ``max_bins`` values get quantile bins, the others one bin per value.
    All features are counted in one job.
    """
    present = df.where(F.col(target).isNotNull())
    edges = ordered.quantile_values(present, features, [i / max_bins for i in range(max_bins + 1)])
    long = _target_long(present, features, target)
    kinds = long.groupBy("feature").agg(F.countDistinct("value").alias("k")).collect()
    many = {r.feature for r in kinds if r.k > max_bins}
    key = F.col("value")
    lo, hi = F.col("value"), F.col("value")
    for f in features:
        if f not in many:
            continue
        cuts = sorted({e for e in edges[f] if e is not None})
        mine = F.col("feature") == f
        key = F.when(mine, quantile_bin("value", cuts[1:-1]).cast("double")).otherwise(key)
    long = long.withColumn("key", key)
    counts = long.groupBy("feature", "key").agg(F.count_if(F.col("y") == 0).alias("good"), F.count_if(F.col("y") == 1).alias("bad"))
    lo, hi = F.col("key"), F.col("key")
    for f in many:
        cuts = sorted({e for e in edges[f] if e is not None})
        mine = F.col("feature") == f
        limits = F.array(*[F.lit(float(e)) for e in cuts])
        at = F.col("key").cast("int") + 1
        lo = F.when(mine, F.get(limits, at - 1)).otherwise(lo)
        hi = F.when(mine, F.get(limits, at)).otherwise(hi)
    few = W.partitionBy("feature").orderBy("key")  # at most max_bins rows per feature
    table = _weights(counts, smoothing).withColumns(
        {
            "lo": lo,
            "hi": hi,
            "binned": F.col("feature").isin(list(many)) if many else F.lit(False),
            "bin": F.row_number().over(few) - 1,
        }
    )
    return table.drop("key")


def information_values(bins: DataFrame) -> DataFrame:
    """Information value per feature with its strength."""
    iv = bins.groupBy("feature").agg(F.sum("iv").alias("iv"), F.count(F.lit(1)).alias("bins"))
    return iv.withColumns({"strength": X.bands("iv", STRENGTH, "Suspicious", closed="left"), "selected": F.col("iv") >= 0.02})


def monotonic(bins: DataFrame) -> DataFrame:
    """Whether the weights of a feature only rise or only fall over its bins."""
    w = W.partitionBy("feature").orderBy("bin")
    step = bins.withColumn("step", F.col("woe") - F.lag("woe").over(w))
    g = step.groupBy("feature").agg(F.min("step").alias("lo"), F.max("step").alias("hi"), F.count(F.lit(1)).alias("bins"))
    return g.select(
        "feature", "bins", (F.coalesce(F.col("lo") >= 0, F.lit(True)) | F.coalesce(F.col("hi") <= 0, F.lit(True))).alias("monotonic")
    )


def woe_transform(df: DataFrame, bins: DataFrame, unseen: str = "null", min_iv: float = 0.02) -> DataFrame:
    """Replace features by their weights; features below ``min_iv`` are dropped.

    The bin table (at most ten rows per feature) becomes CASE expressions. Values outside every bin
    give NULL, the mean weight or the first bin's weight; NULL stays NULL.
    """
    rows = bins.select("feature", "bin", "lo", "hi", "binned", "woe", "iv").orderBy("feature", "bin").collect()
    return woe_apply(df, [r.asDict() for r in rows], unseen, min_iv)


def woe_apply(df: DataFrame, bins: list[dict], unseen: str = "null", min_iv: float = 0.02) -> DataFrame:
    """``woe_transform`` with the bin table as a list, ordered by feature and bin."""
    by: dict[str, list] = {}
    for r in bins:
        by.setdefault(r["feature"], []).append(r)
    made, drop = {}, []
    for feature, parts in by.items():
        if sum(p["iv"] for p in parts) < min_iv:
            drop.append(feature)
            continue
        weights = [p["woe"] for p in parts]
        other = {"null": None, "mean": sum(weights) / len(weights), "first": weights[0]}[unseen]
        fallback = F.lit(other).cast("double")
        v = F.col(feature).cast("double")
        if parts[0]["binned"]:
            e = F.when((v < parts[0]["lo"]) | (v > parts[-1]["hi"]), fallback)
            for p in parts:
                e = e.when(v <= p["hi"], F.lit(p["woe"]))
        else:
            e = F.when(v == parts[0]["lo"], F.lit(parts[0]["woe"]))
            for p in parts[1:]:
                e = e.when(v == p["lo"], F.lit(p["woe"]))
        made[feature] = F.when(v.isNotNull(), e.otherwise(fallback))
    return df.withColumns(made).drop(*drop)


def raw_information_values(df: DataFrame, features: list[str], target: str) -> DataFrame:
    """Information value over raw values, an absent class counted as 0.5."""
    counts = (
        _target_long(df, features, target)
        .groupBy("feature", "value")
        .agg(F.count_if(F.col("y") == 0).alias("good"), F.count_if(F.col("y") == 1).alias("bad"))
    )
    return information_values(_weights(counts, "half"))


def select_features(df: DataFrame, features: list[str], target: str, min_variance: float = 0.01, max_r: float = 0.85) -> DataFrame:
    """Keep features with spread; of two strongly correlated ones drop the one with the lower IV."""
    from . import ordered as _o, profile

    long = _o.long_form(df, features, bucket=False)
    var = long.groupBy("feature").agg(F.var_samp("value").alias("variance"))
    iv = raw_information_values(df, features, target).select("feature", "iv")
    pairs = profile.pearson(df, features).where(F.abs("correlation") > max_r)
    one, two = iv.withColumnsRenamed({"feature": "feature_1", "iv": "iv_1"}), iv.withColumnsRenamed({"feature": "feature_2", "iv": "iv_2"})
    losers = (
        pairs.join(one, "feature_1")
        .join(two, "feature_2")
        # equal values up to rounding: the later feature goes
        .select(F.when(F.col("iv_1") < F.col("iv_2") - 1e-9, F.col("feature_1")).otherwise(F.col("feature_2")).alias("feature"))
        .distinct()
        .withColumn("redundant", F.lit(True))
    )
    return (
        var.join(iv, "feature")
        .join(losers, "feature", "left")
        .withColumn("redundant", F.coalesce("redundant", F.lit(False)))
        .withColumn("kept", (F.col("variance") > min_variance) & ~F.col("redundant"))
    )
