"""Binning, encoders, weight of evidence, imputation, outliers and scaling."""

from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import cleaning as K, encoding as E
from ledgerlens.sources import tables

from . import inputs as I
from .q_reports import resample_sql
from .registry import query

# --- bins -----------------------------------------------------------------------------------------


def edges_sql(col, q, t, alias="e"):
    return ", ".join(f"quantile_cont({col}, {i}/{q}::DOUBLE) AS {alias}{i}" for i in range(1, q))


def bin_sql(col, q, alias="e"):
    return " + ".join(f"CASE WHEN {col} > {alias}{i} THEN 1 ELSE 0 END" for i in range(1, q))


@query(
    "b01_quantile_bins",
    "bin:i n:i lo:2 hi:2",
    f"""WITH e AS (SELECT {edges_sql('Value', 10, 'ev')} FROM ev) SELECT {bin_sql('Value', 10)} AS bin, count(*) AS n, min(Value) AS lo,
        max(Value) AS hi FROM ev, e GROUP BY 1""",
)
def b01(s, sf):
    return E.quantile_bins(I.ev(s, sf), "Value", 10).groupBy("bin").agg(
        F.count(F.lit(1)).alias("n"), F.min("Value").alias("lo"), F.max("Value").alias("hi")
    )


@query(
    "b02_fixed_bins",
    "bin:s n:i",
    """SELECT CASE WHEN Value > 0 AND Value <= 10 THEN 'small' WHEN Value > 10 AND Value <= 100 THEN 'medium'
       WHEN Value > 100 AND Value <= 400 THEN 'large' END AS bin, count(*) AS n FROM ev GROUP BY 1""",
)
def b02(s, sf):
    b = X.cut_left_open("Value", [0, 10, 100, 400], ["small", "medium", "large"])
    return I.ev(s, sf).groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b03_equal_width_bins",
    "bin:i n:i",
    """SELECT least(greatest(ceil((Value - lo) * 5 / (hi - lo)) - 1, 0), 4) AS bin, count(*) AS n
       FROM ev, (SELECT min(Value) lo, max(Value) hi FROM ev) GROUP BY 1""",
)
def b03(s, sf):
    return E.equal_width_bins(I.ev(s, sf), "Value", 5).groupBy("bin").agg(F.count(F.lit(1)).alias("n"))


# --- encoders -------------------------------------------------------------------------------------

_CATS = ["click", "error", "purchase", "signup", "view"]


@query(
    "e01_one_hot",
    "TransactionId:i " + " ".join(f"ProductCategory_{c}:i" for c in _CATS),
    "SELECT TransactionId, " + ", ".join(f"CASE WHEN ProductCategory = '{c}' THEN 1 ELSE 0 END AS ProductCategory_{c}" for c in _CATS) + " FROM evn",
)
def e01(s, sf):
    df = I.evn(s, sf)
    return E.one_hot(df, {"ProductCategory": E.categories(df, "ProductCategory")})


@query(
    "e01_sparse_one_hot",
    "l_orderkey:i l_linenumber:i width:i part_at:i flag_at:i ones:i",
    """WITH p AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS at FROM (SELECT DISTINCT l_partkey AS v FROM lineitem WHERE l_partkey % 7 <> 0)),
       f AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS at FROM (SELECT DISTINCT l_returnflag AS v FROM lineitem)), n AS (SELECT count(*) AS k FROM p)
       SELECT l_orderkey, l_linenumber, k + (SELECT count(*) FROM f) AS width, p.at AS part_at, k + f.at AS flag_at,
       CASE WHEN p.at IS NULL THEN 0 ELSE 1 END + 1 AS ones FROM lineitem LEFT JOIN p ON l_partkey = p.v JOIN f ON l_returnflag = f.v, n""",
)
def e01_sparse(s, sf):
    df = tables.table(s, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")
    known = df.where(F.col("l_partkey") % 7 != 0)
    codes = {"l_partkey": E.fit_labels(known, "l_partkey"), "l_returnflag": E.fit_labels(df, "l_returnflag")}
    out, width = E.one_hot_places(df, codes)
    at = F.col("places")
    part = F.when(F.size(at) == 2, at[0])
    return out.select("l_orderkey", "l_linenumber", F.lit(width).alias("width"), part.alias("part_at"), F.element_at(at, -1).alias("flag_at"), F.size(at).alias("ones"))


@query(
    "e02_label_encode",
    "TransactionId:i ProductCategory_code:i",
    """WITH c AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM (SELECT DISTINCT ProductCategory AS v FROM ev WHERE ProductCategory <> 'error'))
       SELECT TransactionId, CASE WHEN ProductCategory IS NULL THEN -1 ELSE coalesce(code, (SELECT count(*) FROM c)) END AS ProductCategory_code
       FROM evn LEFT JOIN c ON ProductCategory = v""",
)
def e02(s, sf):
    df = I.ev(s, sf)
    codes = E.fit_labels(df.where(F.col("ProductCategory") != "error"), "ProductCategory")
    return E.label_encode(I.evn(s, sf), codes, "ProductCategory", "encode")


_FREQ = "SELECT ProductCategory AS v, count(*) AS n, count(*) / (SELECT count(ProductCategory) FROM evn) AS f FROM evn WHERE ProductCategory IS NOT NULL GROUP BY 1"


@query(
    "e03_frequency_encode",
    "TransactionId:i ProductCategory_freq:8",
    f"SELECT TransactionId, coalesce(f, 0) AS ProductCategory_freq FROM evn LEFT JOIN ({_FREQ}) c ON ProductCategory = v",
)
def e03(s, sf):
    df = I.evn(s, sf)
    return E.frequency_encode(df, E.fit_frequencies(df, "ProductCategory"), "ProductCategory")


@query(
    "e04_binary_encode",
    "TransactionId:i ProductCategory_0:i ProductCategory_1:i ProductCategory_2:i",
    """WITH c AS (SELECT v, row_number() OVER (ORDER BY v) AS o FROM (SELECT DISTINCT ProductCategory AS v FROM evn WHERE ProductCategory IS NOT NULL))
       SELECT TransactionId, (coalesce(o, 0) >> 2) & 1 AS ProductCategory_0, (coalesce(o, 0) >> 1) & 1 AS ProductCategory_1, coalesce(o, 0) & 1 AS ProductCategory_2
       FROM evn LEFT JOIN c ON ProductCategory = v""",
)
def e04(s, sf):
    df = I.evn(s, sf)
    return E.binary_encode(df, E.fit_labels(df, "ProductCategory"), "ProductCategory")


_ENC = ["ProductCategory", "CountryCode", "ChannelId"]


@query(
    "e05_encoding_plan",
    "column:s n_unique:i strategy:s mode:s mode_freq:8",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_unique, CASE WHEN count(*) <= 2 THEN 'label' WHEN count(*) <= 15 THEN 'onehot' ELSE 'frequency' END AS strategy,
        arg_max(v, n * 1000000 - r) AS mode, max(n) / sum(n) AS mode_freq FROM (SELECT {c} AS v, count(*) AS n, row_number() OVER (ORDER BY {c}) AS r
        FROM odc GROUP BY {c})"""
        for c in _ENC
    ),
)
def e05(s, sf):
    return E.encoding_plan(I.odc(s, sf), _ENC)


@query(
    "e05_smart_encode",
    "TransactionId:i ChannelId_F:i ChannelId_O:i ChannelId_P:i CountryCode_freq:8",
    """SELECT TransactionId, """
    + ", ".join(f"CASE WHEN ChannelId = '{c}' THEN 1 ELSE 0 END AS ChannelId_{c}" for c in "FOP")
    + ", count(*) OVER (PARTITION BY CountryCode) / count(*) OVER () AS CountryCode_freq FROM odc",
)
def e05b(s, sf):
    return E.smart_encode(I.odc(s, sf).select("TransactionId", "ChannelId", "CountryCode"), ["ChannelId", "CountryCode"])


@query(
    "e06_rare_categories",
    "CountryCode:s n:i CountryCode_freq:8",
    """SELECT CountryCode, count(*) AS n, count(*) / (SELECT count(*) FROM odc) AS CountryCode_freq FROM odc GROUP BY 1
       HAVING count(*) / (SELECT count(*) FROM odc) < 0.04""",
)
def e06(s, sf):
    return E.rare_categories(I.odc(s, sf), "CountryCode", 0.04)


@query(
    "e07_encoding_summary",
    "column:s n_categories:i categories:s",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", (SELECT count(DISTINCT {c}) FROM odc) AS n_categories, string_agg(v, ',' ORDER BY v) AS categories
        FROM (SELECT DISTINCT {c} AS v FROM odc ORDER BY 1 LIMIT 10)"""
        for c in _ENC
    ),
)
def e07(s, sf):
    return E.encoding_summary(I.odc(s, sf), _ENC)


# --- weight of evidence -----------------------------------------------------------------------------

WF = ["Value", "PricingStrategy", "tx_hour"]


def woe_df(s, sf):
    return I.evn(s, sf).withColumn("tx_hour", F.hour("TransactionStartTime"))


def _woe_sql(q, smoothing):
    """Bin tables of Value and tx_hour (quantile bins) and PricingStrategy (one bin per value)."""
    parts = []
    for c, expr in (("Value", "Value"), ("tx_hour", "hour(TransactionStartTime)")):
        parts.append(
            f"""SELECT '{c}' AS feature, CAST({bin_sql('x', q)} AS DOUBLE) AS k, y FROM (SELECT {expr} AS x, FraudResult AS y FROM evn WHERE {expr} IS NOT NULL) r,
            (SELECT {edges_sql(expr, q, 'evn')} FROM evn) e"""
        )
    parts.append("SELECT 'PricingStrategy', CAST(PricingStrategy AS DOUBLE), FraudResult FROM evn")
    lift = "greatest({}, 1e-10)" if smoothing == "floor" else "{}"
    eps = "1e-10" if smoothing == "epsilon" else "0"
    return f"""r AS ({' UNION ALL '.join(parts)}),
      c AS (SELECT feature, k, count(*) FILTER (WHERE y = 0) AS good, count(*) FILTER (WHERE y = 1) AS bad FROM r GROUP BY 1, 2),
      d AS (SELECT *, {lift.format('good / sum(good) OVER (PARTITION BY feature)')} AS good_dist,
            {lift.format('bad / sum(bad) OVER (PARTITION BY feature)')} AS bad_dist FROM c),
      woe AS (SELECT *, row_number() OVER (PARTITION BY feature ORDER BY k) - 1 AS bin, ln((bad_dist + {eps}) / (good_dist + {eps})) AS woe,
            (bad_dist - good_dist) * ln((bad_dist + {eps}) / (good_dist + {eps})) AS iv FROM d)"""


_WOE_OUT = "feature:s bin:i good:i bad:i good_dist:8 bad_dist:8 woe:6 iv:8"


@query("wo1_fit", _WOE_OUT, f"WITH {_woe_sql(10, 'floor')} SELECT * FROM woe")
def wo1(s, sf):
    return E.fit_woe(woe_df(s, sf), WF, "FraudResult")


def _woe_case(c, x):
    return f"(SELECT woe FROM woe w WHERE w.feature = '{c}' AND w.k = {x})"


@query(
    "wo2_apply",
    "TransactionId:i Value:6 tx_hour:6",
    f"""WITH {_woe_sql(10, 'floor')}, b AS (SELECT TransactionId, {bin_sql('Value', 10)} AS kv, {bin_sql('hour(TransactionStartTime)', 10, 'h')} AS kh, Value AS v
        FROM evn, (SELECT {edges_sql('Value', 10, 'evn')} FROM evn) e, (SELECT {edges_sql('hour(TransactionStartTime)', 10, 'evn', 'h')} FROM evn) h)
        SELECT TransactionId, CASE WHEN v IS NOT NULL THEN w1.woe END AS Value, w2.woe AS tx_hour FROM b
        LEFT JOIN woe w1 ON w1.feature = 'Value' AND w1.k = kv LEFT JOIN woe w2 ON w2.feature = 'tx_hour' AND w2.k = kh""",
)
def wo2(s, sf):
    df = woe_df(s, sf)
    return E.woe_transform(df, E.fit_woe(df, WF, "FraudResult"), min_iv=0.0)


@query(
    "wo3_monotonic",
    "feature:s bins:i monotonic:b",
    f"""WITH {_woe_sql(10, 'floor')}, s AS (SELECT feature, woe - lag(woe) OVER (PARTITION BY feature ORDER BY bin) AS step FROM woe)
        SELECT feature, count(*) AS bins, coalesce(min(step) >= 0, true) OR coalesce(max(step) <= 0, true) AS monotonic FROM s GROUP BY 1""",
)
def wo3(s, sf):
    return E.monotonic(E.fit_woe(woe_df(s, sf), WF, "FraudResult"))


_STR = """CASE WHEN iv < 0.02 THEN 'Useless' WHEN iv < 0.1 THEN 'Weak' WHEN iv < 0.3 THEN 'Medium' WHEN iv < 0.5 THEN 'Strong' ELSE 'Suspicious' END AS strength"""


@query(
    "wo4_iv_summary",
    "feature:s iv:6 bins:i strength:s selected:b",
    f"WITH {_woe_sql(10, 'floor')} SELECT *, {_STR}, iv >= 0.02 AS selected FROM (SELECT feature, sum(iv) AS iv, count(*) AS bins FROM woe GROUP BY 1)",
)
def wo4(s, sf):
    return E.information_values(E.fit_woe(woe_df(s, sf), WF, "FraudResult"))


def _raw_iv_sql(cols, t):
    parts = " UNION ALL ".join(f"SELECT '{n}' AS feature, CAST({e} AS DOUBLE) AS k, FraudResult AS y FROM {t} WHERE {e} IS NOT NULL" for n, e in cols)
    return f"""r AS ({parts}), c AS (SELECT feature, k, CAST(count(*) FILTER (WHERE y = 0) AS DOUBLE) AS g, CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) AS b FROM r GROUP BY 1, 2),
      h AS (SELECT feature, CASE WHEN g = 0 THEN 0.5 ELSE g END AS g, CASE WHEN b = 0 THEN 0.5 ELSE b END AS b FROM c),
      d AS (SELECT feature, g / sum(g) OVER (PARTITION BY feature) AS gd, b / sum(b) OVER (PARTITION BY feature) AS bd FROM h),
      ivs AS (SELECT feature, sum((bd - gd) * ln(bd / gd)) AS iv FROM d GROUP BY 1)"""


_RAWC = [("Value", "Value"), ("PricingStrategy", "PricingStrategy"), ("tx_hour", "hour(TransactionStartTime)")]


@query("wo5_raw_value_iv", "feature:s iv:6 strength:s", f"WITH {_raw_iv_sql(_RAWC, 'evn')} SELECT *, {_STR} FROM ivs")
def wo5(s, sf):
    return E.raw_information_values(woe_df(s, sf), WF, "FraudResult")


@query("wo6_five_bins_epsilon", "feature:s bin:i good:i bad:i woe:6 iv:8", f"WITH {_woe_sql(5, 'epsilon')} SELECT * FROM woe")
def wo6(s, sf):
    return E.fit_woe(woe_df(s, sf), WF, "FraudResult", max_bins=5, smoothing="epsilon")


@query(
    "s22_feature_selection",
    "feature:s variance:0 iv:6 redundant:b kept:b",
    f"""WITH x AS (SELECT Value, Value * 1.1e0 + PricingStrategy AS fee, PricingStrategy, FraudResult FROM od), {_raw_iv_sql([(c, c) for c in ('Value', 'fee', 'PricingStrategy')], 'x')},
        v AS ({' UNION ALL '.join(f"SELECT '{c}' AS feature, var_samp({c}) AS variance FROM x" for c in ('Value', 'fee', 'PricingStrategy'))}),
        f AS (SELECT v.*, iv, v.feature = (SELECT CASE WHEN (SELECT iv FROM ivs WHERE feature = 'Value') < (SELECT iv FROM ivs WHERE feature = 'fee') - 1e-9 THEN 'Value' ELSE 'fee' END)
              AND (SELECT abs(corr(Value, fee)) FROM x) > 0.85 AS redundant FROM v JOIN ivs USING (feature))
        SELECT *, variance > 0.01 AND NOT redundant AS kept FROM f""",
)
def s22(s, sf):
    df = I.od(s, sf).withColumn("fee", F.col("Value") * 1.1 + F.col("PricingStrategy"))
    return E.select_features(df, ["Value", "fee", "PricingStrategy"], "FraudResult")


# --- imputation -----------------------------------------------------------------------------------

_MODE = "(SELECT ProductCategory FROM evn WHERE ProductCategory IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query(
    "i01_simple_impute",
    "TransactionId:i by_mean:4 by_median:4 by_constant:4 ProductCategory:s category_constant:s",
    f"""SELECT TransactionId, coalesce(Value, (SELECT avg(Value) FROM evn)) AS by_mean, coalesce(Value, (SELECT median(Value) FROM evn)) AS by_median,
        coalesce(Value, -1) AS by_constant, coalesce(ProductCategory, {_MODE}) AS ProductCategory, coalesce(ProductCategory, 'missing') AS category_constant FROM evn""",
)
def i01(s, sf):
    df = I.evn(s, sf)
    out = df.select(
        "TransactionId",
        F.col("Value").alias("by_mean"),
        F.col("Value").alias("by_median"),
        F.col("Value").alias("by_constant"),
        "ProductCategory",
        F.col("ProductCategory").alias("category_constant"),
    )
    fills = (
        K.fit_imputer(out, ["by_mean"], "mean")
        | K.fit_imputer(out, ["by_median", "ProductCategory"], "median")
        | K.fit_imputer(out, ["by_constant", "category_constant"], "constant", "constant", constant=-1)
    )
    return K.impute(out, fills)


@query(
    "i02_missing_flags",
    "TransactionId:i Value_missing:i ProductCategory_missing:i",
    """SELECT TransactionId, CASE WHEN Value IS NULL THEN 1 ELSE 0 END AS Value_missing,
       CASE WHEN ProductCategory IS NULL THEN 1 ELSE 0 END AS ProductCategory_missing FROM evn""",
)
def i02(s, sf):
    return K.missing_flags(I.evn(s, sf), ["Value", "ProductCategory", "Amount"])


@query(
    "i05_residual_mean_fill",
    "TransactionId:i Value:4",
    "SELECT TransactionId, coalesce(Value, (SELECT avg(Value) FROM evn)) AS Value FROM evn",
)
def i05(s, sf):
    df = I.evn(s, sf)
    return K.impute(df, K.fit_imputer(df, ["Value"], "mean"))


@query(
    "i06_imputation_summary",
    "column:s imputed:i imputed_pct:6 fill_number:4 fill_text:s",
    f"""SELECT 'Value' AS "column", count(*) - count(Value) AS imputed, (count(*) - count(Value)) * 100 / count(*) AS imputed_pct, median(Value) AS fill_number,
        NULL AS fill_text FROM evn UNION ALL SELECT 'ProductCategory', count(*) - count(ProductCategory), (count(*) - count(ProductCategory)) * 100 / count(*), NULL, {_MODE} FROM evn""",
)
def i06(s, sf):
    df = I.evn(s, sf)
    cols = ["Value", "ProductCategory"]
    return K.imputation_summary(df, cols, K.fit_imputer(df, cols))


# --- outliers -------------------------------------------------------------------------------------

_P = "(SELECT quantile_cont(Value, 0.01) AS lo, quantile_cont(Value, 0.99) AS hi FROM evn)"


@query(
    "o01_percentile_cap",
    "TransactionId:i Value:4 Value_outlier:i",
    f"""SELECT TransactionId, CASE WHEN Value IS NOT NULL THEN greatest(least(Value, hi), lo) END AS Value,
        CASE WHEN Value < lo OR Value > hi THEN 1 ELSE 0 END AS Value_outlier FROM evn, {_P}""",
)
def o01(s, sf):
    df = I.evn(s, sf)
    return K.treat_outliers(df, K.percentile_bounds(df, ["Value"]))


@query(
    "o01_percentile_blank",
    "TransactionId:i Value:4 Value_outlier:i",
    f"""SELECT TransactionId, CASE WHEN Value >= lo AND Value <= hi THEN Value END AS Value,
        CASE WHEN Value < lo OR Value > hi THEN 1 ELSE 0 END AS Value_outlier FROM evn, {_P}""",
)
def o01b(s, sf):
    df = I.evn(s, sf)
    return K.treat_outliers(df, K.percentile_bounds(df, ["Value"]), "remove")


def _summary_sql(lo, hi, rows):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, any_value(lo) AS lower_bound, any_value(hi) AS upper_bound, count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers,
        count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100 / {rows.format(c=c)} AS outlier_pct, min({c}) AS min, max({c}) AS max FROM evn,
        (SELECT {lo.format(c=c)} AS lo, {hi.format(c=c)} AS hi FROM evn)"""
        for c in ("Value", "Amount")
    )


_SUM_OUT = "feature:s lower_bound:4 upper_bound:4 outliers:i outlier_pct:6 min:2 max:2"
_IQR_LO = "quantile_cont({c}, 0.25) - 1.5e0 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
_IQR_HI = "quantile_cont({c}, 0.75) + 1.5e0 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"


@query("o02_outlier_summary", _SUM_OUT, _summary_sql("quantile_cont({c}, 0.01)", "quantile_cont({c}, 0.99)", "count(*)"))
def o02(s, sf):
    df = I.evn(s, sf)
    return K.outlier_summary(df, K.percentile_bounds(df, ["Value", "Amount"]))


@query("o03_iqr", _SUM_OUT, _summary_sql(_IQR_LO, _IQR_HI, "count({c})"))
def o03(s, sf):
    df = I.evn(s, sf)
    return K.outlier_summary(df, K.iqr_bounds(df, ["Value", "Amount"]), of_filled=True)


_CNT_OUT = "feature:s method:s outliers:i outlier_pct:6"


def _method_sql(c, method):
    where, src = {
        "zscore": (f"abs(({c} - m) / s) > 3", f"(SELECT avg({c}) m, stddev_pop({c}) s FROM ev)"),
        "modified_zscore": (
            f"0.6745e0 * abs({c} - m) / d > 3.5",
            f"(SELECT m, median(abs({c} - m)) AS d FROM ev, (SELECT median({c}) AS m FROM ev) GROUP BY m)",
        ),
        "iqr": (f"{c} < lo OR {c} > hi", f"(SELECT {_IQR_LO.format(c=c)} lo, {_IQR_HI.format(c=c)} hi FROM ev)"),
        "percentile": (f"{c} < lo OR {c} > hi", f"(SELECT quantile_cont({c}, 0.01) lo, quantile_cont({c}, 0.99) hi FROM ev)"),
    }[method]
    return f"SELECT '{c}' AS feature, '{method}' AS method, count(*) FILTER (WHERE {where}) AS outliers, count(*) FILTER (WHERE {where}) * 100 / count({c}) AS outlier_pct FROM ev, {src}"


def _methods(name, methods):
    @query(name, _CNT_OUT, " UNION ALL ".join(_method_sql(c, m) for c in ("Value", "Amount") for m in methods))
    def run(s, sf):
        df = I.ev(s, sf)
        return K.outlier_counts(df, K.outlier_tests(df, ["Value", "Amount"], methods))


_methods("o04_zscore", ("zscore",))
_methods("o05_modified_zscore", ("modified_zscore",))
_methods("o06_percentile_rule", ("percentile",))
_methods("o07_method_comparison", K.METHODS)

_OUT = f"Amount < lo OR Amount > hi"
_OB = f"(SELECT {_IQR_LO.format(c='Amount')} AS lo, {_IQR_HI.format(c='Amount')} AS hi FROM ev) b"


def _flag(df):
    return K.outside("Amount", K.iqr_bounds(df, ["Amount"])["Amount"])


@query(
    "o10_outlier_contrast",
    "feature:s outlier_mean:4 inlier_mean:4 difference_pct:4",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, avg({c}) FILTER (WHERE {_OUT}) AS outlier_mean, avg({c}) FILTER (WHERE NOT ({_OUT})) AS inlier_mean,
        (avg({c}) FILTER (WHERE {_OUT}) - avg({c}) FILTER (WHERE NOT ({_OUT}))) / avg({c}) FILTER (WHERE NOT ({_OUT})) * 100 AS difference_pct FROM ev, {_OB}"""
        for c in ("Amount", "PricingStrategy")
    ),
)
def o10(s, sf):
    df = I.ev(s, sf)
    return K.outlier_contrast(df, _flag(df), ["Amount", "PricingStrategy"])


@query(
    "o11_outlier_days",
    "period:s total:2 z_score:5 is_outlier:b",
    f"""WITH d AS ({resample_sql('day', 'od')}) SELECT *, z_score > 3 AS is_outlier FROM (
        SELECT d.*, abs((total - m) / s) AS z_score FROM d, (SELECT avg(total) m, stddev(total) s FROM d))""",
)
def o11(s, sf):
    return K.outlier_days(I.od(s, sf))


@query(
    "o12_outlier_fraud",
    "outliers:i rate_overall:6 rate_outliers:6 rate_inliers:6 capture_rate:6 risk_ratio:5 chi_square:4 significant:b reading:s",
    f"""WITH t AS (SELECT count(*) FILTER (WHERE o AND f)::DOUBLE a, count(*) FILTER (WHERE o AND NOT f)::DOUBLE b, count(*) FILTER (WHERE NOT o AND f)::DOUBLE c,
         count(*) FILTER (WHERE NOT o AND NOT f)::DOUBLE d FROM (SELECT {_OUT} AS o, FraudResult = 1 AS f FROM ev, {_OB})),
        r AS (SELECT a + b AS outliers, (a + c) / (a + b + c + d) * 100 AS rate_overall, coalesce(a / nullif(a + b, 0), 0) * 100 AS rate_outliers,
         coalesce(c / nullif(c + d, 0), 0) * 100 AS rate_inliers, coalesce(a / nullif(a + c, 0), 0) * 100 AS capture_rate,
         (a+b+c+d) * pow(greatest(abs(a*d - b*c) - (a+b+c+d) / 2, 0), 2) / nullif((a+b) * (c+d) * (a+c) * (b+d), 0) AS chi_square FROM t),
        q AS (SELECT *, rate_outliers / nullif(rate_inliers, 0) AS risk_ratio, chi_square > 3.841458820694124 AS significant FROM r)
        SELECT *, CASE WHEN risk_ratio > 3 THEN 'HIGH' WHEN risk_ratio > 2 THEN 'MEDIUM' WHEN risk_ratio > 1 THEN 'LOW' ELSE 'NONE' END AS reading FROM q""",
)
def o12(s, sf):
    df = I.ev(s, sf)
    return K.outlier_fraud(df, _flag(df))


def _impact_sql():
    stats = {
        "mean": "avg(Amount)", "std": "stddev(Amount)", "min": "min(Amount)", "q25": "quantile_cont(Amount, 0.25)",
        "q50": "quantile_cont(Amount, 0.5)", "q75": "quantile_cont(Amount, 0.75)", "max": "max(Amount)",
    }
    return f"WITH k AS (SELECT Amount FROM ev, {_OB} WHERE NOT ({_OUT})) " + " UNION ALL ".join(
        f"SELECT '{n}' AS statistic, w AS with_outliers, wo AS without_outliers, coalesce((wo - w) / nullif(w, 0) * 100, 0) AS change_pct FROM (SELECT {e} AS w FROM ev), (SELECT {e} AS wo FROM k)"
        for n, e in stats.items()
    )


@query("o13_outlier_impact", "statistic:s with_outliers:4 without_outliers:4 change_pct:4", _impact_sql())
def o13(s, sf):
    df = I.ev(s, sf)
    return K.outlier_impact(df, _flag(df))


@query(
    "o13_impact_level",
    "outlier_pct:6 impact:s documentation:s",
    f"""SELECT p AS outlier_pct, CASE WHEN p < 1 THEN 'Minimal impact' WHEN p < 5 THEN 'Low impact' WHEN p < 10 THEN 'Moderate impact' ELSE 'High impact' END AS impact,
        CASE WHEN p > 10 THEN 'Justification' WHEN p > 5 THEN 'Document' ELSE 'Within limits' END AS documentation
        FROM (SELECT count(*) FILTER (WHERE {_OUT}) * 100 / count(*) AS p FROM ev, {_OB})""",
)
def o13b(s, sf):
    df = I.ev(s, sf)
    return K.impact_level(df, _flag(df))


@query(
    "o14_treatment_advice",
    "pct:6 priority:s treatment:s",
    f"""WITH a AS (SELECT count(*) FILTER (WHERE {_OUT}) * 100 / count(*) AS pct, avg(Amount) FILTER (WHERE {_OUT}) AS om, avg(Amount) AS am,
         avg(FraudResult) FILTER (WHERE {_OUT}) AS orate, avg(FraudResult) AS arate FROM ev, {_OB})
        SELECT pct, CASE WHEN pct < 1 THEN 'Low' WHEN pct < 5 THEN CASE WHEN om > am * 10 THEN 'High' ELSE 'Medium' END WHEN pct < 10 THEN 'High' ELSE 'Critical' END AS priority,
         CASE WHEN pct < 1 THEN 'leave as they are' WHEN pct < 5 THEN CASE WHEN om > am * 10 THEN 'cap at the 0.99 quantile' ELSE 'scale by quartiles' END
         WHEN pct < 10 THEN 'trace the origin' ELSE 'leave out with a note' END AS treatment FROM a
        UNION ALL SELECT pct, 'Critical', 'model flagged rows apart' FROM a WHERE orate > arate * 3""",
)
def o14(s, sf):
    df = I.ev(s, sf)
    return K.treatment_advice(df, _flag(df))


# --- scaling --------------------------------------------------------------------------------------


def _scaling(name, kind, expr, **options):
    @query(
        name,
        "TransactionId:i Value:5 Amount:5",
        f"SELECT TransactionId, {expr.format(c='Value', p='v')} AS Value, {expr.format(c='Amount', p='a')} AS Amount FROM ev, (SELECT "
        + ", ".join(
            f"avg({c}) {p}avg, stddev_pop({c}) {p}std, min({c}) {p}min, max({c}) {p}max, median({c}) {p}med, quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25) {p}iqr, max(abs({c})) {p}abs"
            for c, p in (("Value", "v"), ("Amount", "a"))
        )
        + " FROM ev)",
    )
    def run(s, sf):
        df = I.ev(s, sf)
        return K.scale(df, K.fit_scaler(df, ["Value", "Amount"], kind, **options))


_scaling("n01_standard_scale", "standard", "({c} - {p}avg) / {p}std")
_scaling("n02_min_max_scale", "minmax", "({c} - {p}min) / ({p}max - {p}min) * 2 - 1", lo=-1.0, hi=1.0)
_scaling("n03_robust_scale", "robust", "({c} - {p}med) / {p}iqr")
_scaling("n04_max_abs_scale", "maxabs", "{c} / {p}abs")


@query("n05_inverse_scale", "TransactionId:i Value:6 Amount:6", "SELECT TransactionId, Value, Amount FROM ev")
def n05(s, sf):
    df = I.ev(s, sf)
    p = K.fit_scaler(df, ["Value", "Amount"], "robust")
    return K.unscale(K.scale(df, p), p)


@query(
    "n06_scaling_summary",
    "feature:s offset:4 divisor:4 scaled_mean:6 scaled_std:6",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, m AS "offset", s AS divisor, avg(({c} - m) / s) AS scaled_mean, stddev_pop(({c} - m) / s) AS scaled_std
        FROM ev, (SELECT avg({c}) m, stddev_pop({c}) s FROM ev) GROUP BY m, s"""
        for c in ("Value", "Amount")
    ),
)
def n06(s, sf):
    df = I.ev(s, sf)
    return K.scaling_summary(df, K.fit_scaler(df, ["Value", "Amount"]))
