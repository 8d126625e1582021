"""Profiling, statistics and correlation."""

from itertools import combinations

from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import profile as P, relations as R

from . import inputs as I
from .q_relations import value_counts_sql
from .registry import query

NUM = ["Value", "Amount", "PricingStrategy", "FraudResult"]
# numeric view with the hour and the customer's frequency
NUMX_SQL = """SELECT Value, Amount, PricingStrategy, FraudResult, hour(TransactionStartTime) AS tx_hour,
 isodow(TransactionStartTime) - 1 AS tx_weekday, count(*) OVER (PARTITION BY CustomerId) AS customer_frequency, ProductCategory FROM ev"""
NUMX = ["Value", "Amount", "PricingStrategy", "FraudResult", "tx_hour"]


def numx(s, sf):
    df = I.ev(s, sf)
    df = df.withColumns({"tx_hour": F.hour("TransactionStartTime"), "tx_weekday": F.weekday("TransactionStartTime")})
    return R.add_frequencies(df, {"CustomerId": "customer_frequency"})


def numx_plain(s, sf):
    return I.ev(s, sf).withColumn("tx_hour", F.hour("TransactionStartTime"))


@query(
    "s01_structure",
    "metric:s value:i",
    """SELECT 'rows' AS metric, count(*) AS value FROM ev UNION ALL SELECT * FROM (VALUES ('columns', 11), ('numeric_columns', 6),
       ('text_columns', 4), ('datetime_columns', 1), ('boolean_columns', 0)) v""",
)
def s01(s, sf):
    return P.structure(I.ev(s, sf))


_OV = ["TransactionId", "CustomerId", "Value", "ProductCategory", "ChannelId", "FraudResult"]


@query(
    "s02_column_overview",
    "column:s rows:i non_null:i nulls:i null_pct:6 distinct_values:i",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS rows, count({c}) AS non_null, count(*) - count({c}) AS nulls,
        (count(*) - count({c})) * 100 / count(*) AS null_pct, count(DISTINCT {c}) AS distinct_values FROM evn"""
        for c in _OV
    ),
)
def s02(s, sf):
    return P.column_overview(I.evn(s, sf).select(*_OV))


def describe_sql(cols, t):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, count({c}) AS n, avg({c}) AS mean, stddev({c}) AS std, min({c}) AS min, max({c}) AS max,
        quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75,
        skewness({c}) AS skewness, kurtosis({c}) AS kurtosis FROM {t}"""
        for c in cols
    )


@query(
    "s03_numeric_descriptives",
    "feature:s n:i mean:4 std:4 min:4 max:4 q25:4 q50:4 q75:4 skewness:5 kurtosis:4",
    describe_sql(NUM, "evn"),
)
def s03(s, sf):
    return P.describe(I.evn(s, sf), NUM)


_CAT = ["ProductCategory", "ChannelId", "ProviderId"]


def _cat_sql(t):
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS distinct_values, arg_max(v, n * 1000000 - r) AS mode, max(n) * 100 / (SELECT count(*) FROM {t}) AS mode_pct,
        -sum(n / tot * log2(n / tot + 1e-10)) AS entropy FROM (SELECT {c} AS v, count(*) AS n, sum(count(*)) OVER () AS tot,
        row_number() OVER (ORDER BY {c}) AS r FROM {t} WHERE {c} IS NOT NULL GROUP BY {c})"""
        for c in _CAT
    )


@query("s04_categorical_descriptives", "column:s distinct_values:i mode:s mode_pct:6", _cat_sql("evn"))
def s04(s, sf):
    return P.category_summary(I.evn(s, sf), _CAT)


@query("s04_top_values", "column:s value:s n:i rank:i", value_counts_sql(_CAT, "evn", 5))
def s04b(s, sf):
    return R.value_counts(I.evn(s, sf), _CAT, 5)


@query(
    "s05_distribution",
    "feature:s iqr:4 skewness:5 kurtosis:4 is_normal:b",
    f"SELECT *, q75 - q25 AS iqr, abs(skewness) < 0.5 AND abs(kurtosis) < 1 AS is_normal FROM ({describe_sql(NUM, 'ev')})",
)
def s05(s, sf):
    return P.distribution(I.ev(s, sf), NUM)


@query("s06_category_entropy", "column:s entropy:6", _cat_sql("ev"))
def s06(s, sf):
    return P.category_summary(I.ev(s, sf), _CAT)


@query(
    "s07_shape_reading",
    "feature:s skew_reading:s kurtosis_reading:s transform:s",
    f"""SELECT feature, CASE WHEN abs(skewness) < 0.5 THEN 'Approximately symmetric' WHEN abs(skewness) < 1 THEN 'Moderately skewed'
        ELSE 'Highly skewed' END AS skew_reading, CASE WHEN kurtosis > 0 THEN 'Leptokurtic' WHEN kurtosis < 0 THEN 'Platykurtic'
        ELSE 'Mesokurtic' END AS kurtosis_reading, CASE WHEN abs(skewness) > 1 THEN 'Yes' ELSE 'No' END AS transform
        FROM ({describe_sql(NUM, 'ev')})""",
)
def s07(s, sf):
    return P.shape_reading(I.ev(s, sf), NUM)


@query(
    "s08_channel_entropy",
    "ChannelId:s entropy:6",
    """WITH r AS (SELECT ChannelId, Amount, min(Amount) OVER (PARTITION BY ChannelId) lo, max(Amount) OVER (PARTITION BY ChannelId) hi FROM od),
       b AS (SELECT ChannelId, least(floor((Amount - lo) / (hi - lo) * 20) + 1, 20) AS bin, count(*) AS n FROM r GROUP BY 1, 2),
       p AS (SELECT ChannelId, n / sum(n) OVER (PARTITION BY ChannelId) AS p FROM b)
       SELECT ChannelId, -sum(p * log2(p)) AS entropy FROM p GROUP BY 1""",
)
def s08(s, sf):
    return P.histogram_entropy(I.od(s, sf), "ChannelId", "Amount")


@query(
    "s09_histogram",
    "bin:i n:i",
    """SELECT least(floor((Value - lo) / (hi - lo) * 50) + 1, 50) AS bin, count(*) AS n
       FROM ev, (SELECT min(Value) lo, max(Value) hi FROM ev) GROUP BY 1""",
)
def s09(s, sf):
    return P.histogram(I.ev(s, sf), "Value", 50)


def pairs_sql(cols, src, fmt="corr({a}, {b})"):
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_1, '{b}' AS feature_2, {fmt.format(a=a, b=b)} AS correlation FROM {src}"
        for a, b in combinations(cols, 2)
    )


PEARSON_SQL = f"WITH x AS ({NUMX_SQL}) " + pairs_sql(NUMX, "x")


@query("s10_pearson", "feature_1:s feature_2:s correlation:6", PEARSON_SQL)
def s10(s, sf):
    return P.pearson(numx_plain(s, sf), NUMX)


@query(
    "s11_strong_pairs",
    "feature_1:s feature_2:s correlation:6 strength:s",
    """WITH x AS (SELECT Value, Value * 1.1e0 + PricingStrategy AS fee, Amount FROM od), p AS ("""
    + pairs_sql(["Value", "fee", "Amount"], "x")
    + ") SELECT *, CASE WHEN abs(correlation) > 0.8 THEN 'Very Strong' ELSE 'Strong' END AS strength FROM p WHERE abs(correlation) > 0.7",
)
def s11(s, sf):
    df = I.od(s, sf).withColumn("fee", F.col("Value") * 1.1 + F.col("PricingStrategy"))
    return P.strong_pairs(P.pearson(df, ["Value", "fee", "Amount"]))


_RANK = "rank() OVER ({p} ORDER BY {c}) + (count(*) OVER (PARTITION BY {pc} {c}) - 1) / 2.0e0 AS {c}"


def _ranks(cols, by=None):
    return ", ".join(
        _RANK.format(c=c, p=f"PARTITION BY {by}" if by else "", pc=f"{by}," if by else "") for c in cols
    )


@query(
    "s12_spearman",
    "feature_1:s feature_2:s correlation:6",
    f"WITH x AS (SELECT {_ranks(NUM)} FROM ev) " + pairs_sql(NUM, "x"),
)
def s12(s, sf):
    return P.spearman(I.ev(s, sf), NUM)


_KEN = ["Value", "PricingStrategy", "FraudResult"]


def _kendall_sql(a, b):
    return f"""SELECT '{a}' AS feature_1, '{b}' AS feature_2, (SELECT sum(p.n * q.n * sign(q.y - p.y)) FROM g{a}{b} p JOIN g{a}{b} q ON p.x < q.x)
      / sqrt((tot - tx) * (tot - ty)) AS correlation
      FROM (SELECT sum(n) * (sum(n) - 1) / 2 AS tot FROM g{a}{b}),
           (SELECT sum(t * (t - 1) / 2) AS tx FROM (SELECT sum(n) AS t FROM g{a}{b} GROUP BY x)),
           (SELECT sum(t * (t - 1) / 2) AS ty FROM (SELECT sum(n) AS t FROM g{a}{b} GROUP BY y))"""


@query(
    "s13_kendall",
    "feature_1:s feature_2:s correlation:6",
    "WITH "
    + ", ".join(
        f"g{a}{b} AS (SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS n FROM ev GROUP BY 1, 2)"
        for a, b in combinations(_KEN, 2)
    )
    + " "
    + " UNION ALL ".join(_kendall_sql(a, b) for a, b in combinations(_KEN, 2)),
)
def s13(s, sf):
    return P.kendall(I.ev(s, sf), _KEN)


@query(
    "s14_pair_risk",
    "feature_1:s feature_2:s correlation:6 risk:i",
    f"WITH x AS ({NUMX_SQL}), p AS ({pairs_sql(NUMX, 'x')}) "
    "SELECT *, CASE WHEN abs(correlation) > 0.7 THEN 3 WHEN abs(correlation) > 0.3 THEN 2 WHEN abs(correlation) > 0.1 THEN 1 ELSE 0 END AS risk FROM p",
)
def s14(s, sf):
    return P.pair_risk(P.pearson(numx_plain(s, sf), NUMX))


@query(
    "s15_target_correlation",
    "feature:s correlation:6 rank:i",
    "WITH t AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, FraudResult) AS correlation FROM ev" for c in NUM[:3])
    + ") SELECT *, row_number() OVER (ORDER BY abs(correlation) DESC) AS rank FROM t",
)
def s15(s, sf):
    from pyspark.sql import Window as W

    t = P.with_target(I.ev(s, sf), NUM[:3], "FraudResult")
    # one row per feature
    return t.withColumn("rank", F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.abs("correlation").desc())))


# Student's tail by Simpson's rule over the angle asin(r); the normal one over z
_STUDENT = """CASE WHEN abs(correlation) >= 1 THEN 0 ELSE (SELECT 1 - 2 * exp(lgamma((n - 1) / 2.0) - lgamma((n - 2) / 2.0)) / sqrt(pi()) * asin(abs(correlation)) / 12000
   * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * pow(cos(asin(abs(correlation)) * i / 4000.0), n - 3)) FROM range(4001) AS g(i)) END"""
_NORMAL = """(SELECT 1 - 2 / sqrt(2 * pi()) * least(abs(z), 12.0) / 12000
   * sum(CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END * exp(-pow(least(abs(z), 12.0) * i / 4000.0, 2) / 2)) FROM range(4001) AS g(i))"""
_STARS = "CASE WHEN p_value < 0.001 THEN '***' WHEN p_value < 0.01 THEN '**' WHEN p_value < 0.05 THEN '*' ELSE '' END"
_SPEARMAN = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, corr({c}, FraudResult) AS correlation, count(*) AS n FROM (SELECT {_ranks([c, 'FraudResult'])} FROM evn WHERE {c} IS NOT NULL)" for c in NUM[:3]
)
_PEARSON = " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, FraudResult) AS correlation, count(*) AS n FROM evn WHERE {c} IS NOT NULL" for c in NUM[:3])


def _tested(rows, p, z="atanh(correlation) * sqrt(n - 3)"):
    return f"SELECT *, {_STARS} AS significance FROM (SELECT *, {p} AS p_value FROM (SELECT *, {z} AS z FROM ({rows})))"


@query("s16_correlation_significance", "feature:s correlation:6 n:i z:4 p_value:6 significance:s", _tested(_SPEARMAN, _STUDENT))
def s16(s, sf):
    return P.significance(I.evn(s, sf), NUM[:3], "FraudResult")


def _kendall_test_sql(c, y):
    g = f"g{c}"
    five = "sum(t * (t - 1) * (2 * t + 5))"
    sums = f"SELECT sum(t * (t - 1)) AS pairs, sum(t * (t - 1) * (t - 2)) AS triples, {five} AS five FROM (SELECT sum(n) AS t FROM {g} GROUP BY"
    return f"""SELECT '{c}' AS feature, s / sqrt((m / 2 - a.pairs / 2) * (m / 2 - b.pairs / 2)) AS correlation, CAST(k AS BIGINT) AS n,
       s / sqrt((m * (2 * k + 5) - a.five - b.five) / 18 + a.pairs * b.pairs / (2 * m) + a.triples * b.triples / (9 * m * (k - 2))) AS z
       FROM (SELECT (SELECT sum(p.n * q.n * sign(q.y - p.y)) FROM {g} p JOIN {g} q ON p.x < q.x) AS s, k, k * (k - 1) AS m FROM (SELECT sum(n) AS k FROM {g})),
       ({sums} x)) AS a, ({sums} y)) AS b"""


_KT = ["PricingStrategy", "Value"]


@query(
    "s16_three_tests",
    "method:s feature:s correlation:6 n:i p_value:6 significance:s",
    "WITH "
    + ", ".join(f"g{c} AS (SELECT CAST({c} AS DOUBLE) AS x, CAST(FraudResult AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS n FROM evn WHERE {c} IS NOT NULL GROUP BY 1, 2)" for c in _KT)
    + f""" SELECT 'pearson' AS method, feature, correlation, n, p_value, significance FROM ({_tested(_PEARSON, _STUDENT)})
    UNION ALL SELECT 'spearman', feature, correlation, n, p_value, significance FROM ({_tested(_SPEARMAN, _STUDENT)})
    UNION ALL SELECT 'kendall', feature, correlation, n, p_value, significance FROM ({_tested(" UNION ALL ".join(_kendall_test_sql(c, "FraudResult") for c in _KT), _NORMAL, "z")})""".replace("*, z AS z FROM", "* FROM"),
)
def s16_three(s, sf):
    df = I.evn(s, sf)
    tests = [P.significance(df, NUM[:3], "FraudResult", m) for m in ("pearson", "spearman")] + [P.significance(df, _KT, "FraudResult", "kendall")]
    out = tests[0]
    for t in tests[1:]:
        out = out.unionByName(t)
    return out


def _vif3(a, b, c):
    return f"""1 / (1 - (pow(corr({a},{b}), 2) + pow(corr({a},{c}), 2) - 2 * corr({a},{b}) * corr({a},{c}) * corr({b},{c}))
      / (1 - pow(corr({b},{c}), 2)))"""


_VIF = ["Value", "Amount", "PricingStrategy"]


def _vif_sql(cols, t):
    a, b, c = cols
    return " UNION ALL ".join(
        f"SELECT '{x}' AS feature, {_vif3(x, y, z)} AS vif FROM {t}" for x, y, z in ((a, b, c), (b, a, c), (c, a, b))
    )


_VIF_BAND = "CASE WHEN vif <= 5 THEN 'Low' WHEN vif <= 10 THEN 'Medium' WHEN vif <= 20 THEN 'High' ELSE 'Very High' END"


@query("s17_inflation_factors", "feature:s vif:6 risk:s", f"SELECT *, {_VIF_BAND} AS risk FROM ({_vif_sql(_VIF, 'ev')})")
def s17(s, sf):
    return P.vif(I.ev(s, sf), _VIF)


@query(
    "s18_partial_correlation",
    "feature_1:s feature_2:s controls:s correlation:6",
    f"""WITH x AS ({NUMX_SQL}) SELECT 'Amount' AS feature_1, 'FraudResult' AS feature_2, 'tx_hour' AS controls,
        (a - b * c) / sqrt((1 - b * b) * (1 - c * c)) AS correlation FROM (SELECT corr(Amount, FraudResult) a, corr(Amount, tx_hour) b,
        corr(FraudResult, tx_hour) c FROM x)""",
)
def s18(s, sf):
    return P.partial_correlation(numx_plain(s, sf), "Amount", "FraudResult", ["tx_hour"])


def _partial_sql(x, y, controls):
    """Partial correlation by taking one control out at a time."""

    def r(a, b, z):
        if not z:
            return f"corr({a}, {b})"
        ab, ac, bc = r(a, b, z[:-1]), r(a, z[-1], z[:-1]), r(b, z[-1], z[:-1])
        return f"(({ab}) - ({ac}) * ({bc})) / sqrt((1 - pow({ac}, 2)) * (1 - pow({bc}, 2)))"

    return f"WITH x AS ({NUMX_SQL}) SELECT '{x}' AS feature_1, '{y}' AS feature_2, '{','.join(controls)}' AS controls, {r(x, y, controls)} AS correlation FROM x"


@query(
    "s18_partial_three_controls",
    "feature_1:s feature_2:s controls:s correlation:6",
    _partial_sql("Amount", "FraudResult", ["tx_hour", "tx_weekday", "customer_frequency"]),
)
def s18b(s, sf):
    return P.partial_correlation(numx(s, sf), "Amount", "FraudResult", ["tx_hour", "tx_weekday", "customer_frequency"])


_SEG = ["Value", "PricingStrategy"]


@query(
    "s19_segment_spearman",
    "ProductCategory:s n:i feature_1:s feature_2:s correlation:6",
    f"""SELECT ProductCategory, count(*) AS n, 'Value' AS feature_1, 'PricingStrategy' AS feature_2, corr(Value, PricingStrategy) AS correlation
        FROM (SELECT ProductCategory, {_ranks(_SEG, 'ProductCategory')} FROM ev) GROUP BY 1 HAVING count(*) > 100""",
)
def s19(s, sf):
    return P.segment_spearman(I.ev(s, sf), "ProductCategory", _SEG)


@query(
    "s20_correlation_graph",
    "feature:s degree:i centrality:6",
    f"""WITH x AS ({NUMX_SQL}), p AS ({pairs_sql(NUMX, 'x')}), e AS (SELECT * FROM p WHERE abs(correlation) > 0.1)
        SELECT feature, count(e.feature_1) AS degree, count(e.feature_1) / 4 AS centrality
        FROM (SELECT unnest({NUMX!r}) AS feature) f LEFT JOIN e ON feature IN (e.feature_1, e.feature_2) GROUP BY feature""",
)
def s20(s, sf):
    return P.correlation_graph(P.pearson(numx_plain(s, sf), NUMX), NUMX, 0.1)


_REC = ["Value", "Amount", "PricingStrategy"]


@query(
    "s21_feature_recommendations",
    "feature:s target_correlation:6 null_pct:6 vif:6 priority:s drop:b multicollinear:b",
    "WITH b AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, corr({c}, FraudResult) AS target_correlation, (count(*) - count({c})) * 100 / count(*) AS null_pct FROM evn"
        for c in _REC
    )
    + "), v AS (SELECT 'Value' AS feature, 1 / (1 - pow(corr(Value, Amount), 2)) AS vif FROM evn UNION ALL "
    "SELECT 'Amount', 1 / (1 - pow(corr(Value, Amount), 2)) FROM evn) "
    "SELECT b.*, vif, CASE WHEN abs(target_correlation) > 0.3 THEN 'high' WHEN abs(target_correlation) > 0.1 THEN 'medium' ELSE 'low' END AS priority, "
    "null_pct > 30 AS \"drop\", coalesce(vif > 5, false) AS multicollinear FROM b LEFT JOIN v USING (feature)",
)
def s21(s, sf):
    return P.recommendations(I.evn(s, sf), _REC, "FraudResult", ["Value", "Amount"])


@query(
    "j09_recommendations_with_vif",
    "feature:s target_correlation:6 vif:6 risk:s",
    "WITH b AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS feature, corr({c}, FraudResult) AS target_correlation FROM ev" for c in _REC)
    + "), v AS (SELECT 'Value' AS feature, 1 / (1 - pow(corr(Value, Amount), 2)) AS vif FROM ev UNION ALL "
    f"SELECT 'Amount', 1 / (1 - pow(corr(Value, Amount), 2)) FROM ev) SELECT b.*, vif, CASE WHEN vif IS NOT NULL THEN {_VIF_BAND} END AS risk FROM b LEFT JOIN v USING (feature)",
)
def j09(s, sf):
    return P.recommendations(I.ev(s, sf), _REC, "FraudResult", ["Value", "Amount"])


_PSI_EDGES = ", ".join(f"quantile_cont(Value, {i / 10}) AS e{i}" for i in range(1, 10))
_PSI_BIN = " + ".join(f"CASE WHEN Value > e{i} THEN 1 ELSE 0 END" for i in range(1, 10))
_PSI_CUT = "TIMESTAMP '2024-01-16 00:00:00'"


@query(
    "s23_stability_index",
    "psi:6 stable:b",
    f"""WITH e AS (SELECT {_PSI_EDGES} FROM ev WHERE TransactionStartTime < {_PSI_CUT}),
        c AS (SELECT {_PSI_BIN} AS bin, count(*) FILTER (WHERE TransactionStartTime < {_PSI_CUT}) AS b,
              count(*) FILTER (WHERE TransactionStartTime >= {_PSI_CUT}) AS a FROM ev, e GROUP BY 1),
        sh AS (SELECT greatest(b / sum(b) OVER (), 1e-10) AS b, greatest(a / sum(a) OVER (), 1e-10) AS a FROM c)
        SELECT sum((a - b) * ln(a / b)) AS psi, sum((a - b) * ln(a / b)) < 0.25 AS stable FROM sh""",
)
def s23(s, sf):
    df = I.ev(s, sf)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp")
    return P.stability_index(df.where(F.col("TransactionStartTime") < cut), df.where(F.col("TransactionStartTime") >= cut), "Value")


@query(
    "s24_value_at_risk",
    "var_95:4 var_99:4 es_95:4 es_99:4",
    """WITH q AS (SELECT quantile_cont(Amount, 0.05) AS a, quantile_cont(Amount, 0.01) AS b FROM od)
       SELECT max(a) AS var_95, max(b) AS var_99, avg(Amount) FILTER (WHERE Amount <= a) AS es_95,
       avg(Amount) FILTER (WHERE Amount <= b) AS es_99 FROM od, q""",
)
def s24(s, sf):
    return P.value_at_risk(I.od(s, sf), "Amount")


@query(
    "s25_volatility",
    "volatility:4 annualized_volatility:3 sharpe_ratio:6",
    """SELECT stddev(Amount) AS volatility, stddev(Amount) * sqrt(252) AS annualized_volatility,
       avg(Amount) / stddev(Amount) * sqrt(252) AS sharpe_ratio FROM od""",
)
def s25(s, sf):
    return P.volatility(I.od(s, sf), "Amount")


@query(
    "s26_coefficient_of_variation",
    "coefficient_of_variation:6",
    "SELECT stddev(Value) / avg(Value) AS coefficient_of_variation FROM ev",
)
def s26(s, sf):
    return P.volatility(I.ev(s, sf), "Value")


_G1 = "(CASE WHEN min({c}) = max({c}) THEN 0 ELSE skewness({c}) * (count({c}) - 2) / sqrt(count({c})::DOUBLE * (count({c}) - 1)) END)"


@query(
    "s27_normality",
    "feature:s jarque_bera:2 looks_normal:b",
    "WITH m AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, count({c}) AS n, {_G1.format(c=c)} AS g1, kurtosis_pop({c}) AS g2 FROM ev" for c in ("Value", "Amount", "PricingStrategy")
    )
    + ") SELECT feature, n / 6.0e0 * (g1 * g1 + g2 * g2 / 4) AS jarque_bera, n / 6.0e0 * (g1 * g1 + g2 * g2 / 4) < 5.991464547107979 AS looks_normal FROM m",
)
def s27(s, sf):
    return P.normality(I.ev(s, sf), ["Value", "Amount", "PricingStrategy"])


@query(
    "s28_skew_transforms",
    "transform:s skewness:5 kurtosis:5",
    """WITH v AS (SELECT Amount AS original, ln(1 + Amount - lo + 1) AS log, sqrt(Amount - lo) AS square_root, cbrt(Amount) AS cube_root
       FROM ev, (SELECT min(Amount) AS lo FROM ev)) """
    + " UNION ALL ".join(
        f"SELECT '{c}' AS transform, {_G1.format(c=c)} AS skewness, kurtosis_pop({c}) AS kurtosis FROM v"
        for c in ("original", "log", "square_root", "cube_root")
    ),
)
def s28(s, sf):
    return P.skew_transforms(I.ev(s, sf), "Amount")


_GRID = f"(SELECT unnest({P.LAMBDAS!r}::DOUBLE[]) AS l)"
_BC = "CASE WHEN l = 0 THEN ln(Value) ELSE (pow(Value, l) - 1) / l END"
_YJ = """CASE WHEN Amount >= 0 THEN CASE WHEN l = 0 THEN ln(1 + Amount) ELSE (pow(Amount + 1, l) - 1) / l END
 ELSE CASE WHEN l = 2 THEN -ln(1 - Amount) ELSE -(pow(1 - Amount, 2 - l) - 1) / (2 - l) END END"""


@query(
    "s29_power_transform",
    "method:s lambda:1 log_likelihood:3 best:b",
    f"""WITH bc AS (SELECT 'box_cox' AS method, l AS lambda, CASE WHEN (SELECT min(Value) FROM ev) > 0 THEN (l - 1) * sum(ln(Value)) - count(*) / 2 * ln(var_pop({_BC})) END AS log_likelihood FROM (SELECT greatest(Value, 1e-9) AS Value FROM ev), {_GRID} GROUP BY l),
        yj AS (SELECT 'yeo_johnson' AS method, l AS lambda, (l - 1) * sum(sign(Amount) * ln(1 + abs(Amount))) - count(*) / 2 * ln(var_pop({_YJ})) AS log_likelihood
               FROM ev, {_GRID} GROUP BY l), g AS (SELECT * FROM bc UNION ALL SELECT * FROM yj)
        SELECT *, log_likelihood = max(log_likelihood) OVER (PARTITION BY method) AS best FROM g""",
)
def s29(s, sf):
    df = I.ev(s, sf)
    return P.power_transform(df, "Value", "box_cox").unionByName(P.power_transform(df, "Amount", "yeo_johnson"))


@query(
    "s30_chi_square",
    "n11:i n10:i n01:i n00:i chi_square:6 significant:b",
    """WITH t AS (SELECT count(*) FILTER (WHERE a AND b)::DOUBLE n11, count(*) FILTER (WHERE a AND NOT b)::DOUBLE n10,
         count(*) FILTER (WHERE NOT a AND b)::DOUBLE n01, count(*) FILTER (WHERE NOT a AND NOT b)::DOUBLE n00
         FROM (SELECT PricingStrategy = 0 AS a, FraudResult = 1 AS b FROM ev)),
       c AS (SELECT *, (n11+n10+n01+n00) * pow(greatest(abs(n11*n00 - n10*n01) - (n11+n10+n01+n00) / 2, 0), 2)
         / ((n11+n10) * (n01+n00) * (n11+n01) * (n10+n00)) AS chi_square FROM t)
       SELECT *, chi_square > 3.841458820694124 AS significant FROM c""",
)
def s30(s, sf):
    return P.chi_square(I.ev(s, sf), F.col("PricingStrategy") == 0, F.col("FraudResult") == 1)
