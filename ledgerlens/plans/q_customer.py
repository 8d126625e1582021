"""Customer aggregates, time patterns and row functions."""

from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import behaviour, customer as C, evaluation as E, ordered, profile
from ledgerlens.session import cut

from . import inputs as I
from .registry import query

A1_SQL = """SELECT CustomerId, sum(Value) AS total_transaction_amount, avg(Value) AS avg_transaction_amount,
 count(TransactionId) AS transaction_count, coalesce(stddev(Value), 0) AS std_transaction_amount FROM {t} GROUP BY CustomerId"""
A1_COLS = ["total_transaction_amount", "avg_transaction_amount", "transaction_count", "std_transaction_amount"]


@query(
    "a01_required_aggregates",
    "CustomerId:i total_transaction_amount:2 avg_transaction_amount:3 transaction_count:i std_transaction_amount:3",
    A1_SQL.format(t="od"),
)
def a01(s, sf):
    return C.required(I.od(s, sf))


@query(
    "a02_spread",
    "CustomerId:i median_transaction_amount:4 min_transaction_amount:4 max_transaction_amount:4 range_transaction_amount:4 "
    "iqr_transaction_amount:4 p25_transaction_amount:4 p75_transaction_amount:4 p90_transaction_amount:4",
    """SELECT CustomerId, median(Value) AS median_transaction_amount, min(Value) AS min_transaction_amount,
       max(Value) AS max_transaction_amount, max(Value) - min(Value) AS range_transaction_amount,
       quantile_cont(Value, 0.75) - quantile_cont(Value, 0.25) AS iqr_transaction_amount,
       quantile_cont(Value, 0.25) AS p25_transaction_amount, quantile_cont(Value, 0.75) AS p75_transaction_amount,
       quantile_cont(Value, 0.9) AS p90_transaction_amount FROM ev GROUP BY CustomerId""",
)
def a02(s, sf):
    return C.spread(I.ev(s, sf))


@query(
    "a03_shape",
    "CustomerId:i skew_transaction_amount:5 kurtosis_transaction_amount:5",
    """SELECT CustomerId, CASE WHEN count(*) >= 3 THEN skewness(Value) END AS skew_transaction_amount,
       CASE WHEN count(*) >= 4 THEN kurtosis(Value) END AS kurtosis_transaction_amount FROM od GROUP BY CustomerId""",
)
def a03(s, sf):
    return C.shape(I.od(s, sf))


MODE_SQL = """SELECT CustomerId, {c} AS {a} FROM (SELECT CustomerId, {c}, row_number() OVER (PARTITION BY CustomerId
 ORDER BY count(*) DESC, {c}) AS rn FROM {t} WHERE {c} IS NOT NULL GROUP BY CustomerId, {c}) WHERE rn = 1"""


@query("a04_mode", "CustomerId:i mode_transaction_amount:2", MODE_SQL.format(c="Value", a="mode_transaction_amount", t="ev"))
def a04(s, sf):
    return C.mode_amount(I.ev(s, sf))


@query(
    "a05_sign_counts",
    "CustomerId:i zero_transaction_count:i negative_transaction_count:i positive_transaction_count:i",
    """SELECT CustomerId, count(*) FILTER (WHERE Amount = 0) AS zero_transaction_count,
       count(*) FILTER (WHERE Amount < 0) AS negative_transaction_count,
       count(*) FILTER (WHERE Amount > 0) AS positive_transaction_count FROM ev GROUP BY CustomerId""",
)
def a05(s, sf):
    return C.sign_counts(I.ev(s, sf), "Amount")


@query(
    "a06_extended_filled",
    "CustomerId:i median_transaction_amount:3 mode_transaction_amount:2 iqr_transaction_amount:3 skew_transaction_amount:5 "
    "kurtosis_transaction_amount:5 negative_transaction_count:i",
    """WITH md AS (SELECT CustomerId, Amount AS mode_transaction_amount FROM (SELECT CustomerId, Amount, row_number() OVER (
          PARTITION BY CustomerId ORDER BY count(*) DESC, Amount) AS rn FROM od GROUP BY CustomerId, Amount) WHERE rn = 1),
        g AS (SELECT CustomerId, median(Amount) AS median_transaction_amount,
          quantile_cont(Amount, 0.75) - quantile_cont(Amount, 0.25) AS iqr_transaction_amount,
          CASE WHEN count(*) >= 3 THEN skewness(Amount) END AS sk, CASE WHEN count(*) >= 4 THEN kurtosis(Amount) END AS ku,
          count(*) FILTER (WHERE Amount < 0) AS negative_transaction_count FROM od GROUP BY CustomerId)
        SELECT g.*, mode_transaction_amount, coalesce(sk, (SELECT median(sk) FROM g)) AS skew_transaction_amount,
          coalesce(ku, (SELECT median(ku) FROM g)) AS kurtosis_transaction_amount FROM g JOIN md USING (CustomerId)""",
)
def a06(s, sf):
    return C.extended(I.od(s, sf), "Amount")


def _win_sql(t):
    parts = []
    for d in (7, 30, 90):
        w = f"FILTER (WHERE TransactionStartTime > (SELECT max(TransactionStartTime) FROM {t}) - INTERVAL {d} DAY)"
        parts.append(
            f"coalesce(sum(Value) {w}, 0) AS total_amount_{d}d, count(TransactionId) {w} AS transaction_count_{d}d, "
            f"coalesce(avg(Value) {w}, 0) AS avg_amount_{d}d, coalesce(sum(Value) {w}, 0) / sum(Value) AS growth_rate_{d}d"
        )
    return f"SELECT CustomerId, {', '.join(parts)} FROM {t} GROUP BY CustomerId"


@query(
    "a07_trailing_windows",
    "CustomerId:i " + " ".join(f"total_amount_{d}d:2 transaction_count_{d}d:i avg_amount_{d}d:4" for d in (7, 30, 90)),
    _win_sql("od"),
)
def a07(s, sf):
    return C.trailing_windows(I.od(s, sf))


@query(
    "a08_window_share", "CustomerId:i " + " ".join(f"growth_rate_{d}d:6" for d in (7, 30, 90)), _win_sql("ev")
)
def a08(s, sf):
    return C.trailing_windows(I.ev(s, sf))


A9_SQL = """SELECT CustomerId, sum(Value) AS total_transaction_amount, avg(Value) AS avg_transaction_amount,
 count(TransactionId) AS transaction_count, stddev(Value) AS std_transaction_amount, median(Value) AS median_transaction_amount,
 min(Value) AS min_transaction_amount, max(Value) AS max_transaction_amount, max(Value) - min(Value) AS transaction_range,
 max(Value) / nullif(avg(Value), 0) AS value_ratio_max_avg, stddev(Value) / nullif(avg(Value), 0) AS value_ratio_std_avg
 FROM {t} GROUP BY CustomerId"""
A9_OUT = (
    "CustomerId:i total_transaction_amount:2 avg_transaction_amount:3 transaction_count:i std_transaction_amount:3 "
    "median_transaction_amount:3 min_transaction_amount:2 max_transaction_amount:2 transaction_range:2 "
    "value_ratio_max_avg:6 value_ratio_std_avg:6"
)


@query("a09_value_features", A9_OUT, A9_SQL.format(t="od"))
def a09(s, sf):
    return C.value_features(I.od(s, sf))


A10_SQL = """SELECT CustomerId, count(DISTINCT ProductCategory) AS product_category_count, count(DISTINCT ChannelId) AS channel_count,
 count(DISTINCT ProviderId) AS provider_count, count(DISTINCT CurrencyCode) AS currency_count FROM ev GROUP BY CustomerId"""


@query(
    "a10_diversity",
    "CustomerId:i product_category_count:i channel_count:i provider_count:i currency_count:i",
    A10_SQL,
)
def a10(s, sf):
    return C.diversity(I.ev(s, sf))


@query(
    "a11_favourites",
    "CustomerId:i favorite_product_category:s favorite_channel:s",
    f"""SELECT c.CustomerId, coalesce(p.v, 'Unknown') AS favorite_product_category, coalesce(h.v, 'Unknown') AS favorite_channel
        FROM (SELECT DISTINCT CustomerId FROM odn) c
        LEFT JOIN ({MODE_SQL.format(c='ProductCategory', a='v', t='odn')}) p USING (CustomerId)
        LEFT JOIN ({MODE_SQL.format(c='ChannelId', a='v', t='odn')}) h USING (CustomerId)""",
)
def a11(s, sf):
    return C.favourites(I.odn(s, sf))


A12_SQL = """SELECT CustomerId, count(*) / count(DISTINCT CAST(TransactionStartTime AS DATE)) AS transactions_per_active_day,
 sum(Value) / count(DISTINCT CAST(TransactionStartTime AS DATE)) AS amount_per_active_day,
 (epoch_us((SELECT max(TransactionStartTime) FROM ev)) - epoch_us(max(TransactionStartTime))) // 86400000000
 AS days_since_last_transaction FROM ev GROUP BY CustomerId"""


@query(
    "a12_activity",
    "CustomerId:i transactions_per_active_day:6 amount_per_active_day:4 days_since_last_transaction:i",
    A12_SQL,
)
def a12(s, sf):
    return C.activity(I.ev(s, sf))


PARTS = {
    "transaction_hour": "hour(TransactionStartTime)",
    "transaction_day": "day(TransactionStartTime)",
    "transaction_month": "month(TransactionStartTime)",
    "transaction_year": "year(TransactionStartTime)",
    "transaction_day_of_week": "isodow(TransactionStartTime) - 1",
    "transaction_day_of_year": "dayofyear(TransactionStartTime)",
    "transaction_week_of_year": "weekofyear(TransactionStartTime)",
    "transaction_quarter": "quarter(TransactionStartTime)",
    "is_weekend": "CASE WHEN isodow(TransactionStartTime) >= 6 THEN 1 ELSE 0 END",
    "is_business_hours": "CASE WHEN hour(TransactionStartTime) BETWEEN 9 AND 17 THEN 1 ELSE 0 END",
    "is_holiday": "CASE WHEN isodow(TransactionStartTime) >= 6 THEN 1 ELSE 0 END",
    "time_of_day": """CASE WHEN hour(TransactionStartTime) BETWEEN 5 AND 11 THEN 'morning'
        WHEN hour(TransactionStartTime) BETWEEN 12 AND 16 THEN 'afternoon'
        WHEN hour(TransactionStartTime) BETWEEN 17 AND 20 THEN 'evening' ELSE 'night' END""",
    "season": """CASE WHEN month(TransactionStartTime) IN (12, 1, 2) THEN 'winter'
        WHEN month(TransactionStartTime) IN (3, 4, 5) THEN 'spring'
        WHEN month(TransactionStartTime) IN (6, 7, 8) THEN 'summer' ELSE 'fall' END""",
}
_MEAN4 = ["transaction_hour", "transaction_day_of_week", "is_weekend", "is_business_hours"]
A13_SQL = (
    "SELECT CustomerId, "
    + ", ".join(f"avg({PARTS[c]}) AS {c}_mean, stddev({PARTS[c]}) AS {c}_std" for c in _MEAN4)
    + " FROM ev GROUP BY CustomerId"
)


@query("a13_time_means", "CustomerId:i " + " ".join(f"{c}_mean:6 {c}_std:6" for c in _MEAN4), A13_SQL)
def a13(s, sf):
    return C.time_means(I.ev(s, sf))


GAPS = """SELECT CustomerId, TransactionId, (epoch_us(TransactionStartTime) - epoch_us(lag(TransactionStartTime) OVER (
 PARTITION BY CustomerId ORDER BY TransactionStartTime, TransactionId))) / {u}e0 AS gap FROM {t}"""
HOUR_US, DAY_US = "3600000000.0", "86400000000.0"
A14_SQL = f"""SELECT CustomerId, avg(gap) AS gap_mean, stddev(gap) AS gap_std, min(gap) AS gap_min, max(gap) AS gap_max
 FROM ({GAPS.format(t='ev', u=HOUR_US)}) GROUP BY CustomerId"""


@query("a14_time_gaps", "CustomerId:i gap_mean:6 gap_std:6 gap_min:6 gap_max:6", A14_SQL)
def a14(s, sf):
    return behaviour.gap_stats(I.ev(s, sf))


A15_SQL = f"""SELECT CustomerId, avg({PARTS['is_weekend']}) AS weekend_transaction_ratio,
 avg({PARTS['is_business_hours']}) AS business_hours_ratio FROM ev GROUP BY CustomerId"""


@query("a15_time_ratios", "CustomerId:i weekend_transaction_ratio:6 business_hours_ratio:6", A15_SQL)
def a15(s, sf):
    return C.time_ratios(I.ev(s, sf))


def _parts_view(t, cols):
    return f"SELECT CustomerId, {', '.join(f'{PARTS[c]} AS {c}' for c in cols)} FROM {t}"


def _modes_sql(t="ev"):
    joins = " JOIN ".join(
        f"({MODE_SQL.format(c=c, a=c + '_mode', t='pp')}) m{i}" + ("" if i == 0 else " USING (CustomerId)")
        for i, c in enumerate(C.PATTERN_COLUMNS)
    )
    return f"WITH pp AS ({_parts_view(t, C.PATTERN_COLUMNS)}) SELECT *, transaction_hour_mode AS favorite_hour, transaction_day_of_week_mode AS favorite_day_of_week FROM {joins}"


MODES_OUT = (
    "transaction_hour_mode:i transaction_day_of_week_mode:i time_of_day_mode:s is_weekend_mode:i is_business_hours_mode:i "
    "favorite_hour:i favorite_day_of_week:i"
)


@query("a16_time_modes", "CustomerId:i " + MODES_OUT, _modes_sql())
def a16(s, sf):
    return C.time_modes(I.ev(s, sf))


def _consistency_sql():
    per = " JOIN ".join(
        f"(SELECT CustomerId, CASE WHEN count(*) = 1 THEN 1 ELSE 1 - (-sum(p * ln(p + 1e-10))) / ln(count(*)) END AS {c}_consistency "
        f"FROM (SELECT CustomerId, count(*) / sum(count(*)) OVER (PARTITION BY CustomerId) AS p FROM pp GROUP BY CustomerId, {c}) "
        f"GROUP BY CustomerId) k{i}" + ("" if i == 0 else " USING (CustomerId)")
        for i, c in enumerate(C.PATTERN_COLUMNS)
    )
    return f"WITH pp AS ({_parts_view('ev', C.PATTERN_COLUMNS)}) SELECT * FROM {per}"


@query(
    "a17_time_consistency",
    "CustomerId:i " + " ".join(f"{c}_consistency:6" for c in C.PATTERN_COLUMNS),
    _consistency_sql(),
)
def a17(s, sf):
    return C.time_consistency(I.ev(s, sf))


_TB = [f"time_between_transactions_{k}" for k in ("mean", "std", "min", "max")]


@query(
    "a18_time_patterns_filled",
    "CustomerId:i transaction_hour_mode:i time_of_day_mode:s weekend_transaction_ratio:6 " + " ".join(f"{c}:4" for c in _TB),
    f"""WITH g AS (SELECT CustomerId, {', '.join(f"{f}(gap) AS g{i}" for i, f in enumerate(('avg', 'stddev', 'min', 'max')))}
        FROM ({GAPS.format(t='od', u=HOUR_US)}) GROUP BY 1), mm AS ({_modes_sql('od')}),
        w AS (SELECT CustomerId, avg({PARTS['is_weekend']}) AS weekend_transaction_ratio FROM od GROUP BY 1)
        SELECT *, {', '.join(f"coalesce(g{i}, (SELECT median(g{i}) FROM g)) AS {c}" for i, c in enumerate(_TB))}
        FROM g JOIN mm USING (CustomerId) JOIN w USING (CustomerId)""",
)
def a18(s, sf):
    return C.time_patterns(I.od(s, sf))


INTER_OUT = (
    "CustomerId:i avg_amount_per_transaction:3 cv_transaction_amount:6 range_to_avg_ratio:6 "
    "log_total_transaction_amount:6 log_avg_transaction_amount:6 log_max_transaction_amount:6"
)


def _slog(c):
    return f"ln(1 + abs({c})) * sign({c})"


@query(
    "a19_interactions",
    INTER_OUT,
    f"""SELECT CustomerId, coalesce(t / nullif(n, 0), 0) AS avg_amount_per_transaction, coalesce(sd / nullif(a, 0), 0)
        AS cv_transaction_amount, coalesce((mx - mn) / nullif(a, 0), 0) AS range_to_avg_ratio,
        {_slog('t')} AS log_total_transaction_amount, {_slog('a')} AS log_avg_transaction_amount,
        {_slog('mx')} AS log_max_transaction_amount
        FROM (SELECT CustomerId, sum(Amount) t, avg(Amount) a, count(*) n, stddev(Amount) sd, min(Amount) mn, max(Amount) mx
              FROM od GROUP BY 1)""",
)
def a19(s, sf):
    df = I.od(s, sf)
    g = df.groupBy("CustomerId").agg(
        F.sum("Amount").alias("total_transaction_amount"),
        F.avg("Amount").alias("avg_transaction_amount"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.stddev("Amount").alias("std_transaction_amount"),
        F.min("Amount").alias("min_transaction_amount"),
        F.max("Amount").alias("max_transaction_amount"),
    )
    return C.interactions(g)


@query(
    "a20_declared_features",
    "CustomerId:i recency_days:i frequency_30d:i monetary_90d:2 transaction_velocity:6 amount_to_frequency_ratio:4 "
    "transaction_consistency_score:6 weekend_ratio:6",
    f"""WITH mx AS (SELECT max(TransactionStartTime) m FROM ev)
        SELECT CustomerId, (epoch_us(any_value(m)) - epoch_us(max(TransactionStartTime))) // 86400000000 AS recency_days,
        count(*) FILTER (WHERE TransactionStartTime > m - INTERVAL 30 DAY) AS frequency_30d,
        coalesce(sum(Value) FILTER (WHERE TransactionStartTime > m - INTERVAL 90 DAY), 0) AS monetary_90d,
        count(*) / count(DISTINCT CAST(TransactionStartTime AS DATE)) AS transaction_velocity,
        avg(Value) AS amount_to_frequency_ratio, 1 - stddev(Value) / nullif(avg(Value), 0) AS transaction_consistency_score,
        avg({PARTS['is_weekend']}) AS weekend_ratio FROM ev, mx GROUP BY CustomerId""",
)
def a20(s, sf):
    return C.declared_features(I.ev(s, sf))


_A21 = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, count(*) AS rows, count(DISTINCT {c}) AS distinct_values, count(*) - count({c}) AS nulls, "
    f"(count(*) - count({c})) * 100 / count(*) AS null_pct, avg({c}) AS mean, stddev({c}) AS std, min({c}) AS min, "
    f"median({c}) AS q50, max({c}) AS max FROM a"
    for c in ["total_transaction_amount", "transaction_count", "std_transaction_amount"]
)


@query(
    "a21_feature_summary",
    "feature:s rows:i nulls:i null_pct:6 mean:3 std:3 min:3 q50:3 max:3",
    f"WITH a AS ({A9_SQL.format(t='od')}) {_A21}",
)
def a21(s, sf):
    cols = ["total_transaction_amount", "transaction_count", "std_transaction_amount"]
    t = cut(C.value_features(I.od(s, sf)).select("CustomerId", *cols))
    return C.feature_summary(t, cols).join(profile.describe(t, cols, (0.5,)), "feature")


@query(
    "a22_audit_trail",
    "step_no:i step:s transactions:i customers:i position:i feature:s",
    "WITH st(step_no, step, position, feature) AS (VALUES "
    + ", ".join(
        f"({i}, '{st}', {p}, '{f}')" for i, (st, fs) in enumerate(C.STEPS.items(), 1) for p, f in enumerate(fs)
    )
    + ") SELECT st.*, (SELECT count(*) FROM ev) AS transactions, (SELECT count(DISTINCT CustomerId) FROM ev) AS customers FROM st",
)
def a22(s, sf):
    return C.audit_trail(I.ev(s, sf))


_REF = ["Value", "Amount"]


@query(
    "a23_reference_stats",
    "metric:s value:2",
    "SELECT 'customers' AS metric, count(DISTINCT CustomerId)::DOUBLE AS value FROM ev "
    "UNION ALL SELECT 'first_second', epoch_us(min(TransactionStartTime)) / 1e6 FROM ev "
    "UNION ALL SELECT 'last_second', epoch_us(max(TransactionStartTime)) / 1e6 FROM ev "
    + " ".join(
        f"UNION ALL SELECT '{c}_{n}', {f}({c}) FROM ev" for c in _REF for n, f in (("mean", "avg"), ("std", "stddev"), ("median", "median"))
    ),
)
def a23(s, sf):
    return C.reference_stats(I.ev(s, sf), _REF)


# --- row functions ------------------------------------------------------------------------------


def _row_parts(name, cols):
    kinds = {"time_of_day": "s", "season": "s"}
    out = "TransactionId:i " + " ".join(f"{c}:{kinds.get(c, 'i')}" for c in cols)
    sql = f"SELECT TransactionId, {', '.join(f'{PARTS[c]} AS {c}' for c in cols)} FROM ev"

    @query(name, out, sql)
    def run(s, sf):
        return C.time_parts(I.ev(s, sf)).select("TransactionId", *cols)


_row_parts("f01_basic_time_parts", ["transaction_hour", "transaction_day", "transaction_month", "transaction_year"])
_row_parts(
    "f02_calendar_parts",
    ["transaction_day_of_week", "transaction_day_of_year", "transaction_week_of_year", "transaction_quarter"],
)
_row_parts("f03_time_flags", ["is_weekend", "is_holiday", "is_business_hours"])
_row_parts("f04_time_labels", ["time_of_day", "season"])


@query(
    "f05_text_to_time",
    "TransactionId:i micros:i",
    """SELECT TransactionId, epoch_us(try_cast(CASE WHEN ChannelId = 'C0' THEN 'unknown'
       ELSE strftime(TransactionStartTime, '%Y-%m-%d %H:%M:%S') END AS TIMESTAMP)) AS micros FROM ev""",
)
def f05(s, sf):
    text = F.when(F.col("ChannelId") == "C0", "unknown").otherwise(F.date_format("TransactionStartTime", "yyyy-MM-dd HH:mm:ss"))
    parsed = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    return I.ev(s, sf).select("TransactionId", F.unix_micros(parsed).alias("micros"))


@query(
    "f06_math",
    "TransactionId:i log1p:6 log10p:6 root:6 cube_root:6 expo:6 magnitude:2 sgn:i",
    """SELECT TransactionId, ln(1 + Value) AS log1p, log10(Value + 1) AS log10p, sqrt(Value) AS root, cbrt(Amount) AS cube_root,
       exp(-Value / 100) AS expo, abs(Amount) AS magnitude, sign(Amount) AS sgn FROM ev""",
)
def f06(s, sf):
    return I.ev(s, sf).select(
        "TransactionId",
        F.log1p("Value").alias("log1p"),
        F.log10(F.col("Value") + 1).alias("log10p"),
        F.sqrt("Value").alias("root"),
        F.cbrt("Amount").alias("cube_root"),
        F.exp(-F.col("Value") / 100).alias("expo"),
        F.abs("Amount").alias("magnitude"),
        F.signum("Amount").alias("sgn"),
    )


@query(
    "f07_safe_division",
    "TransactionId:i or_null:6 or_zero:6 or_one:6",
    """SELECT TransactionId, Value / nullif(PricingStrategy, 0) AS or_null, coalesce(Value / nullif(PricingStrategy, 0), 0) AS or_zero,
       Value / CASE WHEN PricingStrategy = 0 THEN 1 ELSE PricingStrategy END AS or_one FROM ev""",
)
def f07(s, sf):
    return I.ev(s, sf).select(
        "TransactionId",
        X.ratio("Value", "PricingStrategy").alias("or_null"),
        X.ratio_or_zero("Value", "PricingStrategy").alias("or_zero"),
        (F.col("Value") / X.divisor_or_one("PricingStrategy")).alias("or_one"),
    )


@query(
    "f08_clip",
    "TransactionId:i bounded:2 floored:2",
    """SELECT TransactionId, CASE WHEN Value IS NOT NULL THEN greatest(least(Value, 100.0), 5.0) END AS bounded,
       CASE WHEN Value IS NOT NULL THEN greatest(Value, 10.0) END AS floored FROM evn""",
)
def f08(s, sf):
    return I.evn(s, sf).select("TransactionId", X.clip("Value", 5.0, 100.0).alias("bounded"), X.clip("Value", lo=10.0).alias("floored"))


@query(
    "f09_text_and_json",
    "TransactionId:i id_text:s is_error:b record:s",
    """SELECT TransactionId, CAST(TransactionId AS VARCHAR) AS id_text, contains(ProductCategory, 'err') AS is_error,
       '{"id":' || TransactionId || ',"category":"' || ProductCategory || '","flag":' || FraudResult || '}' AS record FROM ev""",
)
def f09(s, sf):
    return I.ev(s, sf).select(
        "TransactionId",
        F.col("TransactionId").cast("string").alias("id_text"),
        F.contains("ProductCategory", F.lit("err")).alias("is_error"),
        F.to_json(
            F.struct(F.col("TransactionId").alias("id"), F.col("ProductCategory").alias("category"), F.col("FraudResult").alias("flag"))
        ).alias("record"),
    )


@query(
    "f10_expected_loss",
    "CustomerId:i model:s expected_loss:3",
    """SELECT p.CustomerId, model, risk_score * 0.45e0 * total_monetary_value AS expected_loss
       FROM preds p JOIN lab USING (CustomerId)""",
)
def f10(s, sf):
    p = I.preds(s, sf)
    value = I.rfm(s, sf).select("CustomerId", "total_monetary_value")
    return p.join(value, "CustomerId").select(
        "CustomerId", "model", E.expected_loss("risk_score", F.lit(0.45), "total_monetary_value").alias("expected_loss")
    )


@query(
    "f11_business_cost",
    "model:s split:s fn:i fp:i business_cost:i",
    """SELECT model, split, fn, fp, 10000 * fn + 1000 * fp AS business_cost FROM (
       SELECT model, split, count(*) FILTER (WHERE is_high_risk = 1 AND risk_score < 0.5) AS fn,
              count(*) FILTER (WHERE is_high_risk = 0 AND risk_score >= 0.5) AS fp FROM preds GROUP BY 1, 2)""",
)
def f11(s, sf):
    c = E.confusion(I.preds(s, sf), ["model", "split"])
    return c.withColumn("business_cost", E.business_cost("fn", "fp"))
