"""Category, time and fraud reports; data quality."""

from pyspark.sql import functions as F

from ledgerlens.operators import customer as C, quality as Q, relations as R, reports as Rp

from . import inputs as I
from .q_customer import A1_SQL, PARTS
from .registry import query

TS = "TransactionStartTime"
FRAUD_SQL = """SELECT *, coalesce(fraud_mean_amount / nullif(normal_mean_amount, 0), 0) AS amount_ratio FROM (
  SELECT count(*) AS total_transactions, sum(FraudResult) AS fraud_transactions, count(*) FILTER (WHERE FraudResult = 0) AS non_fraud_transactions, avg(FraudResult) * 100 AS fraud_rate,
  coalesce(avg(Amount) FILTER (WHERE FraudResult = 1), 0) AS fraud_mean_amount,
  coalesce(avg(Amount) FILTER (WHERE FraudResult = 0), 0) AS normal_mean_amount FROM {t})"""


@query("c01_fraud_overall", "total_transactions:i fraud_transactions:i non_fraud_transactions:i fraud_rate:6", FRAUD_SQL.format(t="ev"))
def c01(s, sf):
    return Rp.fraud_overall(I.ev(s, sf))


@query("c02_fraud_amounts", "fraud_mean_amount:4 normal_mean_amount:4 amount_ratio:6", FRAUD_SQL.format(t="od"))
def c02(s, sf):
    return Rp.fraud_overall(I.od(s, sf))


@query(
    "c03_fraud_by_dimension",
    "dimension:s value:s n:i frauds:i fraud_rate:6",
    " UNION ALL ".join(
        f"SELECT '{n}' AS dimension, CAST({e} AS VARCHAR) AS value, count(*) AS n, sum(FraudResult) AS frauds, avg(FraudResult) * 100 AS fraud_rate FROM ev GROUP BY 2"
        for n, e in (("channel", "ChannelId"), ("product", "ProductCategory"), ("hour", PARTS["transaction_hour"]))
    ),
)
def c03(s, sf):
    return Rp.fraud_by(
        I.ev(s, sf), {"channel": F.col("ChannelId"), "product": F.col("ProductCategory"), "hour": F.hour(TS)}
    )


def _level_sql(key, t):
    return f"""WITH g AS (SELECT {key} AS grp, avg(FraudResult) * 100 AS fraud_rate FROM {t} GROUP BY 1),
      e AS (SELECT count(DISTINCT fraud_rate) AS k, min(fraud_rate) AS e0, quantile_cont(fraud_rate, 0.25) AS e1,
            quantile_cont(fraud_rate, 0.5) AS e2, quantile_cont(fraud_rate, 0.75) AS e3, max(fraud_rate) AS e4 FROM g)
      SELECT grp, fraud_rate, CASE WHEN k >= 4 AND e0 < e1 AND e1 < e2 AND e2 < e3 AND e3 < e4 THEN
          CASE WHEN fraud_rate <= e1 THEN 'Low' WHEN fraud_rate <= e2 THEN 'Medium' WHEN fraud_rate <= e3 THEN 'High' ELSE 'Very High' END
        WHEN k = 1 THEN 'Medium'
        WHEN fraud_rate <= 0.1 THEN 'Low' WHEN fraud_rate <= 0.5 THEN 'Medium' WHEN fraud_rate <= 1 THEN 'High' ELSE 'Very High' END
        AS risk_level FROM g, e"""


@query("c04_rate_levels_by_country", "grp:s fraud_rate:6 risk_level:s", _level_sql("CountryCode", "odc"))
def c04(s, sf):
    g = I.odc(s, sf).groupBy(F.col("CountryCode").alias("grp")).agg((F.avg("FraudResult") * 100).alias("fraud_rate"))
    return Rp.rate_levels(g, "fraud_rate")


@query("c04_rate_levels_by_product", "grp:s fraud_rate:6 risk_level:s", _level_sql("ProductCategory", "ev"))
def c04b(s, sf):
    g = I.ev(s, sf).groupBy(F.col("ProductCategory").alias("grp")).agg((F.avg("FraudResult") * 100).alias("fraud_rate"))
    return Rp.rate_levels(g, "fraud_rate")


@query(
    "c05_amounts_by_category",
    "ProductCategory:s transactions:i total_value:2 avg_value:4 std_value:4 min_value:2 max_value:2 value_share:6",
    """SELECT ProductCategory, count(*) AS transactions, sum(Amount) AS total_value, avg(Amount) AS avg_value, stddev(Amount) AS std_value,
       min(Amount) AS min_value, max(Amount) AS max_value, sum(Amount) / (SELECT sum(Amount) FROM ev) * 100 AS value_share FROM ev GROUP BY 1""",
)
def c05(s, sf):
    return Rp.amount_stats(I.ev(s, sf), "ProductCategory")


@query(
    "c06_cross_tab",
    "ChannelId:s hour:i n:i mean:6",
    "SELECT ChannelId, hour(TransactionStartTime) AS hour, count(*) AS n, avg(FraudResult) AS mean FROM ev GROUP BY 1, 2",
)
def c06(s, sf):
    return Rp.cross_tab(I.ev(s, sf).withColumn("hour", F.hour(TS)), "ChannelId", "hour", "FraudResult")


@query(
    "c06_cross_tab_wide",
    "ProductCategory:s C0:i C1:i C2:i C3:i",
    "SELECT ProductCategory, " + ", ".join(f"count(*) FILTER (WHERE ChannelId = '{c}') AS {c}" for c in ("C0", "C1", "C2", "C3")) + " FROM ev GROUP BY 1",
)
def c06b(s, sf):
    return Rp.cross_tab_wide(I.ev(s, sf), "ProductCategory", "ChannelId", ["C0", "C1", "C2", "C3"], "TransactionId")


@query(
    "c07_quadrants",
    "CountryCode:s avg_value:3 fraud_rate:6 quadrant:s outlier:b opportunity:b",
    """WITH g AS (SELECT CountryCode, avg(Amount) AS avg_value, avg(FraudResult) * 100 AS fraud_rate FROM odc GROUP BY 1),
       m AS (SELECT median(avg_value) AS mv, median(fraud_rate) AS mr FROM g)
       SELECT g.*, concat(CASE WHEN avg_value > mv THEN 'High Value' ELSE 'Low Value' END, ' / ',
       CASE WHEN fraud_rate > mr THEN 'High Fraud' ELSE 'Low Fraud' END) AS quadrant,
       fraud_rate > mr * 2 OR avg_value > mv * 2 AS outlier, fraud_rate < mr AND avg_value > mv AS opportunity FROM g, m""",
)
def c07(s, sf):
    g = I.odc(s, sf).groupBy("CountryCode").agg(F.avg("Amount").alias("avg_value"), (F.avg("FraudResult") * 100).alias("fraud_rate"))
    return Rp.quadrants(g, "avg_value", "fraud_rate")


@query(
    "c08_amount_bands",
    "band:s n:i pct:6 total_value:2 avg_value:4 std_value:4 fraud_rate:6",
    """SELECT band, count(*) AS n, count(*) * 100 / (SELECT count(*) FROM ev) AS pct, sum(Amount) AS total_value, avg(Amount) AS avg_value,
       stddev(Amount) AS std_value, avg(FraudResult) * 100 AS fraud_rate FROM (SELECT *, CASE WHEN Amount >= 0 AND Amount < 10 THEN 'Very Low Risk'
       WHEN Amount >= 10 AND Amount < 100 THEN 'Low Risk' WHEN Amount >= 100 AND Amount < 1000 THEN 'Medium Risk'
       WHEN Amount >= 1000 AND Amount < 10000 THEN 'High Risk' WHEN Amount >= 10000 THEN 'Very High Risk' END AS band FROM ev)
       WHERE band IS NOT NULL GROUP BY 1""",
)
def c08(s, sf):
    return Rp.amount_bands(I.ev(s, sf))


@query(
    "c09_benchmarks",
    "benchmark:s benchmark_rate:3 fraud_rate:6 status:s",
    """SELECT benchmark, benchmark_rate, fraud_rate, CASE WHEN fraud_rate < benchmark_rate THEN 'Below' WHEN fraud_rate > benchmark_rate THEN 'Above'
       ELSE 'Equal' END AS status FROM (SELECT avg(FraudResult) * 100 AS fraud_rate FROM ev), (VALUES ('ecommerce_average', 0.5),
       ('banking_standard', 0.1), ('high_risk_merchants', 1.0), ('own_risk_appetite', 0.3)) b(benchmark, benchmark_rate)""",
)
def c09(s, sf):
    return Rp.against_benchmarks(I.ev(s, sf))


def resample_sql(unit, t):
    return f"""SELECT strftime(p, '%Y-%m-%d') AS period, coalesce(n, 0) AS n, coalesce(total, 0) AS total, mean, std, min, max FROM (
      SELECT unnest(generate_series((SELECT date_trunc('{unit}', min(TransactionStartTime)) FROM {t}),
      (SELECT date_trunc('{unit}', max(TransactionStartTime)) FROM {t}), INTERVAL 1 {unit})) AS p) c LEFT JOIN (
      SELECT date_trunc('{unit}', TransactionStartTime) AS d, count(*) AS n, sum(Amount) AS total, avg(Amount) AS mean, stddev(Amount) AS std,
      min(Amount) AS min, max(Amount) AS max FROM {t} GROUP BY 1) g ON CAST(c.p AS DATE) = CAST(g.d AS DATE)"""


_RS_OUT = "period:s n:i total:2 mean:3 std:3 min:2 max:2"


@query("c10_daily_resample", _RS_OUT, resample_sql("day", "od"))
def c10(s, sf):
    return Rp.resample(I.od(s, sf), "day")


@query("c11_monthly_resample", _RS_OUT, resample_sql("month", "od"))
def c11(s, sf):
    return Rp.resample(I.od(s, sf), "month")


@query(
    "c12_time_profile",
    "part:s position:i mean:4 std:4 n:i",
    " UNION ALL ".join(
        f"SELECT '{n}' AS part, {e} AS position, avg(Amount) AS mean, stddev(Amount) AS std, count(*) AS n FROM ev GROUP BY 2"
        for n, e in (("weekday", PARTS["transaction_day_of_week"]), ("hour", PARTS["transaction_hour"]))
    ),
)
def c12(s, sf):
    return Rp.time_profile(I.ev(s, sf))


@query(
    "c13_time_coverage",
    "first_date:s last_date:s duration_days:i months:i transactions:i avg_per_day:6 five_years:b",
    """SELECT strftime(a, '%Y-%m-%d') AS first_date, strftime(b, '%Y-%m-%d') AS last_date, d AS duration_days, months, transactions,
       transactions / d AS avg_per_day, d >= 1825 AS five_years FROM (SELECT min(TransactionStartTime) AS a, max(TransactionStartTime) AS b,
       (epoch_us(max(TransactionStartTime)) - epoch_us(min(TransactionStartTime))) // 86400000000 AS d,
       count(DISTINCT date_trunc('month', TransactionStartTime)) AS months, count(*) AS transactions FROM od)""",
)
def c13(s, sf):
    return Rp.coverage(I.od(s, sf))


_KEYSTATS = {
    "total_transactions": "count(*)::DOUBLE",
    "unique_customers": "count(DISTINCT CustomerId)::DOUBLE",
    "transactions_per_customer": "count(*) / count(DISTINCT CustomerId)",
    "total_value": "sum(Amount)",
    "average_value": "avg(Amount)",
    "fraud_rate": "avg(FraudResult) * 100",
    "fraud_transactions": "sum(FraudResult)::DOUBLE",
    "days_covered": "((epoch_us(max(TransactionStartTime)) - epoch_us(min(TransactionStartTime))) // 86400000000)::DOUBLE",
    "transactions_per_day": "count(*) / ((epoch_us(max(TransactionStartTime)) - epoch_us(min(TransactionStartTime))) // 86400000000)",
    "median_value": "median(Amount)",
}


@query(
    "c14_key_statistics",
    "metric:s value:2",
    " UNION ALL ".join(f"SELECT '{k}' AS metric, {e} AS value FROM od" for k, e in _KEYSTATS.items()),
)
def c14(s, sf):
    return Rp.key_statistics(I.od(s, sf))


@query(
    "c15_insights",
    "category:s insight:s action:s",
    """SELECT 'Data Overview' AS category, concat('there are ', count(*), ' transactions') AS insight, 'go on to features' AS action FROM evn
       UNION ALL SELECT 'Data Quality', concat(printf('%.1f', ((count(*) - count(Value)) + (count(*) - count(ProductCategory))) * 100.0 / (count(*) * 11)), '% of values absent'),
       'fill the gaps first' FROM evn""",
)
def c15(s, sf):
    return Rp.insights(I.evn(s, sf))


@query(
    "c16_unusual_times",
    "n:i before_six:i weekend_off_hours:i",
    f"""SELECT count(*) AS n, count(*) FILTER (WHERE hour(TransactionStartTime) < 6) AS before_six,
        count(*) FILTER (WHERE ({PARTS['is_weekend']}) = 1 AND ({PARTS['is_business_hours']}) = 0) AS weekend_off_hours FROM ev""",
)
def c16(s, sf):
    return Rp.unusual_times(I.ev(s, sf))


_CARD = ["ProductCategory", "ChannelId", "PricingStrategy", "CustomerId"]


@query(
    "c17_cardinality",
    "column:s distinct_values:i categorical:b",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS distinct_values, {'true' if c in ('ProductCategory', 'ChannelId') else f'count(DISTINCT {c}) < 20'} AS categorical FROM ev"
        for c in _CARD
    ),
)
def c17(s, sf):
    return Rp.cardinality(I.ev(s, sf), _CARD)


@query(
    "c18_credits",
    "amount_mean:4 value_mean:4 credits:i credit_total:2 credit_mean:4 credit_share:6 means_differ:b high_credit_share:b",
    """SELECT *, abs(amount_mean - value_mean) > 0.01 AS means_differ, credit_share > 0.1 AS high_credit_share FROM (
       SELECT avg(Amount) AS amount_mean, avg(Value) AS value_mean, count(*) FILTER (WHERE Amount < 0) AS credits,
       sum(Amount) FILTER (WHERE Amount < 0) AS credit_total, avg(Amount) FILTER (WHERE Amount < 0) AS credit_mean,
       count(*) FILTER (WHERE Amount < 0) / count(*) AS credit_share FROM ev)""",
)
def c18(s, sf):
    return Rp.credits(I.ev(s, sf))


@query(
    "c19_trimmed_totals",
    "customers:i trimmed_customers:i trimmed_mean:3 risk_cut:3 above_cut:i no_spread_pct:6",
    f"""WITH a AS ({A1_SQL.format(t='od')}), q AS (SELECT quantile_cont(total_transaction_amount, 0.8) AS q80,
        quantile_cont(total_transaction_amount, 0.99) AS q99 FROM a)
        SELECT count(*) AS customers, count(*) FILTER (WHERE total_transaction_amount <= q99) AS trimmed_customers,
        avg(total_transaction_amount) FILTER (WHERE total_transaction_amount <= q99) AS trimmed_mean, max(q80) AS risk_cut,
        count(*) FILTER (WHERE total_transaction_amount > q80) AS above_cut,
        count(*) FILTER (WHERE std_transaction_amount = 0) * 100 / count(*) AS no_spread_pct FROM a, q""",
)
def c19(s, sf):
    return Rp.trimmed_totals(C.required(I.od(s, sf)), "total_transaction_amount", "std_transaction_amount")


# --- data quality -------------------------------------------------------------------------------

_MC = ["TransactionId", "CustomerId", "Value", "Amount", "ProductCategory", "PricingStrategy", "FraudResult"]


def _nulls_sql(cols=_MC, t="evn"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS rows, (count(*) - count({c})) * 100 / count(*) AS null_pct FROM {t}"
        for c in cols
    )


@query("m01_null_counts", "column:s nulls:i rows:i null_pct:6", _nulls_sql())
def m01(s, sf):
    return Q.null_report(I.evn(s, sf).select(*_MC))


@query(
    "m01_null_totals",
    "total_nulls:i total_null_pct:6 rows_with_nulls:i",
    """SELECT sum(k) AS total_nulls, sum(k) * 100.0 / (count(*) * 7) AS total_null_pct, count(*) FILTER (WHERE k > 0) AS rows_with_nulls
       FROM (SELECT CASE WHEN Value IS NULL THEN 1 ELSE 0 END + CASE WHEN ProductCategory IS NULL THEN 1 ELSE 0 END AS k FROM evn)""",
)
def m01b(s, sf):
    return Q.null_totals(I.evn(s, sf).select(*_MC))


@query(
    "m02_null_risk",
    "column:s null_pct:6 risk_level:s compliant:b",
    f"""SELECT *, CASE WHEN null_pct <= 5 THEN 'Low' WHEN null_pct <= 10 THEN 'Medium' WHEN null_pct <= 20 THEN 'High'
        WHEN null_pct <= 30 THEN 'Very High' ELSE 'Critical' END AS risk_level, null_pct <= 30 AS compliant FROM ({_nulls_sql()})""",
)
def m02(s, sf):
    return Q.null_report(I.evn(s, sf).select(*_MC))


@query(
    "m03_weekly_completeness",
    "week:i rows:i completeness:6",
    """SELECT weekofyear(TransactionStartTime) AS week, count(*) AS rows, (count(Value) + count(ProductCategory)) * 100.0 / (count(*) * 2) AS completeness
       FROM odn GROUP BY 1""",
)
def m03(s, sf):
    return Q.weekly_completeness(I.odn(s, sf), ["Value", "ProductCategory"])


_FLAGS = "SELECT CASE WHEN Value IS NULL THEN 1.0 ELSE 0.0 END AS nv, CASE WHEN ProductCategory IS NULL THEN 1.0 ELSE 0.0 END AS np, * FROM evn"


@query(
    "m04_null_flag_correlation",
    "feature_1:s feature_2:s correlation:6",
    f"""WITH f AS ({_FLAGS}) SELECT 'Value' AS feature_1, 'ProductCategory' AS feature_2, corr(nv, np) AS correlation FROM f
        UNION ALL SELECT 'Value', 'FraudResult', corr(nv, FraudResult) FROM f UNION ALL SELECT 'ProductCategory', 'FraudResult', corr(np, FraudResult) FROM f""",
)
def m04(s, sf):
    return Q.flag_matrix(I.evn(s, sf), ["Value", "ProductCategory"], "FraudResult")


@query(
    "m05_null_patterns",
    "pattern:s n:i pct:6 null_columns:i",
    """SELECT pattern, n, n * 100 / (SELECT count(*) FROM evn) AS pct, length(replace(pattern, '0', '')) AS null_columns FROM (
       SELECT concat(CASE WHEN Value IS NULL THEN '1' ELSE '0' END, '0', CASE WHEN ProductCategory IS NULL THEN '1' ELSE '0' END) AS pattern, count(*) AS n
       FROM evn GROUP BY 1)""",
)
def m05(s, sf):
    return Q.patterns(I.evn(s, sf), ["Value", "Amount", "ProductCategory"])


_OTH = ["CustomerId", "Value", "Amount", "PricingStrategy", "FraudResult"]


def _mech_sql():
    def count(flag, skip):
        return " + ".join(
            f"CASE WHEN abs(coalesce((SELECT corr({flag}, {o}) FROM f), 0)) > 0.1 THEN 1 ELSE 0 END" for o in _OTH if o != skip
        )

    return f"""WITH f AS ({_FLAGS}), k AS (SELECT 'Value' AS "column", avg(nv) * 100 AS null_pct, {count('nv', 'Value')} AS links FROM f
      UNION ALL SELECT 'ProductCategory', avg(np) * 100, {count('np', '')} FROM f),
      mech AS (SELECT *, CASE WHEN links = 0 THEN 'MCAR' WHEN links <= 2 THEN 'MAR' ELSE 'MNAR' END AS mechanism,
      null_pct * CASE WHEN links = 0 THEN 1 WHEN links <= 2 THEN 2 ELSE 3 END AS impact FROM k)"""


@query("m06_null_mechanism", "column:s links:i mechanism:s", _mech_sql() + " SELECT * FROM mech")
def m06(s, sf):
    return Q.mechanism(I.evn(s, sf), _OTH)


@query(
    "m07_null_impact",
    "feature:s null_pct:6 correlation:6 impact_score:6 impact:s",
    """SELECT *, CASE WHEN impact_score > 10 THEN 'High' WHEN impact_score > 5 THEN 'Medium' ELSE 'Low' END AS impact FROM (
       SELECT 'Value' AS feature, (count(*) - count(Value)) * 100 / count(*) AS null_pct, corr(Value, FraudResult) AS correlation,
       (count(*) - count(Value)) * 100 / count(*) * abs(corr(Value, FraudResult)) AS impact_score FROM evn HAVING count(Value) > 100)""",
)
def m07(s, sf):
    return Q.modelling_impact(I.evn(s, sf), "FraudResult")


@query("m07_mechanism_impact", "column:s null_pct:6 impact:6", _mech_sql() + " SELECT * FROM mech")
def m07b(s, sf):
    return Q.mechanism(I.evn(s, sf), _OTH)


@query(
    "m08_imputation_advice",
    "column:s mechanism:s strategy:s compliance:s",
    _mech_sql()
    + """SELECT *, CASE WHEN null_pct <= 5 THEN CASE WHEN "column" = 'Value' THEN 'fill with the centre' ELSE 'fill with the mode' END
       WHEN null_pct <= 20 THEN CASE WHEN "column" = 'Value' THEN CASE WHEN mechanism = 'MAR' THEN 'fill by regression' ELSE 'fill from 5 neighbours' END
         ELSE 'fill by a class model' END
       WHEN null_pct <= 30 THEN 'fill by chained rounds' ELSE 'drop or model' END AS strategy,
       CASE WHEN null_pct <= 30 THEN 'acceptable once filled' ELSE 'needs review' END AS compliance FROM mech""",
)
def m08(s, sf):
    return Q.imputation_advice(I.evn(s, sf), _OTH)


@query(
    "m09_quality_metrics",
    "completeness:6 uniqueness:6 duplicates:i consistent:b negative_amounts:i future_transactions:i invalid_flags:i",
    "WITH d AS (SELECT DISTINCT * FROM evn) SELECT (SELECT sum(rows - nulls) * 100 / sum(rows) FROM ("
    + _nulls_sql(["TransactionId", "CustomerId", "TransactionStartTime", "Value", "Amount", "ProductCategory", "ChannelId", "ProviderId", "CurrencyCode", "PricingStrategy", "FraudResult"])
    + ")) AS completeness, ("
    + " + ".join(
        f"count(DISTINCT {c}) / count(*)"
        for c in ["TransactionId", "CustomerId", "TransactionStartTime", "Value", "Amount", "ProductCategory", "ChannelId", "ProviderId", "CurrencyCode", "PricingStrategy", "FraudResult"]
    )
    + """) * 100 / 11 AS uniqueness, count(*) - (SELECT count(*) FROM d) AS duplicates, count(*) = (SELECT count(*) FROM d) AS consistent,
      count(*) FILTER (WHERE Amount < 0) AS negative_amounts, count(*) FILTER (WHERE TransactionStartTime > TIMESTAMP '2024-01-20 00:00:00') AS future_transactions,
      count(*) FILTER (WHERE FraudResult NOT IN (0, 1)) AS invalid_flags FROM evn""",
)
def m09(s, sf):
    return Q.metrics(I.evn(s, sf), "2024-01-20 00:00:00")


@query(
    "m10_compliance_score",
    "days:i rows:i events:i completeness:6 score:4",
    """SELECT *, CASE WHEN days >= 1825 THEN 30 ELSE 0 END + CASE WHEN rows >= 10000 THEN 20 ELSE 0 END + CASE WHEN events >= 100 THEN 25 ELSE 0 END
       + CASE WHEN completeness >= 95 THEN 15 ELSE 0 END + 10 AS score FROM (SELECT (epoch_us(max(TransactionStartTime)) - epoch_us(min(TransactionStartTime))) // 86400000000 AS days,
       count(*) AS rows, sum(FraudResult) AS events, 100 - ((count(*) - count(Value)) + (count(*) - count(ProductCategory))) * 100.0 / (count(*) * 9) AS completeness FROM odn)""",
)
def m10(s, sf):
    return Q.compliance_score(I.odn(s, sf))


@query(
    "m11_validation_flags",
    "rows:i negative_pct:6 duplicate_ids:i missing:s valid:b",
    """SELECT count(*) AS rows, count(*) FILTER (WHERE Amount < 0) * 100 / count(*) AS negative_pct, count(TransactionId) - count(DISTINCT TransactionId) AS duplicate_ids,
       'CountryCode' AS missing, false AS valid FROM ev""",
)
def m11(s, sf):
    return Q.validate(I.ev(s, sf), ["TransactionId", "CustomerId", "Amount", "CountryCode"])


@query(
    "m12_clean_data",
    "TransactionId:i Value:4 ProductCategory:s",
    """SELECT TransactionId, coalesce(Value, (SELECT median(Value) FROM evn)) AS Value, coalesce(ProductCategory, (SELECT ProductCategory FROM evn
       WHERE ProductCategory IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS ProductCategory FROM evn""",
)
def m12(s, sf):
    df = I.evn(s, sf).withColumn("Disputed", F.when(F.col("ProductCategory") == "error", F.col("Value")))
    return Q.clean(df)


@query(
    "m13_request_check",
    "CustomerId:i reason:s",
    """SELECT CustomerId, CASE WHEN recency_days < 0 OR recency_days > 365 THEN 'recency out of range'
       WHEN transaction_frequency < 0 OR total_monetary_value < 0 THEN 'negative value' END AS reason FROM rfm""",
)
def m13(s, sf):
    return Q.check_requests(I.rfm(s, sf))
