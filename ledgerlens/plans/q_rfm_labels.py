"""Recency/frequency/money, lifetime value, behaviour risk and proxy labels."""

from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import behaviour, labels, profile, rfm
from ledgerlens.session import cut

from . import inputs as I
from .registry import query

RFM_OUT = "CustomerId:i recency_days:i transaction_frequency:i total_monetary_value:2"


@query(
    "r01_rfm",
    RFM_OUT,
    "SELECT CustomerId, recency_days, transaction_frequency, total_monetary_value FROM rfm",
)
def r01(s, sf):
    return rfm.rfm_table(I.od(s, sf))


@query("r02_rfm_spread", RFM_OUT + " avg_transaction_value:4 std_transaction_value:3", "SELECT * FROM rfm")
def r02(s, sf):
    return I.rfm(s, sf)


@query(
    "r03_rfm_next_day_snapshot",
    "CustomerId:i recency_days:i transaction_frequency:i total_monetary_value:2 log_monetary:6",
    """SELECT CustomerId, (epoch_us((SELECT max(TransactionStartTime) FROM ev)) + 86400000000
              - epoch_us(max(TransactionStartTime))) // 86400000000 AS recency_days,
              count(*) AS transaction_frequency, sum(Amount) AS total_monetary_value,
              CASE WHEN sum(Amount) > -1 THEN ln(1 + sum(Amount)) END AS log_monetary FROM ev GROUP BY CustomerId""",
)
def r03(s, sf):
    t = rfm.rfm_table(I.ev(s, sf), snapshot_shift="1 day", absolute=False)
    return t.withColumn("log_monetary", F.log1p("total_monetary_value"))


@query(
    "r04_lifetime_intensity",
    "CustomerId:i customer_lifetime_days:i transaction_frequency:i transaction_intensity:6",
    """SELECT CustomerId, (epoch_us(max(TransactionStartTime)) - epoch_us(min(TransactionStartTime))) // 86400000000
              AS customer_lifetime_days, count(*) AS transaction_frequency,
              count(*) / (((epoch_us(max(TransactionStartTime)) - epoch_us(min(TransactionStartTime)))
              // 86400000000) + 1) AS transaction_intensity FROM od GROUP BY CustomerId""",
)
def r04(s, sf):
    return rfm.lifetime(I.od(s, sf))


@query(
    "r05_negative_net_customers",
    "negative_customers:i customers:i",
    """SELECT count(*) FILTER (WHERE v < 0) AS negative_customers, count(*) AS customers
       FROM (SELECT sum(Amount) AS v FROM od GROUP BY CustomerId)""",
)
def r05(s, sf):
    g = I.od(s, sf).groupBy("CustomerId").agg(F.sum("Amount").alias("v"))
    return g.agg(F.count_if(F.col("v") < 0).alias("negative_customers"), F.count(F.lit(1)).alias("customers"))


def _describe_sql(cols, source, digits=None):
    part = (
        "SELECT '{c}' AS feature, count({c}) AS n, avg({c}) AS mean, stddev({c}) AS std, min({c}) AS min, "
        "quantile_cont({c}, 0.25) AS q25, quantile_cont({c}, 0.5) AS q50, quantile_cont({c}, 0.75) AS q75, "
        "max({c}) AS max FROM {s}"
    )
    return " UNION ALL ".join(part.format(c=c, s=source) for c in cols)


RFM_COLS = [
    "recency_days",
    "transaction_frequency",
    "total_monetary_value",
    "avg_transaction_value",
    "std_transaction_value",
]


@query(
    "r06_rfm_describe",
    "feature:s n:i mean:3 std:3 min:3 q25:3 q50:3 q75:3 max:3",
    _describe_sql(RFM_COLS, "rfm"),
)
def r06(s, sf):
    return profile.describe(cut(I.rfm(s, sf)), RFM_COLS)


@query(
    "r07_linear_score",
    "CustomerId:i rfm_score:2",
    "SELECT CustomerId, -recency_days + 2 * transaction_frequency + 3 * total_monetary_value AS rfm_score FROM rfm",
)
def r07(s, sf):
    return I.rfm(s, sf).select(
        "CustomerId",
        rfm.linear_score("recency_days", "transaction_frequency", "total_monetary_value").alias("rfm_score"),
    )


BANDS_SQL = """
CASE WHEN recency_days <= 30 THEN 5 WHEN recency_days <= 60 THEN 4 WHEN recency_days <= 90 THEN 3
     WHEN recency_days <= 180 THEN 2 ELSE 1 END AS recency_score,
CASE WHEN transaction_frequency >= 20 THEN 5 WHEN transaction_frequency >= 10 THEN 4
     WHEN transaction_frequency >= 5 THEN 3 WHEN transaction_frequency >= 2 THEN 2 ELSE 1 END AS frequency_score,
CASE WHEN total_monetary_value >= 10000 THEN 5 WHEN total_monetary_value >= 5000 THEN 4
     WHEN total_monetary_value >= 1000 THEN 3 WHEN total_monetary_value >= 500 THEN 2 ELSE 1 END AS monetary_score"""


@query(
    "r08_band_scores",
    "CustomerId:i recency_score:i frequency_score:i monetary_score:i",
    f"SELECT CustomerId, {BANDS_SQL} FROM rfm",
)
def r08(s, sf):
    return rfm.band_scores(I.rfm(s, sf))


SCORING_SQL = f"""
SELECT CustomerId, recency_score, frequency_score, monetary_score, f, m, std_transaction_value,
       CASE WHEN f > 0 THEN m / f ELSE 0 END AS avg_transaction_value,
       CASE WHEN f > 0 THEN m / f ELSE 0 END AS value_per_transaction,
       m * (f / 12) * 24 AS customer_value,
       (recency_score * 0.4e0 + frequency_score * 0.3e0 + monetary_score * 0.3e0) / 5 AS engagement_index,
       CASE WHEN f <= 1 THEN 1.0 ELSE 0.5 END AS value_concentration, 0.1 AS transaction_size_variability,
       greatest(1.0e0, f / 5) AS estimated_tenure_months,
       f / greatest(1.0e0, greatest(1.0e0, f / 5)) AS monthly_activity
FROM (SELECT CustomerId, CAST(transaction_frequency AS DOUBLE) AS f, total_monetary_value AS m,
      std_transaction_value, {BANDS_SQL} FROM rfm)"""

SCORING_OUT = (
    "CustomerId:i recency_score:i frequency_score:i monetary_score:i avg_transaction_value:3 "
    "std_transaction_value:3 customer_value:2 engagement_index:6 value_concentration:6 value_per_transaction:3 "
    "transaction_size_variability:6 estimated_tenure_months:6 monthly_activity:6"
)


@query("r09_scoring_features", SCORING_OUT, SCORING_SQL)
def r09(s, sf):
    return rfm.scoring_features(I.rfm(s, sf))


@query(
    "r10_training_features",
    "CustomerId:i recency_score:8 frequency_score:6 monetary_score:6 customer_value:2 engagement_index:8 "
    "value_concentration:8 value_per_transaction:3 transaction_size_variability:6 estimated_tenure_months:6 "
    "monthly_activity:6",
    """SELECT CustomerId, 1 / (1 + r) AS recency_score, ln(1 + f) AS frequency_score, ln(1 + m) AS monetary_score,
              m * ln(1 + f) AS customer_value, ln(1 + f) * (1 / (1 + r)) AS engagement_index,
              m / (SELECT max(total_monetary_value) FROM rfm) AS value_concentration,
              m / (f + 1) AS value_per_transaction,
              coalesce(m / nullif(m / (f + 1), 0), 0) AS transaction_size_variability,
              sqrt(f) * 2 AS estimated_tenure_months, f / (sqrt(f) * 2 + 1) AS monthly_activity
       FROM (SELECT CustomerId, CAST(recency_days AS DOUBLE) r, CAST(transaction_frequency AS DOUBLE) f,
             total_monetary_value m FROM rfm)""",
)
def r10(s, sf):
    return rfm.training_features(I.rfm(s, sf))


def quartile_sql(col, source, labels):
    a, b, c, d = labels
    return f"""CASE WHEN {col} <= (SELECT quantile_cont({col}, 0.25) FROM {source}) THEN '{a}'
        WHEN {col} <= (SELECT quantile_cont({col}, 0.5) FROM {source}) THEN '{b}'
        WHEN {col} <= (SELECT quantile_cont({col}, 0.75) FROM {source}) THEN '{c}' ELSE '{d}' END"""


TIERS = ["Bronze", "Silver", "Gold", "Platinum"]


@query(
    "r11_value_tiers",
    "tier:s customers:i mean_value:3",
    f"""SELECT tier, count(*) AS customers, avg(total_monetary_value) AS mean_value FROM (
        SELECT total_monetary_value, {quartile_sql('total_monetary_value', 'rfm', TIERS)} AS tier FROM rfm) GROUP BY tier""",
)
def r11(s, sf):
    t = rfm.quartile_tier(I.rfm(s, sf), "total_monetary_value", TIERS, "tier")
    return t.groupBy("tier").agg(F.count(F.lit(1)).alias("customers"), F.avg("total_monetary_value").alias("mean_value"))


CLV_SQL = """
SELECT *, avg_transaction_value * monthly_frequency * expected_lifespan_months AS "Predicted_CLV" FROM (
  SELECT *, "Frequency" / tenure_months AS monthly_frequency, 1 / churn_probability * 3 AS expected_lifespan_months FROM (
    SELECT *, 1 / (1 + exp(-0.1e0 * ("Recency" - 90))) AS churn_probability FROM (
      SELECT CustomerId,
             (epoch_us((SELECT max(TransactionStartTime) FROM {t})) + 86400000000 - epoch_us(max(TransactionStartTime)))
                 // 86400000000 AS "Recency",
             count(*) AS "Frequency", sum(Amount) AS "Historical_CLV", avg(Amount) AS avg_transaction_value,
             greatest(1.0e0, ((epoch_us(max(TransactionStartTime)) - epoch_us(min(TransactionStartTime)))
                 // 86400000000) / 30.44e0) AS tenure_months
      FROM {t} GROUP BY CustomerId)))"""

CLV_OUT = (
    "CustomerId:i Recency:i Frequency:i Historical_CLV:2 avg_transaction_value:3 tenure_months:6 "
    "monthly_frequency:6 churn_probability:6 expected_lifespan_months:4 Predicted_CLV:2"
)


@query("r12_lifetime_value", CLV_OUT, CLV_SQL.format(t="od"))
def r12(s, sf):
    return rfm.lifetime_value(I.od(s, sf))


def segments_sql(t="od"):
    return f"""WITH clv AS ({CLV_SQL.format(t=t)}), seg AS (SELECT *, {quartile_sql('"Predicted_CLV"', 'clv', rfm.CLV_LABELS)}
        AS "CLV_Segment" FROM clv)"""


@query(
    "r13_lifetime_segments",
    "CLV_Segment:s customers:i pct:6 historical_mean:3 predicted_mean:3 predicted_sum:2",
    segments_sql()
    + """ SELECT "CLV_Segment", count(*) AS customers, count(*) * 100 / (SELECT count(*) FROM seg) AS pct,
          avg("Historical_CLV") AS historical_mean, avg("Predicted_CLV") AS predicted_mean,
          sum("Predicted_CLV") AS predicted_sum FROM seg GROUP BY 1""",
)
def r13(s, sf):
    seg = rfm.lifetime_segments(I.od(s, sf))
    total = seg.select(F.count(F.lit(1))).scalar()
    return seg.groupBy("CLV_Segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.avg("Historical_CLV").alias("historical_mean"),
        F.avg("Predicted_CLV").alias("predicted_mean"),
        F.sum("Predicted_CLV").alias("predicted_sum"),
    ).withColumn("pct", X.ratio(F.col("customers") * 100, total))


@query(
    "r14_top_concentration",
    "customers:i top_customers:i concentration_ratio:4 risk:s",
    """SELECT *, CASE WHEN concentration_ratio > 50 THEN 'HIGH' WHEN concentration_ratio > 30 THEN 'MODERATE' ELSE 'LOW' END
       AS risk FROM (SELECT count(*) AS customers, count(*) FILTER (WHERE rn <= n * 5 // 100) AS top_customers,
       sum(total_monetary_value) FILTER (WHERE rn <= n * 5 // 100) / sum(total_monetary_value) * 100 AS concentration_ratio
       FROM (SELECT total_monetary_value, row_number() OVER (ORDER BY total_monetary_value DESC, CustomerId) rn,
             count(*) OVER () n FROM rfm))""",
)
def r14(s, sf):
    return rfm.top_share(I.rfm(s, sf), "CustomerId", "total_monetary_value")


@query(
    "r15_lorenz_curve",
    "value:2 customer_share:8 value_share:8",
    """SELECT DISTINCT total_monetary_value AS value,
       count(*) OVER w / (SELECT count(*) FROM rfm) AS customer_share,
       sum(total_monetary_value) OVER w / (SELECT sum(total_monetary_value) FROM rfm) AS value_share
       FROM rfm WINDOW w AS (ORDER BY total_monetary_value DESC)""",
)
def r15(s, sf):
    return rfm.lorenz(I.rfm(s, sf), "CustomerId", "total_monetary_value")


PATTERN_SQL = """
WITH gaps AS (SELECT CustomerId, (epoch_us(TransactionStartTime) - epoch_us(lag(TransactionStartTime) OVER (
        PARTITION BY CustomerId ORDER BY TransactionStartTime, TransactionId))) / 86400000000.0e0 AS g FROM od),
 iv AS (SELECT CustomerId, avg(g) AS im, stddev(g) AS isd FROM gaps GROUP BY CustomerId),
 clv AS (""" + CLV_SQL.format(t="od") + """),
 seg AS (SELECT *, """ + quartile_sql('"Predicted_CLV"', "clv", rfm.CLV_LABELS) + """ AS "CLV_Segment" FROM clv),
 am AS (SELECT CustomerId, avg(Amount) AS a, stddev(Amount) AS asd FROM od GROUP BY CustomerId),
 pat AS (SELECT s.CustomerId, s."Historical_CLV" AS monetary, s."Predicted_CLV", s."CLV_Segment", s."Frequency" AS n,
        s."Frequency" / nullif(s."Recency", 0) AS daily_transactions, isd / nullif(im, 0) AS interval_cv,
        asd / nullif(a, 0) AS amount_cv FROM seg s JOIN iv USING (CustomerId) JOIN am USING (CustomerId)),
 flg AS (SELECT *, CASE WHEN daily_transactions > 5 THEN 1 ELSE 0 END AS high_velocity,
        CASE WHEN interval_cv > 1.5 AND n > 5 THEN 1 ELSE 0 END AS irregular_pattern,
        CASE WHEN amount_cv > 2 AND n > 3 THEN 1 ELSE 0 END AS high_variability FROM pat),
 sc AS (SELECT *, 25 * (high_velocity + irregular_pattern + high_variability
        + CASE WHEN "CLV_Segment" IN ('High', 'Very High') THEN 1 ELSE 0 END) AS risk_score FROM flg),
 lv AS (SELECT *, CASE WHEN risk_score > 75 THEN 'Very High' WHEN risk_score > 50 THEN 'High'
        WHEN risk_score > 25 THEN 'Medium' WHEN risk_score > 0 THEN 'Low' END AS risk_level FROM sc)
"""


@query(
    "r16_behaviour_flags",
    "CustomerId:i daily_transactions:6 interval_cv:6 amount_cv:4 high_velocity:i irregular_pattern:i high_variability:i",
    PATTERN_SQL + "SELECT * FROM flg",
)
def r16(s, sf):
    return behaviour.flags(I.od(s, sf))


@query(
    "r17_spending_spike",
    "CustomerId:i previous:2 recent:2 spending_change_pct:3 spending_spike:i",
    """WITH mx AS (SELECT max(TransactionStartTime) AS m FROM od), p AS (
       SELECT CustomerId,
              coalesce(sum(Amount) FILTER (WHERE TransactionStartTime <= m - INTERVAL 30 DAY), 0) AS previous,
              coalesce(sum(Amount) FILTER (WHERE TransactionStartTime > m - INTERVAL 30 DAY), 0) AS recent
       FROM od, mx WHERE TransactionStartTime > m - INTERVAL 60 DAY GROUP BY CustomerId)
       SELECT *, (recent - previous) / CASE WHEN previous = 0 THEN 1 ELSE previous END * 100 AS spending_change_pct,
       CASE WHEN (recent - previous) / CASE WHEN previous = 0 THEN 1 ELSE previous END * 100 > 200 THEN 1 ELSE 0 END
       AS spending_spike FROM p""",
)
def r17(s, sf):
    return behaviour.spending_spike(I.od(s, sf))


@query(
    "r18_behaviour_score",
    "risk_level:s customers:i exposure:2 clv_total:2 clv_share:6",
    PATTERN_SQL
    + """SELECT risk_level, count(*) AS customers, sum(monetary) AS exposure, sum("Predicted_CLV") AS clv_total,
         sum("Predicted_CLV") / (SELECT sum("Predicted_CLV") FROM lv) * 100 AS clv_share FROM lv GROUP BY risk_level""",
)
def r18(s, sf):
    scored = behaviour.score(I.od(s, sf))
    total = scored.select(F.sum("Predicted_CLV")).scalar()
    return (
        scored.groupBy("risk_level")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum("Historical_CLV").alias("exposure"),
            F.sum("Predicted_CLV").alias("clv_total"),
        )
        .withColumn("clv_share", X.ratio("clv_total", total) * 100)
    )


_M = labels.RFM


@query(
    "r19_risk_comparison",
    "is_high_risk:i " + " ".join(f"{c}:4 {c}_norm:6 {c}_vs_low:6" for c in _M),
    "WITH g AS (SELECT is_high_risk, "
    + ", ".join(f"avg({c}) AS {c}" for c in _M)
    + " FROM lab GROUP BY 1) SELECT is_high_risk, "
    + ", ".join(
        f"{c}, {c} / max({c}) OVER () AS {c}_norm, "
        f"{c} / max(CASE WHEN is_high_risk = 0 THEN {c} END) OVER () AS {c}_vs_low"
        for c in _M
    )
    + " FROM g",
)
def r19(s, sf):
    return labels.compare_labels(I.lab(s, sf))


# --- labels -----------------------------------------------------------------------------------

_MEANS = ", ".join(f"avg({c}) AS {c}" for c in _M)
_NORMS = {c: f"{c} / (SELECT max({c}) FROM lab)" for c in _M}


def _cluster_sql(w):
    r, f, m = (_NORMS[c] for c in _M)
    return f"""WITH g AS (SELECT cluster, count(*) AS customers, {_MEANS} FROM lab GROUP BY cluster),
        sc AS (SELECT *, {w[0]!r}::DOUBLE * {r} + {w[1]!r}::DOUBLE * (1 - {f}) + {w[2]!r}::DOUBLE * (1 - {m}) AS risk_score FROM g)
        SELECT *, CASE WHEN cluster = (SELECT cluster FROM sc ORDER BY risk_score DESC, cluster LIMIT 1) THEN 1 ELSE 0 END
        AS is_high_risk FROM sc"""


_CL_OUT = "cluster:i customers:i recency_days:4 transaction_frequency:6 total_monetary_value:3 risk_score:6 is_high_risk:i"


@query(
    "l04_cluster_profile",
    "cluster:i customers:i pct:6 total_value:2 " + " ".join(f"{c}_mean:3 {c}_std:3" for c in _M),
    "SELECT cluster, count(*) AS customers, count(*) * 100 / (SELECT count(*) FROM lab) AS pct, "
    "sum(total_monetary_value) AS total_value, "
    + ", ".join(f"avg({c}) AS {c}_mean, stddev({c}) AS {c}_std" for c in _M)
    + " FROM lab GROUP BY cluster",
)
def l04(s, sf):
    return labels.cluster_profile(I.lab(s, sf))


@query("l05_cluster_risk_equal", _CL_OUT, _cluster_sql(labels.EQUAL_WEIGHTS))
def l05(s, sf):
    return labels.cluster_risk(I.lab(s, sf))


@query("l06_cluster_risk_weighted", _CL_OUT, _cluster_sql(labels.BUSINESS_WEIGHTS))
def l06(s, sf):
    return labels.cluster_risk(I.lab(s, sf), labels.BUSINESS_WEIGHTS)


@query(
    "l07_cluster_risk_rank_sum",
    "cluster:i recency_days:4 transaction_frequency:6 total_monetary_value:3 risk_score:2 is_high_risk:i",
    f"""WITH g AS (SELECT cluster, {_MEANS} FROM lab GROUP BY cluster), sc AS (
        SELECT *, rank() OVER (ORDER BY recency_days) + rank() OVER (ORDER BY transaction_frequency DESC)
        + rank() OVER (ORDER BY total_monetary_value DESC) AS risk_score FROM g)
        SELECT *, CASE WHEN cluster = (SELECT cluster FROM sc ORDER BY risk_score DESC, cluster LIMIT 1) THEN 1 ELSE 0 END
        AS is_high_risk FROM sc""",
)
def l07(s, sf):
    return labels.cluster_risk_by_rank(I.lab(s, sf))


@query(
    "l08_cluster_label",
    "is_high_risk:i customers:i pct:6",
    f"""WITH sc AS ({_cluster_sql(labels.EQUAL_WEIGHTS)}), t AS (
        SELECT CASE WHEN l.cluster = (SELECT cluster FROM sc WHERE is_high_risk = 1) THEN 1 ELSE 0 END AS is_high_risk
        FROM lab l) SELECT is_high_risk, count(*) AS customers, count(*) * 100 / (SELECT count(*) FROM lab) AS pct
        FROM t GROUP BY 1""",
)
def l08(s, sf):
    return labels.label_distribution(labels.cluster_label(I.lab(s, sf)))


@query(
    "l09_threshold_label",
    "CustomerId:i score:6 is_high_risk:i",
    "SELECT s.CustomerId, s.score, l.is_high_risk FROM scored_rfm s JOIN lab l USING (CustomerId)",
)
def l09(s, sf):
    return labels.threshold_label(I.rfm(s, sf))


@query(
    "l10_rank_label",
    "CustomerId:i pct_total:6 pct_spread:6 target:i",
    """WITH a AS (SELECT CustomerId, sum(Value) AS total, stddev(Value) AS sd FROM od GROUP BY 1 HAVING count(*) > 1),
       p AS (SELECT CustomerId,
         (rank() OVER (ORDER BY total) + (count(*) OVER (PARTITION BY total) - 1) / 2.0e0) / count(*) OVER () AS pct_total,
         (rank() OVER (ORDER BY sd) + (count(*) OVER (PARTITION BY sd) - 1) / 2.0e0) / count(*) OVER () AS pct_spread FROM a)
       SELECT *, CASE WHEN pct_total < 0.3 AND pct_spread > 0.7 THEN 1 ELSE 0 END AS target FROM p""",
)
def l10(s, sf):
    g = I.od(s, sf).groupBy("CustomerId").agg(
        F.sum("Value").alias("total"), F.stddev("Value").alias("sd"), F.count(F.lit(1)).alias("n")
    )
    return labels.rank_label(g.where("n > 1"), "total", "sd")


_FRAUD = """fr AS (SELECT CustomerId, max(FraudResult) AS had_fraud FROM od GROUP BY 1),
  j AS (SELECT l.*, coalesce(had_fraud, 0) AS had_fraud FROM lab l LEFT JOIN fr USING (CustomerId))"""


def _hl(c):
    return f"avg({c}) FILTER (WHERE is_high_risk = 1) / nullif(avg({c}) FILTER (WHERE is_high_risk = 0), 0)"


@query(
    "l11_validate_label",
    "fraud_rate_low_risk:6 fraud_rate_high_risk:6 fraud_risk_ratio:6 recency_days_ratio:6 "
    "transaction_frequency_ratio:6 total_monetary_value_ratio:6 makes_business_sense:b",
    f"""WITH {_FRAUD}, o AS (SELECT avg(had_fraud) FILTER (WHERE is_high_risk = 0) AS fraud_rate_low_risk,
        avg(had_fraud) FILTER (WHERE is_high_risk = 1) AS fraud_rate_high_risk, {_hl('had_fraud')} AS fraud_risk_ratio,
        {', '.join(f'{_hl(c)} AS {c}_ratio' for c in _M)} FROM j)
        SELECT *, recency_days_ratio > 1 AND transaction_frequency_ratio < 1 AND total_monetary_value_ratio < 1
        AS makes_business_sense FROM o""",
)
def l11(s, sf):
    return labels.validate(I.lab(s, sf), I.od(s, sf))


@query(
    "l12_relative_risk",
    "is_high_risk:i frauds:i customers:i fraud_rate:6 relative_risk:6",
    f"""WITH {_FRAUD}, g AS (SELECT is_high_risk, sum(had_fraud) AS frauds, count(*) AS customers,
        avg(had_fraud) * 100 AS fraud_rate FROM j GROUP BY 1)
        SELECT *, fraud_rate / nullif(min(fraud_rate) OVER (), 0) AS relative_risk FROM g""",
)
def l12(s, sf):
    return labels.relative_risk(I.lab(s, sf), I.od(s, sf))


@query(
    "l13_default_rate_check",
    "customers:i high_risk:i rate:6 within_range:b",
    """SELECT count(*) AS customers, sum(is_high_risk) AS high_risk, avg(is_high_risk) AS rate,
       avg(is_high_risk) BETWEEN 0.02 AND 0.05 AS within_range FROM lab""",
)
def l13(s, sf):
    return labels.default_rate_check(I.lab(s, sf))


@query(
    "l14_label_summary",
    "total_customers:i high_risk_customers:i high_risk_rate:6 within_range:b features:s "
    + " ".join(f"high_risk_{c}_avg:3" for c in _M),
    """SELECT count(*) AS total_customers, sum(is_high_risk) AS high_risk_customers, avg(is_high_risk) * 100 AS high_risk_rate,
       avg(is_high_risk) * 100 BETWEEN 2 AND 5 AS within_range,
       'CustomerId,avg_transaction_value,cluster,is_high_risk,recency_days,std_transaction_value,total_monetary_value,transaction_frequency'
       AS features, """
    + ", ".join(f"avg({c}) FILTER (WHERE is_high_risk = 1) AS high_risk_{c}_avg" for c in _M)
    + " FROM lab",
)
def l14(s, sf):
    return labels.label_summary(I.lab(s, sf))
