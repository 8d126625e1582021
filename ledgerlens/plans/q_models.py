"""Splits, training, evaluation, scoring, clustering, feature flows and streaming."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from ledgerlens.operators import chained, evaluation as V, forest, modeling as M, neighbours, stages
from ledgerlens.session import cut
from ledgerlens.sources import files, tables
from ledgerlens.streaming import jobs

from . import flows, inputs as I
from .q_customer import GAPS, HOUR_US, MODE_SQL
from .registry import query

# --- clustering -----------------------------------------------------------------------------------

_CL = "CustomerId:i recency_days:i transaction_frequency:i total_monetary_value:2 cluster:i"


@query("l01_kmeans", _CL)
def l01(s, sf):
    return M.clusters(I.rfm(s, sf))


@query("l02_kmeans_log10_robust", _CL)
def l02(s, sf):
    return M.clusters(I.rfm(s, sf), logs="log10", scaler="robust", starts=20)


@query("l02b_kmeans_log1p_standard", _CL)
def l02b(s, sf):
    return M.clusters(I.rfm(s, sf), logs="log1p", starts=10)


@query("l03_cluster_count_sweep", "k:i inertia:4 silhouette_sq:6 davies_bouldin:6")
def l03(s, sf):
    return M.k_sweep(I.rfm(s, sf))


@query("l15_principal_components", "CustomerId:i pc1:6 pc2:6 pc3:6 explained_1:6 explained_2:6 explained_3:6")
def l15(s, sf):
    return M.principal_components(I.rfm(s, sf))


# --- splits and weights ---------------------------------------------------------------------------


def _split_sql(a, b, names):
    return f"""SELECT CustomerId, is_high_risk, CASE WHEN rn * 100 <= n * {a} THEN '{names[0]}' WHEN rn * 100 <= n * {b} THEN '{names[1]}' ELSE '{names[2]}' END AS split
      FROM (SELECT CustomerId, is_high_risk, row_number() OVER (PARTITION BY is_high_risk ORDER BY md5(CAST(CustomerId AS VARCHAR)), CustomerId) AS rn,
      count(*) OVER (PARTITION BY is_high_risk) AS n FROM lab)"""


_N3 = ("train", "val", "test")


@query("t01_stratified_split", "CustomerId:i is_high_risk:i split:s", _split_sql(70, 85, _N3))
def t01(s, sf):
    return V.stratified_split(I.lab(s, sf), "is_high_risk", "CustomerId", {"train": 70, "val": 15, "test": 15})


@query(
    "t02_other_split_ratios",
    "ratio:s CustomerId:i split:s",
    f"SELECT '70/10/20' AS ratio, CustomerId, split FROM ({_split_sql(70, 80, _N3)}) UNION ALL SELECT '56/14/30', CustomerId, split FROM ({_split_sql(56, 70, _N3)})",
)
def t02(s, sf):
    lab = cut(I.lab(s, sf))
    a = V.stratified_split(lab, "is_high_risk", "CustomerId", {"train": 70, "val": 10, "test": 20}).withColumn("ratio", F.lit("70/10/20"))
    b = V.stratified_split(lab, "is_high_risk", "CustomerId", {"train": 56, "val": 14, "test": 30}).withColumn("ratio", F.lit("56/14/30"))
    return a.unionByName(b)


@query(
    "t03_split_balance",
    "split:s rows:i positives:i rate:6 share:6",
    f"""SELECT split, count(*) AS rows, sum(is_high_risk) AS positives, avg(is_high_risk) AS rate, count(*) / (SELECT count(*) FROM lab) AS share
        FROM ({_split_sql(70, 85, _N3)}) GROUP BY split""",
)
def t03(s, sf):
    split = V.stratified_split(I.lab(s, sf), "is_high_risk", "CustomerId", {"train": 70, "val": 15, "test": 15})
    return V.split_balance(split, "is_high_risk")


@query(
    "t04_class_weights",
    "CustomerId:i is_high_risk:i weight:6 positive_scale:6",
    """SELECT CustomerId, is_high_risk, n / (2 * CASE WHEN is_high_risk = 1 THEN n1 ELSE n - n1 END) AS weight, (n - n1) / n1 AS positive_scale
       FROM lab, (SELECT count(*) AS n, sum(is_high_risk) AS n1 FROM lab)""",
)
def t04(s, sf):
    return V.class_weights(I.lab(s, sf), "is_high_risk")


# --- classifiers ----------------------------------------------------------------------------------

_PRED = "split:s CustomerId:i is_high_risk:i risk_score:6"


def _classifier(name, model):
    @query(name, _PRED)
    def run(s, sf):
        table = M.training_table(I.lab(s, sf))
        return M.predict(M.fit(table, model), table, ["split", "CustomerId", "is_high_risk"])


_classifier("t05_logistic_regression", "logistic_regression")
_classifier("t06_decision_tree", "decision_tree")
_classifier("t07_random_forest", "random_forest")
_classifier("t08_gradient_boosting", "gradient_boosting")


#: Searches of this session that the refit starts from.
_SEARCHED = {}
_GRID = "class_weight:s max_depth:s min_samples_leaf:s min_samples_split:s n_estimators:s"


@query("t09_grid_search", f"{_GRID} mean_auc:6 std_auc:6 rank:i best:b")
def t09(s, sf):
    found = cut(M.grid_search(M.training_table(I.lab(s, sf))))
    _SEARCHED[s.sparkContext.applicationId, sf] = found
    return found


_FLOW = "model:s split:s accuracy:6 precision:6 recall:6 f1:6 fnr:6 fpr:6 business_cost:i roc_auc:6"


@query("t09_tuned_model", _FLOW)
def t09_tuned(s, sf):
    table = M.training_table(I.lab(s, sf))
    found = _SEARCHED.get((s.sparkContext.applicationId, sf))
    return M.tuned(table, cut(M.grid_search(table)) if found is None else found)


@query("t10_train_and_select", f"{_FLOW} selected:b compliant:b")
def t10(s, sf):
    return M.train_and_select(M.training_table(I.lab(s, sf)), files.scratch(s, "production"))


# --- evaluation -----------------------------------------------------------------------------------

_CONF = """SELECT model, split, count(*) FILTER (WHERE is_high_risk = 1 AND risk_score >= 0.5) AS tp,
  count(*) FILTER (WHERE is_high_risk = 0 AND risk_score >= 0.5) AS fp, count(*) FILTER (WHERE is_high_risk = 1 AND risk_score < 0.5) AS fn,
  count(*) FILTER (WHERE is_high_risk = 0 AND risk_score < 0.5) AS tn FROM preds GROUP BY 1, 2"""
_RATES = """SELECT *, (tp + tn) / (tp + fp + fn + tn) AS accuracy, tp / nullif(tp + fp, 0) AS precision, tp / nullif(tp + fn, 0) AS recall,
  2 * tp / nullif(2 * tp + fp + fn, 0) AS f1, fn / nullif(fn + tp, 0) AS fnr, fp / nullif(fp + tn, 0) AS fpr, 10000 * fn + 1000 * fp AS business_cost FROM conf"""
_AUC = """SELECT model, split, (sum(rk) FILTER (WHERE is_high_risk = 1) - n1 * (n1 + 1) / 2) / nullif(n1 * n0, 0) AS roc_auc FROM (
  SELECT *, rank() OVER (PARTITION BY model, split ORDER BY risk_score) + (count(*) OVER (PARTITION BY model, split, risk_score) - 1) / 2.0e0 AS rk,
  CAST(sum(is_high_risk) OVER (PARTITION BY model, split) AS DOUBLE) AS n1, CAST(sum(1 - is_high_risk) OVER (PARTITION BY model, split) AS DOUBLE) AS n0
  FROM preds) GROUP BY model, split, n1, n0"""
METRICS = f"conf AS ({_CONF}), rates AS ({_RATES}), auc AS ({_AUC}), metric AS (SELECT r.*, roc_auc FROM rates r JOIN auc USING (model, split))"
_RATE_OUT = "accuracy:6 precision:6 recall:6 f1:6 fnr:6 fpr:6"


@query("v01_confusion_rates", f"model:s split:s tp:i fp:i fn:i tn:i {_RATE_OUT}", f"WITH conf AS ({_CONF}) {_RATES}")
def v01(s, sf):
    return V.rates(V.confusion(I.preds(s, sf), ["model", "split"]))


@query("v02_roc_auc", "model:s split:s roc_auc:6", _AUC)
def v02(s, sf):
    return V.roc_auc(I.preds(s, sf), ["model", "split"])


@query("v03_metric_table", f"model:s split:s {_RATE_OUT} business_cost:i roc_auc:6", f"WITH {METRICS} SELECT * FROM metric")
def v03(s, sf):
    return V.metric_table(I.preds(s, sf))


@query("v04_model_selection", "model:s roc_auc:6", f"WITH {METRICS} SELECT model, roc_auc FROM metric WHERE split = 'test' ORDER BY roc_auc DESC, model LIMIT 1")
def v04(s, sf):
    return V.select_model(V.metric_table(I.preds(s, sf)))


@query(
    "v05_compliance_gate",
    "model:s split:s roc_auc:6 fnr:6 roc_auc_met:b fnr_met:b compliant:b",
    f"WITH {METRICS} SELECT *, roc_auc >= 0.7 AS roc_auc_met, fnr <= 0.2 AS fnr_met, roc_auc >= 0.7 AND fnr <= 0.2 AS compliant FROM metric",
)
def v05(s, sf):
    return V.compliance(V.metric_table(I.preds(s, sf)))


@query("v06_feature_importance", "model:s feature:s value:6 kind:s position:i explainable:b")
def v06(s, sf):
    table = M.training_table(I.lab(s, sf))
    out = None
    for name in M.MODELS:
        part = M.importances(M.fit(table, name), s).withColumn("model", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "v07_business_report",
    "model:s split:s detection_rate:4 false_positive_rate:4 false_negative_rate:4 business_cost:i annual_savings:i",
    f"""WITH {METRICS} SELECT *, recall * 100 AS detection_rate, fpr * 100 AS false_positive_rate, fnr * 100 AS false_negative_rate,
        business_cost * -12 AS annual_savings FROM metric""",
)
def v07(s, sf):
    return V.business_report(V.metric_table(I.preds(s, sf)))


_RECORD = (
    """'{"model":"by_recency","metrics":{"roc_auc":' || round(roc_auc, 6) || ',"f1":' || round(f1, 6) || ',"recall":' || round(recall, 6)
    || ',"precision":' || round(precision, 6) || ',"fnr":' || round(fnr, 6) || '},"features":["""
    + ",".join(f'"{f}"' for f in M.FEATURES)
    + """],"compliant":' || CASE WHEN roc_auc >= 0.7 AND fnr <= 0.2 THEN 'true' ELSE 'false' END || '}'"""
)


@query(
    "v08_model_metadata",
    "model:s roc_auc:6 fnr:6 compliant:b record:s",
    f"""WITH {METRICS} SELECT model, roc_auc, fnr, roc_auc >= 0.7 AND fnr <= 0.2 AS compliant, {_RECORD} AS record
        FROM metric WHERE model = 'by_recency' AND split = 'test'""",
)
def v08(s, sf):
    metrics = V.metric_table(I.preds(s, sf))
    return M.metadata(metrics, "by_recency")


# --- scoring --------------------------------------------------------------------------------------

_SC = "CustomerId:i is_high_risk:b risk_score:6 risk_level:s confidence:6"


@query("sc1_batch_scoring", _SC)
def sc1(s, sf):
    table = M.training_table(I.lab(s, sf))
    return M.score(M.fit(table, "random_forest"), I.rfm(s, sf))


@query("io12_load_model_and_score", _SC)
def io12(s, sf):
    table = M.training_table(I.lab(s, sf))
    path = M.save(M.fit(table, "decision_tree"), files.scratch(s, "model"))
    return M.score(M.load(path), I.rfm(s, sf))


_LEVEL = """SELECT *, CASE WHEN risk_score < 0.3 THEN 'LOW' WHEN risk_score < 0.7 THEN 'MEDIUM' ELSE 'HIGH' END AS risk_level,
  greatest(risk_score, 1 - risk_score) AS confidence, risk_score >= 0.5 AS predicted_high_risk FROM preds"""


@query("sc2_risk_levels", "model:s CustomerId:i risk_score:6 risk_level:s confidence:6 predicted_high_risk:b", _LEVEL)
def sc2(s, sf):
    return V.risk_levels(I.preds(s, sf))


@query(
    "sc3_optional_defaults",
    "CustomerId:i avg_transaction_value:3 value_per_transaction:3 std_transaction_value:3 cluster:i monthly_activity:3",
    """SELECT CustomerId, coalesce(CASE WHEN recency_days <= 300 THEN avg_transaction_value END,
       CASE WHEN transaction_frequency > 0 THEN total_monetary_value / transaction_frequency ELSE 0 END) AS avg_transaction_value,
       CASE WHEN transaction_frequency > 0 THEN total_monetary_value / transaction_frequency ELSE 0 END AS value_per_transaction,
       std_transaction_value, cluster, 0 AS monthly_activity FROM lab""",
)
def sc3(s, sf):
    df = I.lab(s, sf)
    given = F.when(F.col("recency_days") <= 300, F.col("avg_transaction_value"))
    return M.fill_optional(df.withColumn("avg_transaction_value", given))


@query("sc4_default_probability", "CustomerId:i pd:6 expected_loss:3")
def sc4(s, sf):
    table = M.training_table(I.lab(s, sf))
    p = M.predict(M.fit(table, "logistic_regression"), table, ["CustomerId", "total_monetary_value"])
    return p.withColumnRenamed("risk_score", "pd").withColumn("expected_loss", V.expected_loss("pd", F.lit(0.45), "total_monetary_value"))


@query(
    "sc5_score_bands",
    "model:s risk_level:s customers:i mean_score:6 high_risk:i",
    f"""SELECT model, risk_level, count(*) AS customers, avg(risk_score) AS mean_score, count(*) FILTER (WHERE predicted_high_risk) AS high_risk
        FROM ({_LEVEL}) GROUP BY 1, 2""",
)
def sc5(s, sf):
    return V.score_bands(V.risk_levels(I.preds(s, sf)), ["model"])


# --- learned imputation and outliers --------------------------------------------------------------


@query(
    "i03_knn_impute",
    "TransactionId:i Value:4",
    """WITH t AS (SELECT TransactionId, Value, epoch_us(TransactionStartTime) / 1e6 AS x, PricingStrategy::DOUBLE AS p FROM evn),
       z AS (SELECT TransactionId, Value, (x - mx) / sx AS zx, (p - mp) / sp AS zp FROM t,
             (SELECT avg(x) mx, stddev_pop(x) sx, avg(p) mp, stddev_pop(p) sp FROM t)),
       d AS (SELECT zx, zp, avg(Value) AS mean, count(*) AS w FROM z WHERE Value IS NOT NULL GROUP BY 1, 2),
       pr AS (SELECT q.TransactionId, mean, w, sqrt(pow(q.zx - d.zx, 2) + pow(q.zp - d.zp, 2)) AS dist FROM z q, d WHERE q.Value IS NULL),
       rk AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY TransactionId ORDER BY dist ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM pr),
       f AS (SELECT TransactionId, sum(mean * least(w, 5 - seen)) / sum(least(w, 5 - seen)) AS fill FROM rk WHERE seen < 5 GROUP BY 1)
       SELECT z.TransactionId, coalesce(Value, fill) AS Value FROM z LEFT JOIN f USING (TransactionId)""",
)
def i03(s, sf):
    df = I.evn(s, sf).select(
        "TransactionId",
        "Value",
        (F.unix_micros("TransactionStartTime") / 1e6).alias("second"),
        F.col("PricingStrategy").cast("double").alias("PricingStrategy"),
    )
    return neighbours.knn_impute(df, "TransactionId", "Value", ["second", "PricingStrategy"])


def _gaps_at(df):
    """Coordinates with gaps of their own, every fourth asking row without any."""
    i = F.col("TransactionId")
    second = F.when((i % 11 != 0) & (i % 68 != 0), F.unix_micros("TransactionStartTime") / 1e6)
    return df.select("TransactionId", "Value", second.alias("second"), F.when((i % 7 != 0) & (i % 68 != 0), F.col("PricingStrategy").cast("double")).alias("PricingStrategy"))


@query(
    "i03_knn_impute_with_gaps",
    "TransactionId:i Value:4",
    """WITH t AS (SELECT TransactionId, Value, CASE WHEN TransactionId % 11 <> 0 AND TransactionId % 68 <> 0 THEN epoch_us(TransactionStartTime) / 1e6 END AS x,
         CASE WHEN TransactionId % 7 <> 0 AND TransactionId % 68 <> 0 THEN PricingStrategy::DOUBLE END AS p FROM evn),
       z AS (SELECT TransactionId, Value, (x - mx) / sx AS zx, (p - mp) / sp AS zp FROM t, (SELECT avg(x) mx, stddev_pop(x) sx, avg(p) mp, stddev_pop(p) sp FROM t)),
       s AS (SELECT q.TransactionId, CASE WHEN q.zx IS NOT NULL AND d.zx IS NOT NULL THEN d.zx END AS sx, CASE WHEN q.zp IS NOT NULL AND d.zp IS NOT NULL THEN d.zp END AS sp, q.zx, q.zp,
             avg(d.Value) AS mean, count(*) AS w FROM z q, z d WHERE q.Value IS NULL AND d.Value IS NOT NULL GROUP BY ALL),
       pr AS (SELECT *, CASE WHEN sx IS NULL THEN 0 ELSE 1 END AS hx, CASE WHEN sp IS NULL THEN 0 ELSE 1 END AS hp FROM s WHERE sx IS NOT NULL OR sp IS NOT NULL),
       di AS (SELECT *, sqrt((CASE WHEN hx = 1 THEN pow(zx - sx, 2) ELSE 0 END + CASE WHEN hp = 1 THEN pow(zp - sp, 2) ELSE 0 END) * 2 / (hx + hp)) AS dist FROM pr),
       rk AS (SELECT *, coalesce(sum(w) OVER (PARTITION BY TransactionId ORDER BY dist, hx + hp DESC, hx + 2 * hp, coalesce(sx, sp), sp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS seen FROM di),
       f AS (SELECT TransactionId, sum(mean * least(w, 5 - seen)) / sum(least(w, 5 - seen)) AS fill FROM rk WHERE seen < 5 GROUP BY 1)
       SELECT z.TransactionId, coalesce(Value, fill, (SELECT avg(Value) FROM evn)) AS Value FROM z LEFT JOIN f USING (TransactionId)""",
)
def i03_gaps(s, sf):
    return neighbours.knn_impute(_gaps_at(I.evn(s, sf)), "TransactionId", "Value", ["second", "PricingStrategy"])


@query("i04_chained_impute", "TransactionId:i Value:4 Amount:4")
def i04(s, sf):
    df = I.evn(s, sf).withColumn("Amount", F.when(F.col("TransactionId") % 19 != 0, F.col("Amount")))
    df = df.select("TransactionId", "Value", "Amount", F.col("PricingStrategy").cast("double").alias("PricingStrategy"), F.hour("TransactionStartTime").cast("double").alias("tx_hour"))
    return chained.chained_impute(df, ["Value", "Amount", "PricingStrategy", "tx_hour"])


def _chained_sql(rounds):
    """Two columns with gaps, filled in turn; the one with fewer gaps first."""
    steps = [
        """m AS (SELECT avg(v) AS mv, avg(a) AS ma FROM b), r0 AS (SELECT TransactionId, v, a, coalesce(v, mv) AS fv, coalesce(a, ma) AS fa FROM b, m)"""
    ]
    for k in range(1, rounds + 1):
        steps.append(
            f"""c{k} AS (SELECT regr_slope(a, fv) AS s, regr_intercept(a, fv) AS i FROM r{k - 1} WHERE a IS NOT NULL),
            h{k} AS (SELECT TransactionId, v, a, fv, CASE WHEN a IS NULL THEN s * fv + i ELSE fa END AS fa FROM r{k - 1}, c{k}),
            d{k} AS (SELECT regr_slope(v, fa) AS s, regr_intercept(v, fa) AS i FROM h{k} WHERE v IS NOT NULL),
            r{k} AS (SELECT TransactionId, v, a, CASE WHEN v IS NULL THEN s * fa + i ELSE fv END AS fv, fa FROM h{k}, d{k})"""
        )
    return f"""WITH b AS (SELECT TransactionId, Value AS v, CASE WHEN TransactionId % 19 <> 0 THEN Amount + TransactionId % 5 END AS a FROM evn), {", ".join(steps)}
        SELECT TransactionId, fv AS Value, fa AS Amount FROM r{rounds}"""


def _chained(s, sf, rounds):
    amount = F.when(F.col("TransactionId") % 19 != 0, F.col("Amount") + F.col("TransactionId") % 5)
    df = I.evn(s, sf).select("TransactionId", "Value", amount.alias("Amount"))
    return chained.chained_impute(df, ["Value", "Amount"], rounds=rounds, tol=0.0)


@query("i04_chained_one_round", "TransactionId:i Value:4 Amount:4", _chained_sql(1))
def i04_one(s, sf):
    return _chained(s, sf, 1)


@query("i04_chained_three_rounds", "TransactionId:i Value:4 Amount:4", _chained_sql(3))
def i04_three(s, sf):
    return _chained(s, sf, 3)


@query("o08_isolation_forest", "TransactionId:i score:6 is_outlier:b")
def o08(s, sf):
    return forest.isolation_outliers(I.ev(s, sf), "TransactionId", ["Amount", "Value"])


@query("o09_local_outlier_factor", "TransactionId:i lof:5 is_outlier:b")
def o09(s, sf):
    return neighbours.local_outlier_factor(I.ev(s, sf), "TransactionId", ["Amount", "Value"])


@query("o08_isolation_forest_with_gaps", "TransactionId:i score:6 is_outlier:b")
def o08_gaps(s, sf):
    return forest.isolation_outliers(I.evn(s, sf), "TransactionId", ["Amount", "Value"])


def _z(c):
    return f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()"


@query(
    "o09_customer_outlier_factor",
    "CustomerId:i lof:5 is_outlier:b",
    f"""WITH z AS (SELECT CustomerId AS id, {', '.join(f'{_z(c)} AS z{i}' for i, c in enumerate(M.RFM))} FROM rfm),
        pr AS (SELECT a.id AS q, b.id AS p, sqrt(pow(a.z0 - b.z0, 2) + pow(a.z1 - b.z1, 2) + pow(a.z2 - b.z2, 2)) AS d FROM z a JOIN z b ON a.id <> b.id),
        nr AS (SELECT q, p, d FROM pr QUALIFY row_number() OVER (PARTITION BY q ORDER BY d) <= 20),
        kd AS (SELECT q, max(d) AS k FROM nr GROUP BY q),
        lr AS (SELECT n.q, 1 / (avg(greatest(d, k)) + 1e-10) AS lrd FROM nr n JOIN kd ON n.p = kd.q GROUP BY n.q),
        lf AS (SELECT n.q AS CustomerId, avg(t.lrd) / any_value(o.lrd) AS lof FROM nr n JOIN lr t ON n.p = t.q JOIN lr o ON n.q = o.q GROUP BY n.q)
        SELECT *, lof > (SELECT quantile_cont(lof, 0.9) FROM lf) AS is_outlier FROM lf""",
)
def o09b(s, sf):
    return neighbours.local_outlier_factor(cut(I.rfm(s, sf)), "CustomerId", M.RFM)


# at most one gap a row and none in the money, so that no two distances are equal
_FILLED = ", ".join(f"CASE WHEN CustomerId % 15 <> {k} THEN {c}::DOUBLE END AS {c}" for k, c in zip((0, 1, 99), M.RFM))


@query(
    "o09_outlier_factor_with_gaps",
    "CustomerId:i lof:5 is_outlier:b",
    f"""WITH g AS (SELECT CustomerId, {_FILLED} FROM rfm), f AS (SELECT CustomerId, {', '.join(f'coalesce({c}, avg({c}) OVER ()) AS {c}' for c in M.RFM)} FROM g),
        z AS (SELECT CustomerId AS id, {', '.join(f'{_z(c)} AS z{i}' for i, c in enumerate(M.RFM))} FROM f),
        pr AS (SELECT a.id AS q, b.id AS p, sqrt(pow(a.z0 - b.z0, 2) + pow(a.z1 - b.z1, 2) + pow(a.z2 - b.z2, 2)) AS d FROM z a JOIN z b ON a.id <> b.id),
        nr AS (SELECT q, p, d FROM pr QUALIFY row_number() OVER (PARTITION BY q ORDER BY d) <= 20),
        kd AS (SELECT q, max(d) AS k FROM nr GROUP BY q),
        lr AS (SELECT n.q, 1 / (avg(greatest(d, k)) + 1e-10) AS lrd FROM nr n JOIN kd ON n.p = kd.q GROUP BY n.q),
        lf AS (SELECT n.q AS CustomerId, avg(t.lrd) / any_value(o.lrd) AS lof FROM nr n JOIN lr t ON n.p = t.q JOIN lr o ON n.q = o.q GROUP BY n.q)
        SELECT *, lof > (SELECT quantile_cont(lof, 0.9) FROM lf) AS is_outlier FROM lf""",
)
def o09_gaps(s, sf):
    rows = I.rfm(s, sf).select("CustomerId", *[F.when(F.col("CustomerId") % 15 != k, F.col(c).cast("double")).alias(c) for k, c in zip((0, 1, 99), M.RFM)])
    return neighbours.local_outlier_factor(cut(rows), "CustomerId", M.RFM)


# --- feature flows --------------------------------------------------------------------------------

_PL1 = ["total_transaction_amount", "transaction_hour_mean", "time_between_transactions_mean", "days_since_last_transaction"]
_PL1_SQL = f"""WITH f AS (SELECT CustomerId, sum(Value) AS total_transaction_amount, avg(hour(TransactionStartTime)) AS transaction_hour_mean,
   any_value(gm) AS time_between_transactions_mean, CAST((epoch_us((SELECT max(TransactionStartTime) FROM ev)) - epoch_us(max(TransactionStartTime)))
   // 86400000000 AS DOUBLE) AS days_since_last_transaction
   FROM ev JOIN (SELECT CustomerId, avg(gap) AS gm FROM ({GAPS.format(t='ev', u=HOUR_US)}) GROUP BY 1) g USING (CustomerId) GROUP BY CustomerId),
  c AS (SELECT CustomerId, {', '.join(f'greatest(least({c}, (SELECT quantile_cont({c}, 0.99) FROM f)), (SELECT quantile_cont({c}, 0.01) FROM f)) AS {c}' for c in _PL1)} FROM f)
  SELECT CustomerId, {', '.join(f'{_z(c)} AS {c}' for c in _PL1)} FROM c"""


@query("pl1_full_feature_flow", "CustomerId:i " + " ".join(f"{c}:5" for c in _PL1), _PL1_SQL)
def pl1(s, sf):
    return flows.full_flow(I.ev(s, sf))


# the saved stage: measures with gaps, a label, a one-hot and a frequency column, two of them with rare categories
_SM = ["recency_days", "transaction_frequency", "total_monetary_value", "std_transaction_value"]
_SG = ["recency_days", "total_monetary_value"]
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_SB = """b AS (SELECT l.CustomerId, l.is_high_risk AS y, CASE WHEN l.CustomerId % 11 <> 0 THEN CAST(recency_days AS DOUBLE) + CAST(l.CustomerId AS DOUBLE) / 100000 END AS recency_days,
    CAST(transaction_frequency AS DOUBLE) + CAST(l.CustomerId AS DOUBLE) / 100000 AS transaction_frequency, CASE WHEN l.CustomerId % 7 <> 0 THEN total_monetary_value END AS total_monetary_value,
    std_transaction_value, CASE WHEN c_acctbal > 0 THEN 'owed' ELSE 'owing' END AS side, CASE WHEN l.CustomerId % 400 = 3 THEN 'odd' WHEN l.CustomerId % 13 <> 0 THEN c_mktsegment END AS segment,
    CASE WHEN l.CustomerId % 400 = 5 THEN 'nowhere' ELSE CAST(c_nationkey AS VARCHAR) END AS nation FROM lab l JOIN customer ON c_custkey = l.CustomerId)"""


def _saved_flow_sql():
    each = lambda text: ", ".join(text.format(c=c) for c in _SM)
    steps = [
        _SB,
        "n AS (SELECT nation AS v, CASE WHEN count(*) / (SELECT count(*) FROM b) < 0.01 THEN 'rare' ELSE nation END AS g, count(*) AS k FROM b GROUP BY 1)",
        "nf AS (SELECT v, sum(k) OVER (PARTITION BY g) / (SELECT count(*) FROM b) AS nation_freq FROM n)",
        "sf AS (SELECT segment AS v, CASE WHEN count(*) / (SELECT count(segment) FROM b) < 0.01 THEN 'rare' ELSE segment END AS g FROM b WHERE segment IS NOT NULL GROUP BY 1)",
        f"i AS (SELECT CustomerId, y, CASE side WHEN 'owed' THEN 0 ELSE 1 END AS side_code, nation_freq, sf.g AS segment, {', '.join(f'CASE WHEN {c} IS NULL THEN 1 ELSE 0 END AS {c}_missing' for c in _SG)}, "
        + each("coalesce({c}, (SELECT median({c}) FROM b)) AS {c}")
        + " FROM b LEFT JOIN nf ON nation = nf.v LEFT JOIN sf ON segment = sf.v)",
        f"q AS (SELECT {each('quantile_cont({c}, 0.01) AS lo_{c}, quantile_cont({c}, 0.99) AS hi_{c}')} FROM i)",
        f"o AS (SELECT * EXCLUDE ({', '.join(_SM)}), {each('CASE WHEN {c} < lo_{c} OR {c} > hi_{c} THEN 1 ELSE 0 END AS {c}_outlier')}, {each('greatest(least({c}, hi_{c}), lo_{c}) AS {c}')} FROM i, q)",
        f"z AS (SELECT * EXCLUDE ({', '.join(_SM)}), {each('({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}')} FROM o)",
    ]
    for c in _SM:
        # an edge that equals the least or the largest value is no border
        edges = ", ".join(f"quantile_cont({c}, {k}/10::DOUBLE) AS e{k}" for k in range(1, 10))
        key = " + ".join(f"CASE WHEN {c} > e{k} AND e{k} > mn AND e{k} < mx THEN 1 ELSE 0 END" for k in range(1, 10))
        steps += [
            f"k_{c} AS (SELECT CustomerId, y, {key} AS k FROM z, (SELECT {edges}, min({c}) AS mn, max({c}) AS mx FROM z))",
            f"w_{c} AS (SELECT k, ln(greatest(sum(y) / (SELECT sum(y) FROM b), 1e-10) / greatest(sum(1 - y) / (SELECT sum(1 - y) FROM b), 1e-10)) AS woe FROM k_{c} GROUP BY k)",
            f"v_{c} AS (SELECT CustomerId, woe AS {c} FROM k_{c} JOIN w_{c} USING (k))",
        ]
    hot = ", ".join(f"CASE WHEN segment = '{s}' THEN 1 ELSE 0 END AS segment_{s}" for s in [*_SEGMENTS, "rare"])
    return f"WITH {', '.join(steps)} SELECT z.* EXCLUDE ({', '.join(_SM)}), {hot}, {', '.join(f'v_{c}.{c}' for c in _SM)} FROM z {' '.join(f'JOIN v_{c} USING (CustomerId)' for c in _SM)}"


_SAVED_OUT = (
    "CustomerId:i side_code:i nation_freq:6 "
    + " ".join(f"segment_{x}:i" for x in [*_SEGMENTS, "rare"])
    + " "
    + " ".join(f"{c}_missing:i" for c in _SG)
    + " "
    + " ".join(f"{c}_outlier:i {c}:6" for c in _SM)
)


def flow_input(s, sf):
    lab = I.lab(s, sf).join(tables.table(s, sf, "customer").select(F.col("c_custkey").alias("CustomerId"), "c_acctbal", "c_mktsegment", "c_nationkey"), "CustomerId")
    i, nudge = F.col("CustomerId"), F.col("CustomerId").cast("double") / 100000
    return lab.select(
        i,
        "is_high_risk",
        F.when(i % 11 != 0, F.col("recency_days").cast("double") + nudge).alias("recency_days"),
        (F.col("transaction_frequency").cast("double") + nudge).alias("transaction_frequency"),
        F.when(i % 7 != 0, F.col("total_monetary_value")).alias("total_monetary_value"),
        "std_transaction_value",
        F.when(F.col("c_acctbal") > 0, "owed").otherwise("owing").alias("side"),
        F.when(i % 400 == 3, "odd").when(i % 13 != 0, F.col("c_mktsegment")).alias("segment"),
        F.when(i % 400 == 5, "nowhere").otherwise(F.col("c_nationkey").cast("string")).alias("nation"),
    )


@query("pl1_saved_flow", _SAVED_OUT, _saved_flow_sql())
def pl1_saved(s, sf):
    df = cut(flow_input(s, sf))
    path = files.scratch(s, "flow")
    Pipeline(stages=[stages.FeatureFlow(config={"woe": {"min_iv": 0.0}})]).fit(df).write().save(path)
    return PipelineModel.load(path).transform(df)


_PL2 = ["total_transaction_amount", "median_transaction_amount", "is_weekend_mean"]


_HOT = [f"favorite_product_category_{c}" for c in ("click", "error", "purchase", "signup", "view")]


@query(
    "pl2_simple_feature_flow",
    "CustomerId:i " + " ".join(f"{c}:5" for c in _PL2) + " " + " ".join(f"{c}:i" for c in _HOT),
    f"""WITH f AS (SELECT CustomerId, sum(Value) AS total_transaction_amount, median(Value) AS median_transaction_amount,
        avg(CASE WHEN isodow(TransactionStartTime) >= 6 THEN 1 ELSE 0 END) AS is_weekend_mean FROM ev GROUP BY 1),
        m AS ({MODE_SQL.format(c="ProductCategory", a="v", t="ev")})
        SELECT CustomerId, {', '.join(f'{_z(c)} AS {c}' for c in _PL2)}, {', '.join(f"CASE WHEN v = '{c.rsplit('_', 1)[1]}' THEN 1 ELSE 0 END AS {c}" for c in _HOT)} FROM f JOIN m USING (CustomerId)""",
)
def pl2(s, sf):
    return flows.simple_flow(I.ev(s, sf))


@query(
    "pl3_preprocessor",
    "TransactionId:i width:i value_scaled:6 amount_scaled:6 no_category:i channel_c3:i",
    """WITH f AS (SELECT TransactionId, coalesce(Value, (SELECT median(Value) FROM evn)) AS v, Amount AS a, ProductCategory AS c, ChannelId AS h FROM evn)
       SELECT TransactionId, 12 AS width, (v - min(v) OVER ()) / (max(v) OVER () - min(v) OVER ()) AS value_scaled,
       (a - min(a) OVER ()) / (max(a) OVER () - min(a) OVER ()) AS amount_scaled, CASE WHEN c IS NULL THEN 1 ELSE 0 END AS no_category,
       CASE WHEN h = 'C3' THEN 1 ELSE 0 END AS channel_c3 FROM f""",
)
def pl3(s, sf):
    out = flows.preprocessor(I.evn(s, sf), ["Value", "Amount"], ["ProductCategory", "ChannelId"], "TransactionId")
    v = F.col("features")
    # positions: two numbers, the categories in alphabetical order, then the channels
    return out.select("TransactionId", "width", v[0].alias("value_scaled"), v[1].alias("amount_scaled"), v[4].alias("no_category"), v[11].alias("channel_c3"))


# --- streaming ------------------------------------------------------------------------------------


@query(
    "st1_daily_stream_totals",
    "day:s n:i total:2 mean:4 open:b",
    """SELECT strftime(date_trunc('day', ts), '%Y-%m-%d') AS day, count(*) AS n, sum(value) AS total, avg(value) AS mean,
       date_trunc('day', ts) + INTERVAL 1 DAY > (SELECT max(ts) FROM events) - INTERVAL 1 HOUR AS open FROM events
       GROUP BY date_trunc('day', ts)""",
)
def st1(s, sf):
    schema = tables.table(s, sf, "events").schema
    stream = jobs.source(s, f"{sf}/events.parquet", schema)
    return jobs.mark_open(jobs.drain(jobs.daily_totals(stream, "ts", "value"), "daily", "complete"))


@query("st2_stream_deduplication", "l_orderkey:i", "SELECT DISTINCT l_orderkey FROM lineitem")
def st2(s, sf):
    schema = tables.table(s, sf, "lineitem").schema
    stream = jobs.source(s, f"{sf}/lineitem.parquet", schema)
    return jobs.drain(jobs.unique_rows(stream, ["l_orderkey"]).select("l_orderkey"), "unique")


@query("st3_stream_scoring", "CustomerId:i risk_score:6 risk_level:s confidence:6")
def st3(s, sf):
    table = M.training_table(I.lab(s, sf))
    model = M.fit(table, "random_forest", M.RFM, numTrees=20)
    arriving = I.rfm(s, sf).select("CustomerId", *[F.col(c).cast("double").alias(c) for c in M.RFM])
    path = files.write(arriving, files.scratch(s, "arriving"))
    stream = jobs.source(s, path, arriving.schema)
    return jobs.drain(jobs.scored(stream, model), "scored")
