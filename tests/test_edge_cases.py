"""Rules at the edges: few rows, no spread, ties, NULLs, unseen values."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import (
    behaviour,
    cleaning,
    customer,
    encoding,
    evaluation,
    labels,
    profile,
    quality,
    relations,
    reports,
    rfm,
    windows,
)
from ledgerlens.sources import files, tables

T0 = dt.datetime(2024, 1, 1)


def tx(spark, rows):
    """Rows of (id, customer, hours after start, value[, category])."""
    full = [(i, c, T0 + dt.timedelta(hours=h), float(v), (rest or ["x"])[0]) for i, c, h, v, *rest in rows]
    df = spark.createDataFrame(full, "TransactionId bigint, CustomerId bigint, TransactionStartTime timestamp, Value double, ProductCategory string")
    return df.withColumns({"Amount": F.col("Value"), "ChannelId": F.lit("C"), "ProviderId": F.lit("P"), "CurrencyCode": F.lit("USD"), "FraudResult": F.lit(0)})


def by_customer(df):
    return {r.CustomerId: r for r in df.collect()}


@pytest.fixture(scope="module")
def few(spark):
    return tx(
        spark,
        [(1, 1, 0, 5), (2, 2, 0, 1), (3, 2, 5, 3), (4, 3, 0, 1), (5, 3, 1, 2), (6, 3, 2, 9), (7, 4, 0, 7), (8, 4, 1, 7), (9, 4, 2, 7), (10, 4, 3, 7)],
    )


def test_single_transaction_deviation(few):
    assert by_customer(customer.required(few))[1].std_transaction_amount == 0.0
    assert by_customer(customer.value_features(few))[1].std_transaction_amount is None


def test_shape_needs_rows_and_spread(few):
    s = by_customer(customer.shape(few))
    assert s[1].skew_transaction_amount is None and s[2].skew_transaction_amount is None
    assert s[3].skew_transaction_amount is not None and s[3].kurtosis_transaction_amount is None
    assert s[4].skew_transaction_amount == 0.0 and s[4].kurtosis_transaction_amount == 0.0


def test_filled_aggregates_have_no_nulls(few):
    row = customer.extended(few).toPandas()
    assert not row.isna().any().any() and len(row) == 4


def test_four_required_aggregates(spark):
    df = tx(spark, [(i, i % 4, i, 10 + i, "abc"[i % 3]) for i in range(100)])
    got = customer.required(df)
    assert got.count() == 4 and set(got.columns) >= {"total_transaction_amount", "avg_transaction_amount", "transaction_count", "std_transaction_amount"}
    parts = customer.time_parts(df).agg(F.min("transaction_hour"), F.max("transaction_hour"), F.max("transaction_day"), F.max("transaction_month")).first()
    assert 0 <= parts[0] <= parts[1] <= 23 and parts[2] <= 31 and parts[3] <= 12


def test_no_spread_gives_zero_ratios(few):
    row = by_customer(customer.interactions(customer.value_features(few)))
    assert row[4].cv_transaction_amount == 0.0 and row[1].cv_transaction_amount == 0.0


def test_negative_and_zero_totals(spark):
    df = tx(spark, [(1, 1, 0, -5), (2, 1, 1, 2), (3, 2, 0, 4), (4, 2, 1, -4)])
    r = by_customer(rfm.rfm_table(df))
    assert r[1].total_monetary_value == 3.0 and r[2].total_monetary_value == 0.0
    log = by_customer(customer.required(df).withColumn("l", X.signed_log("total_transaction_amount")))
    assert log[1].l == pytest.approx(-math.log(4)) and log[2].l == 0.0


def test_day_part_of_a_difference(spark):
    df = tx(spark, [(1, 1, 23, 1), (2, 2, 24, 1)])
    assert by_customer(rfm.rfm_table(df))[1].recency_days == 0
    assert by_customer(rfm.rfm_table(df, snapshot_shift="1 day"))[1].recency_days == 1


def test_gap_statistics(few):
    g = by_customer(behaviour.gap_stats(few))
    assert g[1].gap_mean is None and g[2].gap_mean == 5.0 and g[2].gap_std is None and g[3].gap_std == 0.0


def test_consistency_of_one_value(few):
    c = by_customer(customer.time_consistency(few))
    assert c[1].transaction_hour_consistency == 1.0
    assert c[3].transaction_hour_consistency == pytest.approx(0.0, abs=1e-8)


def test_trailing_window_keeps_idle_customers(spark):
    df = tx(spark, [(1, 1, 0, 5), (2, 2, 24 * 10, 7)])
    w = by_customer(customer.trailing_windows(df, (7,)))
    assert (w[1].total_amount_7d, w[1].transaction_count_7d, w[1].growth_rate_7d) == (0.0, 0, 0.0)
    assert w[2].growth_rate_7d == 1.0


def test_last_rolling_is_left_open(spark):
    df = tx(spark, [(1, 1, 0, 5), (2, 1, 24 * 7, 7)])
    r = windows.last_rolling(df, {"W": 7}).first()
    assert (r.rolling_sum, r.rolling_count) == (7.0, 1)


def test_empty_day_is_kept(spark):
    df = tx(spark, [(1, 1, 0, 5), (2, 1, 24 * 2, 7)])
    rows = {str(r.period): (r.n, r.total, r["mean"]) for r in reports.resample(df, "day").collect()}
    assert rows["2024-01-02"] == (0, 0.0, None) and len(rows) == 3


def test_score_zero_has_no_level(spark):
    df = spark.createDataFrame([(0,), (25,), (26,), (100,)], "risk_score int")
    got = [r[0] for r in df.select(X.cut_left_open("risk_score", behaviour.RISK_EDGES, behaviour.RISK_LEVELS)).collect()]
    assert got == [None, "Low", "Medium", "Very High"]


def test_risk_level_limits(spark):
    df = spark.createDataFrame([(0.29,), (0.3,), (0.69,), (0.7,)], "risk_score double")
    assert [r.risk_level for r in evaluation.risk_levels(df).collect()] == ["LOW", "MEDIUM", "MEDIUM", "HIGH"]


def test_one_class_metrics_are_null(spark):
    df = spark.createDataFrame([("m", "test", 0, 0.2), ("m", "test", 0, 0.9)], "model string, split string, is_high_risk int, risk_score double")
    r = evaluation.metric_table(df).first()
    assert r.roc_auc is None and r.recall is None and r.fnr is None and r.fpr == 0.5
    assert evaluation.compliance(evaluation.metric_table(df)).first().compliant is not True


def test_auc_counts_ties_half(spark):
    df = spark.createDataFrame([("m", 1, 0.5), ("m", 0, 0.5), ("m", 1, 0.9), ("m", 0, 0.1)], "model string, is_high_risk int, risk_score double")
    assert evaluation.roc_auc(df, ["model"]).first().roc_auc == pytest.approx(3.5 / 4)


def test_split_sizes(spark):
    df = spark.range(1350).select("id", F.lit(0).alias("y")).unionByName(spark.range(1350, 1500).select("id", F.lit(1).alias("y")))
    got = {(r.y, r.split): r["count"] for r in evaluation.stratified_split(df, "y", "id", {"train": 70, "val": 15, "test": 15}).groupBy("y", "split").count().collect()}
    assert got[(0, "train")] == 945 and got[(1, "train")] == 105 and sum(got.values()) == 1500


def test_cluster_rank_direction(spark):
    df = spark.createDataFrame(
        [(1, 300.0, 1.0, 10.0, 0), (2, 5.0, 20.0, 900.0, 1), (3, 100.0, 5.0, 100.0, 2)],
        "CustomerId int, recency_days double, transaction_frequency double, total_monetary_value double, cluster int",
    )
    flagged = lambda t: [r.cluster for r in t.collect() if r.is_high_risk]
    assert flagged(labels.cluster_risk_by_rank(df)) == [0]
    assert flagged(labels.cluster_risk_by_rank(df, riskiest_last=False)) == [1]
    assert flagged(labels.cluster_risk(df)) == [0] and flagged(labels.cluster_risk(df, labels.BUSINESS_WEIGHTS)) == [0]


def test_quantile_bins_drop_repeated_edges(spark):
    df = spark.createDataFrame([(float(v),) for v in [1] * 10 + [2, 3, 4, 5]], "v double")
    bins = {r.v: r.bin for r in encoding.quantile_bins(df, "v", 4).collect()}
    assert bins[1.0] == 0 and bins[5.0] == max(bins.values()) and sorted(set(bins.values())) == list(range(len(set(bins.values()))))


def woe_data(spark):
    rows = [(float(i), i % 3, int(i >= 15)) for i in range(30)]
    return spark.createDataFrame(rows, "v double, d int, y int")


@pytest.mark.parametrize("smoothing", ["floor", "half", "epsilon"])
def test_woe_of_pure_bins_is_finite(spark, smoothing):
    t = encoding.fit_woe(woe_data(spark), ["v", "d"], "y", max_bins=5, smoothing=smoothing).collect()
    assert {r.feature: r.binned for r in t} == {"v": True, "d": False}
    assert all(math.isfinite(r.woe) for r in t)
    assert sum(r.good + r.bad for r in t if r.feature == "v") == 30


def test_woe_transform_policies(spark):
    df = woe_data(spark)
    bins = encoding.fit_woe(df, ["v", "d"], "y", max_bins=5)
    new = spark.createDataFrame([(-5.0, 0, 0), (99.0, 7, 0), (None, None, 0), (0.0, 1, 0)], "v double, d int, y int")
    null = encoding.woe_transform(new, bins, "null", 0.0).collect()
    assert [r.v is None for r in null] == [True, True, True, False] and [r.d is None for r in null] == [False, True, True, False]
    first = encoding.woe_transform(new, bins, "first", 0.0).collect()
    assert first[0].v == first[1].v == first[3].v and first[2].v is None and first[2].d is None
    assert "d" not in encoding.woe_transform(new, bins, "null", 0.02).columns


def test_monotonic_flag(spark):
    rows = spark.createDataFrame(
        [("a", 0, -1.0), ("a", 1, 0.0), ("a", 2, 2.0), ("b", 0, 1.0), ("b", 1, 2.0), ("b", 2, 0.0)], "feature string, bin int, woe double"
    )
    assert {r.feature: r.monotonic for r in encoding.monotonic(rows).collect()} == {"a": True, "b": False}


@pytest.fixture(scope="module")
def colours(spark):
    known = spark.createDataFrame([("red",), ("blue",), ("green",), ("red",)], "c string")
    new = spark.createDataFrame([("red",), ("pink",), (None,)], "c string")
    return known, new


def test_label_policies(colours):
    known, new = colours
    codes = encoding.fit_labels(known, "c")
    got = lambda policy: {r.c: r.c_code for r in encoding.label_encode(new, codes, "c", policy).collect()}
    assert got("encode") == {"red": 2, "pink": 3, None: -1}
    assert got("ignore") == {"red": 2, "pink": -1, None: -1}
    with pytest.raises(ValueError):
        got("error")


def test_other_encoders_on_unseen(colours):
    known, new = colours
    hot = {r.c_red for r in encoding.one_hot(new, {"c": encoding.categories(known, "c")}).collect()}
    assert hot == {0, 1}
    freq = {r.c: r.c_freq for r in encoding.frequency_encode(new, encoding.fit_frequencies(known, "c"), "c").collect()}
    assert freq == {"red": 0.5, "pink": 0.0, None: 0.0}
    bits = {r.c: (r.c_0, r.c_1) for r in encoding.binary_encode(new, encoding.fit_labels(known, "c"), "c").collect()}
    assert bits == {"red": (1, 1), "pink": (0, 0), None: (0, 0)}
    with pytest.raises(ValueError):
        encoding.categories(known, "c", limit=2)


def test_sparse_columns_are_dropped(spark):
    df = spark.range(100).select("id", F.when(F.col("id") >= 31, F.col("id")).alias("s31"), F.when(F.col("id") >= 30, F.col("id")).alias("s30"), F.lit(None).cast("double").alias("none"))
    assert relations.drop_sparse_columns(df).columns == ["id", "s30"]
    cleaned = quality.clean(df)
    assert cleaned.columns == ["id", "s30"] and cleaned.where("s30 is null").count() == 0


def test_correlation_without_spread(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, None)], "a double, b double")
    assert profile.pearson(df, ["a", "b"]).first().correlation is None


def test_modified_z_falls_back_to_mean_deviation(spark):
    df = spark.createDataFrame([(v,) for v in [1.0] * 20 + [100.0]], "v double")
    params = cleaning.mad_params(df, ["v"])
    assert params["v"][1] == pytest.approx(1.4826 * 99 / 21)
    assert df.where(cleaning.mad_outlier("v", params["v"])).count() == 1


def test_scalers_round_trip_and_zero_divisor(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)], "a double, b double")
    for kind in ("standard", "minmax", "robust", "maxabs"):
        p = cleaning.fit_scaler(df, ["a", "b"], kind)
        back = cleaning.unscale(cleaning.scale(df, p), p).toPandas()
        assert abs(back - df.toPandas()).max().max() < 1e-12
    assert cleaning.fit_scaler(df, ["b"], "standard")["b"][1] == 1.0


def test_outlier_strategies(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "v double")
    b = cleaning.percentile_bounds(df, ["v"])
    capped = cleaning.treat_outliers(df, b).agg(F.min("v"), F.max("v"), F.sum("v_outlier")).first()
    assert tuple(capped) == (pytest.approx(1.99), pytest.approx(99.01), 2)
    assert cleaning.treat_outliers(df, b, "remove").where("v is null").count() == 2


def test_request_check(spark):
    df = spark.createDataFrame([(45.0, 12.0, 1500.5), (400.0, 1.0, 1.0), (1.0, 2.0, None)], "recency_days double, transaction_frequency double, total_monetary_value double")
    assert [r.reason for r in quality.check_requests(df).collect()] == [None, "recency out of range", "missing field"]


def test_scoring_keeps_given_values(spark):
    df = spark.createDataFrame([(45.0, 12.0, 1500.5, 3.0), (45.0, 1.0, 10.0, None)], "recency_days double, transaction_frequency double, total_monetary_value double, monthly_activity double")
    a, b = rfm.scoring_features(df).collect()
    assert a.monthly_activity == 3.0 and a.recency_score == 4 and a.frequency_score == 4 and a.monetary_score == 3
    assert b.monthly_activity == 1.0 and b.value_concentration == 1.0


def test_missing_columns_are_named(spark):
    with pytest.raises(ValueError, match="b"):
        files.require(spark.range(1).toDF("a"), ["a", "b"])


def test_aliases_and_conformance(spark):
    df = spark.createDataFrame([("1", "x", "2", "9")], "customer_id string, amount string, target string, other string")
    named = files.canonical(df)
    assert named.columns == ["CustomerId", "Amount", "is_high_risk", "other"]
    row = files.conform(named, ["CustomerId"], ["Amount"], "is_high_risk").first()
    assert row.Amount is None and row.is_high_risk == 2
    assert {f.name for f in tables.TRANSACTION_SCHEMA} >= {"TransactionId", "Amount", "FraudResult"}


def test_rate_levels(spark):
    same = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "g string, r double")
    assert {x.risk_level for x in reports.rate_levels(same, "r").collect()} == {"Medium"}
    few = spark.createDataFrame([("a", 0.05), ("b", 2.0)], "g string, r double")
    assert {x.g: x.risk_level for x in reports.rate_levels(few, "r").collect()} == {"a": "Low", "b": "Very High"}


def test_stability_index_of_equal_samples(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("v"))
    assert profile.stability_index(df, df, "v").first().psi == pytest.approx(0.0)


def test_recent_rows_filter_reaches_the_scan(spark):
    df = tx(spark, [(i, 1, 24 * i, 1) for i in range(20)])
    path = files.write(df, files.scratch(spark, "recent"))
    got = relations.recent(spark.read.parquet(path), 5)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(TransactionStartTime" in plan
    assert sorted(r.TransactionId for r in got.collect()) == [15, 16, 17, 18, 19]
    assert relations.recent(df.where("false"), 5).count() == 0
