"""Saved feature flow, wide categories and p-values."""

import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import encoding, profile, stages
from ledgerlens.sources import files


@pytest.fixture(scope="module")
def customers(spark):
    i = F.col("id")
    return spark.range(600).select(
        i.alias("CustomerId"),
        F.when(i % 9 != 0, (i * 37 % 500).cast("double")).alias("a"),
        ((i * 61) % 89).cast("int").alias("b"),
        F.when(i % 300 == 7, "seldom").when(i % 300 == 8, "hardly").when(i % 5 > 0, F.concat(F.lit("k"), (i % 4).cast("string"))).alias("w"),
        (i % 3 == 0).cast("int").alias("is_high_risk"),
    )


def rows(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_reloaded_stage_gives_equal_rows(spark, customers):
    path = files.scratch(spark, "stage")
    plan = Pipeline(stages=[stages.FeatureFlow(config={"woe": {"min_iv": 0.0}}), VectorAssembler(inputCols=["a", "b", "w_rare"], outputCol="v")])
    fitted = plan.fit(customers)
    fitted.write().save(path)
    again = PipelineModel.load(path)
    assert rows(again.transform(customers)) == rows(fitted.transform(customers))
    # the unfitted flow travels as well
    plan.write().save(f"{path}-plan")
    assert rows(Pipeline.load(f"{path}-plan").fit(customers).transform(customers)) == rows(fitted.transform(customers))


def test_flow_on_new_rows(spark, customers):
    model = stages.FeatureFlow(config={"woe": {"enabled": False}, "scaling": {"enabled": False}}).fit(customers)
    new = spark.createDataFrame([(1, None, 5, "k1", 0), (2, 1e9, None, "never seen", 0), (3, 3.0, 4, None, 1)], customers.schema)
    out = {r.CustomerId: r.asDict() for r in model.transform(new).collect()}
    hot = [f"w_k{k}" for k in range(4)] + ["w_rare"]
    assert [out[1][c] for c in hot] == [0, 1, 0, 0, 0] and [out[2][c] for c in hot] == [0, 0, 0, 0, 1] and [out[3][c] for c in hot] == [0] * 5
    assert (out[1]["a_missing"], out[2]["a_missing"]) == (1, 0) and "b_missing" not in out[1]
    assert out[2]["a_outlier"] == 1 and out[2]["a"] < 1e9 and out[2]["b"] is not None
    assert out[1]["is_high_risk"] == 0


@pytest.mark.parametrize("step", ["encoding", "imputation", "outliers", "scaling", "woe"])
def test_every_step_can_be_left_out(customers, step):
    out = stages.FeatureFlow(config={step: {"enabled": False}}).fit(customers).transform(customers)
    assert out.count() == 600
    assert ("w" in out.columns) == (step == "encoding")
    assert any(c.endswith("_missing") for c in out.columns) == (step != "imputation")
    assert any(c.endswith("_outlier") for c in out.columns) == (step != "outliers")


def test_flow_of_empty_and_repeated_rows(spark, customers):
    none = customers.limit(0)
    assert stages.FeatureFlow(config={"woe": {"enabled": False}}).fit(none).transform(none).collect() == []
    same = customers.limit(1).withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(40)))).drop("n")
    assert stages.FeatureFlow(config={"woe": {"enabled": False}}).fit(same).transform(same).distinct().count() == 1
    with pytest.raises(ValueError):
        stages.FeatureFlow(config={"encoding": {"rare": 0}}).fit(customers)


def test_a_hundred_thousand_categories(spark):
    df = spark.range(200_000, numPartitions=4).select("id", F.concat(F.lit("c"), F.format_string("%06d", F.col("id") % 100_000)).alias("c"), (F.col("id") % 3).cast("string").alias("d"))
    with pytest.raises(ValueError):
        encoding.categories(df, "c")
    codes = {"c": encoding.fit_labels(df, "c"), "d": encoding.fit_labels(df.where("d <> '1'"), "d")}
    out, width = encoding.one_hot_places(df, codes)
    assert width == 100_002 and out.count() == 200_000
    wrong = out.where((F.col("places")[0] != F.col("id") % 100_000) | (F.size("places") != F.when(F.col("id") % 3 == 1, 1).otherwise(2)))
    assert wrong.isEmpty()
    vectors = encoding.sparse_one_hot(df.where("id % 20000 < 3"), codes)
    for r in vectors.collect():
        ones = [r.id % 100_000] + ([] if r.id % 3 == 1 else [100_000 + (r.id % 3 > 0)])
        assert (r.one_hot.size, list(r.one_hot.indices), set(r.one_hot.values)) == (100_002, ones, {1.0})


def student(r, n):
    """Two-sided tail by a fine sum over the angle."""
    v = n - 2
    at = np.linspace(0, math.asin(abs(r)), 200_001)
    f = np.cos(at) ** (v - 1)
    whole = math.exp(math.lgamma((v + 1) / 2) - math.lgamma(v / 2)) / math.sqrt(math.pi)
    return 1 - 2 * whole * float(((f[1:] + f[:-1]) / 2).sum() * (at[1] - at[0]))


def test_p_values(spark):
    cases = [(r, n) for n in (3, 4, 5, 10, 33, 100, 1000, 15_000, 19_999, 20_002, 50_000, 10**6) for r in (0.0, 1e-4, -0.003, 0.01, 0.02, -0.1, 0.5, 0.9, 0.999)]
    df = spark.createDataFrame([(float(r), n) for r, n in cases], "r double, n long")
    for row in df.select("r", "n", X.correlation_p("r", "n").alias("p")).collect():
        assert row.p == pytest.approx(max(student(row.r, row.n), 0), abs=2e-8), row
    edge = spark.createDataFrame([(1.0, 10), (-1.0, 50_000), (None, 10), (0.5, 2)], "r double, n long").select(X.correlation_p("r", "n").alias("p")).collect()
    assert [r.p for r in edge] == [0.0, 0.0, None, None]
    z = spark.createDataFrame([(float(v),) for v in np.linspace(-9, 9, 61)], "z double")
    for row in z.select("z", X.normal_p("z").alias("p")).collect():
        assert row.p == pytest.approx(math.erfc(abs(row.z) / math.sqrt(2)), rel=1e-9, abs=1e-15)


def test_kendall_variance_against_all_orders(spark):
    """Without ties the variance is 2 (2 n + 5) / (9 n (n - 1)) of tau."""
    rng = np.random.default_rng(2)
    x, y = rng.permutation(80).tolist(), rng.permutation(80).tolist()
    df = spark.createDataFrame([(float(a), float(b)) for a, b in zip(x, y)], "x double, y double")
    r = profile.significance(df, ["x"], "y", "kendall").first()
    s = sum(np.sign(x[i] - x[j]) * np.sign(y[i] - y[j]) for i in range(80) for j in range(i))
    tau = s / (80 * 79 / 2)
    assert r.correlation == pytest.approx(tau) and r.z == pytest.approx(tau / math.sqrt(2 * (2 * 80 + 5) / (9 * 80 * 79)))
    assert r.p_value == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)))
    with pytest.raises(ValueError):
        profile.significance(df, ["x"], "y", "other")
