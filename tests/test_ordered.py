"""Order statistics, ranks, gaps and positions against pandas and numpy, with hot keys and heavy ties."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import ordered, profile, windows


@pytest.fixture(scope="module")
def skewed():
    rng = np.random.default_rng(7)
    n = 3000
    key = np.where(rng.random(n) < 0.4, 0, rng.integers(1, 60, n))
    value = np.where(rng.random(n) < 0.35, 5.0, np.round(rng.lognormal(2, 1.5, n), 2))
    ts = pd.Timestamp("2024-01-01") + pd.to_timedelta(rng.integers(0, 20 * 86400, n), unit="s")
    return pd.DataFrame({"id": np.arange(n), "k": key, "v": value, "w": rng.integers(0, 4, n), "ts": ts})


@pytest.fixture(scope="module")
def sdf(spark, skewed):
    return spark.createDataFrame(skewed).repartition(5)


@pytest.fixture(params=[None, 7], ids=["one-bucket", "many-buckets"], autouse=True)
def buckets(request, monkeypatch):
    if request.param:
        monkeypatch.setattr(ordered, "BUCKET_VALUES", request.param)
        monkeypatch.setattr(ordered, "GROUP_ROWS", 20 * request.param)


def test_group_quantiles(sdf, skewed):
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 1.0]
    got = ordered.quantiles(sdf, ["v"], probs, ["k"]).toPandas().set_index("k").sort_index()
    want = skewed.groupby("k")["v"].quantile(probs).unstack()
    np.testing.assert_allclose(got[[f"q{i}" for i in range(6)]].to_numpy(), want.to_numpy(), rtol=1e-12)


def test_global_quantiles_of_two_columns(sdf, skewed):
    got = ordered.quantile_values(sdf, ["v", "w"], [0.05, 0.5, 0.95])
    for c in ("v", "w"):
        np.testing.assert_allclose(got[c], skewed[c].quantile([0.05, 0.5, 0.95]))


def test_ranks(sdf, skewed):
    got = ordered.ranks_of(sdf, "v", "r", "n").toPandas().sort_values("id")
    assert (got["r"].to_numpy() == skewed["v"].rank().to_numpy()).all()
    inside = ordered.rank_columns(sdf, ["v"], ["k"]).toPandas().sort_values("id")
    assert (inside["v_rank"].to_numpy() == skewed.groupby("k")["v"].rank().to_numpy()).all()


@pytest.mark.parametrize("descending", [False, True])
def test_positions_of_rows(sdf, skewed, descending):
    got = ordered.numbered(sdf, "v", "id", "pos", ["k"], descending=descending).toPandas().sort_values("id")
    want = skewed.sort_values(["v", "id"], ascending=[not descending, True]).groupby("k").cumcount() + 1
    assert (got["pos"].to_numpy() == want.sort_index().to_numpy()).all()
    assert (got["pos_of"].to_numpy() == skewed.groupby("k")["id"].transform("count").to_numpy()).all()


@pytest.mark.parametrize("descending", [False, True])
def test_rows_without_a_value_come_last(spark, descending):
    df = spark.createDataFrame([(1, 1, 5.0), (2, 1, None), (3, 1, 7.0), (4, None, None), (5, 1, None)], "id int, k int, v double")
    got = {r.id: (r.pos, r.pos_of) for r in ordered.numbered(df, "v", "id", "pos", ["k"], descending=descending).collect()}
    first, second = (3, 1) if descending else (1, 3)
    assert got == {first: (1, 4), second: (2, 4), 2: (3, 4), 5: (4, 4), 4: (1, 1)}


def test_previous_time(sdf, skewed):
    got = ordered.previous_time(sdf, "k", "ts", "id").toPandas().sort_values("id")["previous_ts"].reset_index(drop=True)
    s = skewed.sort_values(["k", "ts", "id"])
    want = s.groupby("k")["ts"].shift().sort_index()
    assert got.isna().equals(want.isna())
    assert (got.dropna().to_numpy() == want.dropna().to_numpy()).all()


def test_mode_takes_smallest_on_ties(spark):
    df = spark.createDataFrame([(1, 2.0, "b"), (1, 1.0, "a"), (1, 2.0, "b"), (1, 1.0, "a"), (2, 9.0, None)], "k int, v double, s string")
    rows = {r.k: r for r in ordered.modes(df, ["k"], ["v", "s"]).collect()}
    assert (rows[1].v, rows[1].s, rows[1].v_count) == (1.0, "a", 2)
    assert (rows[2].v, rows[2].s) == (9.0, None)


def test_positions_of_distinct_text(spark):
    words = sorted({f"w{i * 7919 % 1000:03d}" for i in range(400)})
    df = spark.createDataFrame([(w,) for w in words[::-1]], "s string").repartition(6)
    got = {r.s: r.code for r in ordered.positions(df, "s").collect()}
    assert got == {w: i for i, w in enumerate(words)}


def test_kendall_against_pairs(spark, skewed):
    part = skewed.head(400)
    x, y = part["v"].to_numpy(), part["w"].to_numpy()
    a, b = np.sign(x[:, None] - x[None, :]), np.sign(y[:, None] - y[None, :])
    tau = (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())
    got = profile.kendall(spark.createDataFrame(part[["v", "w"]]), ["v", "w"]).first().correlation
    assert got == pytest.approx(tau, abs=1e-12)


def test_rolling_correlation_against_pandas(sdf, skewed):
    p = skewed.drop_duplicates("ts").sort_values("ts").set_index("ts")
    want = p["v"].rolling("3D").corr(p["w"])
    src = sdf.dropDuplicates(["ts"]).select("ts").join(sdf.sparkSession.createDataFrame(p.reset_index()), "ts")
    got = windows.rolling_correlation(src, "v", "w", 3, "ts").toPandas().sort_values("ts_us")["correlation"].to_numpy()
    np.testing.assert_allclose(got[2:], want.to_numpy()[2:], atol=1e-8)


def test_rolling_window_is_left_open(spark):
    df = spark.createDataFrame([(0, 1.0), (7 * 86400, 2.0), (8 * 86400, 4.0)], "s bigint, x double")
    df = df.select(F.timestamp_seconds("s").alias("ts"), "x", (F.col("x") * 2).alias("y"))
    got = [r.rows for r in windows.rolling_correlation(df, "x", "y", 7, "ts").orderBy("ts_us").collect()]
    assert got == [1, 1, 2]


def test_edges_follow_distinct_values(spark, monkeypatch):
    """Nearly all rows share one value; the rest must still be spread over the buckets."""
    monkeypatch.setattr(ordered, "BUCKET_VALUES", 10)
    df = spark.range(20000).select(F.when(F.col("id") % 20 == 0, F.col("id")).otherwise(0).alias("v"))
    edges = ordered.splits(df, ["v"])["v"]
    counts = ordered.with_bucket(df.distinct(), ["v"], {"v": edges}).groupBy("v_bucket").count().toPandas()["count"]
    assert counts.max() < 0.2 * counts.sum()


def test_no_task_sees_all_values(sdf, monkeypatch):
    """Edges come from bounded samples; no aggregate sketches or sorts a whole column."""

    def refuse(*_, **__):
        raise AssertionError("a whole column in one aggregate")

    monkeypatch.setattr(F, "percentile_approx", refuse)
    monkeypatch.setattr(F, "approx_percentile", refuse)
    plans = []
    real = ordered.pick_quantiles
    monkeypatch.setattr(ordered, "pick_quantiles", lambda ranked, *a: plans.append(ranked) or real(ranked, *a))
    assert ordered.quantiles(sdf, ["v", "w"], [0.5, 0.9]).count() == 2
    text = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in text and "SinglePartition" not in text


def test_only_buckets_with_a_wanted_rank_are_sorted(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BUCKET_VALUES", 100)
    df = spark.range(40_000).select(((F.col("id") * 7919) % 40_000).cast("double").alias("v"))
    seen = []
    real = ordered.pick_quantiles
    monkeypatch.setattr(ordered, "pick_quantiles", lambda ranked, *a: seen.append(ranked) or real(ranked, *a))
    row = ordered.quantiles(df, ["v"], [0.25, 0.999]).first()
    assert (row.q0, row.q1, row.n) == (pytest.approx(9999.75), pytest.approx(39959.001), 40_000)
    assert seen[0].count() < 8_000


def test_rolling_correlation_keeps_its_digits_over_a_long_history(spark):
    """A million windows of large values before; then small ones around another level."""
    i = F.col("id")
    n = 2_000_000
    late = i >= n - 400
    noise = lambda k: F.pmod(F.xxhash64(i, F.lit(k)), F.lit(10**6)) / 1e6
    x = F.when(late, 1000 + noise(1)).otherwise(1e9 * noise(2))
    df = spark.range(0, n, 1, 4).select(F.timestamp_micros(i * F.lit(43_200_000_000 // 10) - F.lit(10**15)).alias("ts"), x.alias("x"), (x + F.when(late, noise(3)).otherwise(1e9 * noise(4))).alias("y"))
    got = windows.rolling_correlation(df, "x", "y", 1, "ts").orderBy(F.desc("ts_us")).limit(200).toPandas()[::-1]
    last = df.orderBy(F.desc("ts")).limit(400).toPandas()[::-1].reset_index(drop=True)
    want = last["x"].rolling(20).corr(last["y"]).to_numpy()[-200:]
    np.testing.assert_allclose(got["correlation"].to_numpy(), want, atol=1e-7)
    assert (got["rows"] == 20).all()
