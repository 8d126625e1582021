"""Hot keys change the layout of the work, not its result."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import behaviour, encoding, ordered, profile, relations, skew, windows


@pytest.fixture()
def watched(monkeypatch):
    """Treat small tables as large ones, so that the heavy-key paths run."""
    monkeypatch.setattr(skew, "HEAVY_ROWS", 150)
    monkeypatch.setattr(skew, "SAMPLE_SHARE", 1.0)
    monkeypatch.setattr(ordered, "BUCKET_VALUES", 20)


@pytest.fixture(scope="module")
def hot(spark):
    """A third of all rows belong to customer 0, a third of those to one moment; some have no key."""
    i = F.col("id")
    key = F.when(i % 3 == 0, 0).when(i % 50 == 1, F.lit(None)).otherwise(i % 40)
    second = F.when((i % 3 == 0) & (i % 9 == 0), 5000).otherwise((i * 7919) % 100000)
    return spark.range(3000).select(
        i.alias("TransactionId"),
        key.cast("bigint").alias("CustomerId"),
        F.timestamp_seconds(second).alias("TransactionStartTime"),
        (i % 17).cast("double").alias("Value"),
    ).repartition(6)


def same(a, b):
    cols = sorted(a.columns)
    read = lambda d: sorted(map(tuple, d.select(*cols).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))
    return read(a) == read(b)


def test_heavy_keys_are_found(hot, watched):
    found = {r.CustomerId for r in skew.heavy_keys(hot, ["CustomerId"])}
    assert 0 in found and len(found) <= 20


@pytest.mark.parametrize("how", ["left", "inner"])
def test_lookup(hot, watched, how):
    table = hot.groupBy("CustomerId").agg(F.sum("Value").alias("s"))
    assert same(skew.lookup(hot, table, ["CustomerId"], how), hot.join(table, ["CustomerId"], how))


def results(df):
    known = df.where("CustomerId is not null")
    return {
        "gaps": behaviour.gaps(known),
        "gap_stats": behaviour.gap_stats(known).select("CustomerId", F.round("gap_mean", 8).alias("m"), F.round("gap_std", 6).alias("s"), "gap_min", "gap_max"),
        "frequency": relations.add_frequencies(df, {"CustomerId": "n", "Value": "m"}),
        "rolling": windows.last_rolling(known, {"D": 1}),
        "ranks": ordered.ranks_of(df, "Value", "r"),
        "histogram": profile.histogram(known, "Value", 4, ["CustomerId"]),
        "labels": encoding.label_encode(df.withColumn("c", F.col("Value").cast("string")), encoding.fit_labels(df.select(F.col("Value").cast("string").alias("c")), "c"), "c"),
    }


def test_operators_agree_with_and_without_heavy_paths(hot, monkeypatch):
    plain = {k: v.toPandas() for k, v in results(hot).items()}
    monkeypatch.setattr(skew, "HEAVY_ROWS", 150)
    monkeypatch.setattr(skew, "SAMPLE_SHARE", 1.0)
    monkeypatch.setattr(ordered, "BUCKET_VALUES", 20)
    for name, df in results(hot).items():
        a = plain[name].sort_values(sorted(plain[name].columns), ignore_index=True)[sorted(plain[name].columns)]
        b = df.toPandas()
        b = b.sort_values(sorted(b.columns), ignore_index=True)[sorted(b.columns)]
        assert a.equals(b), name
