"""Feature flows: ordered fit/transform steps switched by a nested configuration."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import MinMaxScaler, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import cleaning, customer, stages
from ledgerlens.session import cut

def full_flow(df: DataFrame, config: dict | None = None, target: DataFrame | None = None) -> DataFrame:
    """Transactions to model-ready customer features: build, encode, impute, cap, scale, weigh.

    The steps after the first are ``stages.FeatureFlow``, whose switches ``config`` holds under ``processing``; the weight of evidence
    runs if it is switched on and then needs a target.
    """
    given = (config or {}).get("processing", {})
    key, table, label = customer.KEY, cut(customer.feature_frame(df)), None
    if given.get("woe", {}).get("enabled"):
        if target is None:
            raise ValueError("weight of evidence needs a target")
        label = next(c for c in target.columns if c != key)
        table = cut(table.join(target, key))
    else:
        given = given | {"woe": {"enabled": False}}
    flow = stages.FeatureFlow(key, label or "", given)
    out = flow.fit(table).transform(table)
    return out.drop(label) if label else out


def simple_flow(df: DataFrame) -> DataFrame:
    """Aggregates, time means and favourites per customer: median-filled, encoded and standardised."""
    key = customer.KEY
    table = cut(customer.value_features(df).join(customer.time_means(df), key).join(customer.favourites(df), key))
    flow = stages.FeatureFlow(key, "", {"imputation": {"flags": False}, "outliers": {"enabled": False}, "woe": {"enabled": False}})
    return flow.fit(table).transform(table)


def preprocessor(df: DataFrame, numbers: list[str], words: list[str], key: str) -> DataFrame:
    """Median + standard scale for numbers, 'missing' + one-hot for words, then everything to [0, 1]."""
    fills = cleaning.fit_imputer(df, [*numbers, *words], text="constant")
    filled = cleaning.impute(df, fills).withColumns({c: F.col(c).cast("double") for c in numbers})
    steps = [
        VectorAssembler(inputCols=numbers, outputCol="raw"),
        StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
        StringIndexer(inputCols=words, outputCols=[f"{w}_index" for w in words], stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCols=[f"{w}_index" for w in words], outputCols=[f"{w}_hot" for w in words], dropLast=True),
        VectorAssembler(inputCols=["scaled", *[f"{w}_hot" for w in words]], outputCol="joined"),
        MinMaxScaler(inputCol="joined", outputCol="features"),
    ]
    out = Pipeline(stages=steps).fit(filled).transform(filled)
    v = vector_to_array("features")
    return out.select(key, v.alias("features"), F.array_min(v).alias("low"), F.array_max(v).alias("high"), F.size(v).alias("width"))
