"""Spark side of the shared input views named in ``views.py``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.operators import labels, rfm as rfm_ops
from ledgerlens.sources import tables


def ev(spark: SparkSession, sf: str) -> DataFrame:
    return tables.event_transactions(spark, sf)


def od(spark: SparkSession, sf: str) -> DataFrame:
    return tables.order_facts(spark, sf)


def odc(spark: SparkSession, sf: str) -> DataFrame:
    return tables.order_transactions(spark, sf)


def evn(spark: SparkSession, sf: str) -> DataFrame:
    return tables.with_gaps(ev(spark, sf))


def odn(spark: SparkSession, sf: str) -> DataFrame:
    return tables.with_gaps(od(spark, sf))


def rfm(spark: SparkSession, sf: str) -> DataFrame:
    return rfm_ops.rfm_table(od(spark, sf), amount="Amount", spread=True)


def lab(spark: SparkSession, sf: str) -> DataFrame:
    labelled = labels.threshold_label(rfm(spark, sf))
    cluster = (
        F.when(F.col("recency_days") > 500, 0).when(F.col("transaction_frequency") >= 10, 1).otherwise(2)
    )
    return labelled.drop("score").withColumn("cluster", cluster)


def preds(spark: SparkSession, sf: str) -> DataFrame:
    bucket = X.portable_bucket("CustomerId") % 100
    models = F.array(
        F.struct(F.lit("by_recency").alias("model"), X.logistic((F.col("recency_days") - 700) / 150.0).alias("risk_score")),
        F.struct(F.lit("by_frequency").alias("model"), X.logistic((5 - F.col("transaction_frequency")) / 2.0).alias("risk_score")),
        F.struct(F.lit("by_value").alias("model"), X.logistic((600000 - F.col("total_monetary_value")) / 300000.0).alias("risk_score")),
    )
    return lab(spark, sf).select(
        F.when(bucket < 70, "train").when(bucket < 85, "val").otherwise("test").alias("split"),
        "CustomerId",
        "is_high_risk",
        F.inline(models),
    )
