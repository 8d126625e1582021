"""Declared schemas and the transaction views bound to the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column roles of a raw transaction table (fixed names of the data model).
ID_COLUMNS = ["TransactionId", "BatchId", "AccountId", "SubscriptionId", "CustomerId"]
CATEGORY_COLUMNS = [
    "CurrencyCode",
    "CountryCode",
    "ProviderId",
    "ProductId",
    "ProductCategory",
    "ChannelId",
    "PricingStrategy",
]
AMOUNT_COLUMNS = ["Amount", "Value"]

TRANSACTION_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ID_COLUMNS + CATEGORY_COLUMNS[:-1]]
    + [
        T.StructField("Amount", T.DoubleType()),
        T.StructField("Value", T.DoubleType()),
        T.StructField("TransactionStartTime", T.TimestampType()),
        T.StructField("PricingStrategy", T.IntegerType()),
        T.StructField("FraudResult", T.IntegerType()),
    ]
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with microsecond times, bound to ``events``."""
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("TransactionId"),
        F.col("user_id").alias("CustomerId"),
        F.col("ts").cast("timestamp").alias("TransactionStartTime"),
        F.col("value").alias("Value"),
        F.when(F.col("event_type") == "error", -F.col("value")).otherwise(F.col("value")).alias("Amount"),
        F.col("event_type").alias("ProductCategory"),
        F.concat(F.lit("C"), (F.col("event_id") % 4).cast("string")).alias("ChannelId"),
        F.concat(F.lit("P"), (F.col("user_id") % 6).cast("string")).alias("ProviderId"),
        F.lit("USD").alias("CurrencyCode"),
        (F.get_json_object("props", "$.k").cast("int") % 5).alias("PricingStrategy"),
        ((F.col("event_type") == "error") & (F.col("value") > 200)).cast("int").alias("FraudResult"),
    )


def order_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions over several years, bound to ``orders``, ``customer`` and ``nation``."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    who = c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        "c_custkey", F.col("c_mktsegment").alias("ProviderId"), F.col("n_name").alias("CountryCode")
    )
    facts = _order_facts(o)
    return facts.join(who, facts.CustomerId == who.c_custkey, "left").drop("c_custkey")


def _order_facts(o: DataFrame) -> DataFrame:
    return o.select(
        F.col("o_orderkey").alias("TransactionId"),
        F.col("o_custkey").alias("CustomerId"),
        F.col("o_orderdate").cast("timestamp").alias("TransactionStartTime"),
        F.col("o_totalprice").alias("Value"),
        F.when(F.col("o_orderstatus") == "P", -F.col("o_totalprice"))
        .otherwise(F.col("o_totalprice"))
        .alias("Amount"),
        F.col("o_orderpriority").alias("ProductCategory"),
        F.col("o_orderstatus").alias("ChannelId"),
        (F.col("o_orderkey") % 5).cast("int").alias("PricingStrategy"),
        ((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_totalprice") >= 450000))
        .cast("int")
        .alias("FraudResult"),
    )


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order transactions without the customer attributes (no join)."""
    return _order_facts(table(spark, sf_dir, "orders"))


def with_gaps(df: DataFrame) -> DataFrame:
    """Rule-made NULLs for the data-quality operators."""
    return df.withColumns(
        {
            "Value": F.when(F.col("TransactionId") % 13 != 0, F.col("Value")),
            "ProductCategory": F.when(F.col("TransactionId") % 17 != 0, F.col("ProductCategory")),
        }
    )
