"""Behaviour patterns of a customer and the risk score built from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X

from . import ordered, relations, rfm


def gaps(df: DataFrame, *, unit_seconds: float = 3600.0) -> DataFrame:
    """Transactions with the time since the customer's previous one."""
    prev = ordered.previous_time(
        df.select("CustomerId", "TransactionId", "TransactionStartTime"), "CustomerId", "TransactionStartTime", "TransactionId"
    )
    micros = F.unix_micros("TransactionStartTime") - F.unix_micros("previous_ts")
    return prev.withColumn("gap", micros / F.lit(unit_seconds * 1e6))


def gap_stats(df: DataFrame, *, unit_seconds: float = 3600.0, prefix: str = "gap") -> DataFrame:
    return (
        gaps(df, unit_seconds=unit_seconds)
        .groupBy("CustomerId")
        .agg(
            F.avg("gap").alias(f"{prefix}_mean"),
            F.stddev("gap").alias(f"{prefix}_std"),
            F.min("gap").alias(f"{prefix}_min"),
            F.max("gap").alias(f"{prefix}_max"),
        )
    )


def flags(df: DataFrame) -> DataFrame:
    """High velocity, irregular intervals and variable amounts per customer."""
    intervals = gap_stats(df, unit_seconds=86400.0, prefix="interval")
    at = rfm.latest(df) + F.expr("interval 1 day")
    base = df.groupBy("CustomerId").agg(
        F.max("TransactionStartTime").alias("last_ts"),
        F.count(F.lit(1)).alias("transaction_count"),
        F.avg("Amount").alias("amount_mean"),
        F.stddev("Amount").alias("amount_std"),
    )
    n = F.col("transaction_count")
    out = base.join(intervals, "CustomerId", "left").withColumns(
        {
            "daily_transactions": X.ratio(n, X.whole_days(at, "last_ts")),
            "interval_cv": X.ratio("interval_std", "interval_mean"),
            "amount_cv": X.ratio("amount_std", "amount_mean"),
        }
    )
    hit = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    return out.withColumns(
        {
            "high_velocity": hit(F.col("daily_transactions") > 5),
            "irregular_pattern": hit((F.col("interval_cv") > 1.5) & (n > 5)),
            "high_variability": hit((F.col("amount_cv") > 2) & (n > 3)),
        }
    )


def spending_spike(df: DataFrame, days: int = 30, limit: float = 200.0) -> DataFrame:
    """Spending of the last ``days`` against the ``days`` before, in percent."""
    window = relations.recent(df, 2 * days)
    recent = F.col("TransactionStartTime") > rfm.latest(window) - F.expr(f"interval {days} days")
    zero = F.lit(0.0)
    g = window.groupBy("CustomerId").agg(
        F.coalesce(F.sum(F.when(~recent, F.col("Amount"))), zero).alias("previous"),
        F.coalesce(F.sum(F.when(recent, F.col("Amount"))), zero).alias("recent"),
    )
    change = (F.col("recent") - F.col("previous")) / X.divisor_or_one("previous") * 100
    return g.withColumn("spending_change_pct", change).withColumn("spending_spike", (change > limit).cast("int"))


RISK_EDGES = [0, 25, 50, 75, 100]
RISK_LEVELS = ["Low", "Medium", "High", "Very High"]


def score(df: DataFrame) -> DataFrame:
    """25 points each for three flags and for a high lifetime-value segment; no points, no level."""
    segments = rfm.lifetime_segments(df).select("CustomerId", "Historical_CLV", "Predicted_CLV", "CLV_Segment")
    valued = F.col("CLV_Segment").isin("High", "Very High").cast("int")
    points = 25 * (F.col("high_velocity") + F.col("irregular_pattern") + F.col("high_variability") + valued)
    joined = flags(df).join(segments, "CustomerId").withColumn("risk_score", points)
    return joined.withColumn("risk_level", X.cut_left_open("risk_score", RISK_EDGES, RISK_LEVELS))
