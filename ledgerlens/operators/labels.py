"""Proxy risk labels and their checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.functions import scalars as X
from ledgerlens.session import cut

from . import ordered

RFM = ["recency_days", "transaction_frequency", "total_monetary_value"]
SCORE_WEIGHTS = {"recency_days": 0.5, "transaction_frequency": -0.3, "total_monetary_value": -0.2}


def standard_params(df: DataFrame, cols: list[str]) -> Column:
    """Mean and population deviation of each column as one struct-valued scalar subquery."""
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    one = df.agg(*aggs)
    return one.select(F.struct(*one.columns)).scalar()


def weighted_score(df: DataFrame, weights: dict[str, float] = SCORE_WEIGHTS) -> DataFrame:
    p = standard_params(df, list(weights))
    terms = [
        F.lit(w) * (F.col(c) - p[f"{c}_mean"]) / X.divisor_or_one(p[f"{c}_std"]) for c, w in weights.items()
    ]
    return df.withColumn("score", sum(terms[1:], terms[0]))


def threshold_label(df: DataFrame, share: float = 0.1, weights: dict[str, float] = SCORE_WEIGHTS) -> DataFrame:
    """1 for customers whose weighted z-score reaches the ``1 - share`` quantile."""
    scored = weighted_score(cut(df), weights)
    limit = ordered.quantile_row(scored, ["score"], [1 - share]).select("score_q0").scalar()
    return scored.withColumn("is_high_risk", (F.col("score") >= limit).cast("int"))


def cluster_profile(df: DataFrame) -> DataFrame:
    """Size, share, mean and deviation of R, F, M and total value per cluster."""
    total = df.select(F.count(F.lit(1))).scalar()
    aggs = [F.count(F.lit(1)).alias("customers"), F.sum("total_monetary_value").alias("total_value")]
    for c in RFM:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev(c).alias(f"{c}_std")]
    return df.groupBy("cluster").agg(*aggs).withColumn("pct", X.ratio("customers", total) * 100)


EQUAL_WEIGHTS = (1 / 3, 1 / 3, 1 / 3)
BUSINESS_WEIGHTS = (0.5, 0.3, 0.2)


def cluster_risk(df: DataFrame, weights: tuple[float, float, float] = EQUAL_WEIGHTS) -> DataFrame:
    """Risk score per cluster from its mean R, F, M over the table's maxima; the top one is flagged."""
    tops = df.agg(*[F.max(c).alias(c) for c in RFM])
    top = tops.select(F.struct(*RFM)).scalar()
    g = df.groupBy("cluster").agg(F.count(F.lit(1)).alias("customers"), *[F.avg(c).alias(c) for c in RFM])
    r, f, m = (X.ratio(c, top[c]) for c in RFM)
    scored = g.withColumn("risk_score", weights[0] * r + weights[1] * (1 - f) + weights[2] * (1 - m))
    best = riskiest(scored)
    return scored.withColumn("is_high_risk", (F.col("cluster") == best).cast("int"))


def riskiest(scored: DataFrame) -> Column:
    """Cluster with the highest score, the smallest id on ties."""
    key = F.struct("risk_score", (-F.col("cluster")).alias("neg"))
    return scored.select(F.max(key).alias("m")).select(-F.col("m.neg")).scalar()


def cluster_risk_by_rank(df: DataFrame, *, riskiest_last: bool = True) -> DataFrame:
    """Rank sum over the few cluster means.

    By default a high sum means risky (long recency, few and small transactions); with
    ``riskiest_last=False`` each rank runs the other way.
    """
    g = df.groupBy("cluster").agg(*[F.avg(c).alias(c) for c in RFM])
    up, down = (F.asc, F.desc) if riskiest_last else (F.desc, F.asc)
    # one row per cluster: the frame is as small as the number of clusters
    few = W.partitionBy(F.lit(0))

    def rank(c: str, order) -> Column:
        same = F.count(F.lit(1)).over(W.partitionBy(c))
        return F.rank().over(few.orderBy(order(c))) + (same - 1) / 2.0

    total = (
        rank("recency_days", up) + rank("transaction_frequency", down) + rank("total_monetary_value", down)
    )
    scored = g.withColumn("risk_score", total)
    return scored.withColumn("is_high_risk", (F.col("cluster") == riskiest(scored)).cast("int"))


def cluster_label(df: DataFrame, weights: tuple[float, float, float] = EQUAL_WEIGHTS) -> DataFrame:
    """1 for customers of the riskiest cluster."""
    best = riskiest(cluster_risk(df, weights))
    return df.withColumn("is_high_risk", (F.col("cluster") == best).cast("int"))


def label_distribution(df: DataFrame, label: str = "is_high_risk") -> DataFrame:
    total = df.select(F.count(F.lit(1))).scalar()
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("customers")).withColumn("pct", X.ratio("customers", total) * 100)


def rank_label(df: DataFrame, total: str, spread: str) -> DataFrame:
    """1 when the total is in the low 30 % and the spread in the high 30 % of percentile ranks."""
    ranked = ordered.ranks_of(cut(df), total, "rank_total", "n_total")
    ranked = ordered.ranks_of(ranked, spread, "rank_spread", "n_spread")
    a = X.ratio("rank_total", "n_total")
    b = X.ratio("rank_spread", "n_spread")
    score = F.when(a < 0.3, 0.5).otherwise(0.0) + F.when(b > 0.7, 0.5).otherwise(0.0)
    return ranked.withColumns({"pct_total": a, "pct_spread": b, "target": (score > 0.5).cast("int")})


def with_fraud(df: DataFrame, transactions: DataFrame) -> DataFrame:
    """Attach whether a customer ever had a fraudulent transaction (0 when unmatched)."""
    fraud = transactions.groupBy("CustomerId").agg(F.max("FraudResult").alias("had_fraud"))
    return df.join(fraud, "CustomerId", "left").withColumn("had_fraud", F.coalesce("had_fraud", F.lit(0)))


def validate(df: DataFrame, transactions: DataFrame) -> DataFrame:
    """Fraud rate and R, F, M ratios of the risky over the safe label, with a plausibility flag."""
    joined = with_fraud(df, transactions)
    high = lambda c: F.avg(F.when(F.col("is_high_risk") == 1, F.col(c)))
    low = lambda c: F.avg(F.when(F.col("is_high_risk") == 0, F.col(c)))
    out = joined.agg(
        low("had_fraud").alias("fraud_rate_low_risk"),
        high("had_fraud").alias("fraud_rate_high_risk"),
        X.ratio(high("had_fraud"), low("had_fraud")).alias("fraud_risk_ratio"),
        *[X.ratio(high(c), low(c)).alias(f"{c}_ratio") for c in RFM],
    )
    return out.withColumn(
        "makes_business_sense",
        (F.col("recency_days_ratio") > 1)
        & (F.col("transaction_frequency_ratio") < 1)
        & (F.col("total_monetary_value_ratio") < 1),
    )


def relative_risk(df: DataFrame, transactions: DataFrame) -> DataFrame:
    """Fraud customers per label, their rate and its multiple of the lowest rate."""
    g = (
        with_fraud(df, transactions)
        .groupBy("is_high_risk")
        .agg(F.sum("had_fraud").alias("frauds"), F.count(F.lit(1)).alias("customers"), (F.avg("had_fraud") * 100).alias("fraud_rate"))
    )
    return g.withColumn("relative_risk", X.ratio("fraud_rate", g.select(F.min("fraud_rate")).scalar()))


def default_rate_check(df: DataFrame, lo: float = 0.02, hi: float = 0.05) -> DataFrame:
    rate = F.avg(F.col("is_high_risk").cast("double"))
    return df.agg(F.count(F.lit(1)).alias("customers"), F.sum("is_high_risk").alias("high_risk"), rate.alias("rate")).withColumn(
        "within_range", F.col("rate").between(lo, hi)
    )


def label_summary(df: DataFrame) -> DataFrame:
    """One-row record of the labelling step."""
    high = F.col("is_high_risk") == 1
    return df.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count_if(high).alias("high_risk_customers"),
        (F.avg(F.col("is_high_risk").cast("double")) * 100).alias("high_risk_rate"),
        *[F.avg(F.when(high, F.col(c))).alias(f"high_risk_{c}_avg") for c in RFM],
    ).withColumns(
        {
            "within_range": F.col("high_risk_rate").between(2, 5),
            "features": F.lit(",".join(sorted(df.columns))),
        }
    )


def compare_labels(df: DataFrame) -> DataFrame:
    """Mean R, F, M by label, scaled by the larger mean, with each label's ratio to the safe one."""
    g = df.groupBy("is_high_risk").agg(*[F.avg(c).alias(c) for c in RFM])
    one = g.agg(
        *[F.max(c).alias(f"{c}_max") for c in RFM],
        *[F.max(F.when(F.col("is_high_risk") == 0, F.col(c))).alias(f"{c}_low") for c in RFM],
    )
    p = one.select(F.struct(*one.columns)).scalar()
    return g.withColumns(
        {f"{c}_norm": X.ratio(c, p[f"{c}_max"]) for c in RFM} | {f"{c}_vs_low": X.ratio(c, p[f"{c}_low"]) for c in RFM}
    )
