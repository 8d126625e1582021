"""Recency, frequency, monetary value and what is derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import scalars as X
from ledgerlens.session import cut

from . import ordered


def latest(df: DataFrame, ts: str = "TransactionStartTime") -> Column:
    """The table's last timestamp as a scalar subquery."""
    return df.select(F.max(ts)).scalar()


def rfm_table(
    df: DataFrame,
    *,
    key: str = "CustomerId",
    amount: str = "Amount",
    ts: str = "TransactionStartTime",
    snapshot: Column | None = None,
    snapshot_shift: str | None = None,
    spread: bool = False,
    absolute: bool = True,
) -> DataFrame:
    """One row per customer: days since the last transaction, count and absolute net amount
    (signed with ``absolute=False``).

    The snapshot defaults to the last timestamp; ``snapshot_shift`` (an interval such as ``1 day``)
    moves it. ``spread`` adds the mean and the sample deviation (0 for one transaction).
    """
    aggs = [
        F.max(ts).alias("last_ts"),
        F.count(F.lit(1)).alias("transaction_frequency"),
        F.sum(amount).alias("net_value"),
    ]
    if spread:
        aggs += [
            F.avg(amount).alias("avg_transaction_value"),
            F.coalesce(F.stddev(amount), F.lit(0.0)).alias("std_transaction_value"),
        ]
    at = snapshot if snapshot is not None else latest(df, ts)
    if snapshot_shift:
        at = at + F.expr(f"interval {snapshot_shift}")
    grouped = df.groupBy(key).agg(*aggs)
    return grouped.select(
        key,
        X.whole_days(at, F.col("last_ts")).alias("recency_days"),
        "transaction_frequency",
        (F.abs("net_value") if absolute else F.col("net_value")).alias("total_monetary_value"),
        *(["avg_transaction_value", "std_transaction_value"] if spread else []),
    )


def lifetime(df: DataFrame, key: str = "CustomerId", ts: str = "TransactionStartTime") -> DataFrame:
    """Days between first and last transaction and transactions per such day."""
    g = df.groupBy(key).agg(F.min(ts).alias("a"), F.max(ts).alias("b"), F.count(F.lit(1)).alias("transaction_frequency"))
    days = X.whole_days("b", "a")
    return g.select(
        key,
        days.alias("customer_lifetime_days"),
        "transaction_frequency",
        (F.col("transaction_frequency") / (days + 1)).alias("transaction_intensity"),
    )


def linear_score(r: Column | str, f: Column | str, m: Column | str) -> Column:
    """``-r + 2f + 3m``."""
    return -X.col(r) + 2 * X.col(f) + 3 * X.col(m)


# Band limits of the 1-5 scores (fixed values).
RECENCY_BANDS = [(30, 5), (60, 4), (90, 3), (180, 2)]
FREQUENCY_BANDS = [(2, 1), (5, 2), (10, 3), (20, 4)]
MONETARY_BANDS = [(500, 1), (1000, 2), (5000, 3), (10000, 4)]


def band_scores(df: DataFrame) -> DataFrame:
    """1-5 scores: few days, many transactions and much money score high."""
    return df.withColumns(
        {
            "recency_score": X.bands("recency_days", RECENCY_BANDS, 1),
            "frequency_score": X.bands("transaction_frequency", FREQUENCY_BANDS, 5, closed="left"),
            "monetary_score": X.bands("total_monetary_value", MONETARY_BANDS, 5, closed="left"),
        }
    )


# Optional inputs of a scoring table with what stands in when the caller leaves them out.
OPTIONAL_SCORING = [
    "std_transaction_value",
    "cluster",
    "customer_value",
    "value_concentration",
    "transaction_size_variability",
    "estimated_tenure_months",
    "monthly_activity",
]


def scoring_features(df: DataFrame) -> DataFrame:
    """Derived features of a scoring table; values already present in the input win."""
    given = {c: F.col(c).cast("double") if c in df.columns else F.lit(None).cast("double") for c in OPTIONAL_SCORING}
    f = F.col("transaction_frequency").cast("double")
    m = F.col("total_monetary_value").cast("double")
    per = F.when(f > 0, m / f).otherwise(0.0)
    tenure = F.coalesce(given["estimated_tenure_months"], F.greatest(F.lit(1.0), f / 5))
    scored = band_scores(df)
    engagement = (
        F.col("recency_score") * 0.4 + F.col("frequency_score") * 0.3 + F.col("monetary_score") * 0.3
    ) / 5.0
    return scored.withColumns(
        {
            "avg_transaction_value": per,
            "std_transaction_value": F.coalesce(given["std_transaction_value"], F.lit(0.0)),
            "cluster": F.coalesce(given["cluster"], F.lit(0.0)),
            "customer_value": F.coalesce(given["customer_value"], m * (f / 12) * 24),
            "engagement_index": engagement,
            "value_concentration": F.coalesce(given["value_concentration"], F.when(f <= 1, 1.0).otherwise(0.5)),
            "value_per_transaction": per,
            "transaction_size_variability": F.coalesce(given["transaction_size_variability"], F.lit(0.1)),
            "estimated_tenure_months": tenure,
            "monthly_activity": F.coalesce(given["monthly_activity"], f / F.greatest(F.lit(1.0), tenure)),
        }
    )


TRAINING_COLUMNS = [
    "recency_days",
    "transaction_frequency",
    "total_monetary_value",
    "recency_score",
    "frequency_score",
    "monetary_score",
    "customer_value",
    "engagement_index",
    "value_concentration",
    "value_per_transaction",
    "transaction_size_variability",
    "estimated_tenure_months",
    "monthly_activity",
]


def training_features(df: DataFrame, top: float | None = None) -> DataFrame:
    """Feature set the classifiers are trained on; undefined ratios become 0. ``top`` is the monetary value others are put in relation to (default: the largest)."""
    top = df.select(F.max("total_monetary_value")).scalar() if top is None else F.lit(top)
    r, f, m = (F.col(c).cast("double") for c in ("recency_days", "transaction_frequency", "total_monetary_value"))
    recency = 1 / (1 + r)
    frequency = F.log1p(f)
    per = m / (f + 1)
    tenure = F.sqrt(f) * 2
    made = {
        "recency_score": recency,
        "frequency_score": frequency,
        "monetary_score": F.log1p(m),
        "customer_value": m * frequency,
        "engagement_index": frequency * recency,
        "value_concentration": X.ratio(m, top),
        "value_per_transaction": per,
        "transaction_size_variability": X.ratio(m, per),
        "estimated_tenure_months": tenure,
        "monthly_activity": f / (tenure + 1),
    }
    return df.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in made.items()})


def quartile_tier(df: DataFrame, col: str, labels: list[str], out: str) -> DataFrame:
    """Quartile label of a column: number of inner quartiles strictly below the value."""
    edges = ordered.quantile_row(df, [col], [0.25, 0.5, 0.75]).select(
        F.array(*[F.col(f"{col}_q{i}") for i in range(3)])
    )
    e = edges.scalar()
    below = sum(((F.col(col) > e[i]).cast("int") for i in range(3)), F.lit(0))
    return df.withColumn(out, F.element_at(F.array(*[F.lit(x) for x in labels]), below + 1))


CLV_LABELS = ["Low", "Medium", "High", "Very High"]


def lifetime_value(df: DataFrame) -> DataFrame:
    """Historical and predicted customer lifetime value.

    Tenure counts 30.44-day months, at least one; churn is a logistic in recency around 90 days;
    the expected lifespan is three months over churn.
    """
    ts = "TransactionStartTime"
    g = df.groupBy("CustomerId").agg(
        F.max(ts).alias("last_ts"),
        F.min(ts).alias("first_ts"),
        F.count(F.lit(1)).alias("Frequency"),
        F.sum("Amount").alias("Historical_CLV"),
        F.avg("Amount").alias("avg_transaction_value"),
    )
    at = latest(df) + F.expr("interval 1 day")
    g = g.withColumns(
        {
            "Recency": X.whole_days(at, "last_ts"),
            "tenure_months": X.clip(X.whole_days("last_ts", "first_ts") / F.lit(30.44), lo=1.0),
        }
    )
    churn = X.logistic(F.lit(0.1) * (F.col("Recency") - 90))
    g = g.withColumns({"monthly_frequency": F.col("Frequency") / F.col("tenure_months"), "churn_probability": churn})
    g = g.withColumn("expected_lifespan_months", 1 / F.col("churn_probability") * 3)
    return g.withColumn(
        "Predicted_CLV", F.col("avg_transaction_value") * F.col("monthly_frequency") * F.col("expected_lifespan_months")
    ).drop("last_ts", "first_ts")


def lifetime_segments(df: DataFrame) -> DataFrame:
    return quartile_tier(cut(lifetime_value(df)), "Predicted_CLV", CLV_LABELS, "CLV_Segment")


def top_share(df: DataFrame, key: str, measure: str, share: float = 0.05) -> DataFrame:
    """Part of the measure held by the top ``share`` of rows, with its risk band."""
    pos = ordered.numbered(cut(df.select(key, measure)), measure, key, "pos", descending=True)
    top = F.col("pos") <= F.floor(F.lit(share) * F.col("pos_of"))
    ratio = X.ratio(F.sum(F.when(top, F.col(measure)).otherwise(0.0)), F.sum(measure)) * 100
    return pos.agg(
        F.count(F.lit(1)).alias("customers"),
        F.count_if(top).alias("top_customers"),
        ratio.alias("concentration_ratio"),
    ).withColumn(
        "risk",
        F.when(F.col("concentration_ratio") > 50, "HIGH").when(F.col("concentration_ratio") > 30, "MODERATE").otherwise("LOW"),
    )


def lorenz(df: DataFrame, key: str, measure: str) -> DataFrame:
    """Points of the concentration curve, largest value first, one per distinct value."""
    narrow = cut(df.select(measure))
    cutdf = ordered.with_bucket(narrow, [measure], ordered.splits(narrow, [measure]))
    desc = cutdf.withColumns({"neg": -F.col(measure), "nb": -F.col(f"{measure}_bucket")})
    t = ordered.running_totals(desc, [], "neg", "nb", {"n": F.count(F.lit(1)), "v": F.sum(measure)})
    return t.select(
        (-F.col("neg")).alias("value"),
        X.ratio(F.col("n_before") + F.col("n"), "n_total").alias("customer_share"),
        X.ratio(F.col("v_before") + F.col("v"), "v_total").alias("value_share"),
    )
