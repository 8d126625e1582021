"""One row per customer: aggregates, time patterns and features built on them.

Simple aggregates of one table share a single ``groupBy`` (partial sums before the shuffle, so a
hot customer costs no more than any other). Quantiles, modes and time gaps go through the bounded
helpers of ``ordered``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlens.functions import scalars as X
from ledgerlens.session import cut

from . import behaviour, ordered, rfm

KEY = "CustomerId"
TS = "TransactionStartTime"


def required(df: DataFrame) -> DataFrame:
    """Total, mean, count and sample deviation of the transaction value (0 for one row)."""
    return df.groupBy(KEY).agg(
        F.sum("Value").alias("total_transaction_amount"),
        F.avg("Value").alias("avg_transaction_amount"),
        F.count("TransactionId").alias("transaction_count"),
        F.coalesce(F.stddev("Value"), F.lit(0.0)).alias("std_transaction_amount"),
    )


def spread(df: DataFrame, value: str = "Value") -> DataFrame:
    """Median, quartiles, 90th percentile, extremes, range and interquartile range."""
    q = ordered.wide_quantiles(
        df,
        value,
        [0.25, 0.5, 0.75, 0.9],
        ["p25_transaction_amount", "median_transaction_amount", "p75_transaction_amount", "p90_transaction_amount"],
        [KEY],
    )
    edge = df.groupBy(KEY).agg(F.min(value).alias("min_transaction_amount"), F.max(value).alias("max_transaction_amount"))
    return edge.join(q, KEY, "left").withColumns(
        {
            "range_transaction_amount": F.col("max_transaction_amount") - F.col("min_transaction_amount"),
            "iqr_transaction_amount": F.col("p75_transaction_amount") - F.col("p25_transaction_amount"),
        }
    )


def shape(df: DataFrame, value: str = "Value") -> DataFrame:
    return df.groupBy(KEY).agg(
        X.adjusted_skew(value).alias("skew_transaction_amount"),
        X.adjusted_kurtosis(value).alias("kurtosis_transaction_amount"),
    )


def mode_amount(df: DataFrame, value: str = "Value") -> DataFrame:
    return ordered.modes(df, [KEY], [value]).select(KEY, F.col(value).alias("mode_transaction_amount"))


def sign_counts(df: DataFrame, value: str = "Value") -> DataFrame:
    v = F.col(value)
    return df.groupBy(KEY).agg(
        F.count_if(v == 0).alias("zero_transaction_count"),
        F.count_if(v < 0).alias("negative_transaction_count"),
        F.count_if(v > 0).alias("positive_transaction_count"),
    )


def fill_with_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """Replace NULL by the column's median over all rows; the table is written once, read twice."""
    df = cut(df)
    holes = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    open_cols = [c for c in cols if holes[c]]
    if not open_cols:
        return df
    med = ordered.quantile_row(df, open_cols, [0.5])
    m = med.select(F.struct(*[f"{c}_q0" for c in open_cols])).scalar()
    return df.withColumns({c: F.coalesce(F.col(c), m[f"{c}_q0"]) for c in open_cols})


def extended(df: DataFrame, value: str = "Value") -> DataFrame:
    """Spread, shape, mode and sign counts with NULLs filled: counts by 0, the rest by the median."""
    parts = spread(df, value).join(shape(df, value), KEY, "left").join(mode_amount(df, value), KEY, "left")
    counts = sign_counts(df, value)
    count_cols = [c for c in counts.columns if c != KEY]
    other = [c for c in parts.columns if c != KEY]
    joined = parts.join(counts, KEY, "left").fillna(0, count_cols)
    return fill_with_medians(joined, other)


def trailing_windows(df: DataFrame, days=(7, 30, 90)) -> DataFrame:
    """Sum, count and mean over the last days of the table plus each window's share of the lifetime total."""
    mx = rfm.latest(df)
    ts, v = F.col(TS), F.col("Value")
    aggs: list[Column] = [F.sum("Value").alias("lifetime")]
    for d in days:
        recent = ts > mx - F.expr(f"interval {d} days")
        aggs += [
            F.coalesce(F.sum(F.when(recent, v)), F.lit(0.0)).alias(f"total_amount_{d}d"),
            F.count(F.when(recent, F.col("TransactionId"))).alias(f"transaction_count_{d}d"),
            F.coalesce(F.avg(F.when(recent, v)), F.lit(0.0)).alias(f"avg_amount_{d}d"),
        ]
    g = df.groupBy(KEY).agg(*aggs)
    return g.withColumns({f"growth_rate_{d}d": X.ratio_or_zero(f"total_amount_{d}d", "lifetime") for d in days}).drop("lifetime")


def value_features(df: DataFrame) -> DataFrame:
    """Value statistics and ratios; the deviation of a single transaction stays NULL."""
    med = ordered.wide_quantiles(df, "Value", [0.5], ["median_transaction_amount"], [KEY])
    g = df.groupBy(KEY).agg(
        F.sum("Value").alias("total_transaction_amount"),
        F.avg("Value").alias("avg_transaction_amount"),
        F.count("TransactionId").alias("transaction_count"),
        F.stddev("Value").alias("std_transaction_amount"),
        F.min("Value").alias("min_transaction_amount"),
        F.max("Value").alias("max_transaction_amount"),
    )
    return g.join(med, KEY, "left").withColumns(
        {
            "transaction_range": F.col("max_transaction_amount") - F.col("min_transaction_amount"),
            "value_ratio_max_avg": X.ratio("max_transaction_amount", "avg_transaction_amount"),
            "value_ratio_std_avg": X.ratio("std_transaction_amount", "avg_transaction_amount"),
        }
    )


def diversity(df: DataFrame, cols=("ProductCategory", "ChannelId", "ProviderId", "CurrencyCode")) -> DataFrame:
    """Number of distinct values per customer and column."""
    names = {"ProductCategory": "product_category_count", "ChannelId": "channel_count", "ProviderId": "provider_count", "CurrencyCode": "currency_count"}
    return df.groupBy(KEY).agg(*[F.countDistinct(c).alias(names.get(c, f"{c}_count")) for c in cols if c in df.columns])


def favourites(df: DataFrame) -> DataFrame:
    """Most used category and channel, ``Unknown`` where a customer has none."""
    m = ordered.modes(df, [KEY], ["ProductCategory", "ChannelId"])
    everyone = df.select(KEY).distinct()
    return everyone.join(m, KEY, "left").select(
        KEY,
        F.coalesce("ProductCategory", F.lit("Unknown")).alias("favorite_product_category"),
        F.coalesce("ChannelId", F.lit("Unknown")).alias("favorite_channel"),
    )


def activity(df: DataFrame) -> DataFrame:
    """Transactions and money per active day, days since the last transaction."""
    mx = rfm.latest(df)
    g = df.groupBy(KEY).agg(
        F.sum("Value").alias("total"),
        F.count("TransactionId").alias("n"),
        F.countDistinct(F.to_date(TS)).alias("active_days"),
        F.max(TS).alias("last_ts"),
    )
    return g.select(
        KEY,
        X.ratio("n", "active_days").alias("transactions_per_active_day"),
        X.ratio("total", "active_days").alias("amount_per_active_day"),
        X.whole_days(mx, "last_ts").alias("days_since_last_transaction"),
    )


def time_parts(df: DataFrame, ts: str = TS) -> DataFrame:
    """Row-aligned calendar columns."""
    h = F.hour(ts)
    return df.withColumns(
        {
            "transaction_hour": h,
            "transaction_day": F.dayofmonth(ts),
            "transaction_month": F.month(ts),
            "transaction_year": F.year(ts),
            "transaction_day_of_week": F.weekday(ts),
            "transaction_day_of_year": F.dayofyear(ts),
            "transaction_week_of_year": F.weekofyear(ts),
            "transaction_quarter": F.quarter(ts),
            "is_weekend": X.weekend(ts),
            "is_holiday": X.weekend(ts),
            "time_of_day": X.time_of_day(h),
            "season": X.season(F.month(ts)),
            "is_business_hours": X.business_hours(ts),
        }
    )


def time_means(df: DataFrame) -> DataFrame:
    cols = ["transaction_hour", "transaction_day_of_week", "is_weekend", "is_business_hours"]
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}_mean"), F.stddev(c).alias(f"{c}_std")]
    return time_parts(df).groupBy(KEY).agg(*aggs)


def time_ratios(df: DataFrame) -> DataFrame:
    return df.groupBy(KEY).agg(
        F.avg(X.weekend(TS)).alias("weekend_transaction_ratio"),
        F.avg(X.business_hours(TS)).alias("business_hours_ratio"),
    )


PATTERN_COLUMNS = ["transaction_hour", "transaction_day_of_week", "time_of_day", "is_weekend", "is_business_hours"]


def time_modes(df: DataFrame) -> DataFrame:
    m = ordered.modes(time_parts(df.select(KEY, TS)), [KEY], PATTERN_COLUMNS)
    return m.select(
        KEY,
        *[F.col(c).alias(f"{c}_mode") for c in PATTERN_COLUMNS],
        F.col("transaction_hour").alias("favorite_hour"),
        F.col("transaction_day_of_week").alias("favorite_day_of_week"),
    )


def time_consistency(df: DataFrame) -> DataFrame:
    """One minus normalised entropy of each time pattern; 1 when only one value occurs."""
    cells = F.array(
        *[F.struct(F.lit(c).alias("pattern"), F.col(c).cast("string").alias("v")) for c in PATTERN_COLUMNS]
    )
    counts = time_parts(df.select(KEY, TS)).select(KEY, F.inline(cells)).groupBy(KEY, "pattern", "v").agg(F.count(F.lit(1)).alias("c"))
    # at most 24 rows per customer and pattern here
    share = F.col("c") / F.sum("c").over(W.partitionBy(KEY, "pattern"))
    h = counts.withColumn("p", share).groupBy(KEY, "pattern").agg(
        (-F.sum(F.col("p") * F.log(F.col("p") + F.lit(1e-10)))).alias("h"), F.count(F.lit(1)).alias("k")
    )
    score = F.when(F.col("k") == 1, 1.0).otherwise(1 - F.try_divide(F.col("h"), F.log(F.col("k").cast("double"))))
    scored = h.withColumn("s", score)
    return scored.groupBy(KEY).agg(
        *[F.max(F.when(F.col("pattern") == c, F.col("s"))).alias(f"{c}_consistency") for c in PATTERN_COLUMNS]
    )


def time_patterns(df: DataFrame) -> DataFrame:
    """Modes, consistency, ratios and gaps together, numeric NULLs filled by the column median."""
    joined = (
        time_modes(df)
        .join(time_consistency(df), KEY)
        .join(time_ratios(df), KEY)
        .join(behaviour.gap_stats(df, prefix="time_between_transactions"), KEY)
    )
    gap_cols = [c for c in joined.columns if c.startswith("time_between_transactions")]
    return fill_with_medians(joined, gap_cols)


def interactions(df: DataFrame) -> DataFrame:
    """Ratios and signed logs over the aggregate table; undefined ones become 0."""
    made = {
        "avg_amount_per_transaction": X.ratio("total_transaction_amount", "transaction_count"),
        "cv_transaction_amount": X.ratio("std_transaction_amount", "avg_transaction_amount"),
        "range_to_avg_ratio": X.ratio(
            F.col("max_transaction_amount") - F.col("min_transaction_amount"), "avg_transaction_amount"
        ),
        "log_total_transaction_amount": X.signed_log("total_transaction_amount"),
        "log_avg_transaction_amount": X.signed_log("avg_transaction_amount"),
        "log_max_transaction_amount": X.signed_log("max_transaction_amount"),
    }
    return df.withColumns({k: F.coalesce(v, F.lit(0.0)) for k, v in made.items()})


def declared_features(df: DataFrame) -> DataFrame:
    """Behaviour and money features of the feature configuration, in one pass."""
    mx = rfm.latest(df)
    ts, v = F.col(TS), F.col("Value")
    g = df.groupBy(KEY).agg(
        F.max(TS).alias("last_ts"),
        F.count_if(ts > mx - F.expr("interval 30 days")).alias("frequency_30d"),
        F.coalesce(F.sum(F.when(ts > mx - F.expr("interval 90 days"), v)), F.lit(0.0)).alias("monetary_90d"),
        F.count(F.lit(1)).alias("n"),
        F.countDistinct(F.to_date(TS)).alias("days"),
        F.avg("Value").alias("amount_to_frequency_ratio"),
        F.stddev("Value").alias("sd"),
        F.avg(X.weekend(TS)).alias("weekend_ratio"),
    )
    return g.select(
        KEY,
        X.whole_days(mx, "last_ts").alias("recency_days"),
        "frequency_30d",
        "monetary_90d",
        X.ratio("n", "days").alias("transaction_velocity"),
        "amount_to_frequency_ratio",
        (1 - X.ratio("sd", "amount_to_frequency_ratio")).alias("transaction_consistency_score"),
        "weekend_ratio",
    )


def feature_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Type, distinct, null count and null share per feature column."""
    types = dict(df.dtypes)
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.lit(types[c]).alias("dtype"), F.col(c).cast("double").alias("value"))
            for c in cols
        ]
    )
    return (
        df.select(F.inline(cells))
        .groupBy("feature", "dtype")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("value").alias("distinct_values"),
            F.count_if(F.col("value").isNull()).alias("nulls"),
            (F.avg(F.col("value").isNull().cast("double")) * 100).alias("null_pct"),
        )
    )


# Feature steps and what each creates (audit trail of the feature build).
STEPS = {
    "customer_features": ["total_transaction_amount", "avg_transaction_amount", "transaction_count", "std_transaction_amount"],
    "temporal_features": ["transaction_hour_mean", "is_weekend_mean"],
    "behavioral_features": ["product_category_count", "channel_count"],
    "financial_features": ["transactions_per_active_day", "days_since_last_transaction"],
}


def audit_trail(df: DataFrame, steps: dict[str, list[str]] = STEPS) -> DataFrame:
    """One row per created feature with its step and the row counts the step saw."""
    records = F.array(
        *[
            F.struct(F.lit(i).alias("step_no"), F.lit(s).alias("step"), F.array(*[F.lit(f) for f in fs]).alias("features"))
            for i, (s, fs) in enumerate(steps.items(), 1)
        ]
    )
    seen = df.agg(F.count(F.lit(1)).alias("transactions"), F.countDistinct(KEY).alias("customers"))
    return seen.select("transactions", "customers", F.inline(records)).select(
        "step_no", "step", "transactions", "customers", F.posexplode("features").alias("position", "feature")
    )


def reference_stats(df: DataFrame, cols: list[str]) -> DataFrame:
    """Table-wide counts and dates, then mean, deviation and median per numeric column, in long form."""
    wide = df.agg(
        F.countDistinct(KEY).cast("double").alias("customers"),
        (F.unix_micros(F.min(TS)) / 1e6).alias("first_second"),
        (F.unix_micros(F.max(TS)) / 1e6).alias("last_second"),
        *[f(c).alias(f"{c}_{n}") for c in cols for n, f in (("mean", F.avg), ("std", F.stddev))],
    )
    med = ordered.quantile_row(df, cols, [0.5])
    m = med.select(F.struct(*[F.col(f"{c}_q0").alias(f"{c}_median") for c in cols])).scalar()
    wide = wide.withColumns({f"{c}_median": m[f"{c}_median"] for c in cols})
    return wide.select(
        F.inline(F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).alias("value")) for n in wide.columns]))
    )


def feature_frame(df: DataFrame) -> DataFrame:
    """Customer, time, behaviour and money features side by side."""
    return (
        value_features(df)
        .join(time_means(df), KEY, "left")
        .join(behaviour.gap_stats(df, prefix="time_between_transactions").drop("time_between_transactions_min", "time_between_transactions_max"), KEY, "left")
        .join(diversity(df), KEY, "left")
        .join(favourites(df), KEY, "left")
        .join(activity(df), KEY, "left")
    )
