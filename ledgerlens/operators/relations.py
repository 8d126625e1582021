"""Filters, joins, top-k, duplicates and row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from ledgerlens.functions import scalars as X

from . import skew


def recent(df: DataFrame, days: int, ts: str = "TransactionStartTime") -> DataFrame:
    """Rows of the last ``days`` of the table.

    The limit is read first (one number), so the filter is a literal the file scan can skip row
    groups by.
    """
    last = df.select(F.max(F.unix_micros(ts))).first()[0]
    if last is None:
        return df.where(F.lit(False))
    return df.where(F.col(ts) > F.timestamp_micros(F.lit(last - days * X.DAY_MICROS)))


def validity(df: DataFrame, reference_time: str) -> DataFrame:
    ref = F.lit(reference_time).cast("timestamp")
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("Amount") < 0).alias("negative_amounts"),
        F.count_if(F.col("TransactionStartTime") > ref).alias("future_transactions"),
        F.count_if(~F.col("FraudResult").isin(0, 1)).alias("invalid_flags"),
    )


def null_shares(df: DataFrame) -> dict[str, float]:
    """Share of NULLs per column: one aggregate, one row to the driver."""
    row = df.agg(*[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in df.columns]).first()
    return row.asDict()


def drop_sparse_columns(df: DataFrame, limit: float = 0.3) -> DataFrame:
    return df.drop(*[c for c, share in null_shares(df).items() if share is not None and share > limit])


def numeric_only(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[f.name for f in df.schema if isinstance(f.dataType, T.NumericType) or f.name in keep])


def row_index(df: DataFrame, key: str, out: str = "row_index") -> DataFrame:
    """0-based dense index in MD5 order of the key, counted in 65536 even pieces."""
    digest = F.md5(F.col(key).cast("string"))
    rows = df.withColumns({"__d": digest, "__p": F.substring(digest, 1, 4)})
    inside = W.partitionBy("__p").orderBy("__d", key)
    rows = rows.withColumn("__r", F.row_number().over(inside))
    pieces = rows.groupBy("__p").agg(F.count(F.lit(1)).alias("__c"))
    # at most 65536 rows
    lower = W.partitionBy(F.lit(0)).orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    offsets = pieces.select("__p", F.coalesce(F.sum("__c").over(lower), F.lit(0)).alias("__o"))
    return rows.join(offsets, "__p").withColumn(out, F.col("__r") + F.col("__o") - 1).drop("__d", "__p", "__r", "__o")


def add_target(features: DataFrame, target: DataFrame, key: str = "CustomerId", label: str = "is_high_risk") -> DataFrame:
    """Left join of features and target; customers without a target get 0."""
    return features.join(target.select(key, label), key, "left").withColumn(label, F.coalesce(label, F.lit(0)))


def unmatched(features: DataFrame, target: DataFrame, key: str = "CustomerId") -> DataFrame:
    missing = features.join(target.select(key), key, "left_anti")
    return missing.agg(F.count(F.lit(1)).alias("unmatched"))


def add_frequencies(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Attach how often the row's value occurs, for several columns given as ``{column: new name}``."""
    out = df
    for key, name in names.items():
        out = skew.lookup(out, df.groupBy(key).agg(F.count(F.lit(1)).alias(name)), [key], look_at=df)
    return out


def top_k(df: DataFrame, measure: str, tie: str, k: int) -> DataFrame:
    return df.orderBy(F.desc(measure), F.asc(tie)).limit(k)


def value_counts(df: DataFrame, cols: list[str], k: int | None = None) -> DataFrame:
    """Occurrences per column and value; with ``k`` only the most frequent of each column."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols])
    counts = (
        df.select(F.inline(cells))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    if k is None:
        return counts
    # the rank limit is applied inside each task before rows meet
    w = W.partitionBy("column").orderBy(F.desc("n"), "value")
    return counts.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def duplicate_rows(df: DataFrame) -> DataFrame:
    rows = df.select(F.count(F.lit(1))).scalar()
    return df.distinct().agg(F.count(F.lit(1)).alias("distinct_rows")).select(
        rows.alias("rows"),
        (rows - F.col("distinct_rows")).alias("duplicates"),
        (X.ratio(rows - F.col("distinct_rows"), rows) * 100).alias("duplicate_pct"),
    )


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    return df.agg(F.count(key).alias("n"), F.countDistinct(key).alias("distinct_keys")).select(
        "n", "distinct_keys", (F.col("n") - F.col("distinct_keys")).alias("duplicates")
    )


def without(df: DataFrame, flagged: Column) -> DataFrame:
    """Rows that are not flagged; a flag of NULL flags nothing."""
    return df.where(~F.coalesce(flagged, F.lit(False)))


def band_counts(df: DataFrame, value: str, limits: list[tuple[str, float, float]], extra: list[Column] = ()) -> DataFrame:
    v = F.col(value)
    band = None
    for name, lo, hi in limits:
        test = (v >= lo) if hi == float("inf") else (v >= lo) & (v < hi)
        band = F.when(test, name) if band is None else band.when(test, name)
    return df.withColumn("band", band).where(F.col("band").isNotNull()).groupBy("band").agg(F.count(F.lit(1)).alias("n"), *extra)
