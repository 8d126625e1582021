"""Reading, conforming and writing transaction files."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import durable_dir

# Header words that mark a date column (fixed list).
DATE_WORDS = ("time", "date", "timestamp", "start", "end", "created", "updated")

# Accepted names of canonical columns, first match wins (fixed lists).
ALIASES = {
    "CustomerId": ["CustomerId", "customer_id", "customerid", "AccountId", "user_id", "o_custkey"],
    "Amount": ["Amount", "amount", "TransactionAmount", "total_amount", "value", "o_totalprice"],
    "TransactionStartTime": ["TransactionStartTime", "TransactionDate", "transaction_date", "date", "ts", "o_orderdate"],
    "is_high_risk": ["is_high_risk", "target", "risk_flag", "default_flag", "label"],
}


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint directory."""
    return f"{durable_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def read_transactions(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Read with a declared schema: no inference pass over the files."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss[.SSSSSS]")
    return reader.format(fmt).load(path)


def write(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    writer.format(fmt).save(path)
    return path


def conform(df: DataFrame, text: list[str], numbers: list[str], flag: str | None = None) -> DataFrame:
    """Ids and categories to text, unparsable numbers to NULL, unparsable flags to 0."""
    made: dict[str, Column] = {c: F.col(c).cast("string") for c in text if c in df.columns}
    made |= {c: F.col(c).try_cast("double") for c in numbers if c in df.columns}
    if flag and flag in df.columns:
        made[flag] = F.coalesce(F.col(flag).try_cast("int"), F.lit(0))
    return df.withColumns(made)


def date_columns(df: DataFrame, words: tuple[str, ...] = DATE_WORDS, fmt: str | None = None) -> DataFrame:
    """Columns whose header names a date, with how many of their values parse."""
    named = [c for c in df.columns if any(w in c.lower() for w in words)]
    if not named:
        return df.sparkSession.createDataFrame([], "column string, non_null bigint, parsed bigint")
    args = [F.lit(fmt)] if fmt else []
    aggs = []
    for c in named:
        aggs += [F.count(c).alias(f"{c}__n"), F.count(F.try_to_timestamp(F.col(c), *args)).alias(f"{c}__p")]
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.col(f"{c}__n").alias("non_null"), F.col(f"{c}__p").alias("parsed"))
            for c in named
        ]
    )
    return df.agg(*aggs).select(F.inline(cells))


def first_rows(df: DataFrame, n: int, key: str) -> DataFrame:
    """``n`` rows, the same ones on every run: smallest MD5 of the key."""
    return df.orderBy(F.md5(F.col(key).cast("string")), key).limit(n)


def canonical(df: DataFrame, aliases: dict[str, list[str]] = ALIASES) -> DataFrame:
    """Rename the first alias present to its canonical name; without one, the first column whose name contains it."""
    renames = {}
    for name, options in aliases.items():
        found = next((o for o in options if o in df.columns), None)
        found = found or next((c for c in df.columns if name.lower() in c.lower() and c not in renames), None)
        if found and found != name:
            renames[found] = name
    return df.withColumnsRenamed(renames)


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def require(df: DataFrame, required: list[str]) -> DataFrame:
    missing = missing_columns(df, required)
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df


def data_dictionary(df: DataFrame, label: str = "is_high_risk") -> DataFrame:
    """Per split: rows, column list, class counts and rate in percent."""
    y = F.col(label)
    cols = sorted(c for c in df.columns if c != "split")
    return (
        df.groupBy("split")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(y == 0).alias("low_risk"),
            F.count_if(y == 1).alias("high_risk"),
            (F.avg(y.cast("double")) * 100).alias("high_risk_rate"),
        )
        .withColumn("columns", F.array(*[F.lit(c) for c in cols]))
    )


def granularity(df: DataFrame, key: str = "CustomerId", tx: str = "TransactionId") -> DataFrame:
    """Whether a table holds transactions or one row per customer."""
    has_tx = tx in df.columns
    g = df.agg(F.count(F.lit(1)).alias("rows"), F.countDistinct(key).alias("customers"))
    level = F.when((F.col("rows") > F.col("customers")) & F.lit(has_tx), "transaction").otherwise("customer")
    return g.withColumn("level", level)
