"""Streaming counterparts of the daily totals, the duplicate check and bulk scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators import evaluation, modeling
from ledgerlens.sources import files

PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def source(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files arriving under a path; event times become ``timestamp`` (a watermark needs it)."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # written as a pattern, a path may be a folder or one file
    df = reader.parquet(f"{path[:-1]}[{path[-1]}]")
    plain = [f.name for f in schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in plain}) if plain else df


def daily_totals(stream: DataFrame, ts: str, value: str) -> DataFrame:
    """Count, sum, mean and latest time per day. The state is one row per day, so days are kept and late rows count; drain in ``complete`` mode."""
    return (
        stream.groupBy(F.window(ts, "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"), F.avg(value).alias("mean"), F.max(ts).alias("latest"))
        .select(F.col("w.end").alias("ends"), F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n", "total", "mean", "latest")
    )


def mark_open(days: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Drained days; ``open`` says that rows of the day may still come within the delay after the latest row of all."""
    latest = days.select(F.max("latest") - F.expr(f"INTERVAL {delay}")).scalar()
    return days.select("day", "n", "total", "mean", (F.col("ends") > latest).alias("open"))


def unique_rows(stream: DataFrame, keys: list[str]) -> DataFrame:
    """First row per key. Keys do not expire, however late a row comes."""
    return stream.dropDuplicates(keys)


def scored(stream: DataFrame, model: PipelineModel) -> DataFrame:
    """Arriving customer rows with their risk."""
    return evaluation.risk_levels(modeling.predict(model, stream, [modeling.KEY, *modeling.RFM]))


def drain(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Process everything available into a parquet folder and read it back; in ``complete`` mode the table as of the last batch."""
    spark = stream.sparkSession
    out, state = files.scratch(spark, f"{name}-out"), files.scratch(spark, f"{name}-state")
    # keys that never expire must not have to fit in an executor's memory; the session's own setting comes back afterwards
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    writer = stream.writeStream.option("checkpointLocation", state).outputMode(mode).trigger(availableNow=True)
    done: list[str] = []
    if mode == "complete":

        def write(batch: DataFrame, number: int) -> None:
            done.append(f"{out}/{number}")
            batch.write.mode("overwrite").parquet(done[-1])

        writer = writer.foreachBatch(write)
    else:
        writer = writer.format("parquet").option("path", out)
    try:
        writer.start().awaitTermination()
    finally:
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    if mode == "complete":
        return spark.read.schema(stream.schema).parquet(done[-1]) if done else spark.createDataFrame([], stream.schema)
    return spark.read.schema(stream.schema).parquet(out)
