"""Session settings shared by queries, tests and the benchmark."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession

#: Runtime settings every query relies on (all can be changed on a live session).
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even when that costs one more exchange afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build(app: str = "ledgerlens", cores: int | str = 8, partitions: int | None = None) -> SparkSession:
    """Local session for tests and the benchmark; on a cluster the submitter brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(partitions or cores))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in RUNTIME.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def durable_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and written intermediates.

    A cluster names it in ``spark.checkpoint.dir``; only where that is unset (tests, one
    machine) a folder under the temporary directory is used.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if configured is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
            configured = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR"))
        spark.sparkContext.setCheckpointDir(configured)
        current = spark.sparkContext.getCheckpointDir()
    return configured or current


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and go on from there.

    Used where a result is read several times or by an iteration; it survives lost executors.
    """
    durable_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def widen(df: DataFrame) -> DataFrame:
    """Spread a table of too few partitions over all cores before heavy Python work."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
