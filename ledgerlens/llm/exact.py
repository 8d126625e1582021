"""Exact deduplication by a stateful stream (native).

Every row becomes a short record: digest of the normalised text, length of the original, stable
identifier and content locator. A structured stream groups these records by digest in a disk-backed
(RocksDB) state without watermark, so no key ever expires; the state holds, per digest, the identifier
and locator of the row that stays and the number of rows. The state is read back with Spark's state
reader. Rows whose digest was hit more than once then have their full bytes compared; a digest whose
texts differ would be split by the texts themselves.

Defined cases: NULL and blank texts are equal to the empty text; rows repeated with the same ``doc_id``
are rows of one group, of which one is marked as kept (``doc_id`` equal to ``keep_id``; copies of that very row
share the mark); an empty table gives an empty result; other columns are not touched.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import BLANKS, packed, scratch, stored, unpacked, whole

#: Settings of the state: on disk, without room reserved ahead, as there is one store per shuffle partition.
STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}
RECORD = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("locator", T.StringType()),
    ]
)


def normalised(column: str = "text") -> Column:
    """The text without white space."""
    c = whole(column)
    for blank in BLANKS:
        c = F.replace(c, F.lit(blank), F.lit(""))
    return c


def digest(column: str = "text") -> Column:
    return F.unhex(F.sha2(normalised(column).cast("binary"), 256))


def records(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(whole()).cast("long").alias("length"),
        digest().alias("digest"),
        F.input_file_name().alias("locator"),
    )


def _best(length: str, doc_id: str, locator: str) -> Column:
    """Order of staying: longest first, then smallest identifier (NULL last); the smallest of these structs stays."""
    return F.struct((-F.col(length)).alias("neg"), F.col(doc_id).isNull().alias("no_id"), F.col(doc_id).alias("id"), F.col(locator).alias("at"))


def grouped(stream: DataFrame) -> DataFrame:
    """Stateful grouping of a stream of records; works for any number of batches and any order of arrival."""
    return stream.groupBy("digest").agg(F.min(_best("length", "doc_id", "locator")).alias("best"), F.count(F.lit(1)).alias("n"))


def run_stream(folder: str, docs: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """Stream a folder of records to its end; returns the state: digest, keep_id, keep_length, locator, group_size."""
    spark = docs.sparkSession
    state = scratch(spark, "exact-state")
    before = {k: spark.conf.get(k, None) for k in STORE}
    for k, v in STORE.items():
        spark.conf.set(k, v)
    try:
        reader = spark.readStream.schema(RECORD)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        handle = (
            grouped(reader.parquet(folder))
            .writeStream.format("noop")
            .outputMode("update")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        handle.awaitTermination()
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    held = spark.read.format("statestore").load(state)
    names = held.schema["value"].dataType.names
    best, n = names[0], names[1]
    return held.select(
        F.col("key.digest").alias("digest"),
        F.col("value")[best]["id"].alias("keep_id"),
        F.col("value")[best]["at"].alias("locator"),
        F.col("value")[n].alias("group_size"),
    )


def dedup(docs: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256, locator of the row that stays."""
    spark = docs.sparkSession
    folder = scratch(spark, "exact-records")
    records(docs).write.parquet(folder)
    rows = spark.read.schema(RECORD).parquet(folder)
    if rows.isEmpty():
        found = rows.select("digest", F.col("doc_id").alias("keep_id"), "locator", F.lit(0).cast("long").alias("group_size"))
    else:
        found = stored(run_stream(folder, docs, files_per_batch), "exact-groups")
    hits = found.where("group_size > 1")
    # full bytes on hits: the smallest and the largest text of a digest are the same text, or the digest lies
    texts = docs.select(digest().alias("digest"), normalised().alias("body")).join(hits.select("digest"), "digest", "left_semi")
    compared = texts.groupBy("digest").agg(F.min("body").alias("low"), F.max("body").alias("high"))
    lying = stored(compared.where("low <> high").select("digest"), "exact-collisions")
    out = rows.select("doc_id", "digest").join(found, "digest").select("doc_id", "keep_id", "group_size", "digest", "locator")
    if not lying.isEmpty():
        out = out.join(lying, "digest", "left_anti").unionByName(_by_text(docs, lying))
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), "locator"
    )


def _by_text(docs: DataFrame, lying: DataFrame) -> DataFrame:
    """Rows of colliding digests, grouped by the whole normalised text."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.char_length(whole()).cast("long").alias("length"),
        digest().alias("digest"),
        normalised().alias("body"),
        F.input_file_name().alias("locator"),
    ).join(lying, "digest", "left_semi")
    best = rows.groupBy("body").agg(F.min(_best("length", "doc_id", "locator")).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return rows.drop("locator").join(best, "body").select("doc_id", F.col("best.id").alias("keep_id"), "group_size", "digest", F.col("best.at").alias("locator"))


def keep(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one of each group."""
    kept = stored(dedup(docs).where("kept").select(F.unhex("text_sha256").alias("_digest"), F.col("keep_id").alias("_keep")), "exact-kept")
    twins = not kept.groupBy("_digest", "_keep").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    best = kept.distinct() if twins else kept
    marked = packed(docs, digest=digest(), length=F.char_length(whole()), id=F.col("doc_id").cast("long"))
    out = marked.join(best, (F.col("digest") == F.col("_digest")) & F.col("id").eqNullSafe(F.col("_keep")), "left_semi")
    if twins:
        # the kept row is there more than once: the longest original, and one of equal ones
        out = out.withColumn("top", F.max("length").over(Window.partitionBy("digest"))).where("length = top").dropDuplicates(["digest"])
    return unpacked(out, docs)
