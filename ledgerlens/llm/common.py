"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import durable_dir

#: A word, in the notation both Java's and Python's expressions read.
WORD = r"[^\x20\x09-\x0D]+"
#: White space that separates words.
BLANKS = " \t\n\x0b\x0c\r"

MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write the rows as Parquet into the shared folder and read them back: cuts the lineage, survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new path under the folder that all executors share."""
    return f"{durable_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def whole(column: str = "text") -> Column:
    """The text, NULL read as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def packed(docs: DataFrame, **made: Column) -> DataFrame:
    """Columns a stage works with, and the caller's whole rows as ``row``, so that no name of theirs can clash."""
    return docs.select(*(v.alias(k) for k, v in made.items()), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def unpacked(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The caller's columns again."""
    return df.select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values so that their order looks random."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
_ODD = np.uint64(0x100000001B3)


def _powers(n: int) -> np.ndarray:
    """Powers of an odd multiplier modulo 2**64, grown on demand."""
    global _POW
    if len(_POW) < n + 1:
        p = np.full(max(n + 1, 2 * len(_POW)), _ODD, np.uint64)
        p[0] = 1
        _POW = np.multiply.accumulate(p)
    return _POW


_POW = np.ones(1, np.uint64)


def words_of(raw: bytes | memoryview) -> tuple[np.ndarray, np.ndarray]:
    """Start and end byte of each word (UTF-8 keeps the six blanks as single bytes)."""
    b = np.frombuffer(raw, np.uint8)
    if not len(b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    w = np.concatenate(([False], ~BLANK[b], [False]))
    edge = np.flatnonzero(w[1:] != w[:-1])
    return edge[0::2], edge[1::2]


def word_hashes(raw: bytes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of every word: sums of mixed (byte, place) pairs, so equal words hash equally anywhere."""
    b = np.frombuffer(raw, np.uint8)
    if not len(start):
        return np.empty(0, np.uint64)
    n = end - start
    keep = np.ones(len(b) + 1, bool)
    owner = np.repeat(np.arange(len(start)), n)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    flat = b[np.repeat(start, n) + at].astype(np.uint64)
    del keep, owner
    part = mix64((flat + np.uint64(1)) * MIX + at.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return mix64(np.add.reduceat(part, np.cumsum(n) - n) + n.astype(np.uint64) * MIX)


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values."""
    m = len(h) - k + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for i in range(k):
        out = out * np.uint64(0x9FB21C651E98DF25) + h[i : i + m]
    return mix64(out)


def window_argmin(v: np.ndarray, w: int) -> np.ndarray:
    """Place of the leftmost minimum of every w consecutive values (all windows, by doubling)."""
    m = len(v) - w + 1
    if m <= 0:
        return np.empty(0, np.int64)
    best = np.arange(len(v))
    span = 1
    while span < w:
        step = min(span, w - span)
        a, b = best[: len(best) - step], best[step:]
        best = np.where(v[b] < v[a], b, a)
        span += step
    return best[:m]


def by_row(batches: Iterator[pa.RecordBatch], make, schema: pa.Schema, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Call ``make(row dict) -> dict of lists`` for every row; hand out batches of bounded size."""
    names = schema.names
    out: dict[str, list] = {n: [] for n in names}
    size = 0
    for batch in batches:
        for row in batch.to_pylist():
            got, weight = make(row)
            for n in names:
                out[n].extend(got[n])
            size += weight
            if size >= limit:
                yield pa.RecordBatch.from_pydict(out, schema=schema)
                out, size = {n: [] for n in names}, 0
    if out[names[0]]:
        yield pa.RecordBatch.from_pydict(out, schema=schema)
