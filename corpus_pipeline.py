"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last return the columns of
``documents``. Rows are written as Parquet between stages. Mixing draws lots and tokens follow a
vocabulary file, which SQL cannot express, so there is no SQL for the whole; ``tests/llm`` holds each stage against brute force.

Defined cases are those of the stages' operators: no stage fails on NULLs, empty or long texts, repeated rows, empty tables or extra columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerlens.llm import bpe, exact, jaccard, mixing, q_ops, quality
from ledgerlens.llm.common import stored, table
from ledgerlens.session import tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and are no outliers of their language and source."""
    tune(spark)
    return quality.keep(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of texts that are equal but for white space."""
    tune(spark)
    return exact.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by shingle similarity of 0.8 or more."""
    tune(spark)
    return jaccard.keep(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks."""
    tune(spark)
    return mixing.apply(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the token ids (little-endian, 32 bits) with digests of ids and of the bytes decoded from them."""
    tune(spark)
    return bpe.encode(docs, q_ops.ranks_path(), q_ops.pattern(), with_ids=True)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("tokens", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
