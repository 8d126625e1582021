"""The queries of the numbered operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import audit, bpe, chat, exact, jaccard, language, merkle, mixing, pages, pii, quality, runs, substrings
from .common import table
from .registry import QUERIES, SQL, query  # noqa: F401


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query(
    "op6_exact_dedup",
    r"""
    WITH t AS (SELECT doc_id, coalesce(text, '') AS raw, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body FROM documents),
    g AS (SELECT doc_id, sha256(body) AS text_sha256, count(*) OVER (PARTITION BY body) AS group_size,
        first_value(doc_id) OVER (PARTITION BY body ORDER BY length(raw) DESC, doc_id NULLS LAST) AS keep_id FROM t)
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
    """,
)
def op6(spark, sf_dir) -> DataFrame:
    return exact.dedup(table(spark, sf_dir, "documents")).drop("locator")


@query("op8_byte_bpe")
def op8(spark, sf_dir) -> DataFrame:
    return bpe.encode(table(spark, sf_dir, "documents"), ranks_path(), pattern())


@query("op10_mix_sources")
def op10(spark, sf_dir) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op3_substring_dedup")
def op3(spark, sf_dir) -> DataFrame:
    return substrings.dedup(table(spark, sf_dir, "documents"))


@query("op4_run_index_dedup")
def op4(spark, sf_dir) -> DataFrame:
    return runs.dedup(table(spark, sf_dir, "documents"))


@query("op2_jaccard_join")
def op2(spark, sf_dir) -> DataFrame:
    return jaccard.linked_documents(table(spark, sf_dir, "documents"))


@query("op5_quality_rules")
def op5(spark, sf_dir) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


@query("op9_chat_format")
def op9(spark, sf_dir) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", hard), (-1, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return chat.formatted(rows.unionByName(extra), ranks_path(), pattern(), texts=False)


@query("op1_html_extract")
def op1(spark, sf_dir) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


@query("op7_personal_data")
def op7(spark, sf_dir) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


@query("op11_filter_audit", audit.SQL)
def op11(spark, sf_dir) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op13_merkle_manifest")
def op13(spark, sf_dir) -> DataFrame:
    return merkle.tampered(table(spark, sf_dir, "documents"))


@query("op12_language_id")
def op12(spark, sf_dir) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))
