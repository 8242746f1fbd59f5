"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, conversations, embedding_dedup, language_id, license_scan, line_dedup, merkle, ngram_jaccard, oracles, packing, quality_rules, secret_scan, substring_dedup, toxicity
from .common import Scratch

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(column: str, parts: int):
    return F.crc32(F.col(column).cast("string")) % parts


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.similar_sets(table(spark, sf_dir, "documents"), Scratch(spark))


def op2_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), Scratch(spark))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_digests(table(spark, sf_dir, "documents"), Scratch(spark))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, _fold("doc_id", 4) != 2)
    out = language_id.identify(docs, model)
    return out.select("doc_id", F.coalesce(_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "accepted")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoding_digests(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"), Scratch(spark))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), Scratch(spark), TOKENIZER)


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digests(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), _fold("doc_id", 5) != 0, Scratch(spark))
    return toxicity.score_toxicity(docs, model).select("doc_id", F.coalesce(_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_digests(table(spark, sf_dir, "documents"), Scratch(spark))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest_digests(table(spark, sf_dir, "documents"), Scratch(spark), _fold("doc_id", 3) == 0)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_digests(conversations.damage(table(spark, sf_dir, "conversations")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The operators over their whole tables."""
    ops = (
        op1_ngram_jaccard, op2_embedding_dedup, op3_substring_dedup, op4_language_id, op5_license_scan,
        op6_byte_bpe, op7_quality_rules, op8_best_fit_packing, op9_secret_scan, op10_toxicity,
        op11_line_dedup, op12_merkle_manifest, op13_conversation_repair,
    )
    return {f.__name__: f for f in ops}


def oracle_sql() -> dict[str, str]:
    """SQL for the operators that it can express; tests compare the others with plain versions or on held-out rows."""
    return {
        "op1_ngram_jaccard": oracles.NGRAM_JACCARD,
        "op2_embedding_dedup": oracles.EMBEDDING_DEDUP,
        "op3_substring_dedup": oracles.SUBSTRING_DEDUP,
        "op7_quality_rules": oracles.QUALITY_RULES,
        "op11_line_dedup": oracles.LINE_DEDUP,
        "op12_merkle_manifest": oracles.MERKLE_MANIFEST,
    }
