"""A corpus pipeline: five stages, each written to Parquet and read again by the next.

``documents`` -> quality rules -> one document of each group of similar ones ->
repeated passages removed -> secrets masked -> sequences of 1024 tokens.
"""

from __future__ import annotations

from helixframe.llm import ngram_jaccard, packing, quality_rules, secret_scan, substring_dedup
from helixframe.llm.common import Scratch
from helixframe.llm.queries import TOKENIZER, table
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _recounted(docs: DataFrame) -> DataFrame:
    """``docs`` with n_chars, if there is one, brought up to date with the text."""
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality_rules.quality_filter(docs, scratch or Scratch(spark))


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """One document of each group of similar ones."""
    return ngram_jaccard.drop_similar(docs, scratch or Scratch(spark))


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents without passages that occur earlier."""
    return _recounted(substring_dedup.drop_repeats(docs, scratch or Scratch(spark)))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Documents with secrets masked."""
    return _recounted(secret_scan.redact_secrets(docs))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str, scratch: Scratch | None = None) -> DataFrame:
    """Pieces of documents, with their places in the packed sequences."""
    return packing.pack(docs, scratch or Scratch(spark), TOKENIZER)


STAGES = [("quality_rules", quality), ("ngram_jaccard", similar), ("substring_dedup", substrings), ("secret_scan", secrets), ("best_fit_packing", sequences)]

#: Merging, fitting and packing are not expressible; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``. A stage's own tables go when its result is written, and that when the next one's is."""
    scratch, docs = Scratch(spark), table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        with scratch.temporary() as own:
            after = scratch.save(stage(spark, docs, sf_dir, own))
        if i:
            scratch.drop(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir, scratch)
