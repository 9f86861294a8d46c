"""The corpus pipeline: quality rules, line dedup, near-duplicates, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written and read again
before the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewmill.llm.bpe import bpe_decode, bpe_encode, default_vocabulary
from reviewmill.llm.line_dedup import line_dedup
from reviewmill.llm.minhash import drop_near_duplicates
from reviewmill.llm.mixing import mix_sources
from reviewmill.llm.quality import quality_rules
from reviewmill.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _as_documents(docs: DataFrame) -> DataFrame:
    """The columns of documents, with the length that the text has now."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint")).select(COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go; boilerplate lines go from the others."""
    return _as_documents(quality_rules(docs))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repetitions of passages go from the texts; every row stays."""
    return _as_documents(line_dedup(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return drop_near_duplicates(docs).select(COLUMNS)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents occur as often as their source's target weight asks for."""
    return mix_sources(docs).select(COLUMNS)


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Adds the ids of each text, their number, and whether they decode to the very text."""
    vocabulary = default_vocabulary()
    encoded = bpe_decode(bpe_encode(docs, vocabulary), vocabulary)
    same = F.col("decoded_text") == F.coalesce("text", F.lit(""))
    return encoded.select(*docs.columns, "n_tokens", "tokens", same.alias("decodes"))


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_duplicates", near_dedup_stage),
    ("mix_sources", mixing_stage),
    ("bpe_tokens", tokens_stage),
]

# Extending line runs, connected components and BPE are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, f"pipeline-{name}")
    return docs
