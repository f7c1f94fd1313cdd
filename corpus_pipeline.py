"""Documents to token ids in five stages; each is written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from textkiln.llm.bpe import roundtrip
from textkiln.llm.line_dedup import dedup_lines
from textkiln.llm.mixing import mixed_documents
from textkiln.llm.near_copies import keep_one_of_near_copies
from textkiln.llm.quality import quality_filter
from textkiln.llm.tables import dropped, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_filter(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that a smaller doc_id holds."""
    return dedup_lines(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near copies (five-word shingles, similarity 0.8 or more): SimHash links, verified, and what they can't reach."""
    return keep_one_of_near_copies(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixed_documents(docs)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded text."""
    return roundtrip(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mix_sources", mix_sources),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither SimHash nor byte-level BPE; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        before, docs = docs, written(stage(spark, docs, sf_dir), f"pipeline-{name}")
        dropped(before)
    return STAGES[-1][1](spark, docs, sf_dir)
