"""Repeated text and copies across documents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textkiln.functions.text import BLANK_LINE, body_hash, folded, tokens
from textkiln.operators.pages import markdown_blocks


def pieces(docs: DataFrame, separator: str = "\n") -> DataFrame:
    """``doc_id, line, piece``: the texts' pieces, numbered from 0."""
    return docs.select("doc_id", F.posexplode(F.split(F.coalesce("text", F.lit("")), separator)).alias("line", "piece"))


def boilerplate(docs: DataFrame, separator: str = BLANK_LINE, least_tokens: int = 8, least_docs: int = 3) -> DataFrame:
    """``block, n_docs, first_doc``: normalised pieces of text held by at least ``least_docs`` documents.

    Pieces lie between blank lines unless another separator is given. A piece that starts with ``#`` is a heading and doesn't count. Documents are counted, not
    listed, so a piece held by a third of the corpus costs one row a task.
    """
    named = (
        pieces(docs, separator).where(~F.col("piece").rlike(r"^\s*#"))
        .select("doc_id", tokens(F.col("piece")).alias("t"))
        .where(F.size("t") >= least_tokens)
        .select("doc_id", F.array_join("t", " ").alias("block"))
        .distinct()
    )
    return named.groupBy("block").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc")).where(F.col("n_docs") >= least_docs)


def exact_repetition(docs: DataFrame, least_docs: int = 3) -> DataFrame:
    """``sha256, occurrences, n_docs, first_doc`` of non-blank pieces held by ``least_docs`` documents or more."""
    each = pieces(docs).where(F.trim("piece") != "").groupBy(F.sha2("piece", 256).alias("sha256"), "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return each.groupBy("sha256").agg(F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc")).where(F.col("n_docs") >= least_docs)


#: Kinds of blocks whose repetition counts.
REPEATED_KINDS = ("paragraph", "fence", "table", "reference")


def block_repetition(docs: DataFrame, key: str, body: str, least_docs: int = 3) -> DataFrame:
    """``sha256, kind, occurrences, n_docs, first_doc`` of structural blocks held by ``least_docs`` documents or more."""
    found = markdown_blocks(docs, key, body).where(F.col("kind").isin(*REPEATED_KINDS)).groupBy("sha256", "id").agg(F.min("kind").alias("kind"), F.count(F.lit(1)).alias("n"))
    return found.groupBy("sha256").agg(F.min("kind").alias("kind"), F.sum("n").alias("occurrences"), F.count(F.lit(1)).alias("n_docs"), F.min("id").alias("first_doc")).where(F.col("n_docs") >= least_docs)


def near_repetition(docs: DataFrame, least_chars: int = 80) -> DataFrame:
    """Pieces equal after blanks and case, held by two documents or more in more than one exact form."""
    flat = folded(F.trim(F.regexp_replace("piece", r"\s+", " ")))
    each = (
        pieces(docs).select("doc_id", F.sha2("piece", 256).alias("raw"), flat.alias("flat")).where(F.length("flat") >= least_chars)
        .groupBy(F.sha2("flat", 256).alias("normalized_sha256"), "doc_id", "raw").agg(F.count(F.lit(1)).alias("n"))
    )
    by = each.groupBy("normalized_sha256").agg(
        F.sum("n").alias("occurrences"), F.count_distinct("doc_id").alias("n_docs"), F.count_distinct("raw").alias("n_forms"))
    return by.where("n_docs >= 2 and n_forms > 1")


def canonical_candidates(docs: DataFrame, key: str) -> DataFrame:
    """Keys with several documents; ``substantive_match`` if their normalised bodies are all the same."""
    each = docs.select(F.col(key).alias("key"), "doc_id", body_hash(F.col("text")).alias("h"))
    by = each.groupBy("key").agg(F.count(F.lit(1)).alias("documents"), F.min("doc_id").alias("first_doc"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    return by.where("documents > 1").select("key", "documents", "first_doc", (F.col("lo") == F.col("hi")).alias("substantive_match"))
