"""Word-overlap retrieval: idf times capped term frequency, best documents for each question."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from textkiln.functions.text import search_words
from textkiln.session import settled

#: Asked words up to so many (question, word) rows are broadcast.
MAX_ASKED = 200_000
#: Scores (documents by questions) that a task adds up at once.
CELLS = 1_000_000


def asked_words(questions: DataFrame) -> DataFrame:
    """``question_id, word``, each once."""
    return questions.select("question_id", F.explode(F.array_distinct(search_words(F.col("text")))).alias("word"))


def term_counts(docs: DataFrame, asked: DataFrame, *keep: str) -> DataFrame:
    """``doc_id, word, tf`` and ``keep``: how often documents hold the asked words, counted where the documents are; other words stay there."""
    return (
        docs.select("doc_id", *keep, F.explode(search_words(F.col("text"))).alias("word"))
        .join(asked.select("word").distinct(), "word", "left_semi").groupBy("doc_id", *keep, "word").agg(F.count(F.lit(1)).alias("tf"))
    )


def scored(tf: DataFrame, documents: int, asked: DataFrame, cap: int = 5) -> DataFrame:
    """``question_id, doc_id, score`` of documents that share a word: sum of ln(1 + N / (1 + df)) * min(tf, cap).

    Terms are summed as whole billionths, so that the result doesn't depend on the order of the sum. The asked words with
    their weights, at most ``MAX_ASKED`` rows, go to the documents' counts; those are not shuffled by word.
    """
    idf = tf.groupBy("word").agg(F.count(F.lit(1)).alias("df")).select("word", F.ln(1 + F.lit(documents) / (1 + F.col("df"))).alias("idf"))
    weights = asked.join(idf, "word")
    few = asked.limit(MAX_ASKED + 1).count() <= MAX_ASKED
    terms = tf.join(F.broadcast(weights) if few else weights, "word")
    return terms.groupBy("question_id", "doc_id").agg(F.sum(F.round(F.col("idf") * F.least("tf", F.lit(cap)) * 1e9).cast("long")).alias("score"))


def scores(docs: DataFrame, questions: DataFrame, cap: int = 5) -> DataFrame:
    """``scored`` over all of ``docs``; the counts are written once, since weights and terms both read them."""
    asked = asked_words(questions)
    return scored(settled(term_counts(docs, asked)), docs.count(), asked, cap)


def top_k(scored: DataFrame, k: int = 5) -> DataFrame:
    """``question_id, rank, doc_id``: highest scores, ties to the smaller document."""
    w = Window.partitionBy("question_id").orderBy(F.desc("score"), "doc_id")
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("question_id", "rank", "doc_id")


class _Best:
    """The ``k`` best documents of each question among those a task has seen; ties to the smaller document."""

    def __init__(self, words: list[tuple], cap: int, k: int) -> None:
        """``words``: word, what 1 to ``cap`` occurrences are worth, its questions."""
        self.questions = sorted({q for _, _, qs in words for q in qs}, key=lambda q: (q is not None, q))
        at = {q: i for i, q in enumerate(self.questions)}
        self.words = pa.array([w for w, _, _ in words], pa.string())
        self.worth = np.array([x for _, x, _ in words], np.int64).reshape(-1, cap)
        self.count = np.array([len(qs) for _, _, qs in words], np.int64)
        self.first = np.cumsum(self.count) - self.count
        self.asking = np.array([at[q] for _, _, qs in words for q in qs], np.int64)
        self.cap, self.k = cap, k
        self.held: list[list[tuple]] = [[] for _ in self.questions]
        self.floor = np.ones(len(self.questions))

    def take(self, docs: pa.Array, words: pa.Array, tf: np.ndarray) -> None:
        """Rows of whole documents, each document's together."""
        if not len(docs) or not self.questions:
            return
        number = pc.index_in(words, value_set=self.words)
        known = np.asarray(pc.is_valid(number))
        codes = np.asarray(docs.dictionary_encode(null_encoding="encode").indices)
        starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])
        of = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(docs)]))[known]
        number = np.asarray(number.drop_null())
        worth = self.worth[number, np.minimum(tf[known], self.cap) - 1]
        step = max(1, CELLS // len(self.questions))
        for d in range(0, len(starts), step):
            a, b = np.searchsorted(of, [d, d + step])
            rows, n = min(step, len(starts) - d), self.count[number[a:b]]
            asking = self.asking[np.repeat(self.first[number[a:b]] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            # sums of whole numbers far below 2^53 are exact
            cell = np.repeat(of[a:b] - d, n) * len(self.questions) + asking
            sums = np.bincount(cell, np.repeat(worth[a:b], n), rows * len(self.questions)).reshape(rows, -1)
            least = self.floor if rows <= self.k else np.maximum(self.floor, np.partition(sums, rows - self.k, axis=0)[rows - self.k])
            for i, q in np.argwhere(sums >= least).tolist():
                doc = docs[int(starts[d + i])].as_py()
                self.held[q].append((-int(sums[i, q]), doc is not None, doc))
            for q in np.unique(np.argwhere(sums >= least)[:, 1]).tolist():
                self.held[q] = sorted(self.held[q])[:self.k]
                if len(self.held[q]) == self.k:
                    self.floor[q] = -self.held[q][-1][0]


def best(tf: DataFrame, documents: int, asked: DataFrame, k: int = 5, cap: int = 5) -> DataFrame:
    """``top_k`` of ``scored``: each document's counts meet in one task, which keeps the best of each question; no row per question and document is shuffled.

    More than ``MAX_ASKED`` rows of asked words are joined instead.
    """
    if asked.limit(MAX_ASKED + 1).count() > MAX_ASKED:
        return top_k(scored(tf, documents, asked, cap), k)
    idf = tf.groupBy("word").agg(F.count(F.lit(1)).alias("df")).select("word", F.ln(1 + F.lit(documents) / (1 + F.col("df"))).alias("idf"))
    worth = F.array(*[F.round(F.col("idf") * F.lit(n) * 1e9).cast("long") for n in range(1, cap + 1)])
    words = [tuple(r) for r in asked.groupBy("word").agg(F.collect_list("question_id").alias("questions")).join(idf, "word").select("word", worth, "questions").collect()]
    doc, question = tf.schema["doc_id"], asked.schema["question_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, rest, schema = _Best(words, cap, k), None, None
        for b in batches:
            t = pa.table(b) if rest is None else pa.concat_tables([rest, pa.table(b)])
            t, schema = t.combine_chunks(), b.schema
            codes = np.asarray(t["doc_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices)
            # the last document may go on in the next batch
            turn = np.flatnonzero(codes[1:] != codes[:-1])
            cut = int(turn[-1]) + 1 if len(turn) else 0
            whole, rest = t.slice(0, cut).combine_chunks(), t.slice(cut)
            if cut:
                kept.take(whole["doc_id"].combine_chunks(), whole["word"].combine_chunks(), whole["tf"].to_numpy())
        if rest is not None and rest.num_rows:
            rest = rest.combine_chunks()
            kept.take(rest["doc_id"].combine_chunks(), rest["word"].combine_chunks(), rest["tf"].to_numpy())
        found = [(q, d, -s) for q, held in zip(kept.questions, kept.held) for s, _, d in held]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found]), pa.array([x[1] for x in found], schema.field("doc_id").type), pa.array([x[2] for x in found], pa.int64())], ["question_id", "doc_id", "score"])

    together = tf.select("doc_id", "word", "tf").repartition("doc_id").sortWithinPartitions("doc_id")
    return top_k(together.mapInArrow(run, StructType([question, doc, StructField("score", LongType())])), k)


def evaluate(before: DataFrame, after: DataFrame, wanted: DataFrame) -> DataFrame:
    """Per question: was the wanted document found in each run, and what that makes of it."""
    hit = lambda run, name: run.join(wanted, ["question_id", "doc_id"]).groupBy("question_id").agg(F.min("rank").alias(name))
    out = wanted.select("question_id").distinct().join(hit(before, "baseline_rank"), "question_id", "left").join(hit(after, "enriched_rank"), "question_id", "left")
    verdict = (
        F.when(F.col("baseline_rank").isNotNull() & F.col("enriched_rank").isNull(), "regression")
        .when(F.col("enriched_rank").isNull(), "missing").when(F.col("baseline_rank").isNull(), "gained").otherwise("kept"))
    return out.withColumn("verdict", verdict)
