"""The numbered operators over whole tables, as registered in ``__spark_entry__``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textkiln.llm import oracles


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.quality import quality_report

    out = quality_report(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.mixing import mix

    return mix(_read(spark, sf_dir, "documents"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.line_dedup import digest

    return digest(_read(spark, sf_dir, "documents"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.simhash import hex_fingerprint, near_duplicate_groups

    out = near_duplicate_groups(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.suffix_dedup import digest

    return digest(_read(spark, sf_dir, "documents"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.tables import written
    from textkiln.llm.topk import exact_topk, integer_vectors

    v = written(integer_vectors(_read(spark, sf_dir, "embeddings")), "vectors")
    return exact_topk(v, v.where("id % 50 = 0"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers

    from textkiln.llm.bpe import PATTERN, roundtrip

    if public_tokenizers.PATTERN != PATTERN:
        raise ValueError("the tokenizers split by another pattern")
    return roundtrip(_read(spark, sf_dir, "documents"), vocabulary or public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.langid import predict, train

    docs = _read(spark, sf_dir, "documents")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    model = train(docs.where(~held).select("doc_id", "text", "lang"))
    return predict(docs.select("doc_id", "text", held.alias("held_out")), model, ("doc_id", "held_out"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.sharding import shard_by_bytes

    out = shard_by_bytes(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The rule of the listed hosts: advertising, gambling, adult, pharmacy and link-farm sites are named by a lure and a place, below every name of ``TOPS``.
LURES = "ads adult bet bonus casino cheap clicks coin crypto diet dating escort fake free gold hack jackpot loan lotto lucky pills poker porn prize promo slots spam spy trade win".split()
PLACES = "bets bonus cash chat club deals farm feed games hub link loans market offers online pills play pop pro rush shop spin store stream track traffic win x zone xxx".split()
TOPS = "biz com info net org".split()


def listed_urls(spark: SparkSession) -> DataFrame:
    """``canonical_url``: 4,500 hosts made by the rule. A production list is a table of the same column."""
    word = lambda words, i: F.element_at(F.array(*[F.lit(w) for w in words]), (i + 1).cast("int"))
    n = F.col("id")
    name = F.concat(word(LURES, n % len(LURES)), F.lit("-"), word(PLACES, F.floor(n / len(LURES)) % len(PLACES)), F.lit(".example."), word(TOPS, F.floor(n / (len(LURES) * len(PLACES)))), F.lit("/"))
    return spark.range(len(LURES) * len(PLACES) * len(TOPS)).select(name.alias("canonical_url"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.url_filter import judge_urls

    return judge_urls(_read(spark, sf_dir, "pages"), listed_urls(spark))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.phrases import collocations

    return collocations(_read(spark, sf_dir, "documents"))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.decontaminate import digest

    return digest(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from textkiln.llm.runs import digest

    return digest(_read(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, op2_mix_sources, op3_line_dedup, op4_simhash, op5_suffix_dedup, op6_exact_topk, op7_byte_bpe, op8_language_id, op9_sharding, op10_url_filter, op11_phrase_collocations, op12_decontamination, op13_periodic_runs)}

#: DuckDB SQL for the queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": oracles.OP1, "op2_mix_sources": oracles.OP2, "op3_line_dedup": oracles.OP3, "op6_exact_topk": oracles.OP6, "op9_sharding": oracles.OP9,
    "op10_url_filter": oracles.op10(LURES, PLACES, TOPS), "op11_phrase_collocations": oracles.OP11, "op12_decontamination": oracles.OP12,
}
