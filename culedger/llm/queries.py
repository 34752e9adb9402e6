"""The registered queries of the training-data operators: thin, with
production parameters, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from culedger.llm import collocations, conversations, decontam, jaccard, lines, mixing, pii, ppm, quality, secret_scan, simhash, substring, tokens
from culedger.llm.common import documents, fresh_path
from culedger.llm.oracle import ORACLE

__all__ = ["ORACLE", "QUERIES"]

#: The vocabulary that operator 4's query encodes with.
VOCABULARY = "word_bpe_49k.json"
END_ID = 1


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = lines.drop(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    return pages.select("page_id", "host", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "tokens")
    tokens.write(documents(spark, sf_dir), folder, vocabulary_path(), END_ID)
    return tokens.read(spark, folder)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(documents(spark, sf_dir).select("doc_id", "text"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document with a candidate: how many there are, how many
    the forest calls secrets, and which."""
    found = secret_scan.scan(documents(spark, sf_dir))
    own = F.when(F.col("secret"), F.struct("number", "candidate"))
    out = found.groupBy("doc_id", "key", "row").agg(F.count(F.lit(1)).alias("n_candidates"), F.count(own).alias("n_secrets"), F.array_sort(F.collect_list(own)).alias("secrets"))
    return out.select("doc_id", "n_candidates", "n_secrets", F.array_join(F.transform("secrets", lambda s: s["candidate"]), "\n").alias("secrets"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring.clean(documents(spark, sf_dir))
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document: whether it holds a passage of ``benchmark``,
    of how many items, and the most tokens in agreement."""
    docs = documents(spark, sf_dir)
    found = decontam.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    key = F.xxhash64("doc_id", "text").alias("key")
    out = docs.select("doc_id", key).join(found.drop("doc_id"), "key", "left")
    return out.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), F.coalesce("agreeing", F.lit(0)).alias("agreeing"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(documents(spark, sf_dir)))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, with planted faults, repaired and digested."""
    return conversations.audit(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(documents(spark, sf_dir))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (op1_mix_sources, op2_ngram_join, op3_line_dedup, op4_token_output, op5_quality_rules, op6_secret_scan, op7_substring_dedup, op8_lm_scoring, op9_decontamination, op10_personal_data, op11_conversation_repair, op12_simhash, op13_collocations)}
