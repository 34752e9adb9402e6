"""The corpus pipeline: documents in, token files out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each stage's rows as Parquet in the shared folder and reads them again as the
next stage's ``docs``. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from culedger.llm import decontam, jaccard, mixing, quality, tokens
from culedger.llm.common import documents, fresh_path, materialize
from culedger.llm.queries import END_ID, vocabulary_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that a rule rejects go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each group of documents that links connect (five-word
    shingles, a similarity of 0.8 or more), one stays."""
    return jaccard.keep_one(docs, size=5, share=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that hold a passage of ``benchmark`` go."""
    return decontam.remove(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_to_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: each source is repeated or cut to its share."""
    return mixing.apply(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: encode what is left, write it, and list it from the files."""
    folder = fresh_path(spark, "corpus")
    tokens.write(docs, folder, vocabulary_path(), END_ID)
    return tokens.read(spark, folder)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram join", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing_to_weights),
    ("token output", token_output),
]

#: SQL has no tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
