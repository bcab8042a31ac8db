"""Corpus cleaning in five stages over ``documents``.

Language ID rejects documents without a language, exact dedup and the n-gram
Jaccard join keep one document of each group, decontamination takes out
documents that hold a benchmark item, and byte-level BPE encodes what is left.
Each stage is written as Parquet in the shared folder and read back as the next
one's input; all but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from consult.llm import bpe, decontaminate, exact_dedup, language_id, ngram_join
from consult.llm.common import stage


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: those with a letter (operator 6)."""
    return language_id.drop_undetermined(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 9)."""
    return exact_dedup.drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 10)."""
    return ngram_join.drop_near_copies(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item (operator 2)."""
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and digests of ids and decoded bytes (operator 3)."""
    coded = bpe.encode_decode(docs)
    return coded.select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language),
    ("exact_dedup", exact),
    ("ngram_jaccard", near),
    ("decontamination", clean),
    ("byte_bpe", encode),
]

#: SQL can express neither the language model nor the merges of the last stage.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name)
    return docs
