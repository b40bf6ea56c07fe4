"""The corpus pipeline: stages over ``documents``, each written and read again.

Every stage takes all that the one before kept. All but the last return the columns of
``documents``; the last returns each piece's place in a training sequence.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jsonflow.llm import decontaminate, line_dedup, minhash, packing, toxicity
from jsonflow.llm.common import ready, stored, table
from jsonflow.llm.queries import tokenizer_path

# Shingle sets that share this much of their union are near copies.
NEAR_PERCENT = 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents whose restored text is rejected as toxic."""
    return toxicity.learn(docs, table(ready(spark), sf_dir, "labels")).keep(docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without chunks of lines that occurred before; what is left of nothing goes."""
    ready(spark)
    return line_dedup.dedup_lines(docs, length_col="n_chars")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ready(spark)
    return minhash.drop_copies(docs, NEAR_PERCENT)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold a benchmark item."""
    return decontaminate.decontaminate(docs, table(ready(spark), sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    ready(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("minhash", drop_near_copies),
    ("decontaminate", drop_benchmark),
    ("packing", pack),
]

# Learnt scores, sketches and a tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, over ``documents``."""
    docs = table(ready(spark), sf_dir, "documents")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
