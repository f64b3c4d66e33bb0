"""A training corpus from the documents table, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import langid, mixing, near_dups, packing, pii
from daybook.llm.common import WORD_TOKENIZER
from daybook.llm.registry import prepared
from daybook.session import shared_folder


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is neither unknown nor ambiguous."""
    prepared(spark)
    return langid.accepted(docs)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, by five words and a similarity of 0.8."""
    prepared(spark)
    return near_dups.without_near_dups(docs, size=5, percent=80)


def anonymous(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by its kind."""
    prepared(spark)
    return pii.redacted(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, in the weights of the domain, language and source tree."""
    prepared(spark)
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, packed into sequences of 4,096 tokens."""
    prepared(spark)
    return packing.pack(docs, WORD_TOKENIZER)


STAGES = [
    ("language", known_language),
    ("near_duplicates", distinct),
    ("personal_data", anonymous),
    ("mixing", mixed),
    ("packing", packed),
]

# Learned language models, signatures and tokenizers have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written as Parquet and read again."""
    prepared(spark)
    folder = shared_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
