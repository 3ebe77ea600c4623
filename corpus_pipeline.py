"""A corpus from raw documents, stage by stage; each stage reads what its predecessor wrote."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallywright.llm.common import documents, shared_folder
from tallywright.llm.exact_dedup import without_copies
from tallywright.llm.language_id import in_a_language
from tallywright.llm.mixing import mixed_documents
from tallywright.llm.near_dedup import without_near_duplicates
from tallywright.llm.packing import pack_documents


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that have a language; texts without a letter go."""
    return in_a_language(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the longest, then the one with the smallest id."""
    return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (word shingles, 80 % alike): the one with the smallest id."""
    return without_near_duplicates(docs, 80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix uses them; of a last use in part, only those words."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all uses with their places in the sequences."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

#: SQL has no word for the language model, the tokenizer and the linear program: tested against brute force instead
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written and read again before the next stage."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        path = f"{shared_folder(spark).rstrip('/')}/corpus-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
