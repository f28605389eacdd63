"""The corpus pipeline: documents in, packed pieces out, each stage over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from standings.llm.common import Stage, table
from standings.llm.langid import keep_identified
from standings.llm.packing import PackingRules, pack
from standings.llm.quality import keep_good
from standings.llm.queries import tokenizer_path
from standings.llm.secrets import mask_secrets
from standings.llm.simhash import keep_one_each


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the likelihood ratio reject go."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Models of the languages that the documents name; texts beyond their language's limit go."""
    return keep_identified(docs, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, that with the smallest id."""
    return keep_one_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, their secrets masked."""
    return mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their ids and their places in sequences."""
    return pack(docs, PackingRules(tokenizer_path("word_bpe_49k.json")))


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("secret_scans", secret_scans),
    ("packing", packing),
]

# Language models, hash trees and tokenizers have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again."""
    stage, docs = Stage(spark), table(spark, sf_dir, "documents")
    for number, (name, function) in enumerate(STAGES):
        docs = stage.keep(function(spark, docs, sf_dir), f"{number}-{name}")
    return docs
