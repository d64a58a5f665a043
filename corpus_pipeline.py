"""From raw documents to packed training sequences, in stages over Parquet tables.

Every stage works on what its predecessor kept and returns the columns of ``documents``; the
last one returns the pieces of the packed sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lorekiln.llm import exact_dedup, lang_id, near_copies as simhash, packing, secrets
from lorekiln.sources.shared import Workspace


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is clear; the others go. Learns from the labelled ones."""
    found = lang_id.identify(docs, lang_id.fit(docs), out="__found")
    return found.filter("not __found.rejected").drop("__found")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, that with the smallest id."""
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, Jaccard of 0.8 or more), that
    with the smallest id."""
    return simhash.drop_near_copies(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked; ``n_chars`` follows the text."""
    return secrets.redact(docs, length_col="n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, placed in sequences."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", exact_copies),
    ("simhash_dedup", near_copies),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

#: SQL expresses neither compression nor tokenizers; tests run the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies all stages to ``documents``; each stage is written and read again."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = work.keep(stage(spark, docs, sf_dir), name)
    return docs
