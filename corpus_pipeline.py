"""Corpus pipeline: the documents that are worth training on, packed into sequences.

Each stage takes ``(spark, docs, sf_dir)``. Between stages the documents are written as
Parquet to the shared folder and read again, so a lost executor costs one stage at most.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import public_tokenizers  # noqa: E402

from marlspike.llm import langid, ngram_join, packing, quality_rules, suffix_dedup  # noqa: E402
from marlspike.llm.scratch import stored  # noqa: E402
from marlspike.sources.tables import table  # noqa: E402


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified stay."""
    return langid.keep_identified(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the rules learned from ``labels`` stay."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays (five-word shingles, similarity of 0.8)."""
    return ngram_join.keep_one(docs)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that stand in several places are cut from the texts."""
    return suffix_dedup.remove_repeats(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token pieces of all documents, packed into sequences."""
    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [
    ("language_id", language),
    ("quality_rules", quality),
    ("ngram_jaccard_join", near_copies),
    ("suffix_array_dedup", passages),
    ("best_fit_packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name)
    return docs


#: The language model and the learned rules cannot be expressed in SQL.
ORACLE_SQL = None
