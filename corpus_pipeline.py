"""Corpus pipeline: five operators of ``boxframe.llm`` over the documents of a folder.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again as the
next one's documents.  All but the last return the columns of ``docs``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boxframe.llm import decontam, mixing, neardup, quality, tokenids
from boxframe.llm.textkit import load, written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, load(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity 0.8)."""
    return neardup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontam.drop_contaminated(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by raked source, language and topic weights; those of cells under target stay, once."""
    return mixing.sample_balanced(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the written id stream."""
    import public_tokenizers
    return tokenids.document_ids(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_ids", token_stage),
]
#: SQL cannot express the classifier, MinHash or the coder; tests/llm holds the run against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; between stages the rows are written and read again."""
    docs = load(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = written(docs)
    return docs
