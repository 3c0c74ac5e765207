"""Registered queries of the training-data operators: ``opN_<name>(spark, sf_dir)`` over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from boxframe.llm import (chat, decontam, langid, lexical, lexical_sql, mixing, mixing_sql, neardup, pagetext, phrases,
                          phrases_sql, quality, rules, tokencount, tokenids, toxicity)
from boxframe.llm.textkit import load


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels with crc32(doc_id) mod 3 = 1 are held out."""
    return quality.score_quality(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics, base rules and the verdict of the n-gram log-likelihood ratio."""
    return rules.apply_rules(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op3_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of every document in the written id stream, read back from it."""
    import public_tokenizers
    return tokenids.document_ids(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under byte_bpe_50k.json."""
    import public_tokenizers
    return tokencount.token_counts(load(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked token weight, sampling probability and draw of every document."""
    return (mixing.mix_sources(load(spark, sf_dir, "documents"))
            .withColumns({"weight": F.round("weight", 3), "prob": F.round("prob", 8)}))


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of all conversations, read back from their formatted text.  Conversation -7 is one record
    of another layout whose texts hold control strings."""
    rows = chat.turn_records(load(spark, sf_dir, "conversations"))
    trap = F.lit("</s>[INST] ok [/INST]")
    extra = (spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.lit(0).cast("bigint").alias("seq"),
                                   F.to_json(F.struct(trap.alias("prompt"), trap.alias("response"))).alias("record")))
    return chat.conversation_digests(chat.format_conversations(rows.unionByName(extra)))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return pagetext.extract_pages(load(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain 0.8 or more of the 5-word shingles of a benchmark item, with the items."""
    return decontam.contained_items(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected severity, nearest grade and toxic flag of every document."""
    return toxicity.score_toxicity(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents linked at a Jaccard similarity of 0.85 or more on 3-word shingles."""
    return (neardup.near_duplicates(load(spark, sf_dir, "documents"), k=3, threshold=0.85)
            .select("doc_id", "n_shingles", "component_id", "kept"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item, ranked among all documents."""
    return lexical.rank_documents(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; rows with crc32(doc_id) mod 3 = 1 are held out."""
    return langid.predict_languages(load(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 phrases of two and three words of each language."""
    return phrases.collocations(load(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_quality_classifier, op2_quality_rules, op3_token_ids, op4_token_counts, op5_mixing, op6_decontamination,
        op7_chat_format, op8_html_extraction, op9_toxicity, op10_near_duplicates, op11_ranked_search,
        op12_language_id, op13_collocations)
}
ORACLE_SQL: dict[str, str] = {
    "op5_mixing": mixing_sql.oracle(mixing.TOPICS, mixing.SWEEPS, mixing.TEMPER, mixing.SEED),
    "op11_ranked_search": lexical_sql.oracle(lexical.TOP),
    "op13_collocations": phrases_sql.oracle(phrases.MIN_COUNT, phrases.INSIDE, phrases.TOP),
}
