"""A training-data pipeline of five corpus operators; each stage's result is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palaver.llm import chunks, mixing, packing, quality, simhash
from palaver.llm.common import discard, table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects. Null text has no words and is rejected; columns may have any names."""
    return quality.keep(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the smallest (doc_id, text hash).

    Near copies: SimHash fingerprints of 3-word shingles that differ in at most 2 bits, and chains of them.
    """
    return simhash.one_of_each(docs, shingle=3, budget=2)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has; one that loses all its words goes."""
    return chunks.without_repeats(docs)


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated, or left out, so that sources meet their target words. Texts stay whole."""
    return mixing.repeated(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences: one row per piece with its place."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("mixing", mixing_sources),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL: fingerprints and content-defined chunks are bit operations on bytes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        if before is not None:
            discard(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
