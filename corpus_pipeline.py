"""The corpus pipeline: five stages over ``documents``, each one of the
training-data operators, each over all that the stage before kept.

Order: quality classifier (rejected documents go), SimHash near-duplicates
(one document per component stays), suffix-array deduplication (repeated
bytes go from the texts), benchmark decontamination (documents with a leak
go), mixing to target weights (documents are replicated and shuffled). All
stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakegov.llm import decontaminate, importance, simhash_trie, source_mix, suffix_dedup
from lakegov.llm.staging import staged, table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _, ratios, cut = importance.resample(docs, table(spark, sf_dir, "labels"))
    return importance.keep_selected(docs, ratios, cut)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash_trie.keep_one(docs, simhash_trie.SHINGLE, simhash_trie.MAX_BITS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.cut(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_to_target_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return source_mix.mix(docs)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("mix_to_target_weights", mix_to_target_weights),
]

#: SQL cannot express the hashed n-gram models, the trie join or the suffix
#: sort; ``tests/llm/test_corpus_pipeline.py`` holds run() against plain Python forms on a small fixture.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage's result is written as Parquet and reread."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
