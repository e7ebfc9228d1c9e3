"""From raw documents to packed training sequences: quality rules, line dedup, near-copy removal, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from policypanel.llm import line_dedup, ngram_join, packing, quality
from policypanel.llm.common import on_workers, stored, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    on_workers(spark)
    return quality.apply_rules(docs).where("kept").select(*docs.columns)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat, or nearly repeat, a line kept elsewhere; n_chars counts the new text."""
    return line_dedup.without_near_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a Jaccard similarity of at least 0.8 of their five-word shingles."""
    on_workers(spark)
    return ngram_join.one_per_group(docs, n=5, num=80, den=100)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences of at most 2048 tokens."""
    on_workers(spark)
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("best_fit_packing", best_fit_packing),
]

#: Tokenising and fuzzy joins have no SQL form; tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
