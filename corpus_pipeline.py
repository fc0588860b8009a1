"""Corpus pipeline: each stage reads what the one before it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tankwise.llm import bpe, decontamination, exact_dedup, jaccard_join, language
from tankwise.llm.common import table
from tankwise.llm.queries import tokenizer_path
from tankwise.session import stage


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told go; the network learns from the documents' own labels."""
    learnt = docs.filter(~language.in_fold(F.col("doc_id"), 4, 2)).select("lang", "text")
    return language.keep_known(docs, language.learn(learnt))


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, that with the largest id."""
    return exact_dedup.deduplicate(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates stays, that with the smallest id."""
    return jaccard_join.keep_first(docs)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a benchmark window occurs go."""
    return decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the number of their ids and digests of ids and decoded text."""
    return bpe.with_counts(docs, tokenizer_path())


STAGES = [
    ("language ID", known_language),
    ("exact dedup", exact_duplicates),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("BPE encoding and decoding", encoded),
]

#: Language ID and encoding have no SQL form; tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again as the next one's."""
    docs = table(spark, sf_dir, "documents")
    for _, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
