"""Corpus pipeline: language, quality, near-duplicates, benchmark leaks, tokens."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from galefold.llm import bpe, decontam, entry, langid, minmax, perplexity
from galefold.llm.shared import Scratch, temporary


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.accepted(docs)


def good_text(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return perplexity.passed(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minmax.deduplicated(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, entry.table(spark, sf_dir, "benchmark"))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return entry.digests(bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), decode=True))


STAGES = [
    ("language", known_language),
    ("quality", good_text),
    ("near-duplicates", one_of_each),
    ("decontamination", without_leaks),
    ("tokens", tokenised),
]

#: Language models and perplexity bands are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each is written to the shared folder and read again by the next.

    A stage's own tables are removed once its result is written, and that result once the next one is.

    Edge cases: rows with nulls in any column, empty texts, repeated rows and extra columns pass through the
    stages; texts that are null or empty go with the first one. Rows without an id are judged by their own text
    (near-duplicates by their texts' class can't name them, so they stay). An empty table gives an empty one.
    """
    written = Scratch(spark, "pipeline")
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for _, stage in STAGES:
        with temporary():
            docs = written.keep(stage(spark, docs, sf_dir))
        if before is not None:
            written.drop(before)
        before = docs
    return docs
