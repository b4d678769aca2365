"""Queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from galefold.llm import bpe, decontam, langid, licences, mainhtml, minmax, perplexity, resample, slots, urlrules
from galefold.llm.shared import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontam.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op2_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resample.resampled(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op3_minmax_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minmax.near_duplicates(table(spark, folder, "documents"))


def digests(tokens: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes."""
    return tokens.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return digests(bpe.encode(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), decode=True))


def op5_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.judged(table(spark, folder, "documents"))


def counted_text_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What SQL can say of op5: the counted rules."""
    return perplexity.judged(table(spark, folder, "documents")).drop("log_ppl", "kept")


def op6_main_text(spark: SparkSession, folder: str) -> DataFrame:
    return mainhtml.extract(table(spark, folder, "pages"))


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    return langid.identify(table(spark, folder, "documents")).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


def op8_licences(spark: SparkSession, folder: str) -> DataFrame:
    return licences.scan(table(spark, folder, "documents"))


def op9_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Labels: those of the documents whose text is a page's main text (the numbers of both tables have nothing to do with each other)."""
    pages = table(spark, folder, "pages")
    return urlrules.judged(pages, urlrules.labelled_by_text(pages, table(spark, folder, "documents"), table(spark, folder, "labels")))


def listed_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    """What SQL can say of op9: host, path and listed rule."""
    pages = table(spark, folder, "pages")
    return urlrules.judged(pages, spark.createDataFrame([], "url string, blocked boolean")).select("page_id", "host", "path", "rule")


def op10_virtual_slots(spark: SparkSession, folder: str) -> DataFrame:
    """The map of each input folder has a store of its own under the shared folder, and outlives the run."""
    store = f"{shared_dir(spark)}/galefold-slot-maps/{zlib.crc32(folder.rstrip('/').encode()):08x}"
    placed = slots.sharded(table(spark, folder, "documents"), store, shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", "version")


def queries() -> dict[str, Query]:
    every = (op1_decontamination, op2_resampling, op3_minmax_dedup, op4_byte_bpe, op5_quality_rules, op6_main_text, op7_language, op8_licences, op9_url_rules, op10_virtual_slots, listed_url_rules, counted_text_rules)
    return {q.__name__: q for q in every}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": decontam.oracle_sql(), "op8_licences": licences.oracle_sql(), "op3_minmax_dedup": minmax.oracle_sql(), "listed_url_rules": urlrules.listed_sql(), "counted_text_rules": perplexity.base_sql()}
