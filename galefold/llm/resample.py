"""Importance resampling: hashed n-gram models of good and of all texts, and a Gumbel top-k sample.

Texts are tokens of word characters or of punctuation; their 1- and 2-grams are hashed into ``BUCKETS``
buckets. The raw model counts every text of the table; the target model the texts of a bounded sample of
labelled rows (``target_docs``, the smallest hashes of the ids of good rows; the bound concerns the fit
alone). A text's log importance weight is the sum of the log ratios of its n-grams. Adding Gumbel noise
from a hash of its id and taking the k largest samples without replacement in proportion to the weights.

The k-th largest value is found exactly by narrowing 64-bit keys, 16 bits a pass over counts of at most
65,536 groups, so nothing is sorted or gathered in one place. Rows tied with it are all kept.

Edge cases: a null or empty text has weight 0 (ratio 1). Rows with a null id share one noise value and
never are targets. Without any target row all weights are 0. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galefold.llm.minmax import mixed
from galefold.llm.shared import Scratch, texts_of, type_of

BUCKETS = 1 << 14
TOKENS = re.compile(rb"[A-Za-z0-9_\x80-\xff]+|[^\sA-Za-z0-9_\x80-\xff]+")
SHIFT = np.uint64(64 - 14)


def features(text: str | None, block: int = 1 << 20) -> Iterator[np.ndarray]:
    """Bucket ids of all 1- and 2-grams of a text, a part of it at a time."""
    data = (text or "").encode("utf-8", "surrogatepass")
    begin, last = 0, np.empty(0, np.uint64)
    while begin < len(data):
        end = begin + block
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        found = TOKENS.findall(data, begin, end)
        own = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
        both = np.concatenate([last, own])
        yield (own >> SHIFT).astype(np.int64)
        yield (mixed(both[:-1] * np.uint64(0x9E3779B97F4A7C15) + both[1:]) >> SHIFT).astype(np.int64)
        begin, last = end, both[-1:]


def id_hash(column: Column) -> Column:
    """Ids of any type as numbers."""
    return F.xxhash64(column.cast("string"), F.lit(1))


def log_ratios(docs: DataFrame, target_ids: list[int], id_col: str, text_col: str, smoothing: float = 1.0) -> np.ndarray:
    """For each bucket the log of its probability in the targets over that in all texts."""
    chosen = docs.sparkSession.sparkContext.broadcast(np.sort(np.array(target_ids, np.int64)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            good = np.isin(batch.column(0).fill_null(0).to_numpy(), chosen.value) & batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            waiting: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
            for text, is_target in zip(texts_of(batch.column(1)), good, strict=True):
                for ids in features(text):
                    waiting[int(is_target)].append(ids)
            for is_target, parts in enumerate(waiting):
                for ids in parts and [np.concatenate(parts)]:
                    own = np.bincount(ids, minlength=BUCKETS)
                    raw += own
                    target += own * is_target
        seen = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(raw[seen]), pa.array(target[seen])], names=["bucket", "raw", "target"])

    rows = docs.select(F.when(F.col(id_col).isNotNull(), id_hash(F.col(id_col))).alias("id"), F.col(text_col).cast("string").alias("text"))
    table = rows.mapInArrow(count, "bucket int, raw bigint, target bigint").groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toArrow()
    counts = np.zeros((2, BUCKETS))
    counts[:, table["bucket"].to_numpy()] = table["target"].to_numpy(), table["raw"].to_numpy()
    if not counts[0].any():
        return np.zeros(BUCKETS)
    shares = (counts + smoothing) / (counts.sum(1, keepdims=True) + smoothing * BUCKETS)
    return np.log(shares[0] / shares[1])


def kth_largest(rows: DataFrame, key: str, k: int) -> int | None:
    """The k-th largest value of a bigint column; None if there are fewer rows or k is 0."""
    prefix, left = None, k
    for bits in (48, 32, 16, 0):
        here = rows if prefix is None else rows.where(F.shiftright(key, bits + 16) == prefix)
        groups = here.groupBy(F.shiftright(key, bits).alias("p")).count().collect()  # 65,536 at most
        for p, n in sorted(((r["p"], r["count"]) for r in groups), reverse=True):
            if left <= n:
                prefix = p
                break
            left -= n
        else:
            return None
    return prefix if k > 0 else None


def resampled(
    docs: DataFrame,
    labels: DataFrame,
    good: str = "quality = 1 AND toxic = 0",
    share: float = 0.85,
    target_docs: int = 20_000,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per row: doc_id, log_weight, sample_key (order of the draw), kept (among the ``share`` of all rows drawn)."""
    spark = docs.sparkSession
    ids = labels.where(good).where(F.col(id_col).isNotNull()).select(id_hash(F.col(id_col)).alias("id")).distinct()
    ids = [r["id"] for r in ids.orderBy("id").limit(target_docs).collect()]  # the least hashes: a draw by id
    shared = spark.sparkContext.broadcast(log_ratios(docs, ids, id_col, text_col))

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ratio = shared.value
        for batch in batches:
            weight = np.array([sum(float(ratio[x].sum()) for x in features(t)) for t in texts_of(batch.column(2))], np.float64)
            uniform = (batch.column(1).to_numpy().view(np.uint64).astype(np.float64) + 0.5) / 2.0**64
            drawn = weight - np.log(-np.log(np.clip(uniform, 1e-300, 1 - 2.0**-53)))
            bits = (drawn + 0.0).view(np.int64)
            ordered = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits)  # ascending with the value
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.round(weight, 6)), pa.array(ordered)], names=["doc_id", "log_weight", "sample_key"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(F.col(id_col), F.lit(seed)).alias("noise"), F.col(text_col).cast("string").alias("text"))
    drawn = Scratch(spark, "resample").keep(rows.mapInArrow(weigh, f"doc_id {type_of(rows, 'doc_id')}, log_weight double, sample_key bigint"))
    least = kth_largest(drawn, "sample_key", round(share * drawn.count()))
    return drawn.withColumn("kept", F.lit(False) if least is None else F.col("sample_key") >= least)
