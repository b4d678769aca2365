"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the 1- to 3-grams of letters (other characters become one blank) of labelled texts in
``buckets`` hash buckets a language. The log-probability matrix is broadcast; its size is bounded by
``MATRIX_BYTES``, since the number of buckets halves until all languages fit. Scoring treats a batch as
sparse rows: bucket ids of all n-grams in document order, gathered per language and summed by document.

Training counts every labelled text that isn't held out, whole, and every row is predicted: what stays is a
bounded number of counts, so more texts need no more memory.

Edge cases: a null text or one without a letter is ``und`` with score 0, and so is every text if nothing
could be learnt. Languages that tie go to the first in alphabetical order. Rows with a null language
or null id teach nothing. Languages have equal priors: what a corpus holds most says nothing of a single
text. A language column with more than ``MOST_LANGUAGES`` values is an error (ValueError), as the matrix couldn't
hold 256 buckets for each. Repeated rows are predicted alike; an empty table gives an empty one. Extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galefold.llm.chars import blocks, letters, points, sums
from galefold.llm.shared import text_slices, type_of

ORDERS = (1, 2, 3)
MATRIX_BYTES = 64 << 20
UNKNOWN = "und"
MOST_LANGUAGES = 1 << 15


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_p: np.ndarray  # a row for each language, a column for each bucket, and a last column of zeros


def buckets_for(languages: int, most: int = 1 << 16) -> int:
    while most > 256 and 8 * most * languages > MATRIX_BYTES:
        most //= 2
    return most


def grams(pieces: list[str], buckets: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Bucket ids of the n-grams ending at each symbol, a list item an order; starts of the texts; their letters.

    Runs of non-letters are one blank, and each text begins with one. Ids of n-grams that would reach into
    the text before are ``buckets``, a column without weight.
    """
    marked = points([" " + p for p in pieces])
    low = letters()[marked]
    lengths = np.array([len(p) + 1 for p in pieces])
    starts = np.cumsum(lengths) - lengths
    blank = low == 0
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[starts] = True
    n_letters = sums((~blank).astype(np.int64), starts)
    new_starts = (np.cumsum(keep) - keep)[starts]
    codes = low[keep].astype(np.uint64)
    since = np.arange(len(codes)) - np.repeat(new_starts, np.diff(np.append(new_starts, len(codes))))
    out, key = [], np.zeros(len(codes), np.uint64)
    shift = np.uint64(64 - (buckets.bit_length() - 1))
    for n in ORDERS:
        key[n - 1 :] |= codes[: len(codes) - n + 1] << np.uint64(21 * (n - 1))
        ids = (((key + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)) >> shift).astype(np.int32)
        ids[since < n - 1] = buckets
        if n == 1:
            ids[codes == 0] = buckets
        out.append(ids)
    return out, new_starts, n_letters


def fit(labelled: DataFrame, text_col: str, lang_col: str, id_col: str, alpha: float = 0.5) -> Model:
    """Learn from all rows of ``labelled`` that have a text, a language and an id."""
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("id IS NOT NULL AND lang IS NOT NULL")
    languages = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    if not languages:
        return Model([], np.zeros((0, 1)))
    if len(languages) > MOST_LANGUAGES:
        raise ValueError(f"{lang_col} has {len(languages)} values; at most {MOST_LANGUAGES} can be told apart")
    buckets = buckets_for(len(languages))
    code = {x: i for i, x in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for lo, texts in text_slices(batch.column(0)):
                for at, pieces, _ in blocks([x or "" for x in texts]):
                    ids, starts, _ = grams(pieces, buckets)
                    spans = np.diff(np.append(starts, len(ids[0])))
                    owner = np.repeat(np.array([code[langs[lo + i]] for i in at]), spans)
                    for k in np.unique(owner):
                        mine = owner == k
                        own = total.setdefault(int(k), np.zeros(buckets + 1, np.int64))
                        for x in ids:
                            own += np.bincount(x[mine], minlength=buckets + 1)
        for k, own in total.items():
            found = np.flatnonzero(own[:-1])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), k, np.int32)), pa.array(found.astype(np.int32)), pa.array(own[found])], names=["lang", "bucket", "n"])

    counted = rows.select("text", "lang").mapInArrow(count, "lang int, bucket int, n bigint")
    table = counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros((len(languages), buckets))
    counts[table["lang"].to_numpy(), table["bucket"].to_numpy()] = table["n"].to_numpy()
    log_p = np.log((counts + alpha) / (counts.sum(1, keepdims=True) + alpha * buckets))
    return Model(languages, np.hstack([log_p, np.zeros((len(languages), 1))]))


def predicted(docs: DataFrame, model: Model, text_col: str, keep: list[str], names: tuple[str, str] = ("lang_pred", "score"), fit: tuple[str, str] | None = None) -> DataFrame:
    """The columns ``keep`` of each row, the predicted language and its posterior probability (0 to 1).

    With ``fit``, two more columns of these names: the mean log-probability of an n-gram in that language
    (null without n-grams), and how many letters the text has.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = keep if text_col in keep else [*keep, text_col]
    at_text, pred, value = columns.index(text_col), *names

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        labels = np.array([*model.languages, UNKNOWN], object)
        wide = model.log_p.shape[1] - 1
        for batch in batches:
            n = batch.num_rows
            total = np.zeros((len(model.languages), n))
            seen, n_grams = np.zeros(n, np.int64), np.zeros(n, np.int64)
            for lo, texts in text_slices(batch.column(at_text)) if model.languages else ():
                for of_slice, pieces, _ in blocks([x or "" for x in texts]):
                    at = lo + np.array(of_slice)
                    ids, starts, n_letters = grams(pieces, wide)
                    seen[at] += n_letters
                    if fit:
                        for x in ids:
                            n_grams[at] += sums((x != wide).astype(np.int64), starts)
                    for k, row in enumerate(model.log_p):
                        for x in ids:
                            total[k, at] += sums(row[x], starts)
            best = np.full(n, len(model.languages))
            sure, mean = np.zeros(n), np.full(n, np.nan)
            if model.languages and n:
                known = n_grams > 0
                mean[known] = total.max(0)[known] / n_grams[known]
                # The orders tell of the same letters, so their evidence counts once.
                total /= len(ORDERS)
                top, posterior = total.argmax(0), 1 / np.exp(total - total.max(0)).sum(0)
                best[seen > 0], sure[seen > 0] = top[seen > 0], posterior[seen > 0]
            more = [pa.array(mean, pa.float64(), from_pandas=True), pa.array(seen)] if fit else []
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array(labels[best].tolist(), pa.string()), pa.array(np.round(sure, 6)), *more],
                names=[*batch.schema.names[: len(keep)], pred, value, *(fit or ())],
            )

    kinds = ", ".join(f"`{c}` {type_of(docs, c)}" for c in keep)
    return docs.select(*[F.col(f"`{c}`") for c in columns]).mapInArrow(score, f"{kinds}, `{pred}` string, `{value}` double" + (f", `{fit[0]}` double, `{fit[1]}` bigint" if fit else ""))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, keep: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **settings: float) -> DataFrame:
    """Fit on the rows that aren't held out, and predict every row."""
    model = fit(docs.where(~held_out(id_col)), text_col, lang_col, id_col, **settings)
    return predicted(docs, model, text_col, keep or [id_col])


def ranges(docs: DataFrame, model: Model, text_col: str, lang_col: str, id_col: str) -> list[tuple[str, float, float]]:
    """(language, least mean log-probability of its texts, spread of a single n-gram), from all labelled texts that training never saw.

    The least is the texts' median less one spread: junk in a language stays in it, another language or noise
    lies lower. A language with under 8 such texts takes the mean of its own n-grams for the median.
    """
    rows = docs.where(held_out(id_col)).where(F.col(lang_col).isNotNull()).select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    own = predicted(rows, model, "text", ["lang"], ("pred", "score"), ("mean", "letters")).where("lang = pred AND mean IS NOT NULL")
    bins = own.groupBy("lang", F.floor(F.col("mean") / 0.01).cast("int").alias("bin")).count()
    held: dict[str, list[tuple[int, int]]] = {}
    for r in bins.collect():
        held.setdefault(r["lang"], []).append((r["bin"], r["count"]))
    out = []
    for name, log_p in zip(model.languages, model.log_p, strict=True):
        p = np.exp(log_p[:-1])
        mean = float((p * log_p[:-1]).sum())
        deviation = float(np.sqrt(max(0.0, (p * log_p[:-1] ** 2).sum() - mean**2)))
        pairs = sorted(held.get(name, []))
        if sum(n for _, n in pairs) >= 8:
            places, n = np.array(pairs).T
            upto = np.cumsum(n)
            mean = float(0.01 * (places[np.searchsorted(upto, 0.5 * upto[-1])] + 0.5))
        out.append((name, mean - deviation, deviation))
    return out


def accepted(docs: DataFrame, least: float = 0.3, z: float = 4.0, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **settings: float) -> DataFrame:
    """The rows of ``docs`` whose language is known with a posterior of at least ``least``, and whose n-grams it explains.

    The posterior only compares the languages learnt. So a text must also have a mean log-probability in the
    range of its language's texts (``ranges``), less ``z`` standard errors of a text of so many letters.
    """
    model = fit(docs.where(~held_out(id_col)), text_col, lang_col, id_col, **settings)
    found = predicted(docs, model, text_col, docs.columns, ("__gf_lang", "__gf_score"), ("__gf_mean", "__gf_letters"))
    fits = F.lit(False)
    for name, low, deviation in ranges(docs, model, text_col, lang_col, id_col):
        fits = F.when(F.col("__gf_lang") == name, F.col("__gf_mean") >= low - z * deviation / F.sqrt("__gf_letters")).otherwise(fits)
    kept = found.where((F.col("__gf_lang") != UNKNOWN) & (F.col("__gf_score") >= least) & F.coalesce(fits, F.lit(False)))
    return kept.drop("__gf_lang", "__gf_score", "__gf_mean", "__gf_letters")
