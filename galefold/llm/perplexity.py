"""Quality rules: counted text features, and perplexity bands of a character model.

The model is interpolated modified Kneser-Ney over 4-grams of folded characters (chars.folded), one model
a language. It tells what good text of a language looks like, so it is fitted on the texts that pass the
counted rules and hold few symbols (``reference``); all texts are scored. Spark counts every 4-gram of these
texts; lower orders use continuation counts, derived from the distinct n-grams of the order above. Three
discounts a language and order come from the counts of counts. The finished model is kept as sorted hash
arrays: 63-bit keys of language and n-gram (a perfect hash, so no two n-grams share one), with their
log-probabilities, or, for contexts, their back-off weights. An n-gram that isn't there always backs off.

Size: an order keeps at most ``ENTRIES`` n-grams in arrays, so the seven arrays have 12 bytes for each of
7 * 2**21 entries at most (176 MB) whatever the corpus, and may be broadcast. ``thresholds`` shares the entries
out by language, the most seen first; languages with few n-grams keep all. Where some don't fit, ``Whole`` has
every n-gram in tables: the 4-grams at hand are scored from an array with their exact probabilities, all others
by joins, so scores never depend on ``ENTRIES``. (The arrays alone are a model too: there the probability of
what they leave out goes to the back-off of its context. Scores don't use it then.)

A text's score is its mean negative log-probability a character. Fences of each language come from the
exact histogram of the scores of the reference texts: the quartiles, moved out by ``spread`` interquartile
ranges (of one bin at least, the histogram's resolution). Texts outside are rejected, and so are texts of a
language without a reference text.

Languages: the primary subtag of the language column (two or three letters), else ``und``; so there are
18,279 groups at most. Texts of a group that too few others belong to lie within their own fences.
Edge cases: a null or empty text has no words, fails the base rules and has no score. Texts over a
million characters are read in pieces of that length, each with an empty context. Extra columns are
ignored. Repeated rows count each time. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from galefold.llm.chars import blocks, folded, points, sums
from galefold.llm.shared import Scratch, text_slices, type_of

ORDER = 4
SYMBOL = 12  # bits
ENTRIES = 1 << 21  # of an order
MOST_SYMBOLS = 0.01  # of a reference text's characters
BIN = 0.005  # nats, of the histogram of scores
FEATURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, log_ppl double"
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\v\f\r"


def language(column: Column) -> Column:
    """15-bit number of a language's primary subtag; 0 for none."""
    tag = F.regexp_extract(F.lower(column.cast("string")), r"^([a-z]{2,3})([-_].*)?$", 1)
    value = F.lit(0)
    for i in (1, 2, 3):
        letter = F.substring(tag, i, 1)
        value = value * 27 + F.when(letter == "", 0).otherwise(F.ascii(letter) - 96)
    return F.coalesce(F.when(tag == "", 0).otherwise(value), F.lit(0)).cast("int")


def gram_keys(pieces: list[str], languages: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the 4-grams that end at each character (language, then four symbols; 0 before the text), and where texts begin.

    Runs of white space are one symbol.
    """
    symbols = folded()[points(pieces)]
    lengths = np.array([len(p) for p in pieces])
    owner = np.repeat(np.arange(len(pieces)), lengths)
    keep = np.ones(len(symbols), bool)
    keep[1:] = ~((symbols[1:] == 1) & (symbols[:-1] == 1) & (owner[1:] == owner[:-1]))
    symbols, owner = symbols[keep], owner[keep]
    padded = np.zeros(len(symbols) + (ORDER - 1) * len(pieces) + ORDER, np.uint64)
    at = np.arange(len(symbols)) + (ORDER - 1) * (owner + 1)
    padded[at] = symbols
    grams = padded[ORDER - 1 :].copy()
    for i in range(1, ORDER):
        grams |= padded[ORDER - 1 - i : -i] << np.uint64(SYMBOL * i)
    keys = grams[at - (ORDER - 1)] | (languages[owner].astype(np.uint64) << np.uint64(SYMBOL * ORDER))
    held = np.bincount(owner, minlength=len(pieces))
    return keys, np.cumsum(held) - held


def counted(docs: DataFrame, text_col: str, lang_col: str, chosen: Callable[[str], bool] | None = None) -> DataFrame:
    """(key, c): how often each 4-gram of each language occurs in all texts, or in all that are ``chosen``."""

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        keys, n = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(keys, kind="stable")
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
        return keys[first], sums(n, first)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for batch in batches:
            langs = batch.column(1).to_numpy()
            for lo, texts in text_slices(batch.column(0)):
                texts = [x if x and (chosen is None or chosen(x)) else "" for x in texts]
                for at, pieces, _ in blocks(texts):
                    keys = np.sort(gram_keys(pieces, langs[lo:][at])[0])
                    if len(keys):
                        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
                        parts.append((keys[first], np.diff(np.append(first, len(keys)))))
                    if sum(len(x) for x, _ in parts) > 1_000_000:
                        parts = [merged(parts)]
        if parts:
            keys, n = merged(parts)
            for i in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(keys[i : i + 100_000].view(np.int64)), pa.array(n[i : i + 100_000])], names=["key", "c"])

    rows = docs.select(F.col(text_col).cast("string").alias("text"), language(F.col(lang_col)).alias("lang")).where("text <> ''")
    return rows.mapInArrow(count, "key bigint, c bigint").groupBy("key").agg(F.sum("c").alias("c"))


def shortened(key: Column, symbols: int) -> Column:
    """The language of a key with its last so many symbols."""
    bits = SYMBOL * ORDER
    return F.shiftleft(F.shiftright(key, bits), bits).bitwiseOR(key.bitwiseAND(F.lit((1 << SYMBOL * symbols) - 1)))


def context(key: Column, order: int) -> Column:
    """The language of a key with the symbols before its last one."""
    bits = SYMBOL * ORDER
    return F.shiftleft(F.shiftright(key, bits), bits).bitwiseOR(F.shiftright(key.bitwiseAND(F.lit((1 << SYMBOL * order) - 1)), SYMBOL))


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts for n-grams seen once, twice and more often."""
    y = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
    raw = (1 - 2 * y * n2 / n1 if n1 else 0.5, 2 - 3 * y * n3 / n2 if n2 else 1.0, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(x, 0.05), k - 0.05) for k, x in enumerate(raw, 1))


class Table:
    """Sorted keys with their values, and a hash table of the keys (one of those that share a slot) for direct access."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values = keys[order].astype(np.uint64), values[order].astype(np.float32)
        self.direct: tuple[np.ndarray, np.ndarray] | None = None

    def __getstate__(self) -> dict:
        return {"keys": self.keys, "values": self.values, "direct": None}

    def slots(self, keys: np.ndarray) -> np.ndarray:
        bits = max(1, int(len(self.keys)).bit_length())
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int64)

    def found(self, keys: np.ndarray) -> np.ndarray:
        """The values of ``keys``; NaN for those that aren't there."""
        if not len(self.keys):
            return np.full(len(keys), np.nan)
        if self.direct is None:
            at = np.zeros(1 << max(1, int(len(self.keys)).bit_length()), np.int32)
            at[self.slots(self.keys)] = np.arange(len(self.keys), dtype=np.int32)
            self.direct = self.keys[at], self.values[at]
        slots = self.slots(keys)
        out = np.where(self.direct[0][slots] == keys, self.direct[1][slots], np.nan).astype(np.float64)
        rest = np.flatnonzero(np.isnan(out))
        if len(rest):
            at = np.minimum(np.searchsorted(self.keys, keys[rest]), len(self.keys) - 1)
            out[rest] = np.where(self.keys[at] == keys[rest], self.values[at], np.nan)
        return out


@dataclass
class Whole:
    """All n-grams by order in tables (key, p), their contexts (ctx, g), and the log-probabilities of the 4-grams at hand."""

    top: Table
    grams: dict[int, DataFrame]
    weights: dict[int, DataFrame]
    scratch: Scratch

    def probabilities(self, keys: DataFrame, order: int = ORDER) -> DataFrame:
        """(key, p) of distinct n-grams of an order; a key of any join here has 4096 rows at most."""
        if not order:
            return keys.select("key", F.lit(2.0**-SYMBOL).alias("p"))
        seen = self.scratch.keep(keys.join(self.grams[order], "key", "left"))
        rest = seen.where("p IS NULL").select("key", context(F.col("key"), order).alias("ctx"), shortened(F.col("key"), order - 1).alias("short"))
        lower = self.probabilities(rest.select(F.col("short").alias("key")).distinct(), order - 1).select(F.col("key").alias("short"), "p")
        backed = rest.join(self.weights[order], "ctx", "left").join(lower, "short").select("key", (F.coalesce("g", F.lit(1.0)) * F.col("p")).alias("p"))
        return seen.where("p IS NOT NULL").union(backed)


@dataclass
class Model:
    """By order: log-probabilities of n-grams, and back-off weights of their contexts; ``whole`` if these aren't all."""

    grams: dict[int, Table]
    weights: dict[int, Table]
    whole: Whole | None = None

    def log_p(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Log-probability of the last symbol of each key; n-grams that aren't kept back off."""
        if not order:
            return np.full(len(keys), -SYMBOL * np.log(2.0))
        bits = np.uint64(SYMBOL * ORDER)
        lang = (keys >> bits) << bits
        symbols = keys & np.uint64((1 << SYMBOL * order) - 1)
        out = self.grams[order].found(lang | symbols)
        rest = np.flatnonzero(np.isnan(out))
        if len(rest):
            weight = self.weights[order].found(lang[rest] | (symbols[rest] >> np.uint64(SYMBOL)))
            out[rest] = np.log(np.where(np.isnan(weight), 1.0, weight)) + self.log_p(keys[rest], order - 1)
        return out


def thresholds(tallies: list[tuple[int, int, int]], most: int) -> dict[int, int]:
    """The least count of a kept n-gram for each language, from (language, floor of the count's binary logarithm, n-grams).

    ``most`` n-grams are shared out evenly; what a language doesn't need goes to the others.
    """
    held: dict[int, dict[int, int]] = {}
    for lang, power, n in tallies:
        held.setdefault(lang, {})[power] = n
    left, out = most, {}
    for i, (lang, powers) in enumerate(sorted(held.items(), key=lambda x: (sum(x[1].values()), x[0]))):
        own = left // (len(held) - i)
        kept, least = 0, 62
        for power in sorted(powers, reverse=True):
            if kept + powers[power] > own:
                break
            kept, least = kept + powers[power], power
        out[lang] = 1 if least == min(powers) else 1 << least
        left -= kept
    return out


def trained(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", entries: int = ENTRIES, chosen: Callable[[str], bool] | None = None) -> Model:
    """The model of the texts of ``docs``, or of those that are ``chosen``."""
    spark = docs.sparkSession
    scratch = Scratch(spark, "perplexity")
    grams = {ORDER: scratch.keep(counted(docs, text_col, lang_col, chosen))}
    for k in range(ORDER - 1, 0, -1):
        grams[k] = scratch.keep(grams[k + 1].groupBy(shortened(F.col("key"), k).alias("key")).agg(F.count("*").alias("c")))
    lang = F.shiftright("key", SYMBOL * ORDER).cast("int")
    model, every, complete = Model({}, {}), {}, True
    for k in range(1, ORDER + 1):
        power = F.floor(F.log2("c")).cast("int")
        tallies = grams[k].groupBy(lang.alias("lang"), power.alias("power")).agg(F.count("*").alias("n"), *[F.count_if(F.col("c") == i).alias(f"n{i}") for i in (1, 2, 3, 4)]).collect()  # 18,279 languages by 63 at most
        least = thresholds([(r["lang"], r["power"], r["n"]) for r in tallies], entries)
        complete = complete and all(x == 1 for x in least.values())
        counts = {x: [0, 0, 0, 0] for x in least}
        for r in tallies:
            counts[r["lang"]] = [a + r[f"n{i}"] for i, a in enumerate(counts[r["lang"]], 1)]
        rows = [(x, least[x], *discounts(*counts[x])) for x in least]
        off = spark.createDataFrame(rows, "lang int, least bigint, d1 double, d2 double, d3 double")
        own = grams[k].join(F.broadcast(off), lang == F.col("lang"))  # a row for each of 18,279 languages at most
        taken = F.when(F.col("c") == 1, F.col("d1")).when(F.col("c") == 2, F.col("d2")).otherwise(F.col("d3"))
        stays = F.col("c") >= F.col("least")
        own = own.select("key", "c", context(F.col("key"), k).alias("ctx"), (F.col("c") - taken).alias("rest"), stays.alias("stays"))
        every[k] = own
        # What the kept n-grams of a context leave of its mass, discounts and pruned ones together, is its weight.
        around = own.groupBy("ctx").agg(F.sum("c").alias("total"), F.sum(F.when(F.col("stays"), F.col("rest"))).alias("held")).where("held IS NOT NULL")
        around = scratch.keep(around.select("ctx", "total", (1 - F.col("held") / F.col("total")).alias("g")))
        share = own.where("stays").join(around, "ctx").select("key", (F.col("rest") / F.col("total")).alias("share"), "g")
        kept, contexts = share.toArrow(), around.select("ctx", "g").toArrow()  # ``entries`` rows at most
        model.weights[k] = Table(contexts["ctx"].to_numpy().view(np.uint64), contexts["g"].to_numpy())
        keys = kept["key"].to_numpy().view(np.uint64)
        lower = np.concatenate([np.exp(model.log_p(keys[i : i + (1 << 20)], k - 1)) for i in range(0, len(keys), 1 << 20)] or [np.empty(0)])
        model.grams[k] = Table(keys, np.log(kept["share"].to_numpy() + kept["g"].to_numpy() * lower))
    if not complete:
        model.whole = whole(every)
    scratch.drop()
    return model


def whole(every: dict[int, DataFrame]) -> Whole:
    """Exact probabilities of the n-grams ``every`` order has (key, c, ctx, rest, stays)."""
    scratch = Scratch(every[1].sparkSession, "whole")
    grams: dict[int, DataFrame] = {}
    weights: dict[int, DataFrame] = {}
    for k in range(1, ORDER + 1):
        around = scratch.keep(every[k].groupBy("ctx").agg(F.sum("c").alias("total"), (1 - F.sum("rest") / F.sum("c")).alias("g")))
        own = every[k].join(around, "ctx").select("key", "stays", (F.col("rest") / F.col("total")).alias("share"), "g", shortened(F.col("key"), k - 1).alias("short"))
        lower = grams[k - 1].select(F.col("key").alias("short"), F.col("p").alias("lower")) if k > 1 else None
        own = own.join(lower, "short") if k > 1 else own.withColumn("lower", F.lit(2.0**-SYMBOL))
        found = scratch.keep(own.select("key", (F.col("share") + F.col("g") * F.col("lower")).alias("p"), "stays"))
        grams[k], weights[k] = found.select("key", "p"), around.select("ctx", "g")
    top = found.where("stays").select("key", F.log("p").alias("p")).toArrow()  # ``entries`` rows at most
    return Whole(Table(top["key"].to_numpy().view(np.uint64), top["p"].to_numpy()), grams, weights, scratch)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in 3-word windows found twice or more."""
    if len(words) < 4:
        return 0
    known: dict[bytes, int] = {}
    ids = np.array([known.setdefault(w, len(known)) for w in words], np.int64)
    wide = len(known)
    if wide >= 1 << 20:  # so that three numbers still fit into 63 bits
        pairs = np.unique(ids[:-1] * wide + ids[1:], return_inverse=True)[1]
        windows = pairs[:-1] * wide + ids[2:]
    else:
        windows = (ids[:-2] * wide + ids[1:-1]) * wide + ids[2:]
    _, which, n = np.unique(windows, return_inverse=True, return_counts=True)
    if len(n) == len(windows):
        return 0
    again = n[which] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : len(words) - 2 + i] |= again
    return int(covered.sum())


def features(text: str | None) -> tuple[int, int, int, int, int, bool]:
    """The counted rules of one text."""
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    seen: set[str] = set()
    repeated = 0
    for line in text.split("\n"):
        if line.strip(BLANKS):
            if line in seen:
                repeated += 1
            seen.add(line)
    n, again = len(words), repeat_words(words)
    return n, len(text) - sum(map(text.count, BLANKS)), sum(map(text.count, SYMBOLS)), repeated, again, n < 50 or 100 * again > 50 * n


def reference(text: str) -> bool:
    """Whether a text is one of those that the model and the fences are fitted on."""
    counts = features(text)
    return not counts[5] and counts[2] <= MOST_SYMBOLS * counts[1]


def references(scores: DataFrame) -> DataFrame:
    """The rows of ``scores`` that are reference texts."""
    return scores.where(~F.col("base_failed") & (F.col("n_symbols") <= MOST_SYMBOLS * F.col("word_chars")))


def mean_costs(model: Model, texts: list[str], langs: np.ndarray) -> np.ndarray:
    """Mean negative log-probability a character; NaN for empty texts."""
    total, n = np.zeros(len(texts)), np.zeros(len(texts))
    for at, pieces, _ in blocks(texts):
        keys, starts = gram_keys(pieces, langs[at])
        total[at] -= sums(model.log_p(keys), starts)
        n[at] += np.diff(np.append(starts, len(keys)))
    with np.errstate(invalid="ignore"):
        return np.where(n > 0, total / np.maximum(n, 1), np.nan)


def partly(top: Table, texts: list[str], langs: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[pa.Array]]:
    """Of each text: the costs of its 4-grams in ``top``, its characters, and lists of its other 4-grams and how often each occurs."""
    total, n = np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    owners, others = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for at, pieces, _ in blocks(texts):
        keys, starts = gram_keys(pieces, langs[at])
        held = np.diff(np.append(starts, len(keys)))
        costs = top.found(keys)
        absent = np.isnan(costs)
        total[at] -= sums(np.where(absent, 0.0, costs), starts)
        n[at] += held
        owners.append(np.repeat(np.array(at, np.int64), held)[absent])
        others.append(keys[absent])
    owner, other = np.concatenate(owners), np.concatenate(others)
    order = np.lexsort((other, owner))
    owner, other = owner[order], other[order]
    first = np.flatnonzero(np.append(True, (owner[1:] != owner[:-1]) | (other[1:] != other[:-1]))[: len(owner)])
    offsets = pa.array(np.searchsorted(owner[first], np.arange(len(texts) + 1)).astype(np.int32))
    times = np.diff(np.append(first, len(owner)))
    return total, n, [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (other[first].view(np.int64), times)]


def completed(scores: DataFrame, of: Whole, cost: str) -> DataFrame:
    """``scores`` with the mean cost in ``cost``, where so far is the sum for the 4-grams at hand; the others join their probabilities."""
    scores = of.scratch.keep(scores.withColumn("__gf_row", F.monotonically_increasing_id()))
    asked = scores.select("__gf_row", F.explode(F.arrays_zip("__gf_keys", "__gf_times")).alias("x")).select("__gf_row", F.col("x.__gf_keys").alias("key"), F.col("x.__gf_times").alias("times"))
    costs = of.scratch.keep(of.probabilities(asked.select("key").distinct()))
    more = asked.join(costs, "key").groupBy("__gf_row").agg(F.sum(-F.log("p") * F.col("times")).alias("__gf_more"))
    mean = F.when(F.col("__gf_n") > 0, (F.col(cost) + F.coalesce("__gf_more", F.lit(0.0))) / F.col("__gf_n"))
    return scores.join(more, "__gf_row", "left").withColumn(cost, mean).drop("__gf_row", "__gf_more", "__gf_n", "__gf_keys", "__gf_times")


def scored(docs: DataFrame, model: Model, text_col: str, lang_col: str, keep: list[str], mark: str = "") -> DataFrame:
    """The columns ``keep`` of each row, and lang_code, the features, log_ppl, with ``mark`` before their names."""
    of = model.whole
    shared = docs.sparkSession.sparkContext.broadcast(of.top if of else model)
    partial = of is not None
    names = [mark + x.split()[0] for x in ("lang_code int", *FEATURES.split(", "))]
    more = ["__gf_n", "__gf_keys", "__gf_times"] if partial else []

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, rows, costs, lists = batch.column(len(keep)).to_numpy(), [], [np.empty(0)], []
            for lo, texts in text_slices(batch.column(len(keep) + 1)):
                rows += [features(x) for x in texts]
                own = [x or "" for x in texts], langs[lo : lo + len(texts)]
                if partial:
                    total, n, pairs = partly(shared.value, *own)
                    costs.append(total)
                    lists.append([pa.array(n), *pairs])
                else:
                    costs.append(mean_costs(shared.value, *own))
            columns = list(zip(*rows, strict=True)) or [()] * 6
            kinds = [pa.int64()] * 5 + [pa.bool_()]
            found = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)] + [pa.array(np.concatenate(costs), pa.float64(), from_pandas=True)]
            if partial:
                found += [pa.concat_arrays(x) for x in zip(*lists, strict=True)] or [pa.array([], k) for k in (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep) + 1], *found], names=[*batch.schema.names[: len(keep)], *names, *more])

    rows = docs.select(*[F.col(f"`{c}`") for c in keep], language(F.col(lang_col)).alias("__gf_lang"), F.col(text_col).cast("string").alias("__gf_text"))
    kinds = ", ".join([f"`{c}` {type_of(docs, c)}" for c in keep] + [f"`{n}` {k}" for n, k in zip(names, ("int", *[x.split()[1] for x in FEATURES.split(", ")]), strict=True)])
    if of is None:
        return rows.mapInArrow(score, kinds)
    return completed(rows.mapInArrow(score, kinds + ", __gf_n bigint, __gf_keys array<bigint>, __gf_times array<bigint>"), of, f"{mark}log_ppl")


def written(scores: DataFrame, model: Model) -> DataFrame:
    """``scores`` as written to the shared folder; the tables of ``model`` go."""
    out = Scratch(scores.sparkSession, "scored").keep(scores)
    if model.whole:
        model.whole.scratch.drop()
    return out


def fences(scores: DataFrame, spread: float = 3.0) -> dict[int, tuple[float, float]]:
    """Lower and upper bound of log_ppl for each language, from the exact histogram of the texts that pass the base rules."""
    bins = scores.where("NOT base_failed AND log_ppl IS NOT NULL").groupBy("lang_code", F.floor(F.col("log_ppl") / BIN).cast("int").alias("bin")).count()
    held: dict[int, list[tuple[int, int]]] = {}
    for r in bins.collect():
        held.setdefault(r["lang_code"], []).append((r["bin"], r["count"]))
    out = {}
    for lang, pairs in held.items():
        pairs.sort()
        places, n = np.array(pairs).T
        upto = np.cumsum(n)
        low, high = (BIN * (places[np.searchsorted(upto, q * upto[-1])] + 0.5) for q in (0.25, 0.75))
        reach = spread * max(BIN, high - low)
        out[lang] = (float(low - reach), float(high + reach))
    return out


def bounded(scores: DataFrame, mark: str = "") -> DataFrame:
    """``scores`` with ``kept``: within the fences of their language and past the base rules."""
    plain = scores.select(*[F.col(f"`{mark}{c}`").alias(c) for c in ("lang_code", "base_failed", "n_symbols", "word_chars", "log_ppl")])
    bounds = scores.sparkSession.createDataFrame([(k, *v) for k, v in fences(references(plain)).items()], f"`{mark}lang_code` int, __gf_low double, __gf_high double")
    joined = scores.join(F.broadcast(bounds), f"{mark}lang_code", "left")  # a row for each of 18,279 languages at most
    inside = F.coalesce(F.col(f"{mark}log_ppl").between(F.col("__gf_low"), F.col("__gf_high")), F.lit(False))
    return joined.withColumn(f"{mark}kept", ~F.col(f"{mark}base_failed") & inside).drop("__gf_low", "__gf_high")


def judged(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, the features, log_ppl, kept."""
    model = trained(docs, text_col, lang_col, chosen=reference)
    scores = scored(docs, model, text_col, lang_col, [id_col]).withColumnRenamed(id_col, "doc_id")
    return bounded(written(scores, model)).drop("lang_code")


def base_sql() -> str:
    """The counted rules in DuckDB's SQL: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    return r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, text, regexp_extract_all(text, '[^ 	-
]+') AS words FROM d),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
ln AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM l WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id),
p AS (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS at_word FROM w WHERE len(words) >= 3),
g AS (SELECT doc_id, at_word, array_to_string(words[at_word:at_word + 2], ' ') AS win FROM p),
r AS (SELECT doc_id, at_word FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, win) >= 2),
c AS (SELECT doc_id, count(DISTINCT at_word + o) AS n_repeat_words FROM r, range(3) t(o) GROUP BY doc_id),
a AS (SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN ln USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a
"""


def passed(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass; they are written once with their scores, so no text is scored twice, or shuffled while the model fits into its arrays."""
    mark = "__gf_"
    model = trained(docs, text_col, lang_col, chosen=reference)
    scores = scored(docs, model, text_col, lang_col, docs.columns, mark)
    return bounded(written(scores, model), mark).where(f"`{mark}kept`").select(*[F.col(f"`{c}`") for c in docs.columns])
