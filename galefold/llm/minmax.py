"""Near-duplicate classes by min-max hashing.

Every document's distinct word shingles are hashed once per permutation, and both the smallest and
the largest value are kept, so ``permutations`` evaluations give twice as many signature rows. A band
joins rows of different permutations, which keeps its rows independent even for small sets.

* Equal shingle sets are collapsed first (a map-side combined aggregation), so thousands of copies
  cost one row from there on.
* Documents that share a band are candidates. First, every document is held against the smallest
  document of any of its buckets. Then, where buckets with the same smallest document (a group) still hold
  several components, the documents of different components meet. They do so in units of about ``QUERIES`` by
  ``ROWS`` documents, streamed through bounded memory: a unit's queries are held, its rows pass by, and only
  links between components that it hasn't joined yet leave. So no pairs are listed, no group of any size comes
  into one task, and no connection is left out. Rows of a unit carry the hashes of their shingles, not texts.
* Groups of over ``LARGE`` documents pass a prefix filter before: under one order of all shingles (rare ones
  first, by a count in fixed slots; any order is right) two sets that are alike have one of the first
  ``n - ceil(share * n) + 1`` shingles in common. So only documents that share such a shingle meet, by size, and
  only those that can still reach the share from there on: pages that merely share their boilerplate don't.
  Shingles with the same documents are one. Neighbours by size are compared first, for a few rounds.
* Each link is confirmed on the full shingle sets (tuples of words, not hashes).
* Components come from contraction: each round every document adopts the smallest label near it, until so few
  edges are left that the driver can join them.
* Tables that can't have more than ``FEW_ROWS`` rows, by a count of what they are made from, stay with the driver:
  every table that is written costs a file a partition. Larger ones are written.

Edge cases: a null or wordless text has an empty set, 0 shingles and no links; fewer words than the
shingle length make one shingle of the whole sequence. A null id has the component of its equals, or
null, and counts as kept in the latter case. Rows that share an id are one node of the graph.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from galefold.llm import shared as limits
from galefold.llm.shared import Scratch, each_text, type_of

#: So many ids at most are broadcast to the scan of the texts; of more, a filter is.
FEW_IDS = 1_000_000
#: Most bits of that filter, as a power of two (32 MB); it has 16 to 32 bits an id below that.
FILTER_POWER = 28
#: Slots that count shingles for the order of the prefix filter, as a power of two.
COUNT_POWER = 18
#: Documents that a task of the second comparison holds, and that pass it, about.
QUERIES, ROWS = 64, 256
#: Groups of more documents pass the prefix filter first.
LARGE = 256
#: Rounds of comparing neighbours in those, and documents among which neighbours are taken, about.
ROUNDS, NEIGHBOURS = 2, 4096
#: Values that a batch of lists holds, about.
VALUES = 1 << 19


def lowered(text: str) -> bytes:
    """UTF-8 with A-Z lowered."""
    return text.encode("utf-8", "surrogatepass").lower()


def word_hashes(data: bytes, block: int = 1 << 20) -> np.ndarray:
    """64-bit hashes of the words of ``data``, taken block by block."""
    parts, begin = [], 0
    while begin < len(data):
        end = begin + block
        while end < len(data) and data[end] not in b" \t\n\v\f\r":
            end += 1
        found = data[begin:end].split()
        parts.append(np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found)))
        begin = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the ``size``-word shingles; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    size = min(size, len(words))
    total = np.full(len(words) - size + 1, size, np.uint64)
    for i in range(size):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += words[i : len(words) - size + 1 + i]
    total = mixed(total)
    total.sort()
    return total[np.append(True, total[1:] != total[:-1])]


class Signer:
    """Bands of a set of shingle hashes."""

    def __init__(self, permutations: int, rows: int, seed: int = 20):
        if permutations % rows:
            raise ValueError("permutations must be a multiple of rows")
        self.rows = rows
        self.odd = (np.random.default_rng(seed).integers(0, 1 << 32, permutations, np.uint32) | np.uint32(1))[:, None]
        bands = 2 * permutations // rows
        self.salt = mixed(np.arange(1, bands + 1, dtype=np.uint64))

    def bands(self, shingles: np.ndarray) -> np.ndarray:
        low, high = np.full(len(self.odd), 0xFFFFFFFF, np.uint32), np.zeros(len(self.odd), np.uint32)
        short = (shingles >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(short), 2048):  # the products of a slice stay in the cache
            x = self.odd * short[None, i : i + 2048]
            x ^= x >> np.uint32(15)
            np.minimum(low, x.min(1), out=low)
            np.maximum(high, x.max(1), out=high)
        values = np.concatenate([low, high]).reshape(-1, self.rows).astype(np.uint64)
        out = self.salt
        for i in range(self.rows):
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + values[:, i])
        return out.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str, words: int, permutations: int, rows: int) -> DataFrame:
    """(doc_id, n_shingles, set_key, bands) of each row; set_key is a 128-bit digest of the set, null if empty."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(permutations, rows)
        for batch in batches:
            sizes, keys, bands = [], [], []
            for text in each_text(batch.column(1)):
                shingles = shingle_hashes(word_hashes(lowered(text or "")), words)
                sizes.append(len(shingles))
                keys.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                bands.append(signer.bands(shingles) if len(shingles) else np.empty(0, np.int64))
            ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            values = np.concatenate(bands) if bands else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(values))],
                names=["doc_id", "n_shingles", "set_key", "bands"],
            )

    rows_in = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows_in.mapInArrow(sign, f"doc_id {type_of(rows_in, 'doc_id')}, n_shingles bigint, set_key binary, bands array<bigint>")


def word_tuples(text: str | None, size: int) -> set[tuple[bytes, ...]]:
    """The full shingle set, as words."""
    words = lowered(text or "").split()
    return set(zip(*(words[i:] for i in range(size)), strict=False)) if len(words) >= size else {tuple(words)} if words else set()


def alike(a: set, b: set, percent: int) -> bool:
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)) or not a or not b:
        return False
    both = len(a & b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def texts_named(ids: DataFrame, texts: DataFrame) -> DataFrame:
    """The rows of ``texts`` (doc_id, text) whose id is in the column ``id``, found without shuffling texts.

    Few ids, by a count, are broadcast; of more, a filter of bounded size, which lets some others through.
    """
    spark, n = ids.sparkSession, ids.count()
    if n <= FEW_IDS:
        return texts.join(F.broadcast(ids), F.col("doc_id") == F.col("id"), "left_semi")
    power = min(FILTER_POWER, max(15, (16 * n).bit_length()))
    slot = F.shiftrightunsigned(F.xxhash64("id"), 64 - power)
    parts = ids.select(F.shiftright(slot, 15).cast("int").alias("part"), slot.bitwiseAND(F.lit(32767)).alias("at")).groupBy("part").agg(F.bitmap_construct_agg("at").alias("bits"))
    packed = np.zeros((1 << power) // 8, np.uint8)
    for r in parts.collect():  # 4 KB each, 32 MB at most
        packed[4096 * r["part"] : 4096 * (r["part"] + 1)] = np.frombuffer(r["bits"], np.uint8)
    there = spark.sparkContext.broadcast(packed)

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = there.value
        for batch in batches:
            at = batch.column(2).to_numpy()
            yield batch.filter(pa.array((own[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1)).select([0, 1])

    slotted = texts.where("doc_id IS NOT NULL").select("doc_id", "text", F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - power).alias("slot"))
    return slotted.mapInArrow(wanted, f"doc_id {type_of(texts, 'doc_id')}, text string")


def linked_pairs(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """The ``pairs`` (a, b) whose full sets are alike."""
    kind = type_of(texts, "doc_id")
    some = texts_named(pairs.select(F.col("a").alias("id")).union(pairs.select("b")), texts)
    first = pairs.join(some.withColumnsRenamed({"doc_id": "b", "text": "text_b"}), "b")
    both = first.join(some.withColumnsRenamed({"doc_id": "a", "text": "text_a"}), "a").select("a", "b", "text_a", "text_b")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, known = None, set()
        for batch in batches:
            found = []
            for hub, a, b in zip(batch.column(0).to_pylist(), each_text(batch.column(2)), each_text(batch.column(3)), strict=True):
                if (hub, a) != last:
                    last, known = (hub, a), word_tuples(a, words)
                found.append(alike(known, word_tuples(b, words), percent))
            yield batch.select([0, 1]).filter(pa.array(found, pa.bool_()))

    return both.mapInArrow(compare, f"a {kind}, b {kind}")


def hashed_sets(reps: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(rep, shingles): the shingle hashes of the documents named by the column ``rep``; others may be among them."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, begin, held = [], 0, 0
            for i, text in enumerate(each_text(batch.column(1)), 1):
                found.append(shingle_hashes(word_hashes(lowered(text or "")), words).view(np.int64))
                held += len(found[-1])
                if held > VALUES or i == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(begin, i - begin), listed(found)], names=["rep", "shingles"])
                    found, begin, held = [], i, 0

    some = texts_named(reps.select(F.col("rep").alias("id")), texts)
    made = some.mapInArrow(make, f"rep {type_of(texts, 'doc_id')}, shingles array<bigint>")
    # Repeated rows give one set; texts that share an id keep one each.
    return made.withColumn("hash", F.xxhash64("shingles")).dropDuplicates(["rep", "hash"]).select("rep", "shingles")


def listed(items: list[np.ndarray]) -> pa.Array:
    """A list column."""
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, items)]).astype(np.int32)), pa.array(np.concatenate(items)))


def lists(column: pa.Array) -> list[np.ndarray]:
    """The items of a list column."""
    ends, values = column.offsets.to_numpy(), column.values.to_numpy()
    return [values[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def prefixes(sets: DataFrame, percent: int) -> DataFrame:
    """(group, rep, comp, size, token, turn, after): the shingles of which two sets that are alike have one in common; ``sets``: (group, rep, comp, shingles).

    Shingles are in the order of ``turn`` (how often their slot was seen), then of their unsigned value;
    ``after`` is how many of the set come from this one on.
    """
    shift = np.uint64(64 - COUNT_POWER)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << COUNT_POWER, np.int64)
        for batch in batches:
            values = batch.column(0).flatten().to_numpy().view(np.uint64)
            total += np.bincount((values >> shift).astype(np.int64), minlength=1 << COUNT_POWER)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen.astype(np.int32)), pa.array(total[seen])], names=["slot", "n"])

    counted = sets.select("shingles").mapInArrow(count, "slot int, n bigint").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(1 << COUNT_POWER, np.int64)
    often[counted["slot"].to_numpy()] = counted["n"].to_numpy()
    shared = sets.sparkSession.sparkContext.broadcast(often)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, columns, held = [], [[] for _ in range(4)], 0
            for i, own in enumerate(lists(batch.column(3)), 1):
                keys, n = own.view(np.uint64), len(own)
                turns = shared.value[(keys >> shift).astype(np.int64)]
                first = np.lexsort((keys, turns))[: n + percent * n // -100 + 1]
                row.append(np.full(len(first), i - 1))
                for column, part in zip(columns, (np.full(len(first), n), own[first], turns[first], n - np.arange(len(first))), strict=True):
                    column.append(part)
                held += len(first)
                if held > VALUES or i == batch.num_rows:
                    at = pa.array(np.concatenate(row))
                    yield pa.RecordBatch.from_arrays([*[batch.column(k).take(at) for k in range(3)], *[pa.array(np.concatenate(x).astype(np.int64)) for x in columns]], names=["group", "rep", "comp", "size", "token", "turn", "after"])
                    row, columns, held = [], [[] for _ in range(4)], 0

    kinds = ", ".join(f"{c} {type_of(sets, c)}" for c in ("group", "rep", "comp"))
    return sets.select("group", "rep", "comp", "shingles").mapInArrow(cut, f"{kinds}, size bigint, token bigint, turn bigint, after bigint")


def meetings(tokens: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """(meeting, rep, comp, size, after, home): which documents of different components may be alike, by a shingle they share.

    ``tokens``: the ``prefixes`` of contested documents. Documents of a group meet at a shingle, by
    size: two sets that are alike have sizes in the same cell (each as large again by the inverse of the share) or
    neighbouring ones, so each goes to its own (``home``) and the next. At the first shingle that two sets share, they
    have no more in common than either has from there on; who can't reach the share with the smallest
    one there, stays out.
    """
    keyed = scratch.keep(tokens)
    n_keyed = keyed.count()
    crossed = lambda rows, *by: rows.groupBy(*by).agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("size").alias("least")).where("low < high")
    met = keyed.groupBy("group", "token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.min("turn").alias("turn"), F.count("*").alias("n"), *[F.bit_xor(F.xxhash64("rep", F.lit(i))).alias(f"x{i}") for i in (1, 2)])
    # Shingles with the same documents are one: the first of them.
    unsigned = F.col("token").bitwiseXOR(F.lit(-(1 << 63)))
    firsts = scratch.keep(met.where("low < high").groupBy("group", "n", "x1", "x2").agg(F.min_by("token", F.struct("turn", unsigned)).alias("token")).select("group", "token"), n_keyed)
    # A little wider than the share, so that rounding never puts two such sizes further apart.
    cell = F.floor(F.log(F.col("size").cast("double")) / F.lit(max(math.log(100 / percent), 1e-6) * (1 + 1e-6)))
    dealt = keyed.join(firsts, ["group", "token"]).withColumn("cell", cell).withColumn("place", F.explode(F.array("cell", F.col("cell") + 1)))
    dealt = scratch.keep(dealt.select(F.xxhash64("group", "token", "place").alias("meeting"), "rep", "comp", "size", "after", (F.col("place") == F.col("cell")).alias("home")), 2 * n_keyed)
    n_dealt = dealt.count()
    able = dealt.join(scratch.keep(crossed(dealt, "meeting"), n_dealt), "meeting").where(F.col("after") * (100 + percent) >= percent * (F.col("size") + F.col("least")))
    able = scratch.keep(able.drop("low", "high", "least"), n_dealt)
    return scratch.keep(able.join(scratch.keep(crossed(able, "meeting").select("meeting"), n_dealt), "meeting"), n_dealt)


def neighbours(dealt: DataFrame, rows: int, scratch: Scratch) -> DataFrame:
    """(a, b) for each document the one of another component that it is next to, by size, in most meetings; ``rows``: how many ``dealt`` has."""
    sizes = dealt.groupBy("meeting").agg(F.ceil(F.count("*") / NEIGHBOURS).cast("int").alias("blocks"))
    placed = dealt.join(scratch.keep(sizes, rows), "meeting").withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int"))
    w = Window.partitionBy("meeting", "block").orderBy("size", "rep")
    beside = placed.select("rep", "comp", F.lag("rep").over(w).alias("other"), F.lag("comp").over(w).alias("its")).where("comp <> its")
    pairs = beside.groupBy(F.least("rep", "other").alias("a"), F.greatest("rep", "other").alias("b")).agg(F.count("*").alias("n"))
    ends = scratch.keep(pairs, rows).select(F.explode(F.array("a", "b")).alias("rep"), "a", "b", "n")
    best = ends.groupBy("rep").agg(F.max(F.struct("n", "a", "b")).alias("p")).select("p.a", "p.b")
    return scratch.keep(best.distinct(), rows)


def linked_across(members: DataFrame, texts: DataFrame, words: int, percent: int, scratch: Scratch) -> DataFrame:
    """Links (a, b) that join the components of each group; ``members``: (group, rep, comp).

    In large groups, neighbours in the meetings are compared first, for a few rounds, which joins most families at
    the cost of a text a document. Where components meet, the documents outside of the largest one are the
    queries, and meet all the others.
    """
    kind, n_members = type_of(texts, "doc_id"), members.count()
    several = members.groupBy("group").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("held")).where("low < high").select("group", "held")
    contested = scratch.keep(members.join(scratch.keep(several, n_members), "group"), n_members)
    n_dealt = contested.count()
    sets = scratch.keep(hashed_sets(contested.select("rep").distinct(), texts, words))
    # ``after`` is null where a set is compared whole.
    dealt = contested.where(F.col("held") <= LARGE).select(F.xxhash64("group").alias("meeting"), "rep", "comp", F.lit(None).cast("bigint").alias("after"), F.lit(True).alias("home"))
    found = []
    large = contested.where(F.col("held") > LARGE).drop("held")
    if not large.isEmpty():
        apart = meetings(prefixes(scratch.keep(large.join(sets, "rep")), percent), percent, scratch)
        n_apart = apart.count()
        for _ in range(ROUNDS):
            links = scratch.keep(linked_pairs(neighbours(apart, n_apart, scratch), texts, words, percent), n_apart)
            if links.isEmpty():
                break
            found.append(links)
            of = scratch.keep(apart.select("rep", "comp").distinct(), n_apart)
            ends = links.join(of.withColumnsRenamed({"rep": "a", "comp": "u"}), "a").join(of.withColumnsRenamed({"rep": "b", "comp": "v"}), "b")
            moved = components(ends.select("u", "v"), scratch, n_apart).select(F.col("node").alias("comp"), F.col("comp").alias("now"))
            apart, dealt = (x.join(moved, "comp", "left").withColumn("comp", F.coalesce("now", "comp")).drop("now") for x in (apart, dealt))
            apart = scratch.keep(apart, n_apart)
            still = apart.groupBy("meeting").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high").select("meeting")
            apart = scratch.keep(apart.join(scratch.keep(still, n_apart), "meeting"), n_apart)
            n_apart = apart.count()
        dealt, n_dealt = dealt.unionByName(apart.drop("size")), n_dealt + n_apart
    dealt = scratch.keep(dealt, n_dealt)

    parts = dealt.groupBy("meeting", "comp").agg(F.count("*").alias("n"))
    sizes = parts.groupBy("meeting").agg(F.sum("n").alias("n"), F.max("n").alias("most"), F.max_by("comp", F.struct("n", "comp")).alias("largest")).where("most < n")
    shares = sizes.select("meeting", "largest", F.ceil((F.col("n") - F.col("most")) / QUERIES).cast("int").alias("blocks"), F.ceil(F.col("n") / ROWS).cast("int").alias("salts"))
    dealt = dealt.join(scratch.keep(shares, n_dealt), "meeting")
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")).withColumn("salt", F.pmod(F.xxhash64("comp", "rep"), F.col("salts")).cast("int"))
    own = ["rep", "comp", "after", "home"]
    queries = dealt.where("comp <> largest").select("meeting", "block", F.explode(F.expr("sequence(0, salts - 1)")).alias("salt"), F.lit(0).alias("role"), *own)
    passing = dealt.select("meeting", F.explode(F.expr("sequence(0, blocks - 1)")).alias("block"), "salt", F.lit(1).alias("role"), *own)
    held = queries.union(passing).join(sets, "rep").withColumn("size", F.size("shingles").cast("bigint"))
    held = held.select("meeting", "block", "salt", "role", "rep", "comp", "size", F.coalesce("after", "size").alias("after"), "home", "shingles")
    units = held.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "meeting", "block", "salt").sortWithinPartitions("meeting", "block", "salt", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, waiting, figures, joined = None, [], None, {}

        def root(x: int) -> int:
            while (up := joined.get(x, x)) != x:
                joined[x] = x = joined.get(up, up)
            return x

        for batch in batches:
            a, b = [], []
            columns = [batch.column(i).to_pylist() for i in range(9)]
            for *key, role, rep, comp, size, after, home, own in zip(*columns, lists(batch.column(9)), strict=True):
                if key != unit:
                    unit, waiting, figures, joined = key, [], None, {}
                if role == 0:
                    waiting.append((rep, comp, size, after, home, own))
                    continue
                if figures is None:
                    figures = [np.array([w[i] for w in waiting], np.int64) for i in (2, 3, 4)] if waiting else None
                    waiting = [(w[0], w[1], set(w[5].tolist())) for w in waiting]
                    if figures is None:
                        continue
                sizes, afters, homes = figures
                able = np.minimum(afters, after) * (100 + percent) >= percent * (sizes + size)
                able &= (100 * np.minimum(sizes, size) >= percent * np.maximum(sizes, size)) & ((homes == 1) | home)
                near = np.flatnonzero(able)
                mine = set(own.tolist()) if len(near) else set()
                for i in near.tolist():
                    other, its_comp, its = waiting[i]
                    if root(comp) != root(its_comp) and alike(mine, its, percent):
                        joined[root(comp)] = root(its_comp)
                        a.append(min(rep, other))
                        b.append(max(rep, other))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, batch.schema.types[4]), pa.array(b, batch.schema.types[4])], names=["a", "b"])

    rest = scratch.keep(units.mapInArrow(compare, f"a {kind}, b {kind}").distinct())
    every = reduce(DataFrame.union, found, linked_pairs(rest, texts, words, percent))
    return scratch.keep(every, rest.count() + sum(x.count() for x in found))


def joined(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the graph with the edges ``u``, ``v``, and for each the smallest node that it reaches."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b, low = at[: len(u)], at[len(u) :], np.arange(len(nodes))
    while (apart := low[a] != low[b]).any():
        x, y = low[a[apart]], low[b[apart]]
        np.minimum.at(low, np.maximum(x, y), np.minimum(x, y))
        while (low[low] != low).any():
            low = low[low]
    return nodes, nodes[low]


def components(links: DataFrame, scratch: Scratch, rows: int | None = None) -> DataFrame:
    """(node, comp) of the graph whose edges are the long columns u, v (``rows`` at most, if known); nodes need hashed, so random, labels.

    Each round every node moves to the smallest label around it and the graph is rebuilt from the
    labels, until the edges that are left are few; those the driver joins. Random labels shrink chains by a constant
    share a round.
    """
    edges = scratch.keep(links.select("u", "v").where("u <> v").distinct(), rows)
    labels = None
    while edges.count() > limits.FEW_ROWS:
        ends = edges.union(edges.select("v", "u"))
        hop = scratch.keep(ends.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("at"), F.least("u", "m").alias("to")))
        if labels is None:
            labels = hop.select(F.col("at").alias("node"), F.col("to").alias("comp"))
        else:
            labels = labels.join(hop, labels.comp == hop["at"], "left").select("node", F.coalesce("to", "comp").alias("comp"))
        labels = scratch.keep(labels)
        moved = edges.join(hop.withColumnsRenamed({"at": "u", "to": "mu"}), "u").select("mu", "v")
        moved = moved.join(hop.withColumnsRenamed({"at": "v", "to": "mv"}), "v").where("mu <> mv")
        edges = scratch.keep(moved.select(F.least("mu", "mv").alias("u"), F.greatest("mu", "mv").alias("v")).distinct())
    rest = edges.toArrow()
    found = joined(*(rest[c].to_numpy() for c in ("u", "v")))
    last = scratch.spark.createDataFrame(pa.table(list(found), names=["node", "comp"]), "node bigint, comp bigint")
    if labels is None:
        return last
    last = last.withColumnsRenamed({"node": "at", "comp": "to"})
    return scratch.keep(labels.join(last, labels.comp == last["at"], "left").select("node", F.coalesce("to", "comp").alias("comp")))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    percent: int = 75,
    permutations: int = 64,
    rows: int = 4,
) -> DataFrame:
    """Per row: doc_id, n_shingles, component_id (smallest id reachable over links), kept (it is that id).

    Links hold between sets with ``100 * shared >= percent * united``. With 64 permutations and 4 rows
    there are 32 bands: a pair at 0.75 shares one with probability 1 - 5e-6.
    """
    scratch, result = Scratch(docs.sparkSession, "minmax"), Scratch(docs.sparkSession, "minmax-found")
    signs = result.keep(signatures(docs, id_col, text_col, words, permutations, rows))
    sets = signs.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
    classes = scratch.keep(sets.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands")))
    n_classes = classes.count()
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    banded = classes.select("rep", F.explode("bands").alias("bucket"))
    full = scratch.keep(banded.groupBy("bucket").agg(F.min("rep").alias("hub"), F.max("rep").alias("last")).where("hub < last").select("bucket", "hub"))
    active = scratch.keep(banded.join(full, "bucket"))  # written tables on both sides: a large bucket can be split

    # Each document against the smallest one of its buckets.
    pairs = active.groupBy("rep").agg(F.min("hub").alias("a")).where("a < rep").select("a", F.col("rep").alias("b"))
    links = scratch.keep(linked_pairs(scratch.keep(pairs, n_classes), texts, words, percent), n_classes)
    nodes = [F.xxhash64("a").alias("u"), F.xxhash64("b").alias("v")]
    n_links = links.count()
    labels = components(links.select(*nodes), scratch, n_links)

    # Those still apart, by groups of buckets with the same smallest document.
    members = active.select(F.col("hub").alias("group"), "rep").distinct().withColumn("node", F.xxhash64("rep"))
    members = scratch.keep(members.join(labels, "node", "left").select("group", "rep", F.coalesce("comp", "node").alias("comp")), active.count())
    more = linked_across(members, texts, words, percent, scratch)
    if n_more := more.count():
        labels = components(links.union(more).select(*nodes), scratch, n_links + n_more)

    placed = classes.select("set_key", "rep", F.xxhash64("rep").alias("node")).join(labels, "node", "left").select("set_key", "rep", F.coalesce("comp", "node").alias("comp"))
    placed = scratch.keep(placed, n_classes)
    roots = scratch.keep(placed.groupBy("comp").agg(F.min("rep").alias("root")), n_classes)
    of_set = result.keep(placed.join(roots, "comp").select("set_key", "root"), n_classes)
    scratch.drop()
    component = F.coalesce("root", "doc_id")
    return signs.select("doc_id", "n_shingles", "set_key").join(of_set, "set_key", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept")
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings: int) -> DataFrame:
    """``docs`` with one document of each near-duplicate class; a row repeated as a whole stays once.

    Rows without an id can't be named by a class, and stay.
    """
    found = near_duplicates(docs, id_col, text_col, **settings)
    staying = found.where("kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__gf_id")).distinct()
    named = [F.col(f"`{c}`") for c in docs.columns]
    hashed = [F.col(f"`{c}`") for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind]
    kept = docs.join(staying, F.col(id_col) == F.col("__gf_id"), "left_semi")
    once = kept.withColumn("__gf_row", F.xxhash64(*hashed)).dropDuplicates([id_col, "__gf_row"]).select(*named)
    return once.unionByName(docs.where(F.col(id_col).isNull()))


def oracle_sql(words: int = 5, percent: int = 75) -> str:
    """Exact links and components in DuckDB's SQL: shingle sets as lists, joined over their shingles."""
    return rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < {words} THEN [array_to_string(words, ' ')]
  ELSE list_distinct(list_transform(range(1, len(words) - {words - 2}), lambda i: array_to_string(words[i:i + {words - 1}], ' '))) END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS n FROM s),
e AS (SELECT doc_id, unnest(shingles) AS shingle FROM s),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM e a JOIN e b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * both_n >= {percent} * (x.n + y.n - both_n)),
ends AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT doc_id AS node, doc_id AS root FROM n UNION SELECT ends.b, reach.root FROM reach JOIN ends ON ends.a = reach.node AND reach.root < ends.b),
c AS (SELECT node, min(root) AS root FROM reach GROUP BY node)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, c.root AS component_id, n.doc_id = c.root AS kept FROM n JOIN c ON c.node = n.doc_id
"""
