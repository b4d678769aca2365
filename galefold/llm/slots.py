"""Sharding by fixed virtual slots.

Every record is hashed into one of ``SLOTS`` slots, which never changes. A versioned map says which shard
owns each slot. The first version is made from the bytes of the slots (the largest slot goes to the emptiest
shard) and stored; each later run loads the latest version and edits it: ``rebalanced`` moves the slots that
even out the shards, or fill new ones, and leaves the others. An edit that moves anything is stored as the
next version. Maps are tables (version, slot, shard) and are kept for good; the one in force is always read
back from the store.

Only sums over ``SLOTS`` slots reach the driver; the map is broadcast, a row for each slot and each
``PIECE`` of its rows. Places within a shard number the rows of each such piece on their own and add the
sizes of the pieces before it, so no task sees a whole shard, nor a whole slot that is large.

Law ``bytes``: shards have near equal sizes. Equal texts under different ids lie in different slots on
purpose: a text that a third of all rows share would else fill a third of all bytes into one shard.

Edge cases: a null text has no bytes and the checksum 0; rows with a null id are spread over the slots by a
random number that is written with them. Repeated rows share a slot and get places of their own. Extra
columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galefold.llm.shared import Scratch, listed_names

SLOTS = 4096
#: Rows that one task numbers, about.
PIECE = 1_000_000


@dataclass(frozen=True)
class SlotMap:
    version: int
    shards: list[int]  # by slot

    def frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(self.version, i, s) for i, s in enumerate(self.shards)], "version int, virtual_slot int, shard int")

    def saved(self, spark: SparkSession, path: str) -> None:
        """Add this version to the table at ``path``; a version that is there is never written again."""
        self.frame(spark).write.partitionBy("version").mode("errorifexists").parquet(f"{path}/v{self.version:06d}")


def loaded(spark: SparkSession, path: str, version: int) -> SlotMap:
    rows = spark.read.parquet(f"{path}/v{version:06d}").select("virtual_slot", "shard").collect()
    return SlotMap(version, [s for _, s in sorted((r["virtual_slot"], r["shard"]) for r in rows)])


def planned(sizes: list[int], shards: int) -> SlotMap:
    """First version: slots from the largest on, each to the emptiest shard (the lowest number of equals)."""
    heap, out = [(0, k) for k in range(shards)], [0] * len(sizes)
    for slot in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        total, shard = heapq.heappop(heap)
        out[slot] = shard
        heapq.heappush(heap, (total + sizes[slot], shard))
    return SlotMap(1, out)


def rebalanced(old: SlotMap, sizes: list[int], shards: int) -> SlotMap:
    """The next version for ``shards`` shards: while a move from the fullest to the emptiest shard narrows their gap, the largest such slot moves."""
    out, totals, owned = list(old.shards), [0] * shards, [[] for _ in range(shards)]
    homeless = [i for i, s in enumerate(out) if s >= shards]
    for i, s in enumerate(out):
        if s < shards:
            totals[s] += sizes[i]
            owned[s].append(i)
    for i in sorted(homeless, key=lambda i: (-sizes[i], i)):
        s = min(range(shards), key=lambda k: (totals[k], k))
        out[i], totals[s] = s, totals[s] + sizes[i]
        owned[s].append(i)
    while True:
        full, empty = max(range(shards), key=lambda k: (totals[k], -k)), min(range(shards), key=lambda k: (totals[k], k))
        gap = totals[full] - totals[empty]
        best = max((i for i in owned[full] if 0 < 2 * sizes[i] <= gap), key=lambda i: (sizes[i], -i), default=None)
        if best is None:
            return SlotMap(old.version + 1, out)
        owned[full].remove(best)
        owned[empty].append(best)
        out[best] = empty
        totals[full] -= sizes[best]
        totals[empty] += sizes[best]


def in_force(spark: SparkSession, path: str, sizes: list[int], shards: int) -> SlotMap:
    """The map of the store at ``path`` for these bytes by slot: the first version if there is none, else the latest, edited if that evens out the shards."""
    versions = [int(x[1:]) for x in listed_names(spark, path) if x.startswith("v") and x[1:].isdecimal()]
    if versions:
        latest = loaded(spark, path, max(versions))
        edited = rebalanced(latest, sizes, shards)
        if edited.shards == latest.shards:
            return latest
    else:
        edited = planned(sizes, shards)
    edited.saved(spark, path)
    return loaded(spark, path, edited.version)


def virtual_slot(id_col: Column, noise: Column, slots: int = SLOTS) -> Column:
    return F.when(id_col.isNotNull(), F.pmod(F.xxhash64(id_col), F.lit(slots))).otherwise(F.floor(noise * slots)).cast("int")


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """(doc_id, size, text_crc32, noise, virtual_slot) of each row."""
    text = F.col(text_col).cast("string")
    own = docs.select(
        F.col(id_col).alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8).alias("size"),
        F.coalesce(F.crc32(text), F.lit(0).cast("bigint")).alias("text_crc32"), F.rand(11).alias("noise"),
    )
    return own.withColumn("virtual_slot", virtual_slot(F.col("doc_id"), F.col("noise"), slots))


def slot_sizes(rows: DataFrame, slots: int = SLOTS) -> tuple[list[int], list[int]]:
    """Bytes and rows of each slot."""
    sizes, counts = [0] * slots, [0] * slots
    for r in rows.groupBy("virtual_slot").agg(F.sum("size").alias("size"), F.count("*").alias("n")).collect():
        sizes[r["virtual_slot"]], counts[r["virtual_slot"]] = r["size"], r["n"]
    return sizes, counts


def sharded(docs: DataFrame, store: str, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", slots: int = SLOTS, piece: int = PIECE) -> DataFrame:
    """Per row: doc_id, size, text_crc32, virtual_slot, version, shard, slot (its place in the shard, gapless from 0).

    ``store``: the folder of the map's versions, which all sessions share. Slots of over ``piece`` rows are numbered in parts.
    """
    spark = docs.sparkSession
    rows = Scratch(spark, "slots").keep(measured(docs, id_col, text_col, slots))
    sizes, counts = slot_sizes(rows, slots)
    chosen = in_force(spark, store, sizes, shards)
    parts = [max(1, -(-n // piece)) for n in counts]
    numbers = F.broadcast(spark.createDataFrame([(chosen.version, i, s, n) for i, (s, n) in enumerate(zip(chosen.shards, parts, strict=True))], "version int, virtual_slot int, shard int, parts int"))  # a row for each slot
    rows = rows.join(numbers, "virtual_slot").withColumn("part", F.floor(F.col("noise") * F.col("parts")).cast("int"))
    held = {(i, 0): n for i, n in enumerate(counts)}
    if any(n > 1 for n in parts):  # a row for each slot and each ``piece`` rows of the large ones
        held |= {(r["virtual_slot"], r["part"]): r["count"] for r in rows.where("parts > 1").groupBy("virtual_slot", "part").count().collect()}
    before, offsets = [0] * shards, []
    for (slot, part), n in sorted(held.items()):
        offsets.append((slot, part, before[chosen.shards[slot]]))
        before[chosen.shards[slot]] += n
    table = spark.createDataFrame(offsets, "virtual_slot int, part int, offset bigint")
    place = F.row_number().over(Window.partitionBy("virtual_slot", "part").orderBy("doc_id", "text_crc32", "size"))
    numbered = rows.withColumn("place", place)
    return numbered.join(F.broadcast(table), ["virtual_slot", "part"]).select(  # as many rows as ``held``
        "doc_id", "size", "text_crc32", "virtual_slot", "version", "shard", (F.col("offset") + F.col("place") - 1).alias("slot")
    )
