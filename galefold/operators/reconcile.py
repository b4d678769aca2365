"""Comparing two versions of a partition: counts and violations, by shards of stations; fetch sets and guards."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from galefold.functions.columns import blank_to_null, fingerprint
from galefold.operators.frames import alias_overlaps, last_known
from galefold.operators.sequences import canonical

#: Counts of a report that have to be zero.
FORBIDDEN = ["repeated_before", "repeated_after", "removed", "added_outside", "changed_outside", "metadata_unexpected"]


def family(key: Column, aliases: dict[str, str]) -> Column:
    """The old id of an aliased station, so that both ids meet in one shard; other ids are their own family."""
    out = key
    for new, old in aliases.items():
        out = F.when(key == new, F.lit(old)).otherwise(out)
    return out


def shard(key: Column, shards: int) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(shards)).cast("int")


def _side(frame: DataFrame, keys: Sequence[str], measures: Sequence[str], metadata: Sequence[str], tag: str) -> DataFrame:
    """One row a key: its number of rows, and fingerprints of the smallest one."""
    prints = F.struct(fingerprint(*measures).alias("m"), fingerprint(*metadata).alias("d"))
    return frame.groupBy(*keys).agg(F.count("*").alias(f"{tag}_n"), F.min(prints).alias(tag))


def compared(before: DataFrame, after: DataFrame, keys: Sequence[str], measures: Sequence[str], metadata: Sequence[str], inside: Column, expected: DataFrame) -> DataFrame:
    """One row a key with the flags that a report counts.

    ``inside`` says of a key whether its time lies in the fetched windows; ``expected`` has the metadata that
    each station (the first key) may change to. Both sides are aggregated by key before they meet, so
    repeated keys are counted and never multiply.
    """
    wanted = expected.groupBy(keys[0]).agg(F.min(fingerprint(*metadata)).alias("wanted"))
    both = _side(before, keys, measures, metadata, "b").join(_side(after, keys, measures, metadata, "a"), list(keys), "full_outer").join(wanted, keys[0], "left")
    added, removed, shared = F.col("b").isNull(), F.col("a").isNull(), F.col("a").isNotNull() & F.col("b").isNotNull()
    changed = shared & (F.col("a.m") != F.col("b.m"))
    described = shared & (F.col("a.d") != F.col("b.d"))
    flags = {
        "added": added, "removed": removed, "changed": changed, "metadata_changed": described,
        "added_outside": added & ~inside, "changed_outside": changed & ~inside,
        "metadata_unexpected": described & ~F.col("a.d").eqNullSafe(F.col("wanted")),
    }
    counts = [F.coalesce(f"{tag}_n", F.lit(0)).cast("bigint").alias(f"{tag}_n") for tag in "ab"]
    return both.select(*keys, *counts, *[F.coalesce(f, F.lit(False)).alias(name) for name, f in flags.items()])


def report(keyed: DataFrame, *by: str | Column) -> DataFrame:
    """The counts over ``compared``, in all or by shard: rows, repeated keys, changes, and the invariant ``balanced``."""
    sums = [F.count_if(F.col(c)).alias(c) for c in ("added", "removed", "changed", "metadata_changed", "added_outside", "changed_outside", "metadata_unexpected")]
    keys_before, keys_after = F.count_if(F.col("b_n") > 0), F.count_if(F.col("a_n") > 0)
    total = lambda tag: F.coalesce(F.sum(f"{tag}_n"), F.lit(0)).alias(f"rows_{'before' if tag == 'b' else 'after'}")
    out = keyed.groupBy(*by).agg(
        total("b"), total("a"), F.count_if(F.col("b_n") > 1).alias("repeated_before"), F.count_if(F.col("a_n") > 1).alias("repeated_after"), *sums,
        (keys_before + F.count_if("added") - F.count_if("removed") == keys_after).alias("balanced"),
    )
    return out


def combined(shards: DataFrame) -> DataFrame:
    """Reports of station-disjoint shards added up."""
    counts = [c for c, kind in shards.dtypes if kind == "bigint"]
    return shards.agg(*[F.sum(c).alias(c) for c in counts], F.bool_and("balanced").alias("balanced"))


def violations(report: DataFrame) -> DataFrame:
    """(violation, n): every count of a report that should be zero and isn't."""
    return report.unpivot([], FORBIDDEN, "violation", "n").where("n > 0")


def fetch_set(stations: DataFrame, rows: DataFrame, key: str, time: str, state: str, retired: DataFrame) -> DataFrame:
    """(key, state) to ask the source for: stations at hand that no alias retired, and those only ``rows`` know, with their last state."""
    listed = stations.select(key, state).join(retired.select(key), key, "left_anti")
    known = rows.select(key).distinct().join(stations.select(key), key, "left_anti").join(retired.select(key), key, "left_anti")
    return listed.unionByName(known.join(last_known(rows, key, time, [state], state), key, "left"))


def dropped(recorded: DataFrame, incoming: DataFrame, identity: str) -> DataFrame:
    """Payloads recorded earlier that are missing from the incoming manifest; has to be empty."""
    return recorded.select(identity).distinct().join(incoming.select(identity), identity, "left_anti")


def regressed(earlier: DataFrame, later: DataFrame, key: str, mark: str) -> DataFrame:
    """Keys whose watermark went back or disappeared; has to be empty."""
    both = earlier.select(key, F.col(mark).alias("_was")).join(later.select(key, mark), key, "left")
    return both.where(F.col(mark).isNull() | (F.col(mark) < F.col("_was"))).select(key, F.col("_was").alias("was"), mark)


def partition_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], measures: Sequence[str], metadata: Sequence[str], inside: Column, expected: DataFrame, aliases: DataFrame, label: Column) -> DataFrame:
    """(counter, item, n): every counter of the comparison of two versions; ``item`` is an hour, column, station or alias where a counter has one.

    ``keys``: station and time. ``expected`` has the metadata that a station may change to; ``aliases``:
    (old_id, new_id, boundary). Repeated keys are counted, and the first row of each is compared.
    """
    station, time = keys
    side = lambda frame, tag: frame.groupBy(*keys).agg(F.count("*").alias(f"{tag}_n"), F.min(F.struct(*measures, *metadata)).alias(tag))
    wanted = expected.groupBy(station).agg(F.min(F.struct(*metadata)).alias("wanted"))
    both = side(before, "b").join(side(after, "a"), list(keys), "full_outer").join(wanted, station, "left")
    there = F.col("a").isNotNull() & F.col("b").isNotNull()
    differs = lambda c: there & ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    any_of = lambda columns: reduce(or_, [differs(c) for c in columns], F.lit(False))
    moved = F.lit(False) if not metadata else any_of(metadata)
    restored = moved & F.col("wanted").isNotNull() & F.struct(*[F.col(f"a.{c}") for c in metadata]).eqNullSafe(F.struct(*[F.col(f"wanted.{c}") for c in metadata])) if metadata else F.lit(False)
    flags = both.select(
        *keys, F.coalesce("b_n", F.lit(0)).alias("b_n"), F.coalesce("a_n", F.lit(0)).alias("a_n"), inside.alias("inside"), any_of(measures).alias("changed"), *[differs(c).alias(f"_{c}") for c in measures],
        moved.alias("moved"), restored.alias("restored"), label.alias("label"),
    )
    one = lambda name, n, item=None, when=None: F.struct(F.lit(name).alias("counter"), (F.lit(None).cast("string") if item is None else item).alias("item"), F.when(when if when is not None else F.lit(True), n).cast("bigint").alias("n"))
    added, removed = (F.col("b_n") == 0), (F.col("a_n") == 0)
    parts = [
        one("rows_before", F.col("b_n")), one("rows_after", F.col("a_n")), one("removed_keys", removed.cast("int")), one("duplicate_keys_after", F.greatest(F.col("a_n") - 1, F.lit(0))),
        one("added_in_windows", (added & F.col("inside")).cast("int")), one("added_outside_windows", (added & ~F.col("inside")).cast("int")),
        one("measurement_changes_in_windows", (F.col("changed") & F.col("inside")).cast("int")), one("measurement_changes_outside_windows", (F.col("changed") & ~F.col("inside")).cast("int")),
        one("added_by_hour", F.lit(1), F.date_format("label", "yyyy-MM-dd HH"), added & F.col("inside")),
        *[one("measurement_changes_by_column", F.lit(1), F.lit(c), F.col(f"_{c}")) for c in measures],
        one("metadata_changes_by_station", F.lit(1), F.col(station).cast("string"), F.col("moved")), one("metadata_restored_by_station", F.lit(1), F.col(station).cast("string"), F.col("restored")),
    ]
    counted = flags.select(F.inline(F.array(*parts))).where("n IS NOT NULL AND (item IS NULL OR n > 0)").groupBy("counter", "item").agg(F.sum("n").alias("n"))
    early = after.join(aliases, after[station] == F.col("new_id")).where(F.col(time) < F.col("boundary")).groupBy(F.col("new_id").cast("string").alias("item")).agg(F.count("*").alias("n"))
    overlap = alias_overlaps(after, aliases, station, time).groupBy(F.concat_ws("/", F.col("old_id").cast("string"), F.col("new_id").cast("string")).alias("item")).agg(F.count("*").alias("n"))
    return counted.unionByName(early.withColumn("counter", F.lit("successor_rows_before_boundary"))).unionByName(overlap.withColumn("counter", F.lit("alias_overlaps")))


#: Counters of a diff that have to be zero.
DIFF_FORBIDDEN = ["removed_keys", "duplicate_keys_after", "added_outside_windows", "measurement_changes_outside_windows", "successor_rows_before_boundary", "alias_overlaps"]


def diff_violations(diff: DataFrame) -> DataFrame:
    """(violation, item, n): forbidden counters that aren't zero, and stations whose metadata changed to something unexpected."""
    broken = diff.where(F.col("counter").isin(DIFF_FORBIDDEN) & (F.col("n") > 0)).select(F.col("counter").alias("violation"), "item", "n")
    changes = diff.where(F.col("counter").isin("metadata_changes_by_station", "metadata_restored_by_station"))
    net = changes.groupBy("item").agg(F.sum(F.when(F.col("counter") == "metadata_changes_by_station", F.col("n")).otherwise(-F.col("n"))).alias("n")).where("n > 0")
    return broken.unionByName(net.select(F.lit("metadata_unexpected").alias("violation"), "item", "n"))


def column_violations(before: StructType, after: StructType, except_types: Sequence[str] = ("geometry",)) -> list[str]:
    """What two versions' columns have wrong: list or order, and types other than of ``except_types``."""
    out = [] if before.names == after.names else [f"columns changed: {before.names} to {after.names}"]
    kinds = {f.name: f.dataType for f in after}
    return out + [f"type of {f.name} changed" for f in before if f.name in kinds and f.name not in except_types and kinds[f.name] != f.dataType]


def pair_reconciled(rows: DataFrame, as_of: str, precedence: DataFrame) -> DataFrame:
    """Candidates and choice of each key that two sources report: the rows known by ``as_of`` with ``place`` (order of the candidates) and ``chosen``.

    A key whose candidates are all rejected or superseded has no chosen row.
    """
    key = ["station_id", "variable", "observed_at", "period_seconds", "statistic"]
    known = rows.where(F.col("ingested_at") <= F.lit(as_of).cast("timestamp_ntz")).join(precedence, "source", "left")
    placed = known.withColumn("place", F.row_number().over(Window.partitionBy(*key).orderBy("rank", "source_record_id", "revision_id"))).drop("rank")
    best = canonical(rows, as_of, precedence).select(*[F.col(c).alias(f"_{c}") for c in ("source", *key, "revision_id")])
    same = F.col("revision_id") == F.col("_revision_id")
    for c in ("source", *key):
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    return placed.join(best, same, "left").withColumn("chosen", F.col("_revision_id").isNotNull()).drop(*[f"_{c}" for c in ("source", *key, "revision_id")])


def pair_chosen(rows: DataFrame, as_of: str, precedence: DataFrame) -> Row:
    """The chosen row of candidates that must share one key; none known, several keys, or none left are errors."""
    held = pair_reconciled(rows, as_of, precedence)
    keys = held.select("station_id", "variable", "observed_at", "period_seconds", "statistic").distinct().limit(2).count()
    if keys != 1:
        raise ValueError("no candidate is known by then" if not keys else "the candidates have more than one key")
    found = held.where("chosen").limit(1).collect()
    if not found:
        raise ValueError("all candidates are rejected or superseded")
    return found[0]


def station_identity(msc_id: Column, provider: Column, tc_id: Column, stn_id: Column, hint: Column | None = None) -> Column:
    """``msc_id:<id>``, else ``<provider>:<field>:<value>`` of the first filled field; null if neither is there.

    ``hint`` stands for a provider that isn't there at all; an empty one isn't replaced.
    """
    named = blank_to_null(provider if hint is None else F.coalesce(provider, hint))
    local = F.coalesce(*[F.concat(F.lit(f"{field}:"), blank_to_null(c)) for field, c in (("tc_id", tc_id), ("stn_id", stn_id))])
    return F.coalesce(F.concat(F.lit("msc_id:"), blank_to_null(msc_id)), F.concat(named, F.lit(":"), local))


def available_at(observed: Column, published: Column, ingested: Column) -> Column:
    """When a value could first be known: not before it was observed or published, not after it was read."""
    return F.least(F.greatest(observed, published), ingested)


def ascending(frame: DataFrame, group: str, keys: Sequence[str], position: str) -> DataFrame:
    """(group, breaks) where the keys don't ascend strictly along ``position``."""
    k = F.struct(*keys)
    w = Window.partitionBy(group).orderBy(position)
    return frame.withColumn("_b", k <= F.lag(k).over(w)).groupBy(group).agg(F.count_if("_b").alias("breaks")).where("breaks > 0")
