"""Frame algebra: keep-last, upsert, enrichment, aliases, diffs, three-way rebase, coverage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galefold.functions.columns import fingerprint


def first_of(frame: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of each key; planned as a limit per window group, so losers drop out before the shuffle."""
    return frame.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def upsert(base: DataFrame, fetched: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """Rows of both, one a key: fetched rows win, and among them the first in ``order``."""
    both = base.withColumn("_origin", F.lit(0)).unionByName(fetched.withColumn("_origin", F.lit(1)), allowMissingColumns=True)
    return first_of(both, keys, [F.col("_origin").desc(), *order]).drop("_origin")


def upsert_few(base: DataFrame, fetched: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), broadcast_rows: int = 1_000_000) -> DataFrame:
    """``upsert`` into a base that has each key once: no row of the base is shuffled if a count finds few fetched ones.

    The base loses the fetched keys by a broadcast anti join; beyond ``broadcast_rows`` it is the plain upsert.
    """
    if fetched.count() > broadcast_rows:
        return upsert(base, fetched, keys, order)
    fresh = first_of(fetched, keys, order) if order else fetched.dropDuplicates(list(keys))
    gone = F.broadcast(fresh.select(*[F.col(k).alias(f"_{k}") for k in keys]))  # counted above
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return base.join(gone, same, "left_anti").unionByName(fresh, allowMissingColumns=True)


def compose(base: DataFrame | None, fetched: DataFrame, keys: Sequence[str], order: Sequence[Column] = (), dedup_initial: bool = False) -> DataFrame:
    """Upsert; a first load keeps repeated keys unless told otherwise, and nothing fetched leaves the base as it is."""
    if base is None:
        return first_of(fetched, keys, order) if dedup_initial else fetched
    return upsert(base, fetched, keys, order)


def composed(base: DataFrame | None, fetched: DataFrame, stations: DataFrame, keys: Sequence[str], metadata: Sequence[str], required: str, source: str = "iem", unused: Sequence[str] = ("wxcodes",)) -> DataFrame:
    """The next version of a table: fetched rows of one source, without unused columns, over the base; then enriched.

    Rows of another source are an error. As a first load keeps repeated keys, so does this.
    """
    checked = F.when(F.col("source") == source, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("rows of another source: "), F.coalesce("source", F.lit("none")))).cast("boolean"))
    own = fetched.where(checked).drop("source", *unused)
    merged = compose(base, own, keys)
    return enriched(merged.withColumns({c: F.lit(None).cast(stations.schema[c].dataType) for c in metadata if c not in merged.columns}), stations, keys[0], keys[1], list(metadata), required)


def last_known(frame: DataFrame, key: str, time: str, columns: Sequence[str], required: str) -> DataFrame:
    """For each key the columns of its latest row where ``required`` isn't null."""
    picked = frame.where(F.col(required).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(time, *columns)).alias("_m"))
    return picked.select(key, "_m.*")


def enriched(frame: DataFrame, stations: DataFrame, key: str, time: str, columns: Sequence[str], required: str) -> DataFrame:
    """Metadata by station: from the station table, else what the frame last knew of a retired one."""
    known = last_known(frame, key, time, columns, required).join(stations.select(key), key, "left_anti")
    return frame.drop(*columns).join(stations.select(key, *columns).unionByName(known), key, "left")


def lost_metadata(before: DataFrame, after: DataFrame, key: str, column: str) -> DataFrame:
    """Keys with fewer non-null values after than before."""
    count = lambda f, name: f.groupBy(key).agg(F.count(column).alias(name))
    both = count(before, "before_n").join(count(after, "after_n"), key, "left")
    return both.withColumn("after_n", F.coalesce("after_n", F.lit(0).cast("bigint"))).where("after_n < before_n")


def renamed_before(frame: DataFrame, aliases: DataFrame, key: str, time: str) -> DataFrame:
    """Rows of a new id earlier than its boundary take the old id; ``aliases``: (old_id, new_id, boundary)."""
    joined = frame.join(aliases, frame[key] == F.col("new_id"), "left")
    return joined.withColumn(key, F.when(F.col(time) < F.col("boundary"), F.col("old_id")).otherwise(F.col(key))).drop("old_id", "new_id", "boundary")


def alias_overlaps(frame: DataFrame, aliases: DataFrame, key: str, time: str) -> DataFrame:
    """Instants that both ids of an alias have."""
    old = frame.join(aliases, frame[key] == F.col("old_id")).select("old_id", "new_id", time)
    new = frame.join(aliases, frame[key] == F.col("new_id")).select("old_id", "new_id", time)
    return old.join(new, ["old_id", "new_id", time]).distinct()


def key_diff(before: DataFrame, after: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(keys, kind): added, removed, or changed in one of ``columns`` (null equals null)."""
    a = before.select(*keys, fingerprint(*columns).alias("_a"))
    b = after.select(*keys, fingerprint(*columns).alias("_b"))
    kind = F.when(F.col("_a").isNull(), "added").when(F.col("_b").isNull(), "removed").when(F.col("_a") != F.col("_b"), "changed")
    return a.join(b, list(keys), "full_outer").select(*keys, kind.alias("kind")).where("kind IS NOT NULL")


def withheld(base: DataFrame, current: DataFrame, fetched: DataFrame, keys: Sequence[str], columns: Sequence[str], earlier: DataFrame | None = None) -> DataFrame:
    """Fetched keys that someone else changed between ``base`` and ``current``; earlier decisions stay, with their first kind."""
    found = key_diff(base, current, keys, columns).join(fetched.select(*keys).distinct(), list(keys), "left_semi")
    if earlier is None:
        return found
    return earlier.unionByName(found.join(earlier.select(*keys), list(keys), "left_anti"))


def rebased(current: DataFrame, fetched: DataFrame, held: DataFrame, keys: Sequence[str]) -> DataFrame:
    return upsert(current, fetched.join(held.select(*keys), list(keys), "left_anti"), keys)


def digest(frame: DataFrame, *columns: str) -> DataFrame:
    """A digest that the order of rows doesn't change: their number, and sum and xor of their hashes."""
    h = fingerprint(*columns)
    return frame.agg(F.count("*").alias("n"), F.bit_xor(h).alias("xored"), F.sum(h.cast("decimal(38,0)")).alias("summed"))


def plain_digest(frame: DataFrame, text: Column) -> DataFrame:
    """Likewise by md5 of a text of each row, so that other engines can compute it: n, summed (of 32-bit numbers), xored."""
    h = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return frame.select(h.alias("h")).agg(F.count("*").alias("n"), F.sum("h").alias("summed"), F.bit_xor("h").alias("xored"))


def pooled(frame: DataFrame, key: str, hour: Column, width: int) -> DataFrame:
    """Distinct keys of the ``width`` hours up to each hour; a row counts in every window it lies in."""
    ends = F.explode(F.array(*[hour + F.expr(f"interval {i} hours") for i in range(width)]))
    return frame.select(ends.alias("hour"), key).groupBy("hour").agg(F.count_distinct(key).alias("n"))


def hourly_counts(frame: DataFrame, key: str, label: Column, start: str, end: str) -> DataFrame:
    """Distinct keys at each hour of [start, end], 0 where there are none."""
    grid = frame.sparkSession.sql(f"SELECT explode(sequence(timestamp_ntz'{start}', timestamp_ntz'{end}', interval 1 hour)) AS hour")
    counted = frame.select(label.alias("hour"), key).groupBy("hour").agg(F.count_distinct(key).alias("n"))
    return grid.join(counted, "hour", "left").select("hour", F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


def low_hours(counts: DataFrame, now: str, lookback: int = 48, grace: int = 2, days: int = 7, least_days: int = 3, ratio: float = 0.5) -> DataFrame:
    """Hours in (now - lookback, now - grace] with less than ``ratio`` of the median of their hour of day before."""
    at = f"timestamp_ntz'{now}'"
    checked = counts.where(f"hour > {at} - interval {lookback} hours AND hour <= {at} - interval {grace} hours")
    past = counts.where(f"hour <= {at} - interval {lookback} hours AND hour > {at} - interval {lookback + 24 * days} hours AND n > 0")
    base = past.groupBy(F.hour("hour").alias("h")).agg(F.median("n").alias("baseline"), F.count("*").alias("days")).where(F.col("days") >= least_days).where("baseline > 0")
    joined = checked.join(F.broadcast(base), F.hour("hour") == F.col("h"), "left")  # 24 rows
    status = F.when(F.col("baseline").isNull(), "insufficient_baseline").when(F.col("n") < ratio * F.col("baseline"), "low").otherwise("ok")
    return joined.select("hour", "n", "baseline", status.alias("status"))
