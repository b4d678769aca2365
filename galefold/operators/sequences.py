"""Ordered-sequence operators: gaps, segments, islands, revision chains, evidence frames, canonical selection, capabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from galefold.functions.columns import joined_reasons, micros, precipitating
from galefold.operators.frames import first_of

HOUR = 3_600_000_000  # microseconds


def rolling_mean(frame: DataFrame, key: str, time: str, value: str, width: int = 365, least: int = 180) -> DataFrame:
    """Centred mean over ``width`` rows of the key, null where fewer than ``least`` have a value."""
    w = Window.partitionBy(key).orderBy(time).rowsBetween(-(width // 2), width // 2)
    return frame.withColumn("rolling", F.when(F.count(value).over(w) >= least, F.avg(value).over(w)))


def largest_gaps(frame: DataFrame, key: str, time: str) -> DataFrame:
    step = micros(F.col(time)) - F.lag(micros(F.col(time))).over(Window.partitionBy(key).orderBy(time))
    return frame.select(key, step.alias("gap")).groupBy(key).agg(F.max("gap").alias("max_gap_us"))


def segments(frame: DataFrame, key: str, time: str, hours: float = 25) -> DataFrame:
    """Adds ``segment``, a number that grows where the time since the row before is over ``hours``."""
    w = Window.partitionBy(key).orderBy(time)
    starts = (micros(F.col(time)) - F.lag(micros(F.col(time))).over(w) > int(hours * HOUR)).cast("bigint")
    return frame.withColumn("_s", F.coalesce(starts, F.lit(0).cast("bigint"))).withColumn("segment", F.sum("_s").over(w)).drop("_s")


def islands(frame: DataFrame, keys: Sequence[str], start: str, end: str, same: Sequence[str], summed: Sequence[str]) -> DataFrame:
    """Neighbouring intervals with equal ``same`` columns and no gap become one; ``summed`` columns add up."""
    w = Window.partitionBy(*keys).orderBy(start)
    continues = F.col(start) == F.lag(end).over(w)
    for c in same:
        continues = continues & F.col(c).eqNullSafe(F.lag(c).over(w))
    flagged = frame.withColumn("_new", F.when(F.coalesce(continues, F.lit(False)), 0).otherwise(1)).withColumn("_island", F.sum("_new").over(w))
    return flagged.groupBy(*keys, "_island", *same).agg(F.min(start).alias(start), F.max(end).alias(end), *[F.sum(c).alias(c) for c in summed]).drop("_island")


def chained(frame: DataFrame, record: str, revision: str, order: Sequence[str]) -> DataFrame:
    """Adds supersedes_revision_id: the revision before it of the same record; repeats of the one before are dropped.

    A value that returns to an older one is a new revision.
    """
    w = Window.partitionBy(record).orderBy(*order)
    fresh = frame.withColumn("_p", F.lag(revision).over(w)).where(F.col("_p").isNull() | (F.col("_p") != F.col(revision))).drop("_p")
    return fresh.withColumn("supersedes_revision_id", F.lag(revision).over(w))


def latest(frame: DataFrame, record: str, order: Sequence[str]) -> DataFrame:
    return first_of(frame, [record], [F.col(c).desc_nulls_last() for c in order])


def canonical(rows: DataFrame, as_of: str, precedence: DataFrame) -> DataFrame:
    """The best value of each (station_id, variable, observed_at, period_seconds, statistic) as of an instant.

    Rows ingested later or rejected aren't eligible. An eligible row removes the one it supersedes, of its
    source and key. Then: observed, accepted, rank of the source, newest, revision id.
    """
    key = ["station_id", "variable", "observed_at", "period_seconds", "statistic"]
    able = rows.where(F.col("ingested_at") <= F.lit(as_of).cast("timestamp_ntz")).where("quality <> 'rejected'")
    fixes = able.where("supersedes_revision_id IS NOT NULL").select(*[F.col(c).alias(f"_{c}") for c in ["source", *key]], F.col("supersedes_revision_id").alias("_r")).distinct()
    replaced = F.col("revision_id") == F.col("_r")
    for c in ["source", *key]:
        replaced = replaced & (F.col(c).eqNullSafe(F.col(f"_{c}")) if c == "period_seconds" else F.col(c) == F.col(f"_{c}"))
    # Null ranks would sort first, so a source without one is an error.
    ranked = F.coalesce(F.col("rank"), F.raise_error(F.concat(F.lit("no rank for source "), F.col("source"))).cast("int"))
    alive = able.join(precedence, "source", "left").withColumn("rank", ranked).join(fixes, replaced, "left_anti")
    order = [F.col("value_state") != "observed", F.col("quality") != "accepted", F.col("rank"), F.col("available_at").desc(), F.col("revision_id")]
    return first_of(alive, key, order)


def sort_key() -> list[Column]:
    """The order of canonical tables; no period sorts as -1."""
    return [F.col("station_id"), F.col("variable"), F.col("observed_at"), F.coalesce("period_seconds", F.lit(-1.0)), F.col("statistic")]


def within_payload(rows: DataFrame, payload: str, record: str, revision: str, position: str) -> DataFrame:
    """Revisions of a record within one payload: repeats of a content are dropped, each other one supersedes the one before it."""
    firsts = first_of(rows, [payload, record, revision], [F.col(position)])
    w = Window.partitionBy(payload, record).orderBy(position)
    return firsts.withColumn("supersedes_revision_id", F.lag(revision).over(w))


def unranked(rows: DataFrame, precedence: DataFrame) -> DataFrame:
    """Sources without a rank; a selection over them is an error."""
    return rows.select("source").distinct().join(precedence, "source", "left_anti")


def evidence(rows: DataFrame, station: str, time: str, weather: Column, zero: Column, nonzero: Column, period: int = HOUR, reach: int = 24 * HOUR, least: int = 2) -> DataFrame:
    """Adds contradicted, contradictions, gauges, suspect.

    A zero is contradicted if weather lies in (t - period, t]; it is suspect with ``least`` contradicted
    zeros and no gauge report above zero within ``reach`` on both sides. All are frames over one sort.
    """
    w = Window.partitionBy(station).orderBy("_t")
    flags = rows.withColumn("_t", micros(F.col(time))).withColumn("_w", weather.cast("int")).withColumn("_z", zero.cast("int")).withColumn("_g", nonzero.cast("int"))
    seen = flags.withColumn("contradicted", (F.col("_z") == 1) & (F.sum("_w").over(w.rangeBetween(-period + 1, 0)) > 0))
    both = w.rangeBetween(-reach, reach)
    seen = seen.withColumn("contradictions", F.sum(F.col("contradicted").cast("int")).over(both)).withColumn("gauges", F.sum("_g").over(both))
    return seen.withColumn("suspect", F.col("contradicted") & (F.col("contradictions") >= least) & (F.col("gauges") == 0)).drop("_t", "_w", "_z", "_g")


def classified(rows: DataFrame, least: int = 2) -> DataFrame:
    """Marks contradicted zero precipitation of a normalized table as suspect.

    Latest revisions decide; all revisions of a zero at a suspect station and instant are marked.
    """
    active = latest(rows, "source_record_id", ["ingested_at", "revision_id"])
    amount = F.col("variable") == "precipitation"
    accepted = F.col("quality") == "accepted"
    is_trace = F.coalesce("is_trace", F.lit(False))
    zero = amount & accepted & (F.col("value_float") == 0) & ~is_trace
    judged = evidence(
        active, "station_id", "observed_at",
        F.coalesce((F.col("variable") == "present_weather") & precipitating(F.col("value_text")), F.lit(False)),
        F.coalesce(zero, F.lit(False)), F.coalesce(amount & accepted & (F.col("value_float") > 0), F.lit(False)), least=least,
    )
    hours = judged.where("suspect").select("station_id", "observed_at").distinct().withColumn("_hit", F.lit(True))
    marked = rows.join(hours, ["station_id", "observed_at"], "left").withColumn("_hit", F.coalesce("_hit", F.lit(False)) & amount & (F.col("value_float") == 0) & ~is_trace)
    return (
        marked.withColumn("quality_reason", F.when(F.col("_hit"), joined_reasons(F.col("quality_reason"), F.lit("present_weather_contradicts_zero"))).otherwise(F.col("quality_reason")))
        .withColumn("quality", F.when(F.col("_hit") & (F.col("quality") != "rejected"), "suspect").otherwise(F.col("quality")))
        .drop("_hit")
    )


def capability_state(expected: Column, observed: Column, accepted: Column, threshold: float = 0.8, contradicted: Column | None = None) -> Column:
    state = F.when(observed == 0, "absent").when(accepted / expected < threshold, "degraded").otherwise("present")
    return state if contradicted is None else F.when((state == "present") & contradicted, "degraded").otherwise(state)


def daily_rows(rows: DataFrame, station: str, day: str, time: str, variable: str, accepted: Column, variables: Sequence[str], threshold: float = 0.8) -> DataFrame:
    """Daily capabilities that count rows of any state, every day and variable a row; both counts end at ``expected``."""
    names = F.explode(F.array(*map(F.lit, variables))).alias(variable)
    every = rows.groupBy(station, day).agg(F.count_distinct(time).alias("expected")).select("*", names)
    seen = rows.groupBy(station, day, variable).agg(F.count("*").alias("_n"), F.count_if(accepted).alias("_good"))
    full = every.join(seen, [station, day, variable], "left")
    cap = lambda c: F.least(F.coalesce(c, F.lit(0).cast("bigint")), "expected")
    counted = full.select(station, day, variable, "expected", cap("_n").alias("observed"), cap("_good").alias("accepted"))
    return counted.withColumn("state", capability_state(F.col("expected"), F.col("observed"), F.col("accepted"), threshold))


def confusion(rows: DataFrame, truth: Column, guess: Column) -> DataFrame:
    """False positives and negatives with their rates; 0.0 for a class without members."""
    fp, fn = F.count_if(guess & ~truth), F.count_if(~guess & truth)
    rate = lambda n, of: F.coalesce(F.try_divide(n, F.count_if(of)), F.lit(0.0))
    return rows.agg(fp.alias("fp"), fn.alias("fn"), rate(fp, ~truth).alias("fp_rate"), rate(fn, truth).alias("fn_rate"))
