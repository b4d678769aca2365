"""Validation of wide tables: every metric in one pass, one row a check."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def out_of_bounds(frame: DataFrame, bounds: dict[str, tuple[float, float]]) -> DataFrame:
    """outside, present and rate over all bounded columns."""
    off = [F.count_if(~F.col(c).between(lo, hi)) for c, (lo, hi) in bounds.items()]
    there = [F.count(c) for c in bounds]
    sums = frame.agg(sum(off[1:], off[0]).alias("outside"), sum(there[1:], there[0]).alias("present"))
    return sums.withColumn("rate", F.coalesce(F.try_divide("outside", "present"), F.lit(0.0)))


def validated(frame: DataFrame, keys: list[str], time: str, bounds: dict[str, tuple[float, float]], null_columns: list[str], least_rows: int, earliest: str, latest: str, most_null: float = 0.5, most_outside: float = 0.001) -> DataFrame:
    """(check_name, passed, metric) of: rows, nulls in time, time range, bounds, null rates, duplicates (always passed)."""
    off = sum((F.count_if(~F.col(c).between(lo, hi)) for c, (lo, hi) in bounds.items()), F.lit(0))
    there = sum((F.count(c) for c in bounds), F.lit(0))
    nulls = F.greatest(*[F.try_divide(F.count_if(F.col(c).isNull()), F.count("*")) for c in null_columns], F.lit(0.0))
    m = frame.agg(
        F.count("*").alias("rows"), F.count_if(F.col(time).isNull()).alias("no_time"), F.min(time).alias("first"), F.max(time).alias("last"),
        F.coalesce(F.try_divide(off, there), F.lit(0.0)).alias("outside"), nulls.alias("nulls"),
    )
    repeated = frame.groupBy(*keys).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("duplicates"))
    in_range = (F.col("first") >= F.lit(earliest).cast("timestamp_ntz")) & (F.col("last") <= F.lit(latest).cast("timestamp_ntz"))
    rows: list[tuple[str, Column, Column]] = [
        ("record_count", F.col("rows") >= least_rows, F.col("rows")),
        ("timestamps", (F.col("no_time") == 0) & F.coalesce(in_range, F.lit(False)), F.col("no_time")),
        ("physical_bounds", F.col("outside") <= most_outside, F.col("outside")),
        ("null_rates", F.col("nulls") <= most_null, F.col("nulls")),
        ("duplicates", F.lit(True), F.col("duplicates")),
    ]
    each = F.array(*[F.struct(F.lit(n).alias("check_name"), p.alias("passed"), F.round(v.cast("double"), 6).alias("metric")) for n, p, v in rows])
    return m.crossJoin(repeated).select(F.inline(each))  # one row each


def consistent(frame: DataFrame, a: Column, b: Column, most: float) -> DataFrame:
    """n, consistent: rows, and those whose two columns differ by ``most`` at most."""
    return frame.agg(F.count("*").alias("n"), F.count_if(F.abs(a - b) <= most).alias("consistent"))


def readable(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None if it isn't there or can't be read."""
    try:
        return spark.read.parquet(path)
    except (PySparkException, Py4JJavaError):
        return None


def summary(found: DataFrame) -> DataFrame:
    """total, passed, all_passed of a table of checks."""
    return found.agg(F.count("*").alias("total"), F.count_if("passed").alias("passed"), F.bool_and("passed").alias("all_passed"))


def geometry_verdict(frame: DataFrame, geometry: str = "geometry", most_null: float = 0.1) -> DataFrame:
    """``geometry_check`` and whether it passes: some points, and few nulls."""
    few = F.col("nulls") <= most_null * F.col("rows")
    return geometry_check(frame, geometry).withColumn("passed", few & (F.col("points") > 0))


def outside_boxes(frame: DataFrame, lon: str, lat: str, boxes: list[tuple[float, float, float, float]]) -> DataFrame:
    """located, outside: rows with coordinates, and those of them in none of the boxes (west, south, east, north)."""
    inside = F.lit(False)
    for west, south, east, north in boxes:
        inside = inside | (F.col(lon).between(west, east) & F.col(lat).between(south, north))
    there = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    return frame.agg(F.count_if(there).alias("located"), F.count_if(there & ~inside).alias("outside"))


def unknown_codes(frame: DataFrame, column: str, allowed: DataFrame) -> DataFrame:
    """Distinct codes that the list doesn't have."""
    return frame.select(column).where(F.col(column).isNotNull()).distinct().join(allowed.select(column), column, "left_anti")


def station_coverage(frame: DataFrame, stations: DataFrame, key: str) -> DataFrame:
    """present, expected, missing, extra: distinct stations of the rows against those of the list."""
    seen = frame.select(key).distinct().withColumn("_s", F.lit(1))
    listed = stations.select(key).distinct().withColumn("_l", F.lit(1))
    both = seen.join(listed, key, "full_outer")
    return both.agg(F.count("_s").alias("present"), F.count("_l").alias("expected"), F.count_if(F.col("_s").isNull()).alias("missing"), F.count_if(F.col("_l").isNull()).alias("extra"))


def temporal_completeness(frame: DataFrame, key: str, time: str, least_per_day: float = 12, gap_hours: int = 48) -> DataFrame:
    """One row: stations, those with few reports a day, those with a long gap, median of reports a day; all stations count."""
    at = F.unix_micros(F.col(time).cast("timestamp"))
    step = at - F.lag(at).over(Window.partitionBy(key).orderBy(time))
    each = frame.select(key, at.alias("_t"), step.alias("_g")).groupBy(key).agg(F.count("*").alias("n"), F.min("_t").alias("a"), F.max("_t").alias("b"), F.max("_g").alias("g"))
    per_day = F.col("n") / (F.floor((F.col("b") - F.col("a")) / 86_400_000_000) + 1)
    return each.withColumn("per_day", per_day).agg(
        F.count("*").alias("stations"), F.count_if(F.col("per_day") < least_per_day).alias("sparse"), F.count_if(F.col("g") > gap_hours * 3_600_000_000).alias("gapped"), F.median("per_day").alias("median_per_day")
    )


def geometry_check(frame: DataFrame, geometry: str = "geometry") -> DataFrame:
    """rows, nulls, points, others: kinds by the type bytes of little-endian WKB."""
    g = F.col(geometry)
    point = F.hex(F.substring(g, 1, 5)) == "0101000000"
    return frame.agg(F.count("*").alias("rows"), F.count_if(g.isNull()).alias("nulls"), F.count_if(point).alias("points"), F.count_if(~point).alias("others"))
