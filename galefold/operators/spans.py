"""Half-open time windows: parsing, merging, clipping, membership."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parsed(text: str) -> list[tuple[datetime, datetime]]:
    """START/END[,START/END]; a zone is required."""
    out = []
    for part in text.split(","):
        start, end = (datetime.fromisoformat(x.strip()) for x in part.split("/"))
        if start.tzinfo is None or end.tzinfo is None:
            raise ValueError("a window needs a time zone")
        if not start < end:
            raise ValueError("a window must end after it starts")
        out.append((start.astimezone(UTC), end.astimezone(UTC)))
    return merged(out)


def merged(spans: list[tuple[datetime, datetime]]) -> list[tuple[datetime, datetime]]:
    """In order, with those that overlap or touch made one."""
    out: list[tuple[datetime, datetime]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], end))
        else:
            out.append((start, end))
    return out


def merged_rows(spans: DataFrame, keys: list[str], start: str = "start", end: str = "end") -> DataFrame:
    """The same for a table of windows. Ones without a start come last and stay apart, as nothing is known to overlap them.

    Equal windows are one, in whatever order they come: both frames are cut from one sort.
    """
    w = Window.partitionBy(*keys).orderBy(F.asc_nulls_last(start), F.asc_nulls_last(end))
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    flagged = spans.withColumn("_new", F.when(F.col(start) <= reach, 0).otherwise(1)).withColumn("_n", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return flagged.groupBy(*keys, "_n").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_n")


def inside(time: Column, spans: list[tuple[str, str]]) -> Column:
    """Membership in one of the windows; plain ranges, so that it reaches the scan."""
    out = F.lit(False)
    for start, end in spans:
        out = out | ((time >= F.lit(start).cast("timestamp_ntz")) & (time < F.lit(end).cast("timestamp_ntz")))
    return out


def split_by(spans: DataFrame, unit: str, start: str = "start", end: str = "end") -> DataFrame:
    """Windows cut at the boundaries of ``unit`` (year or month); one that ends at a boundary belongs to the part before."""
    pieces = F.expr(f"explode(sequence(cast(date_trunc('{unit}', {start}) as timestamp_ntz), {end} - interval 1 microsecond, interval 1 {unit}))")
    cut = spans.withColumn("_p", pieces)
    return cut.withColumn("_e", F.expr(f"_p + interval 1 {unit}")).withColumn(start, F.greatest(start, "_p")).withColumn(end, F.least(end, "_e")).drop("_p", "_e")


def split_long(spans: DataFrame, unit: str, days: int, start: str = "start", end: str = "end") -> DataFrame:
    """``split_by`` for windows of more than ``days`` days; others stay whole."""
    whole = F.expr(f"timestampdiff(DAY, `{start}`, `{end}`) <= {days}")
    return split_by(spans.where(~whole), unit, start, end).unionByName(spans.where(whole))
