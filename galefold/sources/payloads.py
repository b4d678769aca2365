"""Raw payloads: manifests, the content-addressed archive, watermarks, station metadata, page checks."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from galefold.functions.columns import blank_to_null

MANIFEST_JSON = "struct<payloads:array<struct<path:string,uri:string,sha256:string,ingested_at:string,source_published_at:string,network:string,media_type:string>>,source_complete_through:string,unavailable_intervals:array<struct<start:string,end:string>>>"


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row a payload of the JSON manifest at ``path``; payload paths are relative to the manifest."""
    folder = path.rsplit("/", 1)[0]
    text = spark.read.text(path, wholetext=True).select(F.from_json("value", MANIFEST_JSON).alias("m"))
    rows = text.select(F.inline("m.payloads"))
    return manifest_times(rows.withColumn("path", F.when(F.col("path").rlike(r"^([a-zA-Z][a-zA-Z0-9+.-]*:)?/"), F.col("path")).otherwise(F.concat(F.lit(folder + "/"), "path"))))


def manifest_times(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.try_to_timestamp(F.col(c)) for c in ("ingested_at", "source_published_at")})


def with_content(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """``manifest`` with the bytes of each payload that lies in ``folder``, met by the end of its path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select(F.regexp_extract("path", r"([^/]+)$", 1).alias("_name"), "content")
    return manifest.withColumn("_name", F.regexp_extract("path", r"([^/]+)$", 1)).join(files, "_name", "left").drop("_name")


def digest_mismatches(payloads: DataFrame) -> DataFrame:
    """(uri, sha256, actual) of the payloads whose content isn't what the manifest says; has to be empty."""
    return payloads.select("uri", "sha256", F.sha2(F.col("content"), 256).alias("actual")).where(~F.col("sha256").eqNullSafe(F.col("actual")))


def archive(payloads: DataFrame, media_type: Column) -> DataFrame:
    """One row a content: sha256, size, media type, and the first payload (by ingestion, then uri) that brought it."""
    kept = payloads.withColumn("_d", F.sha2(F.col("content"), 256)).groupBy("_d").agg(F.min(F.struct("ingested_at", "uri")).alias("_f"), F.first(F.octet_length("content")).cast("bigint").alias("size"), F.min(media_type).alias("media_type"))
    return kept.select(F.col("_d").alias("sha256"), "_f.uri", "_f.ingested_at", "size", "media_type")


def unarchived(archive_rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Contents that the archive lacks; those it has are immutable and never written again."""
    return archive_rows.join(stored.select("sha256"), "sha256", "left_anti")


def media_type(header: Column) -> Column:
    """``text/xml`` of ``Text/XML; charset=utf-8``."""
    return F.lower(F.trim(F.split_part(header, F.lit(";"), F.lit(1))))


def first_filled(*columns: Column) -> Column:
    return F.coalesce(*map(blank_to_null, columns))


def watermark(observations: DataFrame, payloads: DataFrame, source: str, dataset_start: str) -> DataFrame:
    """One row of JSON: how far a source's table reaches, and the payloads it came from.

    The digests of all payloads are a table of their own (``archive``); here stand their number and their sum
    (of the first 32 bits), which their order doesn't change.
    """
    digests = payloads.select("sha256").distinct().agg(F.count("*").alias("raw_objects"), F.sum(F.conv(F.substring("sha256", 1, 8), 16, 10).cast("bigint")).alias("raw_sum"), F.lit(1).alias("_one"))
    reach = payloads.agg(F.max("ingested_at").alias("as_of"), F.lit(1).alias("_one")).join(digests, "_one")
    counted = observations.agg(F.count("*").alias("observation_count"), F.lit(1).alias("_one"))
    row = reach.join(counted, "_one").select(F.lit(source).alias("source"), F.lit(dataset_start).alias("dataset_start"), F.date_format("as_of", "yyyy-MM-dd'T'HH:mm:ss").alias("as_of"), "raw_objects", "raw_sum", "observation_count")
    return row.select(F.to_json(F.struct(*sorted(row.columns))).alias("json"))


def completeness(source: str, through: Column, gaps: DataFrame) -> DataFrame:
    """One row of JSON: up to when a source is complete, and the intervals that are known to be missing."""
    each = gaps.select(F.struct(F.date_format("start", "yyyy-MM-dd'T'HH:mm:ss").alias("start"), F.date_format("end", "yyyy-MM-dd'T'HH:mm:ss").alias("end")).alias("g"))
    return each.agg(F.array_sort(F.collect_list("g")).alias("unavailable_intervals")).select(F.to_json(F.struct(F.lit(source).alias("source"), F.date_format(through, "yyyy-MM-dd'T'HH:mm:ss").alias("source_complete_through"), "unavailable_intervals")).alias("json"))


# --- stations ------------------------------------------------------------------------------------


def region_code(network: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(network, "_ASOS$", ""), "_+$", "")


def country(network: Column) -> Column:
    """``AU__ASOS`` is a country, ``CA_AB_ASOS`` a Canadian province, other networks are states of the US."""
    region = region_code(network)
    return F.when(F.contains(network, F.lit("__ASOS")), region).when(F.startswith(network, F.lit("CA_")) & (F.length(region) > 2), "CA").otherwise("US")


def station_features(payloads: DataFrame, now: Column, text: str = "content", network: str = "network") -> DataFrame:
    """Stations of GeoJSON payloads, one a network; an open archive ends today."""
    schema = "struct<features:array<struct<id:string,geometry:struct<coordinates:array<double>>,properties:struct<sname:string,elevation:double,county:string,wfo:string,tzname:string,online:boolean,archive_begin:string,archive_end:string>>>>"
    each = payloads.select(network, F.explode(F.from_json(F.col(text).cast("string"), schema)["features"]).alias("f"))
    date = lambda c: F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).cast("timestamp_ntz")
    return each.select(
        F.col("f.id").alias("station"), F.col("f.properties.sname").alias("name"), F.col("f.geometry.coordinates")[0].alias("longitude"), F.col("f.geometry.coordinates")[1].alias("latitude"),
        F.col("f.properties.elevation").alias("elevation"), region_code(F.col(network)).alias("state"), country(F.col(network)).alias("country"), F.col("f.properties.online").alias("online"),
        date(F.col("f.properties.archive_begin")).alias("archive_begin"), F.coalesce(date(F.col("f.properties.archive_end")), F.date_trunc("day", now).cast("timestamp_ntz")).alias("archive_end"),
    )


def active(stations: DataFrame, start: Column, end: Column, online_only: bool = False) -> DataFrame:
    """Stations whose archive overlaps [start, end]."""
    found = stations.where((F.col("archive_begin") <= end) & (F.col("archive_end") >= start))
    return found.where("online") if online_only else found


# --- pages, windows, cursors ---------------------------------------------------------------------


def off_day(features: DataFrame, time: str, day: Column) -> DataFrame:
    """Rows of a page that don't belong to the day it was asked for, or have no time; has to be empty."""
    return features.where(F.col(time).isNull() | (F.to_date(F.col(time)) != day))


def malformed(payloads: DataFrame, text: str, schema: str, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(good, quarantined): rows whose JSON has every required field, with the parsed column ``parsed``; and the others with the reason."""
    parsed = payloads.withColumn("parsed", F.from_json(F.col(text), schema))
    reason = F.when(~F.coalesce(F.is_valid_utf8(F.col(text)), F.lit(False)), "no text").when(F.get_json_object(F.col(text), "$").isNull(), "not JSON")
    for name in required:
        reason = reason.when(F.col(f"parsed.{name}").isNull(), f"no {name}")
    marked = parsed.withColumn("reason", reason)
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL").drop("parsed")


def guarded_years(rows: DataFrame, time: str, first: int, last: int) -> DataFrame:
    """Rows up to the end of ``last``; a row before ``first`` is an error."""
    year = F.year(time)
    checked = F.when(year < first, F.raise_error(F.concat(F.lit(f"rows before {first}: "), F.col(time).cast("string")))).otherwise(F.lit(True))
    return rows.where(checked.cast("boolean")).where(year <= last)


def year_report(rows: DataFrame, time: str, first: int, last: int) -> DataFrame:
    """(verdict, n): how many rows the guard would reject, skip or keep."""
    year = F.year(time)
    return rows.groupBy(F.when(year < first, "rejected").when(year > last, "skipped").otherwise("kept").alias("verdict")).agg(F.count("*").alias("n"))


def capture_bounds(now: Column, cursor: Column) -> tuple[Column, Column]:
    """From the cursor, or six hours before the end, to the last full hour that is an hour old."""
    end = F.date_trunc("hour", now - F.expr("interval 1 hour")).cast("timestamp_ntz")
    return F.coalesce(cursor, end - F.expr("interval 6 hours")), end


def capture_chunks(cursors: DataFrame, now: str = "now", cursor: str = "cursor", hours: int = 6, overlap: int = 6, retention_days: int = 29) -> DataFrame:
    """The chunks that a capture commits one by one: (start, end, read_from); each reads ``overlap`` hours again.

    A cursor beyond the source's retention is an error; one at the end has no chunk.
    """
    start, end = capture_bounds(F.col(now), F.col(cursor))
    ranged = cursors.withColumn("_a", start).withColumn("_b", end)
    late = F.col(cursor).isNotNull() & (F.col("_b") - F.expr(f"interval {retention_days} days") > F.col(cursor))
    ranged = ranged.where(F.when(late, F.raise_error(F.lit("the cursor is beyond the source's retention"))).otherwise(F.lit(True)).cast("boolean")).where("_a < _b")
    starts = ranged.withColumn("start", F.explode(F.expr(f"sequence(_a, _b - interval 1 microsecond, interval {hours} hours)")))
    starts = starts.withColumn("end", F.least(F.col("start") + F.expr(f"interval {hours} hours"), F.col("_b")))
    return starts.withColumn("read_from", F.col("start") - F.expr(f"interval {overlap} hours")).drop("_a", "_b")


def advanced(cursor: Column, end: Column) -> Column:
    """A cursor never goes back."""
    return F.greatest(cursor, end)


def reread_windows(runs: DataFrame, now: str = "now") -> DataFrame:
    """The windows that each run reads again: the last 6 hours, once a day (at midnight) the last 72, from the full hour on."""
    hours = F.when(F.hour(now) == 0, 72).otherwise(6)
    return runs.withColumn("start", F.expr(f"date_trunc('hour', {now} - make_interval(0, 0, 0, 0, case when hour({now}) = 0 then 72 else 6 end)) :: timestamp_ntz")).withColumn("hours", hours).withColumn("end", F.col(now))


def incremental_start(frame: DataFrame, time: str, hours: int = 2) -> DataFrame:
    """One row: from where on an incremental load reads, ``hours`` before the newest row."""
    return frame.agg((F.max(time) - F.expr(f"interval {hours} hours")).alias("start"))


def coverage_cutoff(now: Column, year: Column) -> Column:
    """The end of what a year's table can cover: now, or the year's end."""
    return F.least(now, F.make_timestamp_ntz(year + 1, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))


def may_create(year: Column, now: Column, previous: Column, grace_days: int = 7) -> Column:
    """Whether a missing year's table may be made: the current year, in its first days, if the year before is there."""
    early = (year == F.year(now)) & (now < F.make_timestamp_ntz(year, F.lit(1), F.lit(1), F.lit(0), F.lit(0), F.lit(0)) + F.expr(f"interval {grace_days} days"))
    return early & previous


def batch_plan(counts: DataFrame, key: str, size: str, target: int) -> DataFrame:
    """(key, batch): whole keys in order, cut into batches of ``target`` rows; a larger key is a batch of its own.

    A fold over one row a station, in order, in constant memory; the rows themselves never come here.
    """

    def cut(frames):
        batch, held, first = 0, 0, True
        for frame in frames:
            out = []
            for n in frame[size].tolist():
                if not first and held + n > target:
                    batch, held = batch + 1, 0
                first, held = False, held + n
                out.append(batch)
            yield frame[[key]].assign(batch=out)

    one = counts.select(key, size).repartition(1).sortWithinPartitions(key)
    return one.mapInPandas(cut, f"{key} {counts.schema[key].dataType.simpleString()}, batch bigint")


def hours_back(now: datetime, hours: int) -> tuple[datetime, datetime]:
    """The re-read window of a run as instants: its start on the full hour."""
    start = now - timedelta(hours=hours)
    return start.replace(minute=0, second=0, microsecond=0), now
