"""Queries over datasets by year, raw payloads, stations, windows and cursors, written tables and streams, each with its SQL twin.

``orders`` by the year of its date stands for the partitioned dataset, ``documents`` for raw payloads.
Tables that a query writes and reads again lie in the session's shared folder.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galefold import schema
from galefold.functions import columns as C
from galefold.operators import checks, frames, places, reconcile, sequences, spans
from galefold.plans.catalog import _PLACES, _partitions, _places, query, rounded, t
from galefold.sources import geo, partitions, payloads, reports
from galefold.sources.workspace import fresh_folder, path_and_files
from galefold.streaming import upserts


def table(s: SparkSession, values: str, names: str) -> DataFrame:
    return s.sql(f"SELECT * FROM VALUES {values} AS t({names})")


# --- the dataset by year -------------------------------------------------------------------------


def _years(s, d) -> str:
    """``orders`` written by year: station is the customer, valid the date."""
    root = fresh_folder(s, "years")
    rows = t(s, d, "orders").select(F.col("o_custkey").alias("station"), F.col("o_orderdate").alias("valid"), "o_orderkey", "o_totalprice")
    partitions.write_years(rows, root, rows_per_file=100_000)
    return root


_ORDERS = "SELECT o_custkey AS station, o_orderdate AS valid, o_orderkey, o_totalprice FROM orders"


@query(f"{_ORDERS} WHERE o_orderdate >= '1996-11-01' AND o_orderdate < '1998-01-01'")
def partitioned_year_range(s, d):
    return partitions.read_years(s, _years(s, d), "1996-11-01", "1998-01-01").drop("year")


@query(f"{_ORDERS} WHERE o_orderdate >= '1990-01-01' AND o_orderdate < '1997-06-01'")
def unreadable_years_skipped(s, d):
    """A year whose file is no Parquet is skipped."""
    root = _years(s, d)
    s.range(1).select(F.lit("broken").alias("value")).coalesce(1).write.text(f"{root}/year=1990", compression="none")
    place, files = path_and_files(s, f"{root}/year=1990")
    for f in files.listStatus(place):
        name = f.getPath().getName()
        if name.endswith(".txt"):
            files.rename(f.getPath(), path_and_files(s, f"{root}/year=1990/data.parquet")[0])
    known = s.read.parquet(f"{root}/year=1996").schema
    return partitions.readable_years(s, root, "1990-01-01", "1997-06-01", schema=T.StructType([*known.fields, T.StructField("year", T.IntegerType())])).drop("year")


@query("SELECT y AS year, (SELECT count(*) FROM orders WHERE year(o_orderdate) = y)::BIGINT AS n FROM (VALUES (1997)) v(y)")
def one_year_or_none(s, d):
    root = _years(s, d)
    assert partitions.read_year(s, root, 1901) is None
    return partitions.read_year(s, root, 1997).groupBy(F.col("year").cast("int").alias("year")).agg(F.count("*").alias("n"))


@query("SELECT year(o_orderdate)::INT AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders WHERE year(o_orderdate) IN (1996, 1998) GROUP BY 1")
def file_list_view(s, d):
    """An explicit list of year folders under one base path, asked by SQL over a temporary view."""
    root = _years(s, d)
    s.read.option("basePath", root).parquet(f"{root}/year=1996", f"{root}/year=1998").createOrReplaceTempView("listed_years")
    return s.sql("SELECT cast(year AS int) AS year, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM listed_years GROUP BY year")


@query("SELECT year(o_orderdate)::INT AS year, count(*) AS n FROM orders GROUP BY 1")
def glob_view(s, d):
    root = _years(s, d)
    s.read.option("basePath", root).parquet(f"{root}/year=*").createOrReplaceTempView("all_years")
    return s.sql("SELECT cast(year AS int) AS year, count(*) AS n FROM all_years GROUP BY year")


@query(f"{_ORDERS} WHERE o_custkey BETWEEN 10 AND 40 AND year(o_orderdate) = 1997")
def station_key_range(s, d):
    """A range of the sort key within one year: row groups outside of it are skipped by their statistics."""
    return s.read.parquet(_years(s, d)).where("year = 1997 AND station BETWEEN 10 AND 40").drop("year")


@query("SELECT count(DISTINCT year(o_orderdate)) AS partitions, count(*) AS rows, min(year(o_orderdate))::INT AS first_year, max(year(o_orderdate))::INT AS last_year, true AS has_bytes FROM orders")
def dataset_info(s, d):
    info = partitions.dataset_info(s.read.parquet(_years(s, d)))
    return info.select("partitions", "rows", F.col("first_year").cast("int").alias("first_year"), F.col("last_year").cast("int").alias("last_year"), (F.col("bytes") > 0).alias("has_bytes"))


@query("SELECT 0::BIGINT AS unsorted_files, (SELECT count(*) FROM orders) AS rows")
def written_in_order(s, d):
    """Files of a written dataset ascend by station, time and order within."""
    root = fresh_folder(s, "sorted")
    rows = t(s, d, "orders").select(F.col("o_custkey").alias("station"), "o_orderkey", F.col("o_orderdate").alias("valid"))
    partitions.write_years(rows, root, rows_per_file=100_000, keys=("station", "o_orderkey", "valid"))
    back = s.read.parquet(root)
    bad = partitions.out_of_order(back, "station", "o_orderkey", "valid").agg(F.count("*").alias("unsorted_files"))
    return bad.crossJoin(back.agg(F.count("*").alias("rows")))  # one row each


@query("SELECT year(o_orderdate)::INT AS year, count(*) AS n FROM orders WHERE year(o_orderdate) IN (1996, 1997) GROUP BY 1")
def backfill_create_only(s, d):
    """Years are made one by one; one that is there is refused."""
    root = fresh_folder(s, "backfill")
    rows = t(s, d, "orders").select(F.col("o_custkey").alias("station"), F.col("o_orderdate").alias("valid"))
    for year in (1996, 1997):
        partitions.create_year(rows, root, year)
    try:
        partitions.create_year(rows, root, 1997)
    except Exception as refused:  # noqa: BLE001
        if "exists" not in str(refused).lower():
            raise
    return s.read.parquet(root).groupBy(F.col("year").cast("int").alias("year")).agg(F.count("*").alias("n"))


@query("SELECT 1::BIGINT AS files, count(*) AS rows, 0::BIGINT AS unsorted_files FROM orders WHERE year(o_orderdate) = 1997")
def compacted_year(s, d):
    """A year's files put together into one, in the order of the keys."""
    root, to = fresh_folder(s, "parts"), fresh_folder(s, "compact")
    rows = t(s, d, "orders").where("year(o_orderdate) = 1997").select(F.col("o_custkey").alias("station"), "o_orderkey", F.col("o_orderdate").alias("valid"))
    partitions.write_years(rows, root, rows_per_file=200, keys=("station", "o_orderkey", "valid"))
    partitions.compact_year(s, root, 1997, to, keys=("station", "o_orderkey", "valid"))
    back = s.read.parquet(to)
    sizes = back.agg(F.count_distinct("_metadata.file_path").alias("files"), F.count("*").alias("rows"))
    return sizes.crossJoin(partitions.out_of_order(back, "station", "o_orderkey", "valid").agg(F.count("*").alias("unsorted_files")))  # one row each


@query("SELECT date_trunc('hour', ts)::TIMESTAMP + INTERVAL 1 HOUR AS hour, count(DISTINCT user_id) AS n FROM (SELECT ts - INTERVAL 1 MICROSECOND AS ts, user_id FROM events WHERE ts > TIMESTAMP '2024-01-18 00:00:00' AND ts <= TIMESTAMP '2024-01-20 00:00:00') GROUP BY 1")
def bounded_hour_counts(s, d):
    """Stations of each hour of two days: two columns and a range of the time reach the scan."""
    rows = t(s, d, "events").where("ts > timestamp_ntz'2024-01-18 00:00:00' AND ts <= timestamp_ntz'2024-01-20 00:00:00'")
    return rows.groupBy(C.hour_label(F.col("ts")).alias("hour")).agg(F.count_distinct("user_id").alias("n"))


@query("SELECT event_id, TRY_CAST(CASE WHEN event_id % 3 = 0 THEN 'M' WHEN event_id % 3 = 1 THEN '' ELSE value::VARCHAR END AS DOUBLE) AS value FROM events")
def tolerant_casts(s, d):
    k = F.col("event_id") % 3
    return t(s, d, "events").select("event_id", F.when(k == 0, "M").when(k == 1, "").otherwise(F.col("value").cast("string")).try_cast("double").alias("value"))


@query("SELECT event_id, ts >= (SELECT max(ts) FROM events) - INTERVAL 72 HOUR AS healed FROM events WHERE event_id % 3 = 0")
def late_reports(s, d):
    """Which late reports the scheduled re-reads still take in; older ones need a window given by hand."""
    newest = t(s, d, "events").agg(F.max("ts").alias("newest"))
    rows = t(s, d, "events").where("event_id % 3 = 0").crossJoin(F.broadcast(newest))  # one row
    return rows.select("event_id", (F.col("ts") >= F.col("newest") - F.expr("interval 72 hours")).alias("healed"))


@query("SELECT * FROM (VALUES ('columns changed'), ('type of value changed'), ('rows out of order')) v(problem)")
def version_violations(s, d):
    """Two versions of a table that differ in their columns' order and types, the later one unsorted."""
    e = t(s, d, "events").select("user_id", "ts", "value")
    later = e.select("ts", "user_id", F.col("value").cast("float").alias("value"))
    found = reconcile.column_violations(e.schema, later.schema)
    root = fresh_folder(s, "versions")
    later.coalesce(1).sortWithinPartitions(F.col("user_id").desc(), "ts").write.parquet(root)
    unsorted = partitions.out_of_order(s.read.parquet(root), "user_id", "ts").select(F.lit("rows out of order").alias("problem"))
    return s.createDataFrame([(x.split(":")[0],) for x in found], "problem string").union(unsorted)


@query("SELECT column_name, problem FROM (VALUES ('extra_column', 'unknown'), ('wxcodes', 'missing')) v(column_name, problem)")
def schema_difference(s, d):
    """Columns that a table lacks or that its schema doesn't know, from the footer alone."""
    names = [f.name for f in schema.WIDE_V1 if f.name != "wxcodes"]
    root = fresh_folder(s, "schema")
    t(s, d, "events").limit(1).select(*[F.lit(None).cast("double").alias(n) for n in [*names, "extra_column"]]).write.parquet(root)
    missing, extra = schema.compared(s.read.parquet(root), schema.WIDE_V1)
    return s.createDataFrame([(n, "missing") for n in missing] + [(n, "unknown") for n in extra], "column_name string, problem string")


@query("SELECT event_id::VARCHAR AS source_record_id, value AS value_float, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 3600.0::DOUBLE END AS period_seconds, row_number() OVER (ORDER BY user_id::VARCHAR, event_type, ts, coalesce(CASE WHEN event_id % 3 = 0 THEN NULL ELSE 3600.0 END, -1), event_id::VARCHAR) AS place FROM events WHERE user_id < 5")
def typed_round_trip(s, d):
    """Normalized records written with their schema, read back, in canonical order (no period sorts first)."""
    from pyspark.sql import Window

    e = t(s, d, "events").where("user_id < 5")
    rows = e.select(F.lit("x").alias("source"), F.col("user_id").cast("string").alias("station_id"), F.col("event_id").cast("string").alias("source_record_id"), F.col("event_type").alias("variable"), F.col("value").alias("value_float"), F.col("ts").cast("timestamp").alias("observed_at"), F.when(F.col("event_id") % 3 != 0, 3600.0).alias("period_seconds"), F.lit("mean").alias("statistic"))
    path = fresh_folder(s, "normalized")
    schema.write_records(schema.conform(rows, schema.NORMALIZED), "normalized", path)
    back = schema.read_records(s, "normalized", path)
    # One window over a few stations, to show the order; tables are sorted when written.
    return back.select("source_record_id", "value_float", "period_seconds", F.row_number().over(Window.orderBy(*sequences.sort_key(), "source_record_id")).cast("bigint").alias("place"))


@query("SELECT station, name FROM (SELECT c_custkey AS station, c_name AS name FROM customer WHERE c_custkey < 50)")
def conformed_to_base(s, d):
    """Fetched rows take the base's column order and types; text in place of a number is refused."""
    base = t(s, d, "customer").select(F.col("c_custkey").alias("station"), F.col("c_name").alias("name"))
    fetched = t(s, d, "customer").where("c_custkey < 50").select(F.col("c_name").alias("name"), F.col("c_custkey").cast("int").alias("station"), F.lit(1).alias("more"))
    try:
        schema.conform_to(fetched.withColumn("station", F.col("station").cast("string")), base)
    except ValueError:
        return schema.conform_to(fetched, base)
    raise AssertionError("text was taken for a number")


# --- raw payloads --------------------------------------------------------------------------------


def _payloads(s, d):
    docs = t(s, d, "documents").where("text IS NOT NULL")
    wrong = F.when(F.col("doc_id") % 50 == 7, F.lit("0" * 64)).otherwise(F.sha2(F.col("text").cast("binary"), 256))
    ingested = F.expr("timestamp_ntz'2026-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, 0, doc_id % 977)")
    return docs.select(F.concat(F.lit("u/"), F.col("doc_id")).alias("uri"), wrong.alias("sha256"), ingested.alias("ingested_at"), F.col("text").cast("binary").alias("content"), F.lit("Text/CSV; charset=utf-8").alias("header"))


_PAYLOADS = "(SELECT 'u/' || doc_id AS uri, CASE WHEN doc_id % 50 = 7 THEN repeat('0', 64) ELSE sha256(text) END AS sha256, TIMESTAMP '2026-01-01' + to_seconds(doc_id % 977) AS ingested_at, text, sha256(text) AS actual FROM documents WHERE text IS NOT NULL)"


@query(f"SELECT uri, sha256, actual FROM {_PAYLOADS} WHERE sha256 <> actual")
def payload_digests(s, d):
    return payloads.digest_mismatches(_payloads(s, d))


@query(f"SELECT actual AS sha256, arg_min(uri, (ingested_at, uri)) AS uri, min(ingested_at) AS ingested_at, octet_length(any_value(encode(text)))::BIGINT AS size, 'text/csv' AS media_type FROM {_PAYLOADS} GROUP BY actual")
def content_archive(s, d):
    return payloads.archive(_payloads(s, d), payloads.media_type(F.col("header")))


@query(f"SELECT DISTINCT actual AS sha256 FROM {_PAYLOADS} WHERE actual NOT IN (SELECT actual FROM {_PAYLOADS} WHERE uri LIKE '%1')")
def unarchived_payloads(s, d):
    rows = _payloads(s, d)
    whole, stored = (payloads.archive(x, F.lit("text/csv")) for x in (rows, rows.where("uri LIKE '%1'")))
    return payloads.unarchived(whole, stored).select("sha256")


@query("SELECT p.uri, p.sha256, p.n AS size, TIMESTAMP '2026-03-01 05:00:00' AS ingested_at, CASE WHEN p.uri = 'u/a' THEN TIMESTAMP '2026-03-01 04:00:00' END AS source_published_at FROM (SELECT 'u/a' AS uri, sha256('alpha') AS sha256, 5::BIGINT AS n UNION ALL SELECT 'u/b', sha256('beta'), 4) p")
def manifest_and_files(s, d):
    """A JSON manifest with payload files beside it, paths relative to the manifest, bytes checked by digest."""
    root = fresh_folder(s, "manifest")
    for name, text in (("a", "alpha"), ("b", "beta")):
        _put(s, f"{root}/raw/{name}.csv", text)
    digest = {r[0]: r[1] for r in table(s, "('a', 'alpha'), ('b', 'beta')", "n, x").select("n", F.sha2(F.col("x").cast("binary"), 256)).collect()}
    items = [{"path": f"raw/{n}.csv", "uri": f"u/{n}", "sha256": digest[n], "ingested_at": "2026-03-01T05:00:00+00:00", "source_published_at": "2026-03-01T04:00:00Z" if n == "a" else None} for n in "ab"]
    _put(s, f"{root}/manifest.json", json.dumps({"payloads": items, "source_complete_through": "2026-03-01T00:00:00Z"}))
    rows = payloads.with_content(s, payloads.read_manifest(s, f"{root}/manifest.json"), f"{root}/raw")
    assert payloads.digest_mismatches(rows).isEmpty()
    return rows.select("uri", "sha256", F.octet_length("content").cast("bigint").alias("size"), *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("ingested_at", "source_published_at")])


def _put(s, path: str, text: str) -> None:
    place, files = path_and_files(s, path)
    out = files.create(place, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


@query(f"""SELECT '{{"as_of":"' || strftime(max(ingested_at), '%Y-%m-%dT%H:%M:%S') || '","dataset_start":"2026-01-01T00:00:00","observation_count":' || (SELECT count(*) FROM events) || ',"raw_objects":' || count(DISTINCT sha256) || ',"raw_sum":' ||
(SELECT sum(('0x' || substr(sha256, 1, 8))::BIGINT)::BIGINT FROM (SELECT DISTINCT sha256 FROM {_PAYLOADS})) || ',"source":"iem"}}' AS json FROM {_PAYLOADS}""")
def watermark_document(s, d):
    return payloads.watermark(t(s, d, "events"), _payloads(s, d), "iem", "2026-01-01T00:00:00")


@query("""SELECT '{"source":"climate","source_complete_through":"2026-02-01T00:00:00","unavailable_intervals":[{"start":"2026-01-03T00:00:00","end":"2026-01-04T00:00:00"},{"start":"2026-01-09T06:00:00","end":"2026-01-09T07:00:00"}]}' AS json""")
def completeness_document(s, d):
    gaps = table(s, "(timestamp_ntz'2026-01-09 06:00:00', timestamp_ntz'2026-01-09 07:00:00'), (timestamp_ntz'2026-01-03 00:00:00', timestamp_ntz'2026-01-04 00:00:00')", "start, end")
    return payloads.completeness("climate", F.lit("2026-02-01").cast("timestamp_ntz"), gaps)


@query("""SELECT event_id, CASE WHEN event_id % 9 = 4 THEN 'not JSON' ELSE 'no k' END AS reason FROM events WHERE event_id % 9 IN (4, 5)""")
def quarantined_payloads(s, d):
    broken = F.when(F.col("event_id") % 9 == 4, F.lit("{k:")).when(F.col("event_id") % 9 == 5, F.lit('{"j": 1}')).otherwise(F.col("props"))
    return payloads.malformed(t(s, d, "events").select("event_id", broken.alias("props")), "props", "struct<k:bigint>", ["k"])[1].select("event_id", "reason")


@query("SELECT CASE WHEN year(o_orderdate) < 1996 THEN 'rejected' WHEN year(o_orderdate) > 1998 THEN 'skipped' ELSE 'kept' END AS verdict, count(*) AS n FROM orders GROUP BY 1")
def year_guard(s, d):
    return payloads.year_report(t(s, d, "orders"), "o_orderdate", 1996, 1998)


@query("SELECT count(*) AS n FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998")
def guarded_rows(s, d):
    rows = t(s, d, "orders")
    return payloads.guarded_years(rows.where("o_orderdate >= '1996-01-01'"), "o_orderdate", 1996, 1998).agg(F.count("*").alias("n"))


@query("SELECT event_id FROM events WHERE date_trunc('day', ts) <> DATE '2024-01-10' AND event_id % 10 = 0")
def pages_off_day(s, d):
    return payloads.off_day(t(s, d, "events").where("event_id % 10 = 0"), "ts", F.lit("2024-01-10").cast("date")).select("event_id")


@query("SELECT event_id, occurrence, lag(occurrence) OVER (PARTITION BY user_id, event_type ORDER BY event_id) AS supersedes FROM (SELECT *, event_type || floor(value / 100)::INT AS occurrence, row_number() OVER (PARTITION BY user_id, event_type, floor(value / 100) ORDER BY event_id) AS n FROM events WHERE user_id < 20) WHERE n = 1")
def payload_scope_revisions(s, d):
    rows = t(s, d, "events").where("user_id < 20").withColumn("occurrence", F.concat("event_type", F.floor(F.col("value") / 100).cast("int")))
    return sequences.within_payload(rows, "user_id", "event_type", "occurrence", "event_id").select("event_id", "occurrence", F.col("supersedes_revision_id").alias("supersedes"))


@query("""SELECT event_id, sha256('{"event_type":"' || event_type || '","user_id":' || user_id || '}') AS content_id, sha256('{"content_revision_id":"' || sha256('{"event_type":"' || event_type || '","user_id":' || user_id || '}') || '","raw_uri":"u/' || user_id || '"}') AS occurrence_id FROM events""")
def sorted_json_ids(s, d):
    """Ids of content as JSON with sorted keys, and of an occurrence of it in a payload."""
    own = t(s, d, "events").select("event_id", "user_id", C.json_id(user_id=F.col("user_id"), event_type=F.col("event_type")).alias("content_id"))
    return own.select("event_id", "content_id", C.json_id(raw_uri=F.concat(F.lit("u/"), "user_id"), content_revision_id=F.col("content_id")).alias("occurrence_id"))


# --- readers of raw formats ----------------------------------------------------------------------


@query("""SELECT user_id::VARCHAR AS station, date_trunc('minute', ts)::TIMESTAMP AS valid, value AS tmpf, (CASE event_id % 5 WHEN 0 THEN 0.0 WHEN 1 THEN NULL ELSE 0.25 END)::DOUBLE AS p01m, event_id % 5 = 0 AS is_trace, CASE WHEN event_id % 2 = 0 THEN 'RA' END AS wxcodes FROM events WHERE event_id % 7 <> 0""")
def hourly_csv_rows(s, d):
    """Reports as CSV files: blanks and M are missing, T is a trace, reports without a temperature are dropped."""
    e = t(s, d, "events")
    value = F.col("value").cast("string")
    text = {"station": F.col("user_id").cast("string"), "valid": F.date_format("ts", "yyyy-MM-dd HH:mm"), **{m: F.lit("1") for m in schema.MEASURES}}
    text |= {"tmpf": F.when(F.col("event_id") % 7 == 0, F.lit("")).otherwise(value), "p01m": F.when(F.col("event_id") % 5 == 0, "T").when(F.col("event_id") % 5 == 1, "M").otherwise(" 0.25 ")}
    text |= {"lon": F.lit("-73.8"), "lat": F.lit("40.6"), "wxcodes": F.when(F.col("event_id") % 2 == 0, "RA").otherwise("")}
    root = fresh_folder(s, "csv")
    e.select(*[c.alias(n) for n, c in text.items()]).write.option("header", "true").csv(root)
    return reports.read_hourly_csv(s, root).select("station", F.col("valid").cast("timestamp_ntz").alias("valid"), "tmpf", "p01m", "is_trace", "wxcodes")


@query("""SELECT user_id::VARCHAR AS station_id, date_trunc('second', ts)::TIMESTAMP AS observed_at, v.variable, round(CASE v.variable WHEN 'air_temperature' THEN value ELSE (event_id % 36) * 10.0 END, 6) AS value_float, v.unit, v.variable = 'air_temperature' AND event_id % 11 = 0 AS is_trace
FROM events, (VALUES ('air_temperature', 'degC'), ('wind_direction', 'degree')) v(variable, unit) WHERE NOT (v.variable = 'wind_direction' AND event_id % 4 = 1)""")
def geojson_features(s, d):
    """Climate features in GeoJSON, one collection a station; a flag of no data hides its number."""
    flag = lambda odd, mark: F.when(odd, mark)
    props = F.struct(
        F.col("user_id").cast("string").alias("CLIMATE_IDENTIFIER"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("UTC_DATE"), F.col("value").alias("TEMP"), flag(F.col("event_id") % 11 == 0, "T").alias("TEMP_FLAG"),
        (F.col("event_id") % 36).alias("WIND_DIRECTION"), flag(F.col("event_id") % 4 == 1, "na").alias("WIND_DIRECTION_FLAG"),
    )
    feature = F.struct(F.col("event_id").cast("string").alias("id"), F.struct(F.array(F.lit(-75.0), F.lit(45.0)).alias("coordinates")).alias("geometry"), props.alias("properties"))
    each = t(s, d, "events").groupBy("user_id").agg(F.collect_list(feature).alias("features")).select(F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), "features")).alias("content"))
    found = reports.climate_long(reports.climate_features(each))
    return found.select("station_id", F.col("observed_at").cast("timestamp_ntz").alias("observed_at"), "variable", F.round("value_float", 6).alias("value_float"), "unit", "is_trace")


@query("""SELECT CASE WHEN user_id % 3 = 0 THEN 'msc_id:' || user_id WHEN user_id % 3 = 1 THEN 'MSC:tc_id:' || user_id ELSE 'HINT:stn_id:' || user_id END AS station, date_trunc('second', ts)::TIMESTAMP AS result_time, v.name, v.uom, CASE WHEN v.name = 'air_temp' THEN floor(value)::INT::VARCHAR WHEN event_id % 2 = 0 THEN NULL ELSE '7' END AS value
FROM events, (VALUES ('air_temp', 'Cel'), ('pcpn', 'mm')) v(name, uom)""")
def xml_observations(s, d):
    """Observation collections with two members and namespaces; identity by the network's id, provider and local id, or a hint."""
    e = t(s, d, "events")
    kind = F.col("user_id") % 3
    element = lambda name, value: F.concat(F.lit(f'<e:element name="{name}" uom="unitless" value="'), value, F.lit('"/>'))
    user = F.col("user_id").cast("string")
    ids = F.when(kind == 0, F.concat(element("msc_id", user), element("data_pvdr", F.lit("MSC")))).when(kind == 1, F.concat(element("data_pvdr", F.lit("MSC")), element("tc_id", user))).otherwise(element("stn_id", user))
    data = F.concat(F.lit('<element name="air_temp" uom="Cel" value="'), F.floor("value").cast("string"), F.lit('"><qualifier name="qa" value="100"/></element><element name="pcpn" uom="mm" value="'), F.when(F.col("event_id") % 2 == 0, " msng ").otherwise("7"), F.lit('"/>'))
    member = F.concat(
        F.lit('<om:member><om:Observation><om:metadata><e:set><e:identification-elements>'), ids, F.lit("</e:identification-elements></e:set></om:metadata><om:resultTime><gml:TimeInstant><gml:timePosition>"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</gml:timePosition></gml:TimeInstant></om:resultTime><om:result><elements><!-- a > b -->"), data, F.lit("</elements></om:result></om:Observation></om:member>"),
    )
    head = '<om:ObservationCollection xmlns:om="urn:om" xmlns:gml="urn:gml" xmlns:e="urn:e">'
    each = e.groupBy(F.floor(F.col("event_id") / 2)).agg(F.concat(F.lit(head), F.array_join(F.collect_list(member), ""), F.lit("</om:ObservationCollection>")).alias("content"))
    found = reports.observation_xml(each, hint=F.lit("HINT"))
    return found.select("station", F.col("result_time").cast("timestamp_ntz").alias("result_time"), "name", "uom", "value")


@query("""SELECT event_id, CASE WHEN event_id % 3 = 0 THEN value ELSE value + 1 END AS value_float FROM events""")
def field_priority(s, d):
    """Two fields of one variable: the first that has a number counts."""
    wide = t(s, d, "events").select("event_id", C.number(F.when(F.col("event_id") % 3 == 0, F.col("value").cast("string")).otherwise("n/a")).alias("first_field"), (F.col("value") + 1).alias("second_field"))
    fields = [("first_field", "air_temperature", "degC", "mean", None, 1.0), ("second_field", "air_temperature", "degC", "mean", None, 1.0)]
    return reports.long_rows(wide, fields, ["event_id"]).select("event_id", "value_float")


# --- stations ------------------------------------------------------------------------------------

_NETWORKS = "(SELECT c_custkey AS station, CASE c_custkey % 4 WHEN 0 THEN 'CA_ASOS' WHEN 1 THEN 'AU__ASOS' WHEN 2 THEN 'CA_AB_ASOS' ELSE 'NY_ASOS' END AS network, c_acctbal FROM customer)"


def _networks(s, d):
    k = F.col("c_custkey")
    name = F.when(k % 4 == 0, "CA_ASOS").when(k % 4 == 1, "AU__ASOS").when(k % 4 == 2, "CA_AB_ASOS").otherwise("NY_ASOS")
    return t(s, d, "customer").select(k.alias("station"), name.alias("network"), "c_acctbal")


@query(f"SELECT station, rtrim(regexp_replace(network, '_ASOS$', ''), '_') AS region_code, CASE WHEN network = 'AU__ASOS' THEN 'AU' WHEN network = 'CA_AB_ASOS' THEN 'CA' ELSE 'US' END AS country FROM {_NETWORKS}")
def network_regions(s, d):
    return _networks(s, d).select("station", payloads.region_code(F.col("network")).alias("region_code"), payloads.country(F.col("network")).alias("country"))


_STATIONS = f"""(SELECT station::VARCHAR AS station, rtrim(regexp_replace(network, '_ASOS$', ''), '_') AS state, station % 5 <> 0 AS online, TIMESTAMP '1990-01-01' + to_days((station % 40)::INT * 365) AS archive_begin,
CASE WHEN station % 2 = 0 THEN TIMESTAMP '2020-01-01' ELSE TIMESTAMP '2026-09-10' END AS archive_end FROM {_NETWORKS})"""


def _stations(s, d):
    n = _networks(s, d)
    begin = F.expr("date_format(date_add(date'1990-01-01', cast((station % 40) * 365 AS int)), 'yyyy-MM-dd')")
    props = F.struct(F.concat(F.lit("N"), "station").alias("sname"), F.lit(5.0).alias("elevation"), (F.col("station") % 5 != 0).alias("online"), begin.alias("archive_begin"), F.when(F.col("station") % 2 == 0, "2020-01-01").alias("archive_end"))
    feature = F.struct(F.col("station").cast("string").alias("id"), F.struct(F.array(F.lit(-70.0), F.lit(40.0)).alias("coordinates")).alias("geometry"), props.alias("properties"))
    each = n.groupBy("network").agg(F.collect_list(feature).alias("features")).select("network", F.to_json(F.struct("features")).alias("content"))
    return payloads.station_features(each, F.lit("2026-09-10 12:30:00").cast("timestamp_ntz"))


@query(f"SELECT station, state, online, archive_begin, archive_end FROM {_STATIONS}")
def station_metadata(s, d):
    return _stations(s, d).select("station", "state", "online", "archive_begin", "archive_end")


@query(f"SELECT station FROM {_STATIONS} WHERE online AND archive_begin <= TIMESTAMP '2010-12-31' AND archive_end >= TIMESTAMP '2010-01-01'")
def archive_overlap(s, d):
    instant = lambda x: F.lit(x).cast("timestamp_ntz")
    return payloads.active(_stations(s, d), instant("2010-01-01"), instant("2010-12-31"), online_only=True).select("station")


# --- windows and cursors -------------------------------------------------------------------------

_RUNS = "(SELECT event_id, ts AS now, CASE WHEN event_id % 3 = 0 THEN NULL WHEN event_id % 3 = 1 THEN date_trunc('hour', ts)::TIMESTAMP - INTERVAL 20 HOUR ELSE date_trunc('hour', ts)::TIMESTAMP END AS cursor FROM events WHERE event_id % 20 = 0)"


def _runs(s, d):
    hour = F.date_trunc("hour", "ts").cast("timestamp_ntz")
    cursor = F.when(F.col("event_id") % 3 == 1, hour - F.expr("interval 20 hours")).when(F.col("event_id") % 3 == 2, hour)
    return t(s, d, "events").where("event_id % 20 = 0").select("event_id", F.col("ts").alias("now"), cursor.alias("cursor"))


_BOUNDS = f"(SELECT *, coalesce(cursor, date_trunc('hour', now - INTERVAL 1 HOUR)::TIMESTAMP - INTERVAL 6 HOUR) AS a, date_trunc('hour', now - INTERVAL 1 HOUR)::TIMESTAMP AS b FROM {_RUNS})"


@query(f'SELECT event_id, a AS "start", b AS "end" FROM {_BOUNDS}')
def capture_bounds(s, d):
    start, end = payloads.capture_bounds(F.col("now"), F.col("cursor"))
    return _runs(s, d).select("event_id", start.alias("start"), end.alias("end"))


@query(f'SELECT event_id, p AS "start", least(p + INTERVAL 6 HOUR, b) AS "end", p - INTERVAL 6 HOUR AS read_from FROM (SELECT *, unnest(range(a, b, INTERVAL 6 HOUR)) AS p FROM {_BOUNDS} WHERE a < b)')
def capture_chunks(s, d):
    return payloads.capture_chunks(_runs(s, d)).select("event_id", "start", "end", "read_from")


@query(f'SELECT event_id, date_trunc(\'hour\', now - to_hours(CASE WHEN hour(now) = 0 THEN 72 ELSE 6 END))::TIMESTAMP AS "start", now AS "end" FROM {_RUNS}')
def reread_windows(s, d):
    return payloads.reread_windows(_runs(s, d)).select("event_id", "start", "end")


@query(f"SELECT event_id, greatest(cursor, now) AS cursor FROM {_RUNS}")
def cursor_never_back(s, d):
    return _runs(s, d).select("event_id", payloads.advanced(F.col("cursor"), F.col("now")).alias("cursor"))


@query('SELECT max(ts) - INTERVAL 2 HOUR AS "start" FROM events')
def incremental_start(s, d):
    return payloads.incremental_start(t(s, d, "events"), "ts")


@query("SELECT y AS year, least(TIMESTAMP '2026-09-10 12:30:00', make_timestamp(y + 1, 1, 1, 0, 0, 0.0)) AS cutoff FROM (SELECT DISTINCT year(o_orderdate)::INT AS y FROM orders UNION SELECT 2026)")
def coverage_cutoff(s, d):
    years = t(s, d, "orders").select(F.year("o_orderdate").alias("year")).union(s.range(1).select(F.lit(2026))).distinct()
    return years.select("year", payloads.coverage_cutoff(F.lit("2026-09-10 12:30:00").cast("timestamp_ntz"), F.col("year")).alias("cutoff"))


@query("SELECT event_id, day(ts) <= 7 AND event_id % 2 = 0 AS allowed FROM events")
def year_rollover(s, d):
    return t(s, d, "events").select("event_id", payloads.may_create(F.lit(2024), F.col("ts"), F.col("event_id") % 2 == 0).alias("allowed"))


@query("""WITH w AS (SELECT o_orderkey AS id, o_orderdate AS "start", o_orderdate + to_days((10 + o_orderkey % 50)::INT) AS "end", 10 + o_orderkey % 50 <= 31 AS whole FROM orders)
SELECT id, greatest("start", p) AS "start", least("end", p + INTERVAL 1 MONTH) AS "end" FROM (SELECT *, unnest(range(date_trunc('month', "start")::TIMESTAMP, "end", INTERVAL 1 MONTH)) AS p FROM w WHERE NOT whole) UNION ALL SELECT id, "start", "end" FROM w WHERE whole""")
def long_windows_by_month(s, d):
    """Windows of 31 days at most stay whole, longer ones are cut by month."""
    rows = t(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + F.expr("make_interval(0, 0, 0, cast(10 + o_orderkey % 50 as int))")).alias("end"))
    return spans.split_long(rows, "month", 31)


@query("SELECT TIMESTAMP '2026-01-01 05:00:00' AS \"start\", TIMESTAMP '2026-01-03 00:00:00' AS \"end\" UNION ALL SELECT TIMESTAMP '2026-02-01', TIMESTAMP '2026-02-02'")
def window_texts(s, d):
    """START/END texts with zones: parsed to UTC, and merged where they touch."""
    found = spans.parsed("2026-01-02T00:00Z/2026-01-03T00:00Z, 2026-01-01T00:00-05:00/2026-01-02T00:00Z, 2026-02-01T00:00Z/2026-02-02T00:00Z")
    return s.createDataFrame(found, "start timestamp, end timestamp").select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("end").cast("timestamp_ntz").alias("end"))


@query("SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts)::TIMESTAMP END AS parsed FROM events")
def utc_times(s, d):
    """ISO times with Z, an offset, or none (UTC), and one format of their own; others are missing."""
    e = t(s, d, "events").withColumn("n", F.col("event_id") % 4).withColumn("at", F.date_trunc("second", "ts").cast("timestamp_ntz"))
    iso = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(F.col("n") == 0, F.concat(iso(F.col("at")), F.lit("Z"))).when(F.col("n") == 1, F.concat(iso(F.col("at") - F.expr("interval 5 hours")), F.lit("-05:00"))).when(F.col("n") == 2, iso(F.col("at"))).otherwise(F.date_format("at", "yyyyMMddHHmmss"))
    text = F.when(F.col("event_id") % 5 != 0, text).otherwise("yesterday")
    parsed = F.coalesce(C.utc(text), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))
    return e.select("event_id", parsed.cast("timestamp_ntz").alias("parsed"))


@query("SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE ts - INTERVAL 2 HOUR END AS zoned FROM events")
def zones_required(s, d):
    """Times without a zone are refused, others turned to UTC."""
    local = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = F.when(F.col("event_id") % 3 == 0, local).otherwise(F.concat(local, F.lit("+02:00")))
    return t(s, d, "events").select("event_id", C.zoned(text).cast("timestamp_ntz").alias("zoned"))


@query("""WITH RECURSIVE c AS (SELECT user_id, count(*) AS n, row_number() OVER (ORDER BY user_id) AS i FROM events GROUP BY user_id),
f AS (SELECT i, user_id, n AS held, 0::BIGINT AS batch FROM c WHERE i = 1 UNION ALL SELECT c.i, c.user_id, CASE WHEN f.held + c.n > 500 THEN c.n ELSE f.held + c.n END, CASE WHEN f.held + c.n > 500 THEN f.batch + 1 ELSE f.batch END FROM f JOIN c ON c.i = f.i + 1)
SELECT user_id, batch FROM f""")
def batch_cuts(s, d):
    return payloads.batch_plan(t(s, d, "events").groupBy("user_id").agg(F.count("*").alias("n")), "user_id", "n", 500)


# --- texts and numbers ---------------------------------------------------------------------------


@query("SELECT month(ts)::INT AS month, count(*) AS n FROM events WHERE month(ts) IN (1, 2) GROUP BY 1")
def month_counts(s, d):
    return t(s, d, "events").where(F.month("ts").isin(1, 2)).groupBy(F.month("ts").alias("month")).agg(F.count("*").alias("n"))


@query("SELECT event_id, user_id || ' ' || strftime(ts, '%Y-%m-%d %H:%M') AS label FROM events")
def station_labels(s, d):
    return t(s, d, "events").select("event_id", F.concat(F.col("user_id").cast("string"), F.lit(" "), F.date_format("ts", "yyyy-MM-dd HH:mm")).alias("label"))


@query("SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'text/xml' WHEN 1 THEN 'application/geo+json' ELSE '' END AS media_type FROM events")
def media_types(s, d):
    k = F.col("event_id") % 3
    header = F.when(k == 0, "Text/XML; charset=UTF-8").when(k == 1, " application/geo+json ").otherwise(";x=1")
    return t(s, d, "events").select("event_id", payloads.media_type(header).alias("media_type"))


@query("SELECT event_id, CASE WHEN event_id % 4 = 0 THEN event_type WHEN event_id % 4 = 1 THEN 'second' ELSE NULL END AS text FROM events")
def first_filled_key(s, d):
    k = F.col("event_id") % 4
    a, b = F.when(k == 0, F.col("event_type")).otherwise(" "), F.when(k == 1, " second ").when(k == 2, "")
    return t(s, d, "events").select("event_id", payloads.first_filled(a, b).alias("text"))


@query("SELECT event_id, event_id % 7 <> 0 AND event_id % 7 <> 1 AND event_id % 7 <> 2 AS present, event_id % 7 IN (3, 4) AS flagged FROM events")
def missing_codes(s, d):
    """Sentinels of missing text, and climate flags without a number, whatever their case."""
    k = F.col("event_id") % 7
    text = F.when(k == 0, " msng ").when(k == 1, "").when(k == 2, "Na").otherwise("7.5")
    flag = F.when(k == 3, "nd").when(k == 4, " NA").when(k == 5, "T")
    return t(s, d, "events").select("event_id", C.present(text).isNotNull().alias("present"), reports.flagged(flag).alias("flagged"))


@query("SELECT event_id, event_id % 2 = 0 AS contradicted FROM events")
def reasons_named(s, d):
    reasons = C.joined_reasons(F.when(F.col("event_id") % 3 == 0, "physical_bounds"), F.when(F.col("event_id") % 2 == 0, "present_weather_contradicts_zero"))
    return t(s, d, "events").select("event_id", C.has_reason(reasons, "present_weather_contradicts_zero").alias("contradicted"))


@query("SELECT event_id, CASE WHEN event_id % 4 < 2 THEN value END AS value FROM events")
def finite_values(s, d):
    odd = F.when(F.col("event_id") % 4 == 2, F.lit("NaN")).when(F.col("event_id") % 4 == 3, F.lit("-inf")).otherwise(F.col("value").cast("string"))
    return t(s, d, "events").select("event_id", C.finite(odd.try_cast("double")).alias("value"))


@query("SELECT count(*) AS n, count(*) FILTER (WHERE abs(mm - inches * 25.4) <= 1.0) AS consistent FROM (SELECT value / 100 AS inches, CASE WHEN event_id % 9 = 0 THEN value ELSE value * 0.254 + 0.5 END AS mm FROM events)")
def precipitation_units(s, d):
    mm = F.when(F.col("event_id") % 9 == 0, F.col("value")).otherwise(F.col("value") * 0.254 + 0.5)
    return checks.consistent(t(s, d, "events").select((F.col("value") / 100).alias("inches"), mm.alias("mm")), F.col("mm"), F.col("inches") * 25.4, 1.0)


@query(f"""WITH k AS (SELECT station, 6371 * 2 * asin(sqrt(power(sin(radians(latitude - p.y) / 2), 2) + cos(radians(p.y)) * cos(radians(latitude)) * power(sin(radians(longitude - p.x) / 2), 2))) AS km FROM {_PLACES}, (SELECT latitude AS y, longitude AS x FROM {_PLACES} WHERE station = 7) p WHERE station IN (7, 8, 9, 10, 11)),
j AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, value, CASE WHEN event_type <> 'click' THEN value * 2 END AS other, km, user_id, ts FROM events JOIN k ON station = user_id),
g AS (SELECT day, count(*) AS stations, round(CASE WHEN min(km) < 0.01 THEN arg_min(value, (km, ts)) ELSE sum(value / power(km, 2)) / sum(1 / power(km, 2)) END, 6) AS value,
round(CASE WHEN count(other) < 2 THEN NULL WHEN min(km) FILTER (WHERE other IS NOT NULL) < 0.01 THEN arg_min(other, (km, ts)) FILTER (WHERE other IS NOT NULL) ELSE sum(other / power(km, 2)) FILTER (WHERE other IS NOT NULL) / sum(1 / power(km, 2)) FILTER (WHERE other IS NOT NULL) END, 6) AS other FROM j GROUP BY day HAVING count(*) >= 2)
SELECT * FROM g""")
def idw_variables(s, d):
    """Two variables at a station's own place: it decides where it has a value, the others where it has none."""
    here = _places(s, d).where("station = 7").select(F.col("latitude").alias("y"), F.col("longitude").alias("x"))
    near = _places(s, d).where("station BETWEEN 7 AND 11").crossJoin(F.broadcast(here))  # one row
    near = near.select(F.col("station").alias("user_id"), C.haversine(F.col("y"), F.col("x"), F.col("latitude"), F.col("longitude")).alias("distance_km"))
    rows = t(s, d, "events").join(near, "user_id").select(C.day(F.col("ts")).alias("day"), "ts", "distance_km", "value", F.when(F.col("event_type") != "click", F.col("value") * 2).alias("other"))
    found = places.interpolated_all(rows, "day", ["value", "other"], tie="ts")
    return found.select("day", "stations", F.round("value", 6).alias("value"), F.round("other", 6).alias("other"))


# --- selection, comparison, composition ----------------------------------------------------------

_MEASURED = "SELECT user_id, ts, min(value) AS value, min(floor(value / 7)) AS rest, min(event_type) AS kind FROM events WHERE value >= 25 GROUP BY user_id, ts"
_LATER = "SELECT user_id, ts, min(CASE WHEN event_type = 'view' THEN value + 1 ELSE value END) AS value, min(floor(value / 7)) + CASE WHEN min(value) > 300 THEN 1 ELSE 0 END AS rest, min(CASE WHEN event_type = 'error' THEN 'click' ELSE event_type END) AS kind FROM events WHERE value <= 450 GROUP BY user_id, ts"


def _measured(s, d):
    old, new = _partitions(s, d)
    e = t(s, d, "events")
    rest = lambda where: e.where(where).groupBy("user_id", "ts").agg(F.min(F.floor(F.col("value") / 7).cast("double")).alias("rest"), F.min("value").alias("_v"))
    more = F.col("rest") + F.when(F.col("_v") > 300, 1.0).otherwise(0.0)
    a = old.join(rest("value >= 25"), ["user_id", "ts"]).select("user_id", "ts", "value", "rest", "kind")
    return a, new.join(rest("value <= 450"), ["user_id", "ts"]).select("user_id", "ts", "value", more.alias("rest"), "kind")


_DIFF = f"""WITH b AS ({_MEASURED}), a AS ({_LATER}), al AS (SELECT * FROM (VALUES (3, 5, TIMESTAMP '2024-01-12'), (7, 9, TIMESTAMP '2024-01-03')) v(old_id, new_id, boundary)),
j AS (SELECT user_id, ts, b.value AS bv, a.value AS av, b.rest AS br, a.rest AS ar, b.kind AS bk, a.kind AS ak, b.user_id IS NOT NULL AS in_b, a.user_id IS NOT NULL AS in_a, ts >= '2024-01-05' AND ts < '2024-01-20' AS inside FROM b FULL JOIN a USING (user_id, ts)),
f AS (SELECT user_id, ts, bk, ak, in_b, in_a, inside, in_a AND in_b AND bv IS DISTINCT FROM av AS dv, in_a AND in_b AND br IS DISTINCT FROM ar AS dr, in_a AND in_b AND bk IS DISTINCT FROM ak AS dk FROM j),
x AS (SELECT 'rows_before' AS counter, NULL AS item, count(*) FILTER (WHERE in_b) AS n FROM f UNION ALL SELECT 'rows_after', NULL, count(*) FILTER (WHERE in_a) FROM f
UNION ALL SELECT 'removed_keys', NULL, count(*) FILTER (WHERE NOT in_a) FROM f UNION ALL SELECT 'duplicate_keys_after', NULL, 0
UNION ALL SELECT 'added_in_windows', NULL, count(*) FILTER (WHERE NOT in_b AND inside) FROM f UNION ALL SELECT 'added_outside_windows', NULL, count(*) FILTER (WHERE NOT in_b AND NOT inside) FROM f
UNION ALL SELECT 'measurement_changes_in_windows', NULL, count(*) FILTER (WHERE (dv OR dr) AND inside) FROM f UNION ALL SELECT 'measurement_changes_outside_windows', NULL, count(*) FILTER (WHERE (dv OR dr) AND NOT inside) FROM f
UNION ALL SELECT 'added_by_hour', strftime(date_trunc('hour', ts - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR, '%Y-%m-%d %H'), count(*) FROM f WHERE NOT in_b AND inside GROUP BY 2
UNION ALL SELECT 'measurement_changes_by_column', 'value', count(*) FROM f WHERE dv HAVING count(*) > 0 UNION ALL SELECT 'measurement_changes_by_column', 'rest', count(*) FROM f WHERE dr HAVING count(*) > 0
UNION ALL SELECT 'metadata_changes_by_station', user_id::VARCHAR, count(*) FROM f WHERE dk GROUP BY 2
UNION ALL SELECT 'metadata_restored_by_station', user_id::VARCHAR, count(*) FROM f WHERE dk AND ak = 'click' AND user_id % 2 = 0 GROUP BY 2
UNION ALL SELECT 'successor_rows_before_boundary', new_id::VARCHAR, count(*) FROM a JOIN al ON a.user_id = new_id WHERE ts < boundary GROUP BY 2
UNION ALL SELECT 'alias_overlaps', old_id || '/' || new_id, count(DISTINCT o.ts) FROM al JOIN a o ON o.user_id = old_id JOIN a w ON w.user_id = new_id AND w.ts = o.ts GROUP BY 2)
"""


def _diff(s, d):
    before, after = _measured(s, d)
    wanted = t(s, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("user_id"), F.lit("click").alias("kind"))
    aliases = table(s, "(3L, 5L, timestamp_ntz'2024-01-12 00:00:00'), (7L, 9L, timestamp_ntz'2024-01-03 00:00:00')", "old_id, new_id, boundary")
    inside = F.expr("ts >= timestamp_ntz'2024-01-05' AND ts < timestamp_ntz'2024-01-20'")
    return reconcile.partition_diff(before, after, ["user_id", "ts"], ["value", "rest"], ["kind"], inside, wanted, aliases, C.hour_label(F.col("ts")))


@query(_DIFF + "SELECT counter, item, n::BIGINT AS n FROM x")
def partition_diff(s, d):
    return _diff(s, d)


@query(_DIFF + """SELECT counter AS violation, item, n::BIGINT AS n FROM x WHERE n > 0 AND counter IN ('removed_keys', 'duplicate_keys_after', 'added_outside_windows', 'measurement_changes_outside_windows', 'successor_rows_before_boundary', 'alias_overlaps')
UNION ALL SELECT 'metadata_unexpected', item, sum(CASE WHEN counter = 'metadata_changes_by_station' THEN n ELSE -n END)::BIGINT FROM x WHERE counter IN ('metadata_changes_by_station', 'metadata_restored_by_station') GROUP BY item HAVING sum(CASE WHEN counter = 'metadata_changes_by_station' THEN n ELSE -n END) > 0""")
def diff_violations(s, d):
    return reconcile.diff_violations(_diff(s, d))


_PAIRS = """(SELECT CASE WHEN event_id % 2 = 0 THEN 'climate' ELSE 'realtime' END AS source, user_id::VARCHAR AS station_id, event_type AS variable, date_trunc('day', ts)::TIMESTAMP AS observed_at, NULL::DOUBLE AS period_seconds, 'mean' AS statistic, event_id::VARCHAR AS source_record_id, 'r' || event_id AS revision_id,
CASE WHEN event_id % 7 = 3 THEN 'r' || (event_id - 1) END AS supersedes_revision_id, CASE WHEN event_id % 5 = 0 THEN 'rejected' WHEN event_id % 5 = 1 THEN 'suspect' ELSE 'accepted' END AS quality, 'observed' AS value_state, ts AS available_at, ts AS ingested_at FROM events WHERE user_id < 30)"""


def _pairs(s, d):
    k = F.col("event_id")
    return t(s, d, "events").where("user_id < 30").select(
        F.when(k % 2 == 0, "climate").otherwise("realtime").alias("source"), F.col("user_id").cast("string").alias("station_id"), F.col("event_type").alias("variable"), C.day(F.col("ts")).alias("observed_at"), F.lit(None).cast("double").alias("period_seconds"), F.lit("mean").alias("statistic"),
        k.cast("string").alias("source_record_id"), F.concat(F.lit("r"), k).alias("revision_id"), F.when(k % 7 == 3, F.concat(F.lit("r"), k - 1)).alias("supersedes_revision_id"),
        F.when(k % 5 == 0, "rejected").when(k % 5 == 1, "suspect").otherwise("accepted").alias("quality"), F.lit("observed").alias("value_state"), F.col("ts").alias("available_at"), F.col("ts").alias("ingested_at"),
    )


_RANKS = "('climate', 0), ('realtime', 1)"


@query(f"""WITH p AS (SELECT *, CASE source WHEN 'climate' THEN 0 ELSE 1 END AS rank_no FROM {_PAIRS} WHERE ingested_at <= '2024-01-20'),
e AS (SELECT * FROM p WHERE quality <> 'rejected'),
v AS (SELECT * FROM e WHERE NOT EXISTS (SELECT 1 FROM e f WHERE f.source = e.source AND f.station_id = e.station_id AND f.variable = e.variable AND f.observed_at = e.observed_at AND f.supersedes_revision_id = e.revision_id)),
c AS (SELECT revision_id FROM (SELECT *, row_number() OVER (PARTITION BY station_id, variable, observed_at ORDER BY quality <> 'accepted', rank_no, available_at DESC, revision_id) AS n FROM v) WHERE n = 1)
SELECT revision_id, row_number() OVER (PARTITION BY station_id, variable, observed_at ORDER BY rank_no, source_record_id, revision_id) AS place, revision_id IN (SELECT revision_id FROM c) AS chosen FROM p""")
def pair_reconciliation(s, d):
    """Candidates of two sources in their order, and the one chosen of each key."""
    held = reconcile.pair_reconciled(_pairs(s, d), "2024-01-20", table(s, _RANKS, "source, rank"))
    return held.select("revision_id", F.col("place").cast("bigint").alias("place"), "chosen")


@query(f"SELECT 'no rank' AS error, (SELECT count(*) FROM {_PAIRS})::BIGINT AS rows")
def unranked_source_refused(s, d):
    """A selection over a source without a rank raises instead of letting it win."""
    rows = _pairs(s, d)
    try:
        sequences.canonical(rows, "2024-02-20", table(s, "('climate', 0)", "source, rank")).count()
    except Exception as error:  # noqa: BLE001
        if "no rank for source" not in str(error):
            raise
        return rows.agg(F.lit("no rank").alias("error"), F.count("*").alias("rows"))
    raise AssertionError("an unranked source was accepted")


@query("""WITH m AS (SELECT user_id, ts, value, 1 AS pri FROM events WHERE event_id % 3 = 0 UNION ALL SELECT user_id, ts, value, 0 FROM events WHERE event_id % 3 <> 2),
k AS (SELECT user_id, ts, arg_max(value, pri) AS value FROM m GROUP BY 1, 2) SELECT user_id, ts, value, c_mktsegment AS country FROM k LEFT JOIN customer ON c_custkey = user_id""")
def composed_version(s, d):
    """Fetched rows of one source over the base, without weather codes, with the stations' metadata."""
    e = t(s, d, "events").select("event_id", "user_id", "ts", "value")
    base = e.where("event_id % 3 <> 2").drop("event_id").withColumn("country", F.lit("old"))
    fetched = e.where("event_id % 3 = 0").drop("event_id").withColumns({"source": F.lit("iem"), "wxcodes": F.lit("RA"), "country": F.lit(None).cast("string")})
    stations = t(s, d, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("country"))
    return frames.composed(base, fetched, stations, ["user_id", "ts"], ["country"], "country").select("user_id", "ts", "value", "country")


@query("WITH f AS (SELECT user_id, ts, max(value) AS value FROM (SELECT user_id, ts, value + 1 AS value FROM events WHERE event_id % 50 = 0 UNION ALL SELECT user_id, ts + INTERVAL 1 YEAR, value FROM events WHERE event_id % 50 = 1) GROUP BY 1, 2) SELECT * FROM f UNION ALL SELECT user_id, ts, value FROM events e WHERE NOT EXISTS (SELECT 1 FROM f WHERE f.user_id = e.user_id AND f.ts = e.ts)")
def upsert_few(s, d):
    """A small fetch into a large unique table, without shuffling the table."""
    base = t(s, d, "events").select("user_id", "ts", "value")
    fetched = t(s, d, "events").where("event_id % 50 = 0").select("user_id", "ts", (F.col("value") + 1).alias("value")).union(t(s, d, "events").where("event_id % 50 = 1").select("user_id", F.col("ts") + F.expr("interval 1 year"), "value"))
    return frames.upsert_few(base, fetched, ["user_id", "ts"], [F.col("value").desc()])


@query("""WITH a AS (SELECT event_id, user_id, ts, event_type, floor(value / 250) AS value FROM events WHERE user_id < 60),
w AS (SELECT user_id, ts FROM a WHERE event_type = 'error'), z AS (SELECT * FROM a WHERE event_type = 'view' AND value = 0),
c AS (SELECT z.*, EXISTS (SELECT 1 FROM w WHERE w.user_id = z.user_id AND w.ts > z.ts - INTERVAL 1 HOUR AND w.ts <= z.ts) AS hit FROM z),
s AS (SELECT DISTINCT user_id, ts FROM c WHERE hit AND (SELECT count(*) FROM c d WHERE d.user_id = c.user_id AND d.hit AND d.ts BETWEEN c.ts - INTERVAL 24 HOUR AND c.ts + INTERVAL 24 HOUR) >= 1
AND NOT EXISTS (SELECT 1 FROM a g WHERE g.user_id = c.user_id AND g.event_type = 'view' AND g.value > 0 AND g.ts BETWEEN c.ts - INTERVAL 24 HOUR AND c.ts + INTERVAL 24 HOUR))
SELECT z.event_id::VARCHAR AS revision_id, CASE WHEN s.ts IS NULL THEN 'accepted' ELSE 'suspect' END AS quality, CASE WHEN s.ts IS NOT NULL THEN 'present_weather_contradicts_zero' END AS quality_reason FROM z LEFT JOIN s USING (user_id, ts)""")
def precipitation_classifier(s, d):
    """Zeros that reported weather contradicts, over a normalized table."""
    k = t(s, d, "events").where("user_id < 60")
    amount = F.col("event_type") == "view"
    rows = k.select(
        F.lit("x").alias("source"), F.col("user_id").cast("string").alias("station_id"), F.col("event_id").cast("string").alias("source_record_id"), F.col("event_id").cast("string").alias("revision_id"),
        F.when(amount, "precipitation").when(F.col("event_type") == "error", "present_weather").otherwise("air_temperature").alias("variable"), F.when(F.col("event_type") != "error", F.floor(F.col("value") / 250).cast("double")).alias("value_float"),
        F.when(F.col("event_type") == "error", "-RA BR").alias("value_text"), F.lit("accepted").alias("quality"), F.lit(None).cast("string").alias("quality_reason"), F.lit(False).alias("is_trace"), F.col("ts").alias("observed_at"), F.col("ts").alias("ingested_at"),
    )
    return sequences.classified(rows, least=1).where("variable = 'precipitation' AND value_float = 0").select("revision_id", "quality", "quality_reason")


@query("SELECT DISTINCT ON (user_id) user_id, event_type, value FROM events WHERE value IS NOT NULL ORDER BY user_id, ts, event_id")
def distinct_first(s, d):
    """The first row of each station with a value."""
    return frames.first_of(t(s, d, "events").where("value IS NOT NULL"), ["user_id"], [F.col("ts"), F.col("event_id")]).select("user_id", "event_type", "value")


@query("SELECT hour, count(DISTINCT user_id) AS n FROM (SELECT date_trunc('hour', ts)::TIMESTAMP + to_hours(o) AS hour, user_id FROM events, (VALUES (0), (1), (2)) w(o)) GROUP BY hour")
def pooled_hours(s, d):
    """Distinct stations of each three-hour window, a window an hour; overlapping windows share rows, not sums."""
    return frames.pooled(t(s, d, "events"), "user_id", F.date_trunc("hour", "ts").cast("timestamp_ntz"), 3)


@query("SELECT family, count(*) AS n, count(DISTINCT user_id) AS ids, 1::BIGINT AS shards FROM (SELECT user_id, (CASE WHEN user_id = 5 THEN 3 WHEN user_id = 9 THEN 7 ELSE user_id END)::VARCHAR AS family FROM events) GROUP BY family")
def alias_families(s, d):
    """Both ids of an alias lie in one shard."""
    rows = t(s, d, "events").withColumn("family", reconcile.family(F.col("user_id").cast("string"), {"5": "3", "9": "7"}))
    return rows.withColumn("shard", reconcile.shard(F.col("family"), 16)).groupBy("family").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("ids"), F.count_distinct("shard").alias("shards"))


# --- geometry ------------------------------------------------------------------------------------


def _points(s, d):
    return _places(s, d).select("station", "longitude", "latitude", C.wkb_point(F.col("longitude"), F.when(F.col("station") % 6 != 0, F.col("latitude"))).alias("geometry"))


@query(f"SELECT station % 3 AS part, min(longitude) FILTER (station % 6 <> 0) AS xmin, min(latitude) FILTER (station % 6 <> 0) AS ymin, max(longitude) FILTER (station % 6 <> 0) AS xmax, max(latitude) FILTER (station % 6 <> 0) AS ymax, count(*) FILTER (station % 6 <> 0) AS geometries, CASE WHEN count(*) FILTER (station % 6 <> 0) > 0 THEN 'Point' ELSE '' END AS kinds FROM {_PLACES} GROUP BY 1")
def geometry_bounds(s, d):
    """Bounds and kinds of each part, as its GeoParquet metadata names them."""
    return geo.bounds(_points(s, d).withColumn("part", F.col("station") % 3), "part").withColumn("kinds", F.array_join("kinds", ","))


@query(f"SELECT min(longitude) AS xmin, min(latitude) AS ymin, max(longitude) AS xmax, max(latitude) AS ymax, count(*) AS geometries, 'Point' AS kinds FROM {_PLACES} WHERE station % 6 <> 0")
def geometry_union(s, d):
    parts = geo.bounds(_points(s, d).withColumn("part", F.col("station") % 3), "part")
    return geo.united(parts).withColumn("kinds", F.array_join("kinds", ","))


@query(f"SELECT 'Point' AS kind, 'OGC:CRS84' AS crs, 'geometry' AS primary_column, (SELECT min(longitude) FROM {_PLACES} WHERE station % 6 <> 0) AS xmin, (SELECT max(latitude) FROM {_PLACES} WHERE station % 6 <> 0) AS ymax, 0::BIGINT AS problems")
def geo_document(s, d):
    """The geo document in a written table's footer is the union of its parts' and fits the table's schema."""
    rows = partitions.with_geometry(_places(s, d).where("station % 6 <> 0"))
    parts = [geo.geo_metadata(rows.where(F.col("station") % 3 == i)) for i in (1, 2)] + [geo.geo_metadata(rows.where("station % 3 = 0"))]
    document = geo.geo_union(parts)
    root = fresh_folder(s, "geo")
    geo.stamped(rows, document).write.parquet(root)
    document = geo.document_of(s.read.parquet(root))
    problems = geo.geo_violations(geo.geo_metadata(rows), document, rows.schema)
    column = json.loads(document)["columns"]["geometry"]
    return s.createDataFrame([(column["geometry_types"][0], geo.declared_crs(document), json.loads(document)["primary_column"], column["bbox"][0], column["bbox"][3], len(problems))], "kind string, crs string, primary_column string, xmin double, ymax double, problems bigint")


@query("SELECT * FROM (VALUES ('column order changed'), ('type changed for latitude'), ('crs changed for geometry'), ('covering missing for other'), ('no geo metadata')) v(problem)")
def written_file_check(s, d):
    """What a written table may have wrong: order, types, reference system, covering, no metadata at all."""
    good = partitions.with_geometry(_places(s, d))
    bad = good.select("latitude", "station", *[c for c in good.columns if c not in ("latitude", "station")]).withColumn("latitude", F.col("latitude").cast("float"))
    column = {"encoding": "WKB", "geometry_types": ["Point"], "crs": "OGC:CRS84", "covering": geo.COVERING}
    want = json.dumps({"primary_column": "geometry", "columns": {"geometry": column, "other": column}})
    have = json.dumps({"primary_column": "geometry", "columns": {"geometry": column | {"crs": "EPSG:3857"}, "other": {k: v for k, v in column.items() if k != "covering"}}})
    found = geo.schema_violations(good.schema, bad.schema) + geo.geo_violations(want, have, bad.schema) + geo.geo_violations(want, None, bad.schema)
    return s.createDataFrame([(x.split(":")[0],) for x in found], "problem string")


@query(f"SELECT station, station % 6 = 0 OR station % 5 <> 0 AS same FROM {_PLACES}")
def geometry_equality(s, d):
    """Bytes decide, null equals null."""
    moved = C.wkb_point(F.col("longitude") + F.when(F.col("station") % 5 == 0, 0.5).otherwise(0.0), F.when(F.col("station") % 6 != 0, F.col("latitude")))
    return _points(s, d).select("station", geo.same_geometry(F.col("geometry"), moved).alias("same"))


@query(f"SELECT station, CASE WHEN station % 6 <> 0 THEN longitude END AS xmin, CASE WHEN station % 6 <> 0 THEN latitude END AS ymax FROM {_PLACES}")
def covering_boxes(s, d):
    rows = partitions.with_geometry(_places(s, d).withColumn("latitude", F.when(F.col("station") % 6 != 0, F.col("latitude"))))
    return rows.select("station", "bbox.xmin", "bbox.ymax")


@query(f"SELECT true AS exists_ok, false AS missing_ok, count(*) FILTER (station % 6 = 0) <= 0.1 * count(*) AS geometry_ok, count(*) >= 100 AS many_rows, count(*) >= 10 AS any_rows FROM {_PLACES}")
def file_and_geometry_checks(s, d):
    """A table that is there and readable, one that isn't, geometry that lacks too often, and thresholds by caller."""
    root = fresh_folder(s, "check")
    _points(s, d).write.parquet(root)
    there, missing = checks.readable(s, root), checks.readable(s, f"{root}-none")
    verdict = checks.geometry_verdict(s.read.parquet(root), "geometry", most_null=0.1)
    return verdict.select(F.lit(there is not None).alias("exists_ok"), F.lit(missing is not None).alias("missing_ok"), F.col("passed").alias("geometry_ok"), (F.col("rows") >= 100).alias("many_rows"), (F.col("rows") >= 10).alias("any_rows"))


@query("SELECT 5::BIGINT AS total, 3::BIGINT AS passed, false AS all_passed")
def check_summary(s, d):
    found = checks.validated(t(s, d, "events"), ["user_id", "ts"], "ts", {"value": (20.0, 450.0)}, ["value", "event_type"], 10**9, "1900-01-01", "2025-01-01")
    return checks.summary(found)


# --- streams and commits -------------------------------------------------------------------------


@query("SELECT user_id, day, arg_max(value, (value, event_id)) AS value FROM (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, event_id, value, event_id % 3 AS batch, max(event_id % 3) OVER (PARTITION BY user_id, date_trunc('day', ts)) AS newest FROM events) WHERE batch = newest GROUP BY 1, 2")
def stream_upsert(s, d):
    """Files arriving one by one are upserted exactly once each; the last batch of a key wins, and within it the largest value."""
    root = fresh_folder(s, "stream")
    rows = t(s, d, "events").select("event_id", "user_id", C.day(F.col("ts")).alias("day"), "value")
    for i in range(3):
        rows.where(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(f"{root}/in")
    held = upserts.VersionedTable(s, f"{root}/table", "date_format(day, 'yyyyMMdd')")
    upserts.upsert_stream(s, f"{root}/in", rows.schema, ["user_id", "day"], ["value", "event_id"], held, f"{root}/offsets").awaitTermination()
    return held.read().select("user_id", "day", "value")


@query("SELECT event_id % 100 AS id, count(*) AS n FROM events GROUP BY 1 HAVING count(*) > 0")
def stream_once(s, d):
    """At-least-once input read once by payload identity: every file is played twice."""
    root = fresh_folder(s, "once")
    rows = t(s, d, "events").select(F.col("ts").cast("timestamp").alias("ts"), "event_id")
    for _ in range(2):
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
    stream = upserts.once(s.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in"), "ts", ["event_id"], "3650 days")
    stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/offsets").trigger(availableNow=True).start().awaitTermination()
    return s.read.schema(rows.schema).parquet(f"{root}/out").groupBy((F.col("event_id") % 100).alias("id")).agg(F.count("*").alias("n"))


@query("SELECT 'good' AS side, count(*) FILTER (event_id % 9 <> 4) AS n FROM events UNION ALL SELECT 'bad', count(*) FILTER (event_id % 9 = 4) FROM events")
def stream_quarantine(s, d):
    """Malformed payloads of a stream go to a table of their own."""
    root = fresh_folder(s, "quarantine")
    rows = t(s, d, "events").select(F.when(F.col("event_id") % 9 == 4, "{k:").otherwise(F.col("props")).alias("text"))
    rows.coalesce(2).write.parquet(f"{root}/in")
    source = s.readStream.schema(rows.schema).parquet(f"{root}/in")
    upserts.quarantining_stream(source, "text", "struct<k:bigint>", ["k"], f"{root}/good", f"{root}/bad", f"{root}/offsets").awaitTermination()
    count = lambda side: s.read.parquet(f"{root}/{side}").agg(F.lit(side).alias("side"), F.count("*").alias("n"))
    return count("good").union(count("bad"))


_BASE = "SELECT user_id, min(value) AS value FROM events WHERE event_id % 2 = 0 GROUP BY user_id"


@query(f"""WITH base AS ({_BASE}), cur AS (SELECT user_id, CASE WHEN user_id % 5 = 0 THEN value + 1000 ELSE value END AS value FROM base),
f AS (SELECT user_id, max(value) AS value FROM events WHERE user_id % 2 = 0 GROUP BY user_id)
SELECT coalesce(cur.user_id, f.user_id) AS user_id, CASE WHEN f.user_id IS NULL OR (cur.user_id % 5 = 0 AND cur.user_id IS NOT NULL) THEN cur.value ELSE f.value END AS value, 2 AS attempts FROM cur FULL JOIN f ON f.user_id = cur.user_id""")
def optimistic_commit(s, d):
    """The first try meets someone else's version; the second is rebased on it and withholds the keys that it changed."""
    e = t(s, d, "events")
    base = e.where("event_id % 2 = 0").groupBy("user_id").agg(F.min("value").alias("value"))
    current = base.withColumn("value", F.when(F.col("user_id") % 5 == 0, F.col("value") + 1000).otherwise(F.col("value")))
    state: dict = {"version": 1, "rows": base}

    def publish(version: int, rows: DataFrame) -> None:
        if state["version"] == 1:  # someone else was faster
            state.update(version=2, rows=current)
        if version != state["version"]:
            raise upserts.Conflict
        state.update(version=version + 1, rows=rows)

    fetched = e.where("user_id % 2 = 0").groupBy("user_id").agg(F.max("value").alias("value"))
    attempts, _ = upserts.published(lambda: (state["version"], state["rows"]), publish, fetched, ["user_id"], ["value"])
    return state["rows"].select("user_id", "value", F.lit(attempts).alias("attempts"))


_LOADED = "SELECT year(o_orderdate)::INT AS year, o_custkey AS station FROM orders WHERE year(o_orderdate) < 1998"


@query(f"SELECT y AS year, CASE WHEN count(station) = 0 THEN 'pending' ELSE 'completed' END AS status, count(station) AS records, count(DISTINCT station) AS stations FROM range(1994, 2001) r(y) LEFT JOIN ({_LOADED}) l ON l.year = r.y GROUP BY y")
def load_status(s, d):
    return _load_status(s, d).select(F.col("year").cast("bigint").alias("year"), "status", "records", "stations")


@query(f"SELECT 7::BIGINT AS total_years, count(*) AS completed, sum(n)::BIGINT AS total_records, max(k) AS total_stations FROM (SELECT year, count(*) AS n, count(DISTINCT station) AS k FROM ({_LOADED}) WHERE year BETWEEN 1994 AND 2000 GROUP BY year)")
def load_summary(s, d):
    return upserts.load_summary(_load_status(s, d))


def _load_status(s, d):
    done = t(s, d, "orders").where("year(o_orderdate) < 1998").select(F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("station"))
    return upserts.load_status(s.range(1994, 2001).select(F.col("id").cast("int").alias("year")), done)
