"""Datasets by year, payloads, cursors, written tables, versions and commits: what their queries don't show."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from galefold import schema
from galefold.operators import frames, reconcile, sequences, spans
from galefold.sources import geo, partitions, payloads, reports
from galefold.streaming import upserts


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def days(spark, text):
    return spark.sql(f"SELECT * FROM VALUES {text} AS t(station, day, value)").withColumn("day", F.col("day").cast("timestamp_ntz"))


def test_versions_rewrite_only_the_parts_they_touch(spark, tmp_path):
    table = upserts.VersionedTable(spark, str(tmp_path / "t"), "date_format(day, 'yyyyMM')")
    batches = [
        days(spark, "('a', '2026-01-05', 1.0D), ('a', '2026-02-05', 2.0D), ('b', '2026-03-01', 3.0D)"), days(spark, "('a', '2026-02-05', 9.0D), ('c', '2026-02-06', 4.0D)"),
        days(spark, "('d', '2026-03-01', 5.0D), ('d', '2026-03-01', 6.0D)"),
    ]
    for i, batch in enumerate(batches):
        table.upsert(batch, i, ["station", "day"], ["value"])
    assert table.parts(2) == {"202601": 0, "202602": 1, "202603": 2} and table.newest() == 2
    want = rows(table.read())
    assert [(r[0], r[2]) for r in want] == [("a", 1.0), ("a", 9.0), ("b", 3.0), ("c", 4.0), ("d", 6.0)]
    # The batch before and the newest stay for readers and replays; nothing else does.
    assert table.versions() == [1, 2] and not (tmp_path / "t" / "v0" / "part=202602").exists() and (tmp_path / "t" / "v0" / "part=202603").exists()
    table.upsert(batches[2], 2, ["station", "day"], ["value"])
    assert rows(table.read()) == want
    table.upsert(batches[0].limit(0), 3, ["station", "day"], ["value"])
    assert rows(table.read()) == want


def test_reads_of_years_are_pruned(spark, tmp_path):
    root = str(tmp_path / "y")
    data = spark.range(400).select(F.concat(F.lit("S"), F.col("id") % 5).alias("station"), F.expr("timestamp_ntz'2020-06-01' + make_interval(0, 0, 0, cast(id * 5 AS int))").alias("valid"))
    partitions.write_years(data, root, rows_per_file=50)
    found = partitions.read_years(spark, root, "2022-01-01", "2023-01-01")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "2022" in plan and "PushedFilters: [IsNotNull(valid)" in plan
    assert found.count() == 73 and {r[0].split("year=")[1][:4] for r in found.select("_metadata.file_path").distinct().collect()} == {"2022"}
    assert partitions.years_of(spark, root) == list(range(2020, 2026)) and partitions.years_of(spark, root + "-no") == []
    assert partitions.read_year(spark, root, 2031) is None and partitions.read_year(spark, root, 2021).count() == 73
    (tmp_path / "y" / "year=2040").mkdir()
    (tmp_path / "y" / "year=2040" / "a.parquet").write_text("broken")
    assert partitions.read_year(spark, root, 2040) is None
    assert partitions.out_of_order(spark.read.parquet(f"{root}/year=2021"), "station", "valid").count() == 0


def test_pair_of_sources(spark):
    names = "source string, station_id string, variable string, observed_at timestamp_ntz, period_seconds double, statistic string, source_record_id string, revision_id string, supersedes_revision_id string, quality string, value_state string, available_at timestamp_ntz, ingested_at timestamp_ntz"
    at = datetime(2026, 8, 10)
    one = lambda source, revision, quality="accepted", station="7", ingested=at: (source, station, "air_temperature", at, None, "mean", revision, revision, None, quality, "observed", at, ingested)
    ranks = spark.sql("SELECT * FROM VALUES ('climate', 0), ('realtime', 1) AS t(source, rank)")
    make = lambda *given: spark.createDataFrame(list(given), names)
    assert reconcile.pair_chosen(make(one("realtime", "b"), one("climate", "a")), "2026-09-01", ranks)["revision_id"] == "a"
    assert reconcile.pair_chosen(make(one("realtime", "b"), one("climate", "a", "suspect")), "2026-09-01", ranks)["revision_id"] == "b"
    late = datetime(2026, 10, 1)
    for given, message in ((make(one("climate", "a", ingested=late)), "known"), (make(one("climate", "a"), one("climate", "b", station="8")), "more than one key"), (make(one("climate", "a", "rejected")), "rejected")):
        with pytest.raises(ValueError, match=message):
            reconcile.pair_chosen(given, "2026-09-01", ranks)
    with pytest.raises(Exception, match="no rank for source"):
        sequences.canonical(make(one("other", "a"), one("climate", "b")), "2026-09-01", ranks).collect()


def test_identity_hint_stands_for_an_absent_provider_only(spark):
    frame = spark.sql("SELECT * FROM VALUES (cast(null as string), cast(null as string), 'ADN'), (null, '', 'ADN'), (null, 'MSC', 'ADN') AS v(m, p, t)")
    got = [r[0] for r in frame.select(reconcile.station_identity(F.col("m"), F.col("p"), F.col("t"), F.lit(None), F.lit("H"))).collect()]
    assert got == ["H:tc_id:ADN", None, "MSC:tc_id:ADN"]
    xml = '<c xmlns:x="u"><x:member><Observation><metadata><set><identification-elements><element name="stn_id" value="5"/><element name="data_pvdr" value="P"/></identification-elements></set></metadata><resultTime><TimeInstant><timePosition>2026-01-01T00:00:00Z</timePosition></TimeInstant></resultTime><result><elements><element name="n" uom="m" value="a &gt; b"/></elements></result></Observation></x:member></c>'
    assert [(r["station"], r["value"]) for r in reports.observation_xml(spark.createDataFrame([(xml,)], "content string")).collect()] == [("P:stn_id:5", "a > b")]


def test_records_keep_their_schema(spark, tmp_path):
    for kind, fields in schema.RECORD_SCHEMAS.items():
        frame = spark.createDataFrame([tuple(None for _ in fields)], fields)
        schema.write_records(frame, kind, str(tmp_path / kind))
        assert schema.read_records(spark, kind, str(tmp_path / kind)).schema == fields
    with pytest.raises(ValueError, match="missing"):
        schema.write_records(spark.range(1), "attribution", str(tmp_path / "x"))
    with pytest.raises(ValueError, match="unknown"):
        schema.read_records(spark, "attribution", str(tmp_path / "capability"))
    with pytest.raises(ValueError, match="missing"):
        schema.conform_to(spark.range(1), spark.range(1).withColumn("b", F.lit(1)))


def test_partition_diff_of_repeated_and_aliased_rows(spark):
    kind = "station string, valid int, value double, country string"
    old = spark.createDataFrame([("a", 1, 1.0, "X"), ("a", 2, None, "X"), ("b", 1, 3.0, None), ("n", 3, 1.0, None)], kind)
    new = spark.createDataFrame([("a", 1, 2.0, "X"), ("a", 2, None, "Y"), ("c", 9, 1.0, "X"), ("c", 9, 1.0, "X"), ("n", 3, 1.0, None), ("n", 7, 1.0, None), ("o", 7, 1.0, None)], kind)
    wanted = spark.createDataFrame([("a", "Y")], "station string, country string")
    aliases = spark.createDataFrame([("o", "n", 5)], "old_id string, new_id string, boundary int")
    diff = reconcile.partition_diff(old, new, ["station", "valid"], ["value"], ["country"], F.col("valid") < 5, wanted, aliases, F.lit("2026-01-01").cast("timestamp_ntz"))
    got = {(r["counter"], r["item"]): r["n"] for r in diff.collect()}
    assert got == {
        ("rows_before", None): 4, ("rows_after", None): 7, ("removed_keys", None): 1, ("duplicate_keys_after", None): 1, ("added_in_windows", None): 0, ("added_outside_windows", None): 3,
        ("measurement_changes_in_windows", None): 1, ("measurement_changes_outside_windows", None): 0, ("measurement_changes_by_column", "value"): 1, ("metadata_changes_by_station", "a"): 1, ("metadata_restored_by_station", "a"): 1,
        ("successor_rows_before_boundary", "n"): 1, ("alias_overlaps", "o/n"): 1,
    }
    assert {r["violation"] for r in reconcile.diff_violations(diff).collect()} == {"removed_keys", "duplicate_keys_after", "added_outside_windows", "successor_rows_before_boundary", "alias_overlaps"}
    assert reconcile.column_violations(old.schema, new.select("valid", "station", F.col("value").cast("int").alias("value"), "country").schema) == ["columns changed: ['station', 'valid', 'value', 'country'] to ['valid', 'station', 'value', 'country']", "type of value changed"]


def test_geo_documents_that_disagree(spark):
    one = lambda crs, box: json.dumps({"primary_column": "g", "columns": {"g": {"crs": crs, "encoding": "WKB", "geometry_types": ["Point"], **({"bbox": box} if box else {})}}})
    whole = json.loads(geo.geo_union([one("A", [0, 1, 2, 3]), one("A", None), one("A", [-1, 2, 1, 9])]))
    assert whole["columns"]["g"]["bbox"] == [-1, 1, 2, 9]
    with pytest.raises(ValueError):
        geo.geo_union([one("A", None), one("B", None)])
    assert geo.declared_crs(None) == "OGC:CRS84" and geo.declared_crs(one("A", None), "g") == "A"


def test_cursors_guards_and_batches(spark):
    late = spark.sql("SELECT timestamp_ntz'2026-03-10 05:30:00' AS now, timestamp_ntz'2026-01-01 00:00:00' AS cursor")
    with pytest.raises(Exception, match="retention"):
        payloads.capture_chunks(late).collect()
    with pytest.raises(Exception, match="rows before 2026"):
        payloads.guarded_years(spark.sql("SELECT timestamp_ntz'2025-12-31 23:00:00' AS t"), "t", 2026, 2026).collect()
    counts = spark.createDataFrame([("a", 4), ("b", 90), ("c", 3), ("d", 7), ("e", 1)], "s string, n bigint")
    assert rows(payloads.batch_plan(counts, "s", "n", 10)) == [("a", 0), ("b", 1), ("c", 2), ("d", 2), ("e", 3)]
    spans_in = spark.sql("SELECT 1 AS id, timestamp_ntz'2026-01-20' AS start, timestamp_ntz'2026-02-20' AS end UNION ALL SELECT 2, timestamp_ntz'2026-01-20', timestamp_ntz'2026-02-21 00:00:01'")
    assert spans.split_long(spans_in, "month", 31).groupBy("id").count().orderBy("id").collect() == [(1, 1), (2, 2)]


def test_commit_gives_up_after_three_conflicts(spark):
    base = spark.createDataFrame([(1, 1.0)], "k int, v double")
    tries = []

    def publish(version, frame):
        tries.append(version)
        raise upserts.Conflict

    with pytest.raises(upserts.Conflict):
        upserts.published(lambda: (len(tries), base), publish, base, ["k"], ["v"])
    assert tries == [0, 1, 2]


def test_small_upserts_equal_plain_ones(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (None, "c", 3.0)], "k int, t string, v double")
    fetched = spark.createDataFrame([(2, "b", 9.0), (2, "b", 8.0), (None, "c", 7.0), (4, "d", 6.0)], "k int, t string, v double")
    want = [(None, "c", 7.0), (1, "a", 1.0), (2, "b", 9.0), (4, "d", 6.0)]
    few = frames.upsert_few(base, fetched, ["k", "t"], [F.col("v").desc()])
    assert sorted(few.collect(), key=repr) == sorted(want, key=repr) == sorted((tuple(r) for r in frames.upsert_few(base, fetched, ["k", "t"], [F.col("v").desc()], broadcast_rows=0).collect()), key=repr)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
