"""Golden and metamorphic tests of the weather operators."""

import struct
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from galefold import schema
from galefold.functions import columns as C
from galefold.operators import frames, reconcile, sequences, spans
from galefold.sources import partitions, reports
from galefold.streaming import upserts


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


@pytest.mark.parametrize("text,value", [("1.5", 1.5), ("-2e1", -20.0), ("1.0d", None), ("inf", None), ("NaN", None), ("", None), (None, None), (" 7 ", 7.0), (".5", 0.5)])
def test_number(spark, text, value):
    assert spark.createDataFrame([(text,)], "x string").select(C.number(F.col("x"))).head()[0] == value


@pytest.mark.parametrize("at,label", [("05:53:00", 6), ("06:00:00", 6), ("06:00:01", 7)])
def test_hour_label(spark, at, label):
    assert spark.sql(f"SELECT timestamp_ntz'2026-01-01 {at}' AS t").select(C.hour_label(F.col("t"))).head()[0].hour == label


@pytest.mark.parametrize("lon,lat", [(-73.7789, 40.6397), (0.0, -0.5), (180.0, 90.0), (1e-9, -89.999999), (-122.375, 37.0)])
def test_wkb(spark, lon, lat):
    got = spark.createDataFrame([(lon, lat)], "a double, b double").select(C.wkb_point(F.col("a"), F.col("b"))).head()[0]
    assert bytes(got) == struct.pack("<BIdd", 1, 1, lon, lat)


def test_fingerprint_sees_where_nulls_are(spark):
    frame = spark.createDataFrame([(1, None, 2), (1, 2, None)], "a int, b int, c int").select(C.fingerprint("a", "b", "c"))
    assert frame.distinct().count() == 2


def test_compose_quirks(spark):
    base = spark.createDataFrame([("A", 1, 1.0), ("B", 1, 2.0)], "station string, valid int, v double")
    new = spark.createDataFrame([("A", 1, 5.0), ("A", 1, 6.0)], base.schema)
    order = [F.col("v").desc()]
    assert rows(frames.compose(base, new, ["station", "valid"], order)) == [("A", 1, 6.0), ("B", 1, 2.0)]
    assert frames.compose(None, new, ["station", "valid"], order).count() == 2
    assert frames.compose(None, new, ["station", "valid"], order, dedup_initial=True).count() == 1
    once = frames.upsert(base, new, ["station", "valid"], order)
    assert rows(frames.upsert(once, new, ["station", "valid"], order)) == rows(once)


def test_diff_invariant(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "k int, v double")
    b = spark.createDataFrame([(2, None), (3, 4.0), (4, 1.0)], "k int, v double")
    kinds = dict(rows(frames.key_diff(a, b, ["k"], ["v"])))
    assert kinds == {1: "removed", 3: "changed", 4: "added"}
    assert a.count() + 1 - 1 == b.count()
    earlier = spark.createDataFrame([(3, "removed")], "k int, kind string")
    held = frames.withheld(a, b, b, ["k"], ["v"], earlier)
    assert rows(held) == [(3, "removed"), (4, "added")]


def test_classifier_decides_on_latest_and_marks_all(spark):
    def row(rid, rev, variable, at, value=None, text=None, quality="accepted", trace=False):
        return (rid, rev, "S", variable, datetime(2026, 1, 1, at), value, text, quality, None, trace, datetime(2026, 1, 2, rev))

    names = "source_record_id string, revision_id int, station_id string, variable string, observed_at timestamp_ntz, value_float double, value_text string, quality string, quality_reason string, is_trace boolean, ingested_at timestamp_ntz"
    data = [row(f"p{h}", 1, "precipitation", h, 0.0) for h in (3, 5, 7)] + [row(f"w{h}", 1, "present_weather", h, None, "-RA") for h in (3, 5)] + [row("w7", 1, "present_weather", 7, None, "VCSH"), row("p3", 2, "precipitation", 3, 0.0)]
    got = {(r["source_record_id"], r["revision_id"]): r["quality"] for r in sequences.classified(spark.createDataFrame(data, names)).collect()}
    assert got == {("p3", 1): "suspect", ("p3", 2): "suspect", ("p5", 1): "suspect", ("p7", 1): "accepted", ("w3", 1): "accepted", ("w5", 1): "accepted", ("w7", 1): "accepted"}
    wet = [*data, row("p9", 1, "precipitation", 9, 1.2)]
    assert "suspect" not in {r["quality"] for r in sequences.classified(spark.createDataFrame(wet, names)).collect()}


def test_only_eligible_rows_supersede(spark):
    names = "source string, station_id string, variable string, observed_at timestamp_ntz, period_seconds double, statistic string, revision_id string, supersedes_revision_id string, ingested_at timestamp_ntz, available_at timestamp_ntz, quality string, value_state string"
    at = datetime(2026, 1, 1)
    row = lambda rev, sup, day, quality: ("a", "S", "t", at, None, "mean", rev, sup, datetime(2026, 1, day), datetime(2026, 1, day), quality, "observed")
    data = spark.createDataFrame([row("r1", None, 2, "accepted"), row("r2", "r1", 3, "rejected"), row("r3", "r1", 9, "accepted")], names)
    ranks = spark.createDataFrame([("a", 0)], "source string, rank int")
    assert [r["revision_id"] for r in sequences.canonical(data, "2026-01-05", ranks).collect()] == ["r1"]
    assert [r["revision_id"] for r in sequences.canonical(data, "2026-01-10", ranks).collect()] == ["r3"]
    assert sequences.unranked(data, ranks.where("rank > 0")).count() == 1


def test_value_that_returns_is_a_new_revision(spark):
    data = spark.createDataFrame([("r", v, i) for i, v in enumerate("aabba")], "rec string, rev string, i int")
    got = [(r["rev"], r["supersedes_revision_id"]) for r in sequences.chained(data, "rec", "rev", ["i"]).orderBy("i").collect()]
    assert got == [("a", None), ("b", "a"), ("a", "b")]


def test_spans():
    assert len(spans.parsed("2026-01-01T00:00Z/2026-01-02T00:00Z,2026-01-02T00:00Z/2026-01-03T00:00Z")) == 1
    with pytest.raises(ValueError):
        spans.parsed("2026-01-01T00:00/2026-01-02T00:00")
    a, b, c = (datetime(2026, 1, d, tzinfo=UTC) for d in (1, 2, 3))
    assert spans.merged([(b, c), (a, b)]) == [(a, c)]


def test_hourly_csv(spark, tmp_path):
    head = "station,valid," + ",".join(schema.MEASURES) + ",lon,lat,wxcodes"
    line = lambda t, tmpf, p: f"JFK,2026-01-01 {t},{tmpf}," + ",".join(["1"] * 10) + f",{p},{p},-73.8,40.6,"
    path = tmp_path / "a.csv"
    path.write_text("\n".join([head, line("00:00", "50", "0.1"), line("00:30", "", "0.1"), line("02:00", "51", "T")]))
    got = reports.read_hourly_csv(spark, str(path)).orderBy("valid").collect()
    assert [(r["tmpf"], r["p01m"], r["is_trace"], r["wxcodes"]) for r in got] == [(50.0, 0.1, False, None), (51.0, 0.0, True, None)]
    (tmp_path / "b.csv").write_text("station,valid\nJFK,x\n")
    with pytest.raises(ValueError):
        reports.read_hourly_csv(spark, str(tmp_path / "b.csv"))
    long = reports.long_rows(reports.read_hourly_csv(spark, str(path)), reports.HOURLY_FIELDS, ["station", "valid"])
    assert long.count() == 14


def test_year_partitions(spark, tmp_path):
    data = spark.sql("SELECT concat('S', id % 3) AS station, timestamp'2025-12-31 22:00:00' + make_interval(0,0,0,0,id) AS valid, -73.5D AS longitude, CASE WHEN id > 0 THEN 40.5D END AS latitude FROM range(5)")
    root = str(tmp_path / "years")
    partitions.write_years(partitions.with_geometry(data), root)
    assert partitions.read_years(spark, root, "2025-01-01", "2026-01-01").count() == 2
    back = spark.read.parquet(root)
    assert back.where("geometry IS NULL").count() == 1 and back.where("bbox.xmin = -73.5").count() == 4
    assert partitions.out_of_order(back, "station", "valid").count() == 0
    assert partitions.dataset_info(back).head()["files"] == 2
    partitions.write_years(partitions.with_geometry(data.where("year(valid) = 2026").limit(1)), root)
    assert spark.read.parquet(root).count() == 3


def test_stream_equals_batch(spark, tmp_path):
    data = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("event_id", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"), "value")
    for i in range(3):
        data.where(F.col("event_id") % 3 != i).withColumn("value", F.col("value") + i).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    table = upserts.VersionedTable(spark, str(tmp_path / "table"))
    q = upserts.upsert_stream(spark, str(tmp_path / "in"), data.schema, ["user_id", "day"], ["value", "event_id"], table, str(tmp_path / "cp"))
    q.awaitTermination()
    got = table.read()
    assert got.count() == data.select("user_id", "day").distinct().count() and table.newest() == 2
    again = upserts.upsert_stream(spark, str(tmp_path / "in"), data.schema, ["user_id", "day"], ["value", "event_id"], table, str(tmp_path / "cp"))
    again.awaitTermination()
    assert rows(table.read()) == rows(got)


def test_contract(spark):
    good = {"quality": "accepted", "value_state": "observed", "value_float": 1.0, "raw_sha256": "a" * 64, "is_trace": False}
    frame = schema.conform(spark.createDataFrame([tuple(good.values())], "quality string, value_state string, value_float double, raw_sha256 string, is_trace boolean"), schema.NORMALIZED)
    assert schema.violations(frame).count() == 0
    assert [r["invariant"] for r in schema.violations(frame.withColumn("value_float", F.lit(None).cast("double"))).collect()] == ["observed without value"]


@pytest.mark.parametrize("x,y", [(-73.7789, 40.6397), (0.0, -0.5), (180.0, 90.0), (5e-324, -89.999999)])
def test_wkb_decoded(spark, x, y):
    frame = spark.createDataFrame([(struct.pack("<BIdd", 1, 1, x, y),), (b"\x01\x02",), (None,)], "g binary")
    got = [r[0] and tuple(r[0]) for r in frame.select(C.wkb_xy(F.col("g"))).collect()]
    assert got == [(x, y), None, None]


def test_report_of_two_versions(spark):
    kind = "station string, valid int, value double, country string"
    old = spark.createDataFrame([("a", 1, 1.0, "X"), ("a", 2, None, "X"), ("b", 1, 3.0, None), ("b", 1, 3.0, None)], kind)
    new = spark.createDataFrame([("a", 1, 2.0, "X"), ("a", 2, None, "Y"), ("c", 9, 1.0, "X")], kind)
    wanted = spark.createDataFrame([("a", "X")], "station string, country string")
    keyed = reconcile.compared(old, new, ["station", "valid"], ["value"], ["country"], F.col("valid") < 5, wanted)
    whole = reconcile.report(keyed).head().asDict()
    assert whole == {"rows_before": 4, "rows_after": 3, "repeated_before": 1, "repeated_after": 0, "added": 1, "removed": 1, "changed": 1, "metadata_changed": 1, "added_outside": 1, "changed_outside": 0, "metadata_unexpected": 1, "balanced": True}
    parts = reconcile.report(keyed.withColumn("shard", reconcile.shard(F.col("station"), 4)), "shard")
    assert reconcile.combined(parts).head().asDict() == whole
    assert rows(reconcile.violations(reconcile.report(keyed))) == [("added_outside", 1), ("metadata_unexpected", 1), ("removed", 1), ("repeated_before", 1)]


def test_station_identity(spark):
    frame = spark.sql("SELECT * FROM VALUES ('7', 'MSC', 'ADN', null), ('', 'MSC', 'ADN', '9'), (null, 'MSC', ' ', '9'), (null, 'MSC', null, null), (null, null, 'ADN', null) AS v(m, p, t, s)")
    got = [r[0] for r in frame.select(reconcile.station_identity(*[F.col(c) for c in "mpts"])).collect()]
    assert got == ["msc_id:7", "MSC:tc_id:ADN", "MSC:stn_id:9", None, None]


def test_merged_windows_of_null_and_equal_dates(spark, tmp_path):
    """Windows without a start stay apart as in the SQL, open ends come last, equal windows are one."""
    import duckdb

    from galefold.plans import catalog

    day = lambda n: datetime(2026, 1, n) if n else None
    orders = [(1, None), (1, None), (1, day(3)), (None, day(3)), (None, None), (2, None), (3, day(1)), (3, day(9)), (4, None), (4, day(2)), (4, None)]
    spark.createDataFrame(orders, "o_custkey bigint, o_orderdate timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    got = rows(catalog.queries()["window_merge"](spark, str(tmp_path)).select("o_custkey", "start", "end"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT * FROM read_parquet('{tmp_path}/orders.parquet/*.parquet')")
    assert got == sorted(con.sql(catalog.oracle_sql()["window_merge"]).select("o_custkey, start, \"end\"").fetchall(), key=repr) and len(got) == 10
    known = [(1, 5, 9), (1, 5, 9), (1, 1, 3), (1, 5, 9), (1, 20, None), (1, 20, 22), (1, 22, 23), (1, None, 4)]
    assert rows(spans.merged_rows(spark.createDataFrame(known, "k int, start int, end int"), ["k"])) == [(1, 1, 3), (1, 20, 23), (1, 5, 9), (1, None, 4)]
