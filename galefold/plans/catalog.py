"""Registry of the queries over the driver's tables, each with its SQL twin.

``events`` stands for reports (user_id: station, ts: time, value: measurement, event_type: kind),
``customer`` with ``nation`` for stations, ``lineitem`` for overlapping fetches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from galefold.functions import columns as C
from galefold.operators import checks, frames, places, reconcile, sequences, spans
from galefold.sources import reports

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        _QUERIES[f.__name__] = f
        if sql is not None:
            _SQL[f.__name__] = sql
        return f

    return register


def queries() -> dict[str, Query]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def t(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def rounded(c, name: str):
    return F.round(c, 7).alias(name)


# --- scans, projections, filters -----------------------------------------------------------------


@query("SELECT user_id, ts, round((value - 32) * 5 / 9, 7) AS celsius FROM events WHERE user_id = 7")
def scan_filter_project(s, d):
    return t(s, d, "events").where("user_id = 7").select("user_id", "ts", rounded(C.celsius(F.col("value")), "celsius"))


@query("SELECT event_id, user_id FROM events WHERE user_id IN (1, 5, 9, 13, 21) AND month(ts) = 1 AND value IS NOT NULL")
def in_list_filter(s, d):
    return t(s, d, "events").where(F.col("user_id").isin(1, 5, 9, 13, 21) & (F.month("ts") == 1) & F.col("value").isNotNull()).select("event_id", "user_id")


@query("SELECT l_orderkey, l_linenumber, l_discount, l_tax FROM lineitem WHERE l_discount <= l_tax AND l_quantity BETWEEN 10 AND 12")
def cross_column_filter(s, d):
    return t(s, d, "lineitem").where("l_discount <= l_tax AND l_quantity BETWEEN 10 AND 12").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")


@query("SELECT event_id, ts FROM events WHERE date_trunc('day', ts) = DATE '2024-01-05'")
def day_equality_range(s, d):
    return t(s, d, "events").where(spans.inside(F.col("ts"), [("2024-01-05", "2024-01-06")])).select("event_id", "ts")


@query("SELECT event_id FROM events WHERE (ts >= '2024-01-03' AND ts < '2024-01-04 12:00') OR (ts >= '2024-01-20' AND ts < '2024-01-21')")
def interval_membership(s, d):
    return t(s, d, "events").where(spans.inside(F.col("ts"), [("2024-01-03", "2024-01-04 12:00"), ("2024-01-20", "2024-01-21")])).select("event_id")


@query("SELECT year(o_orderdate) AS year, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 1998 GROUP BY 1")
def year_range_scan(s, d):
    t(s, d, "orders").createOrReplaceTempView("galefold_orders")
    return s.sql("SELECT cast(year(o_orderdate) AS bigint) AS year, count(*) AS n, count(DISTINCT o_custkey) AS customers FROM galefold_orders WHERE o_orderdate >= timestamp_ntz'1996-01-01' AND o_orderdate < timestamp_ntz'1999-01-01' GROUP BY 1")


@query("SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_quantity IN (5.0, 17.0, 41.0) AND round(l_discount, 2) = 0.05 ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber, l_partkey LIMIT 50")
def suspicious_values(s, d):
    rows = t(s, d, "lineitem").where(F.col("l_quantity").isin(5.0, 17.0, 41.0) & (F.round("l_discount", 2) == 0.05))
    return rows.orderBy(F.col("l_extendedprice").desc(), "l_orderkey", "l_linenumber", "l_partkey").limit(50).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("SELECT l_suppkey, count(*) AS n FROM lineitem WHERE l_discount = 0.05 GROUP BY l_suppkey ORDER BY n DESC, l_suppkey LIMIT 20")
def suspicious_by_station(s, d):
    return t(s, d, "lineitem").where("l_discount = 0.05D").groupBy("l_suppkey").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "l_suppkey").limit(20)


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE CAST(json_extract_string(props, '$.k') AS BIGINT) >= 50")
def json_extract(s, d):
    return t(s, d, "events").select("event_id", F.get_json_object("props", "$.k").try_cast("bigint").alias("k")).where("k >= 50")


# --- aggregation ---------------------------------------------------------------------------------


@query("SELECT count(*) AS n, count(l_quantity) AS quantity, count(l_tax) AS tax, count(l_shipdate) AS shipdate, min(l_shipdate) AS first, max(l_shipdate) AS last FROM lineitem")
def completeness_counts(s, d):
    return t(s, d, "lineitem").agg(F.count("*").alias("n"), F.count("l_quantity").alias("quantity"), F.count("l_tax").alias("tax"), F.count("l_shipdate").alias("shipdate"), F.min("l_shipdate").alias("first"), F.max("l_shipdate").alias("last"))


@query("SELECT user_id, count(*) AS n, min(value) AS low, round(avg(value), 7) AS mean, max(value) AS high, round(sum(value), 2) AS total FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 25")
def station_summary_topk(s, d):
    g = t(s, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.min("value").alias("low"), rounded(F.avg("value"), "mean"), F.max("value").alias("high"), F.round(F.sum("value"), 2).alias("total"))
    return g.orderBy(F.col("n").desc(), "user_id").limit(25)


@query("SELECT l_suppkey, round(sum(l_quantity), 2) AS total FROM lineitem GROUP BY l_suppkey HAVING sum(l_quantity) BETWEEN 100 AND 1000000 ORDER BY total DESC, l_suppkey LIMIT 10")
def having_ranking(s, d):
    return t(s, d, "lineitem").groupBy("l_suppkey").agg(F.round(F.sum("l_quantity"), 2).alias("total")).where("total BETWEEN 100 AND 1000000").orderBy(F.col("total").desc(), "l_suppkey").limit(10)


@query("SELECT event_id, user_id, value FROM events WHERE value > 0 ORDER BY value ASC NULLS LAST, event_id LIMIT 10")
def extremes_topk(s, d):
    return t(s, d, "events").where("value > 0").orderBy(F.col("value").asc_nulls_last(), "event_id").limit(10).select("event_id", "user_id", "value")


@query("SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, round(avg(value), 7) AS mean FROM events GROUP BY 1, 2")
def daily_mean(s, d):
    return t(s, d, "events").groupBy("user_id", C.day(F.col("ts")).alias("day")).agg(rounded(F.avg("value"), "mean"))


@query("""SELECT user_id, day, CASE WHEN count(mean) OVER w >= 3 THEN round(avg(mean) OVER w, 7) END AS rolling FROM
(SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, avg(value) AS mean FROM events WHERE value IS NOT NULL GROUP BY 1, 2)
WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""")
def rolling_mean_centered(s, d):
    daily = t(s, d, "events").where("value IS NOT NULL").groupBy("user_id", C.day(F.col("ts")).alias("day")).agg(F.avg("value").alias("mean"))
    return sequences.rolling_mean(daily, "user_id", "day", "mean", width=7, least=3).select("user_id", "day", rounded(F.col("rolling"), "rolling"))


@query("SELECT user_id, arg_max(event_id, (value, -event_id)) AS event_id, max(value) AS value FROM events GROUP BY user_id")
def arg_max_per_group(s, d):
    return t(s, d, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("value", -F.col("event_id"))).alias("event_id"), F.max("value").alias("value"))


@query("""WITH m AS (SELECT year(o_orderdate) AS year, o_custkey, max(o_totalprice) AS best FROM orders GROUP BY ALL)
SELECT CAST(year AS BIGINT) AS year, o_custkey, best FROM m WHERE (year, best) IN (SELECT (year, max(best)) FROM m GROUP BY year)""")
def annual_champion(s, d):
    by = t(s, d, "orders").groupBy(F.year("o_orderdate").cast("bigint").alias("year"), "o_custkey").agg(F.max("o_totalprice").alias("best"))
    return by.join(by.groupBy("year").agg(F.max("best").alias("best")), ["year", "best"], "left_semi")


@query("""SELECT date_trunc('hour', ts - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS hour, count(DISTINCT user_id) AS stations,
count(DISTINCT user_id) FILTER (WHERE event_type = 'click') AS clicking FROM events GROUP BY 1""")
def hour_label_counts(s, d):
    return t(s, d, "events").groupBy(C.hour_label(F.col("ts")).alias("hour")).agg(F.count_distinct("user_id").alias("stations"), F.count_distinct(F.when(F.col("event_type") == "click", F.col("user_id"))).alias("clicking"))


_GRID = "SELECT unnest(range(TIMESTAMP '2024-01-01 00:00', TIMESTAMP '2024-01-31 01:00', INTERVAL 1 HOUR)) AS hour"
_COUNTS = f"(SELECT g.hour, coalesce(c.n, 0) AS n FROM ({_GRID}) g LEFT JOIN (SELECT date_trunc('hour', ts - INTERVAL 1 MICROSECOND) + INTERVAL 1 HOUR AS hour, count(DISTINCT user_id) AS n FROM events GROUP BY 1) c USING (hour))"


def _hourly(s, d):
    return frames.hourly_counts(t(s, d, "events"), "user_id", C.hour_label(F.col("ts")), "2024-01-01 00:00", "2024-01-31 00:00")


@query(f"SELECT * FROM {_COUNTS}")
def hour_grid_zero_fill(s, d):
    return _hourly(s, d)


@query(f"""WITH c AS (SELECT * FROM {_COUNTS}), b AS (SELECT hour(hour) AS h, median(n) AS baseline FROM c WHERE hour <= TIMESTAMP '2024-01-26 12:30' AND hour > TIMESTAMP '2024-01-19 12:30' AND n > 0 GROUP BY 1 HAVING count(*) >= 3 AND median(n) > 0)
SELECT hour, n, baseline, CASE WHEN baseline IS NULL THEN 'insufficient_baseline' WHEN n < 0.5 * baseline THEN 'low' ELSE 'ok' END AS status
FROM c LEFT JOIN b ON hour(c.hour) = b.h WHERE hour > TIMESTAMP '2024-01-26 12:30' AND hour <= TIMESTAMP '2024-01-28 10:30'""")
def coverage_low_hours(s, d):
    return frames.low_hours(_hourly(s, d), "2024-01-28 12:30")


@query("""SELECT (floor(l_quantity / 10))::INT AS speed, least(floor((l_extendedprice % 361) / 22.5), 15)::INT AS direction, round(100.0 * count(*) / (SELECT count(*) FROM lineitem), 7) AS pct
FROM lineitem WHERE l_quantity < 50 GROUP BY 1, 2""")
def wind_rose_histogram(s, d):
    rows = t(s, d, "lineitem")
    total = rows.agg(F.count("*").alias("total"))
    bins = rows.where("l_quantity < 50").groupBy(F.floor(F.col("l_quantity") / 10).cast("int").alias("speed"), C.direction_bin(F.col("l_extendedprice") % 361).alias("direction")).count()
    return bins.crossJoin(F.broadcast(total)).select("speed", "direction", rounded(F.col("count") * 100.0 / F.col("total"), "pct"))  # one row


@query("SELECT date_trunc('day', ts)::TIMESTAMP AS bin, round(sum(value), 2) AS total FROM events GROUP BY 1")
def adaptive_bins(s, d):
    rows = t(s, d, "events")
    span = rows.agg(F.timestamp_diff("DAY", F.min("ts"), F.max("ts")).alias("days"))
    unit = F.when(F.col("days") <= 60, "day").when(F.col("days") <= 365, "week").otherwise("month")
    day, week, month = (F.date_trunc(u, "ts").cast("timestamp_ntz") for u in ("day", "week", "month"))
    binned = rows.crossJoin(F.broadcast(span.select(unit.alias("unit"))))  # one row
    return binned.groupBy(F.when(F.col("unit") == "day", day).when(F.col("unit") == "week", week).otherwise(month).alias("bin")).agg(F.round(F.sum("value"), 2).alias("total"))


@query("SELECT CAST(hour(ts) AS BIGINT) AS h, median(value) AS mid, count(DISTINCT date_trunc('day', ts)) AS days FROM events GROUP BY 1 HAVING count(DISTINCT date_trunc('day', ts)) >= 3")
def median_by_hour(s, d):
    g = t(s, d, "events").groupBy(F.hour("ts").cast("bigint").alias("h")).agg(F.median("value").alias("mid"), F.count_distinct(C.day(F.col("ts"))).alias("days"))
    return g.where("days >= 3")


@query("SELECT user_id, count(*) AS n, round(count(*) / (date_diff('second', min(ts), max(ts)) // 86400 + 1), 7) AS per_day FROM events GROUP BY user_id HAVING count(*) / (date_diff('second', min(ts), max(ts)) // 86400 + 1) < 12")
def sparse_stations(s, d):
    days = F.floor((F.floor(C.micros(F.max("ts")) / 1_000_000) - F.floor(C.micros(F.min("ts")) / 1_000_000)) / 86400) + 1
    g = t(s, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), days.alias("days"))
    return g.where("n / days < 12").select("user_id", "n", rounded(F.col("n") / F.col("days"), "per_day"))


@query("""SELECT event_type, max(ts) AS freshest, count(*) AS n, date_diff('second', max(ts), TIMESTAMP '2024-01-31') AS latency_s,
max(ts) < TIMESTAMP '2024-01-30 22:00' AS gap FROM events GROUP BY event_type""")
def freshness_by_network(s, d):
    at = F.lit("2024-01-31").cast("timestamp_ntz")
    seconds = F.floor(C.micros(at) / 1_000_000) - F.floor(C.micros(F.max("ts")) / 1_000_000)
    return t(s, d, "events").groupBy("event_type").agg(F.max("ts").alias("freshest"), F.count("*").alias("n"), seconds.cast("bigint").alias("latency_s"), (F.max("ts") < F.lit("2024-01-30 22:00").cast("timestamp_ntz")).alias("gap"))


@query("""SELECT count(*) FILTER (WHERE g AND NOT q) AS fp, count(*) FILTER (WHERE NOT g AND q) AS fn,
round(count(*) FILTER (WHERE g AND NOT q) / count(*) FILTER (WHERE NOT q), 7) AS fp_rate, round(count(*) FILTER (WHERE NOT g AND q) / count(*) FILTER (WHERE q), 7) AS fn_rate
FROM (SELECT l_returnflag = 'R' AS q, l_quantity > 25 AS g FROM lineitem)""")
def confusion_metrics(s, d):
    m = sequences.confusion(t(s, d, "lineitem"), F.col("l_returnflag") == "R", F.col("l_quantity") > 25)
    return m.select("fp", "fn", rounded(F.col("fp_rate"), "fp_rate"), rounded(F.col("fn_rate"), "fn_rate"))


@query("SELECT round(min(value), 7) AS low, round(avg(value), 7) AS mean, round(max(value), 7) AS high, count(*) FILTER (WHERE value > 100) AS wet, count(*) AS n FROM events WHERE user_id = 3")
def result_stats(s, d):
    return t(s, d, "events").where("user_id = 3").agg(rounded(F.min("value"), "low"), rounded(F.avg("value"), "mean"), rounded(F.max("value"), "high"), F.count_if(F.col("value") > 100).alias("wet"), F.count("*").alias("n"))


# --- joins and set operations --------------------------------------------------------------------


@query("SELECT e.event_id, e.user_id, c.c_mktsegment, n.n_name FROM events e LEFT JOIN customer c ON c.c_custkey = e.user_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey")
def enrich_left_join(s, d):
    stations = t(s, d, "customer").join(t(s, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left").select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "n_name")
    return t(s, d, "events").join(stations, "user_id", "left").select("event_id", "user_id", "c_mktsegment", "n_name")


@query("""WITH s AS (SELECT c_custkey AS user_id, c_mktsegment AS kind FROM customer WHERE c_acctbal > 0),
k AS (SELECT user_id, arg_max(event_type, (ts, event_type)) AS kind FROM events WHERE event_type <> 'error' AND user_id NOT IN (SELECT user_id FROM s) GROUP BY user_id)
SELECT e.event_id, e.user_id, m.kind FROM events e LEFT JOIN (SELECT * FROM s UNION ALL SELECT * FROM k) m USING (user_id)""")
def enrich_last_known(s, d):
    rows = t(s, d, "events").withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type")))
    stations = t(s, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("kind"))
    return frames.enriched(rows, stations, "user_id", "ts", ["kind"], "kind").select("event_id", "user_id", "kind")


@query("SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)")
def anti_existing_only(s, d):
    return t(s, d, "events").select("user_id").distinct().join(t(s, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("user_id")), "user_id", "left_anti")


@query("SELECT c_custkey FROM customer EXCEPT SELECT user_id FROM events")
def unresolved_ids(s, d):
    return t(s, d, "customer").select("c_custkey").subtract(t(s, d, "events").select(F.col("user_id").alias("c_custkey")))


@query("SELECT hour, coalesce(a.n, 0) AS clicks, coalesce(b.n, 0) AS errors FROM (SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS n FROM events WHERE event_type = 'click' GROUP BY 1) a FULL JOIN (SELECT date_trunc('hour', ts)::TIMESTAMP AS hour, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) b USING (hour)")
def hour_table_full_outer(s, d):
    by = lambda kind, name: t(s, d, "events").where(F.col("event_type") == kind).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).agg(F.count("*").alias(name))
    return by("click", "clicks").join(by("error", "errors"), "hour", "full_outer").fillna(0, ["clicks", "errors"])


_ALIASES = "(VALUES (1003, 3, TIMESTAMP '2024-01-15'), (1008, 8, TIMESTAMP '2024-01-20'))"


def _aliases(s):
    return s.sql("SELECT cast(col1 AS bigint) AS old_id, cast(col2 AS bigint) AS new_id, col3 AS boundary FROM VALUES (1003, 3, timestamp_ntz'2024-01-15'), (1008, 8, timestamp_ntz'2024-01-20')")


@query(f"SELECT event_id, CASE WHEN e.ts < a.boundary THEN a.old_id ELSE e.user_id END AS user_id, ts FROM events e LEFT JOIN {_ALIASES} a(old_id, new_id, boundary) ON a.new_id = e.user_id")
def alias_rewrite(s, d):
    return frames.renamed_before(t(s, d, "events").select("event_id", "user_id", "ts"), _aliases(s), "user_id", "ts")


@query("SELECT DISTINCT a.ts FROM events a JOIN events b ON date_trunc('hour', a.ts) = date_trunc('hour', b.ts) AND a.ts = b.ts WHERE a.user_id = 3 AND b.user_id = 3")
def alias_overlap(s, d):
    rows = t(s, d, "events").where("user_id = 3").select("user_id", "ts")
    both = rows.union(rows.select(F.lit(1003).cast("bigint").alias("user_id"), "ts"))
    return frames.alias_overlaps(both, _aliases(s), "user_id", "ts").select("ts")


@query("SELECT DISTINCT user_id FROM events WHERE event_type = 'click' INTERSECT SELECT user_id FROM events WHERE event_type = 'error' AND value > 100")
def key_intersection(s, d):
    e = t(s, d, "events")
    return e.where("event_type = 'click'").select("user_id").intersect(e.where("event_type = 'error' AND value > 100").select("user_id"))


@query("""SELECT source, text_id, first_doc FROM (SELECT source, md5(text) AS text_id, doc_id AS first_doc, row_number() OVER (PARTITION BY source, md5(text) ORDER BY doc_id) AS n FROM documents) WHERE n = 1""")
def merge_manifests(s, d):
    rows = t(s, d, "documents").select("source", F.md5(F.col("text").cast("binary")).alias("text_id"), F.col("doc_id").alias("first_doc"))
    return rows.groupBy("source", "text_id").agg(F.min("first_doc").alias("first_doc"))


_LINE = "l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice"
_LAST = "l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"


def _newest():
    return [F.col(c).desc() for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]


@query(f"SELECT {_LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LAST}) AS n FROM lineitem) WHERE n = 1")
def dedup_keep_last(s, d):
    return frames.first_of(t(s, d, "lineitem"), ["l_orderkey", "l_linenumber"], _newest()).select(*_LINE.split(", "))


@query(f"""SELECT {_LINE} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY origin DESC, {_LAST}) AS n FROM
(SELECT *, 0 AS origin FROM lineitem UNION ALL SELECT * REPLACE (l_quantity + 1 AS l_quantity), 1 AS origin FROM lineitem WHERE l_returnflag = 'R')) WHERE n = 1""")
def upsert_merge(s, d):
    rows = t(s, d, "lineitem")
    fetched = rows.where("l_returnflag = 'R'").withColumn("l_quantity", F.col("l_quantity") + 1)
    return frames.upsert(rows, fetched, ["l_orderkey", "l_linenumber"], _newest()).select(*_LINE.split(", "))


_BEFORE = "SELECT event_id, event_type, value FROM events WHERE value >= 25"
_AFTER = "SELECT event_id, event_type, CASE event_type WHEN 'view' THEN value + 1 WHEN 'error' THEN NULL ELSE value END AS value FROM events WHERE value <= 450"


def _versions(s, d):
    e = t(s, d, "events").select("event_id", "event_type", "value")
    value = F.when(F.col("event_type") == "view", F.col("value") + 1).when(F.col("event_type") == "error", F.lit(None)).otherwise(F.col("value"))
    return e.where("value >= 25"), e.where("value <= 450").withColumn("value", value)


_DIFF = f"SELECT coalesce(b.event_id, a.event_id) AS event_id, CASE WHEN b.event_id IS NULL THEN 'added' WHEN a.event_id IS NULL THEN 'removed' ELSE 'changed' END AS kind FROM ({_BEFORE}) b FULL JOIN ({_AFTER}) a ON a.event_id = b.event_id WHERE a.event_id IS NULL OR b.event_id IS NULL OR a.value IS DISTINCT FROM b.value OR a.event_type IS DISTINCT FROM b.event_type"


@query(_DIFF)
def key_diff_added_removed_changed(s, d):
    return frames.key_diff(*_versions(s, d), ["event_id"], ["event_type", "value"])


@query(f"SELECT * FROM ({_DIFF}) WHERE event_id IN (SELECT event_id FROM events WHERE event_type IN ('click', 'view'))")
def three_way_withhold(s, d):
    return frames.withheld(*_versions(s, d), t(s, d, "events").where("event_type IN ('click', 'view')"), ["event_id"], ["event_type", "value"])


@query(f"SELECT count(*) AS n FROM ({_AFTER}) FULL JOIN (SELECT event_id FROM events WHERE event_type IN ('click', 'view') AND event_id NOT IN (SELECT event_id FROM ({_DIFF}))) USING (event_id)")
def three_way_rebase(s, d):
    before, after = _versions(s, d)
    fetched = t(s, d, "events").where("event_type IN ('click', 'view')").select("event_id", "event_type", "value")
    held = frames.withheld(before, after, fetched, ["event_id"], ["event_type", "value"])
    return frames.rebased(after, fetched, held, ["event_id"]).agg(F.count("*").alias("n"))


@query("SELECT user_id, b.n AS before_n, coalesce(a.n, 0) AS after_n FROM (SELECT user_id, count(value) AS n FROM events GROUP BY 1) b LEFT JOIN (SELECT user_id, count(value) AS n FROM events WHERE event_type <> 'view' GROUP BY 1) a USING (user_id) WHERE coalesce(a.n, 0) < b.n")
def lost_metadata_guard(s, d):
    e = t(s, d, "events")
    return frames.lost_metadata(e, e.where("event_type <> 'view'"), "user_id", "value")


# --- windows and sequences -----------------------------------------------------------------------

_EVIDENCE = """WITH f AS (SELECT *, epoch_us(ts) AS us FROM events),
z AS (SELECT *, event_type = 'view' AND sum((event_type = 'error')::INT) OVER (PARTITION BY user_id ORDER BY us RANGE BETWEEN 86399999999 PRECEDING AND CURRENT ROW) > 0 AS contradicted FROM f),
e AS (SELECT *, sum(contradicted::INT) OVER w AS contradictions, sum((event_type = 'purchase')::INT) OVER w AS gauges FROM z WINDOW w AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN 86400000000 PRECEDING AND 86400000000 FOLLOWING))"""


def _evidence(s, d):
    kind = F.col("event_type")
    return sequences.evidence(t(s, d, "events"), "user_id", "ts", kind == "error", kind == "view", kind == "purchase", period=24 * sequences.HOUR)


@query(f"{_EVIDENCE} SELECT event_id FROM e WHERE contradicted")
def range_contradiction(s, d):
    return _evidence(s, d).where("contradicted").select("event_id")


@query(f"{_EVIDENCE} SELECT event_id, CAST(contradictions AS BIGINT) AS contradictions, CAST(gauges AS BIGINT) AS gauges, contradicted AND contradictions >= 2 AND gauges = 0 AS suspect FROM e")
def symmetric_evidence(s, d):
    return _evidence(s, d).select("event_id", "contradictions", "gauges", "suspect")


@query("""SELECT user_id, event_id, CAST(sum(g) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS segment FROM
(SELECT *, coalesce((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) > 90000000000)::INT, 0) AS g FROM events)""")
def segment_gaps(s, d):
    return sequences.segments(t(s, d, "events"), "user_id", "ts", 25).select("user_id", "event_id", "segment")


@query("SELECT user_id, max(gap) AS max_gap_us FROM (SELECT user_id, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS gap FROM events) GROUP BY user_id")
def max_gap_per_station(s, d):
    return sequences.largest_gaps(t(s, d, "events"), "user_id", "ts")


@query("""WITH day AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS valid_from, count(*) AS n FROM events GROUP BY 1, 2),
s AS (SELECT *, valid_from + INTERVAL 1 DAY AS valid_to, CASE WHEN n > 2 THEN 'present' ELSE 'degraded' END AS state FROM day),
l AS (SELECT *, CASE WHEN valid_from = lag(valid_to) OVER w AND state = lag(state) OVER w THEN 0 ELSE 1 END AS fresh FROM s WINDOW w AS (PARTITION BY user_id ORDER BY valid_from)),
i AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY valid_from) AS island FROM l)
SELECT user_id, state, min(valid_from) AS valid_from, max(valid_to) AS valid_to, CAST(sum(n) AS BIGINT) AS n FROM i GROUP BY user_id, state, island""")
def islands_compress(s, d):
    day = t(s, d, "events").groupBy("user_id", C.day(F.col("ts")).alias("valid_from")).agg(F.count("*").alias("n"))
    day = day.withColumn("valid_to", F.col("valid_from") + F.expr("interval 1 day")).withColumn("state", F.when(F.col("n") > 2, "present").otherwise("degraded"))
    return sequences.islands(day, ["user_id"], "valid_from", "valid_to", ["state"], ["n"])


@query("""WITH r AS (SELECT user_id AS source_record_id, event_type AS revision_id, event_id FROM events),
f AS (SELECT * FROM (SELECT *, lag(revision_id) OVER w AS p FROM r WINDOW w AS (PARTITION BY source_record_id ORDER BY event_id)) WHERE p IS NULL OR p <> revision_id)
SELECT event_id, revision_id, lag(revision_id) OVER (PARTITION BY source_record_id ORDER BY event_id) AS supersedes_revision_id FROM f""")
def revision_chain_lag(s, d):
    rows = t(s, d, "events").select(F.col("user_id").alias("source_record_id"), F.col("event_type").alias("revision_id"), "event_id")
    return sequences.chained(rows, "source_record_id", "revision_id", ["event_id"]).select("event_id", "revision_id", "supersedes_revision_id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n = 1")
def latest_revision(s, d):
    return sequences.latest(t(s, d, "events"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


def _records(s, d):
    """Reports as normalized rows with revisions: each one of an hour supersedes the one before it."""
    e = t(s, d, "events")
    w = Window.partitionBy("event_type", "user_id", "observed_at").orderBy("event_id")
    rows = e.select(
        F.when(F.col("event_id") % 3 == 0, "a").otherwise("b").alias("source"), F.col("user_id").alias("station_id"), F.col("event_type").alias("variable"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("observed_at"),
        F.when(F.col("event_type") == "view", 3600.0).alias("period_seconds"), F.lit("sum").alias("statistic"), F.col("event_id").alias("revision_id"), F.col("ts").alias("ingested_at"), F.col("ts").alias("available_at"),
        F.when(F.col("event_id") % 4 == 0, "rejected").when(F.col("event_id") % 4 == 1, "suspect").otherwise("accepted").alias("quality"), F.when(F.col("value") < 50, "missing").otherwise("observed").alias("value_state"), "event_type", "user_id", "event_id",
    )
    return rows.withColumn("supersedes_revision_id", F.lag("revision_id").over(w)).drop("event_type", "user_id", "event_id")


_RECORDS = """r0 AS (SELECT CASE WHEN event_id % 3 = 0 THEN 'a' ELSE 'b' END AS source, user_id AS station_id, event_type AS variable, date_trunc('day', ts)::TIMESTAMP AS observed_at, CASE WHEN event_type = 'view' THEN 3600.0 END AS period_seconds, event_id AS revision_id, ts AS ingested_at,
CASE event_id % 4 WHEN 0 THEN 'rejected' WHEN 1 THEN 'suspect' ELSE 'accepted' END AS quality, CASE WHEN value < 50 THEN 'missing' ELSE 'observed' END AS value_state FROM events),
r AS (SELECT *, lag(revision_id) OVER (PARTITION BY variable, station_id, observed_at ORDER BY revision_id) AS sup FROM r0),
able AS (SELECT * FROM r WHERE ingested_at <= TIMESTAMP '2024-01-20' AND quality <> 'rejected'),
gone AS (SELECT a.* FROM able a WHERE EXISTS (SELECT 1 FROM able b WHERE b.sup = a.revision_id AND b.source = a.source AND b.station_id = a.station_id AND b.variable = a.variable AND b.observed_at = a.observed_at AND b.period_seconds IS NOT DISTINCT FROM a.period_seconds)),
alive AS (SELECT * FROM able WHERE revision_id NOT IN (SELECT revision_id FROM gone))"""


@query(f"""WITH {_RECORDS} SELECT station_id, variable, observed_at, revision_id FROM (SELECT *, row_number() OVER (PARTITION BY station_id, variable, observed_at, period_seconds
ORDER BY value_state <> 'observed', quality <> 'accepted', CASE source WHEN 'a' THEN 0 ELSE 1 END, ingested_at DESC, revision_id) AS n FROM alive) WHERE n = 1""")
def canonical_select(s, d):
    ranks = s.sql("SELECT col1 AS source, col2 AS rank FROM VALUES ('a', 0), ('b', 1)")
    return sequences.canonical(_records(s, d), "2024-01-20", ranks).select("station_id", "variable", "observed_at", "revision_id")


@query(f"WITH {_RECORDS} SELECT revision_id FROM gone")
def supersession_anti(s, d):
    rows = _records(s, d)
    able = rows.where("ingested_at <= timestamp_ntz'2024-01-20' AND quality <> 'rejected'").alias("a")
    keys = ["source", "station_id", "variable", "observed_at"]
    same = F.col("a.revision_id") == F.col("b.supersedes_revision_id")
    for k in keys:
        same = same & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return able.join(able.alias("b"), same & F.col("a.period_seconds").eqNullSafe(F.col("b.period_seconds")), "left_semi").select("revision_id")


@query("SELECT l_orderkey, l_linenumber, l_partkey, variable, value FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity AS quantity, l_discount * 100 AS discount, l_tax AS tax FROM lineitem) UNPIVOT (value FOR variable IN (quantity, discount, tax))")
def unpivot_variables(s, d):
    fields = [("l_quantity", "quantity", "1", "sum", None, 1.0), ("l_discount", "discount", "percent", "mean", None, 100.0), ("l_tax", "tax", "1", "mean", None, 1.0)]
    rows = t(s, d, "lineitem")
    return reports.long_rows(rows, fields, ["l_orderkey", "l_linenumber", "l_partkey"]).select("l_orderkey", "l_linenumber", "l_partkey", "variable", F.col("value_float").alias("value"))


@query("""SELECT event_id, CASE WHEN off OR late THEN 'suspect' ELSE 'accepted' END AS quality, nullif(concat_ws(';', CASE WHEN off THEN 'physical_bounds' END, CASE WHEN late THEN 'future_observation' END), '') AS reason
FROM (SELECT event_id, NOT value BETWEEN 20 AND 450 AS off, ts > TIMESTAMP '2024-01-29' AS late FROM events)""")
def bounds_classify(s, d):
    quality, reason = reports.bounded_quality(F.col("value"), F.lit(20), F.lit(450), F.col("ts") > F.lit("2024-01-29").cast("timestamp_ntz"))
    return t(s, d, "events").select("event_id", quality.alias("quality"), reason.alias("reason"))


@query("""WITH w AS (SELECT event_id, CASE event_id % 12 WHEN 0 THEN '-RA BR' WHEN 1 THEN 'VCSH' WHEN 2 THEN '+TSRA' WHEN 3 THEN 'BLSN' WHEN 4 THEN 'FZDZ' WHEN 5 THEN 'TS' WHEN 6 THEN 'RERA' WHEN 7 THEN 'shsngs' WHEN 8 THEN '' WHEN 9 THEN 'VCTS RA' WHEN 10 THEN 'HZ FG' END AS wx FROM events)
SELECT event_id, coalesce(len(list_filter(string_split_regex(upper(wx), '\\s+'), lambda x: NOT contains(regexp_replace(x, '^[+-]+', ''), 'VC') AND NOT regexp_matches(regexp_replace(x, '^[+-]+', ''), '^(RE|DR|BL)')
AND regexp_matches(regexp_replace(regexp_replace(x, '^[+-]+', ''), '^(MI|BC|PR|DR|BL|SH|TS|FZ)', ''), '^(DZ|RA|SN|SG|IC|PL|GR|GS|UP)+$'))) > 0, false) AS wet FROM w""")
def token_precip_match(s, d):
    texts = ["-RA BR", "VCSH", "+TSRA", "BLSN", "FZDZ", "TS", "RERA", "shsngs", "", "VCTS RA", "HZ FG"]
    wx = F.lit(None).cast("string")
    for i, x in enumerate(texts):
        wx = F.when(F.col("event_id") % 12 == i, x).otherwise(wx)
    return t(s, d, "events").select("event_id", C.precipitating(wx).alias("wet"))


_DAYS = """sd AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, count(DISTINCT ts) AS expected FROM events GROUP BY 1, 2), v(variable) AS (VALUES ('click'), ('view'), ('purchase')),
o AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, event_type AS variable, count(DISTINCT event_id) AS observed, count(DISTINCT event_id) FILTER (WHERE value > 100) AS accepted, max((value > 480)::INT) = 1 AS odd FROM events GROUP BY ALL),
c AS (SELECT user_id, day, variable, expected, least(coalesce(observed, 0), expected) AS observed, least(coalesce(accepted, 0), expected) AS accepted, coalesce(odd, false) AS odd FROM sd CROSS JOIN v LEFT JOIN o USING (user_id, day, variable))"""


def _days(s, d):
    e = t(s, d, "events").withColumn("day", C.day(F.col("ts")))
    expected = e.groupBy("user_id", "day").agg(F.count_distinct("ts").alias("expected"))
    kinds = s.sql("SELECT explode(array('click', 'view', 'purchase')) AS variable")
    seen = e.groupBy("user_id", "day", F.col("event_type").alias("variable")).agg(F.count_distinct("event_id").alias("observed"), F.count_distinct(F.when(F.col("value") > 100, F.col("event_id"))).alias("accepted"), F.bool_or(F.col("value") > 480).alias("odd"))
    full = expected.crossJoin(F.broadcast(kinds)).join(seen, ["user_id", "day", "variable"], "left")  # three rows
    cap = lambda c: F.least(F.coalesce(c, F.lit(0).cast("bigint")), "expected").alias(c)
    return full.select("user_id", "day", "variable", "expected", cap("observed"), cap("accepted"), F.coalesce("odd", F.lit(False)).alias("odd"))


@query(f"WITH {_DAYS} SELECT user_id, day, variable, expected, observed, accepted, CASE WHEN observed = 0 THEN 'absent' WHEN accepted / expected < 0.8 THEN 'degraded' ELSE 'present' END AS state FROM c")
def capability_daily(s, d):
    return _days(s, d).withColumn("state", sequences.capability_state(F.col("expected"), F.col("observed"), F.col("accepted"))).drop("odd")


@query(f"WITH {_DAYS} SELECT user_id, day, variable, CASE WHEN observed = 0 THEN 'absent' WHEN accepted / expected < 0.1 THEN 'degraded' WHEN odd THEN 'degraded' ELSE 'present' END AS state FROM c")
def capability_contradiction(s, d):
    state = sequences.capability_state(F.col("expected"), F.col("observed"), F.col("accepted"), 0.1, F.col("odd"))
    return _days(s, d).select("user_id", "day", "variable", state.alias("state"))


# --- places --------------------------------------------------------------------------------------

_PLACES = "(SELECT c_custkey AS station, CAST((c_custkey * 37) % 180 - 90 AS DOUBLE) AS latitude, CAST((c_custkey * 53) % 360 - 180 AS DOUBLE) AS longitude FROM customer)"
_KM = "6371 * 2 * asin(sqrt(power(sin(radians(latitude - 40.6) / 2), 2) + cos(radians(40.6)) * cos(radians(latitude)) * power(sin(radians(longitude + 73.8) / 2), 2)))"


def _places(s, d):
    k = F.col("c_custkey")
    return t(s, d, "customer").select(k.alias("station"), ((k * 37) % 180 - 90).cast("double").alias("latitude"), ((k * 53) % 360 - 180).cast("double").alias("longitude"))


@query(f"SELECT station, round({_KM}, 7) AS distance_km FROM {_PLACES} ORDER BY {_KM}, station LIMIT 5")
def knn_haversine(s, d):
    return places.nearest(_places(s, d), 40.6, -73.8, 5).select("station", rounded(F.col("distance_km"), "distance_km"))


@query(f"""WITH k AS (SELECT station, {_KM} AS km FROM {_PLACES} WHERE station IN (SELECT user_id FROM events) ORDER BY km, station LIMIT 8),
j AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, value, km FROM events JOIN k ON k.station = user_id)
SELECT day, count(*) AS stations, round(sum(value / power(km, 2)) / sum(1 / power(km, 2)), 7) AS interpolated FROM j GROUP BY day HAVING count(*) >= 2""")
def idw_interpolate(s, d):
    near = places.nearest(_places(s, d).join(t(s, d, "events").select(F.col("user_id").alias("station")), "station", "left_semi"), 40.6, -73.8, 8).select(F.col("station").alias("user_id"), "distance_km")
    rows = t(s, d, "events").join(F.broadcast(near), "user_id").withColumn("day", C.day(F.col("ts")))  # eight rows
    return places.interpolated(rows, "day", "value").select("day", "stations", rounded(F.col("interpolated"), "interpolated"))


# --- checks --------------------------------------------------------------------------------------


@query("SELECT count(*) FILTER (WHERE NOT l_quantity BETWEEN 1 AND 45) + count(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 0.09) AS outside, count(l_quantity) + count(l_discount) AS present, round((count(*) FILTER (WHERE NOT l_quantity BETWEEN 1 AND 45) + count(*) FILTER (WHERE NOT l_discount BETWEEN 0 AND 0.09)) / (count(l_quantity) + count(l_discount)), 6) AS rate FROM lineitem")
def physical_bounds_rate(s, d):
    return checks.out_of_bounds(t(s, d, "lineitem"), {"l_quantity": (1.0, 45.0), "l_discount": (0.0, 0.09)}).withColumn("rate", F.round("rate", 6))


@query("""SELECT * FROM (VALUES ('record_count', true, (SELECT count(*)::DOUBLE FROM events)), ('timestamps', true, 0.0), ('physical_bounds', false, (SELECT round(count(*) FILTER (WHERE NOT value BETWEEN 20 AND 450) / count(value), 6) FROM events)),
('null_rates', true, 0.0), ('duplicates', true, (SELECT (count(*) - count(DISTINCT (user_id, ts)))::DOUBLE FROM events))) v(check_name, passed, metric)""")
def validation_metrics(s, d):
    return checks.validated(t(s, d, "events"), ["user_id", "ts"], "ts", {"value": (20.0, 450.0)}, ["value", "event_type"], 10, "1900-01-01", "2025-01-01")


@query("SELECT count(*) AS n, count(*) FILTER (WHERE abs(c - (value - 32) * 5 / 9) <= 0.5) AS consistent FROM (SELECT value, CASE WHEN event_id % 9 = 0 THEN value ELSE (value - 32) * 5 / 9 + 0.2 END AS c FROM events)")
def unit_consistency(s, d):
    c = F.when(F.col("event_id") % 9 == 0, F.col("value")).otherwise(C.celsius(F.col("value")) + 0.2)
    return t(s, d, "events").agg(F.count("*").alias("n"), F.count_if(F.abs(c - C.celsius(F.col("value"))) <= 0.5).alias("consistent"))


_SPANS = "(SELECT o_orderkey AS id, o_orderdate AS \"start\", o_orderdate + INTERVAL 45 DAY AS \"end\" FROM orders)"


def _spans(s, d):
    return t(s, d, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + F.expr("interval 45 days")).alias("end"))


def _split_sql(unit: str) -> str:
    return f"SELECT id, greatest(\"start\", p) AS \"start\", least(\"end\", p + INTERVAL 1 {unit}) AS \"end\" FROM (SELECT *, unnest(range(date_trunc('{unit}', \"start\")::TIMESTAMP, \"end\", INTERVAL 1 {unit})) AS p FROM {_SPANS})"


@query(_split_sql("year"))
def window_split_by_year(s, d):
    return spans.split_by(_spans(s, d), "year")


@query(_split_sql("month"))
def month_split(s, d):
    return spans.split_by(_spans(s, d), "month")


@query("""WITH w AS (SELECT o_custkey, o_orderdate AS s, o_orderdate + INTERVAL 60 DAY AS e FROM orders),
f AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM w),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY o_custkey ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS n FROM f)
SELECT o_custkey, min(s) AS "start", max(e) AS "end" FROM g GROUP BY o_custkey, n""")
def window_merge(s, d):
    rows = t(s, d, "orders").select("o_custkey", F.col("o_orderdate").alias("start"), (F.col("o_orderdate") + F.expr("interval 60 days")).alias("end"))
    return spans.merged_rows(rows, ["o_custkey"])


@query("SELECT count(*) AS n, sum(h)::BIGINT AS summed, bit_xor(h) AS xored FROM (SELECT ('0x' || substr(md5(l_orderkey || '|' || l_linenumber || '|' || l_quantity::INT), 1, 8))::BIGINT AS h FROM lineitem)")
def order_free_digest(s, d):
    text = F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("int").cast("string"))
    return frames.plain_digest(t(s, d, "lineitem"), text)


@query("""SELECT '7' AS station_id, TIMESTAMP '2026-08-10 05:00:00' AS observed_at, variable, value_float, unit, statistic, period_seconds, is_trace FROM (VALUES ('air_temperature', 21.5::DOUBLE, 'degC', 'instantaneous', NULL::DOUBLE, false),
('wind_direction', 270.0, 'degree', 'instantaneous', NULL, false), ('precipitation', 0.0, 'mm', 'sum', 3600.0, true)) v(variable, value_float, unit, statistic, period_seconds, is_trace)""")
def geojson_parse(s, d):
    payload = '{"type":"FeatureCollection","features":[{"id":"7.2026","geometry":{"type":"Point","coordinates":[-75.6,45.3]},"properties":{"CLIMATE_IDENTIFIER":"7","UTC_DATE":"2026-08-10T05:00:00","TEMP":21.5,"WIND_DIRECTION":27,"PRECIP_AMOUNT":0.0,"PRECIP_AMOUNT_FLAG":"T"}}]}'
    found = reports.climate_long(reports.climate_features(s.createDataFrame([(payload,)], "content string")))
    return found.withColumn("observed_at", F.col("observed_at").cast("timestamp_ntz"))


@query("""SELECT 'MSC' AS provider, 'MSC:tc_id:ADN' AS station, TIMESTAMP '2026-08-10 05:01:00' AS result_time, name, uom, value FROM (VALUES ('air_temp', 'degC', '20.1'), ('pcpn_amt', 'mm', NULL)) v(name, uom, value)""")
def xml_parse(s, d):
    payload = """<om:ObservationCollection xmlns:om="urn:om"><om:member><om:Observation><om:metadata><set><identification-elements><element name="data_pvdr" value="MSC"/><element name="tc_id" value="ADN"/></identification-elements></set></om:metadata><om:resultTime><gml:TimeInstant><gml:timePosition>2026-08-10T05:01:00Z</gml:timePosition></gml:TimeInstant></om:resultTime><om:result><elements><element name="air_temp" uom="degC" value="20.1"/><element name="pcpn_amt" uom="mm" value="MSNG"/></elements></om:result></om:Observation></om:member></om:ObservationCollection>"""
    return reports.observation_xml(s.createDataFrame([(payload,)], "content string")).withColumn("result_time", F.col("result_time").cast("timestamp_ntz"))


# --- reconciliation ------------------------------------------------------------------------------

_IN_WINDOW = "ts >= '2024-01-05' AND ts < '2024-01-20'"
_OLD = "SELECT user_id, ts, min(value) AS value, min(event_type) AS kind FROM events WHERE value >= 25 GROUP BY user_id, ts"
_NEW = "SELECT user_id, ts, min(CASE WHEN event_type = 'view' THEN value + 1 ELSE value END) AS value, min(CASE WHEN event_type = 'error' THEN 'click' ELSE event_type END) AS kind FROM events WHERE value <= 450 GROUP BY user_id, ts"


def _partitions(s, d):
    e = t(s, d, "events")
    value = F.when(F.col("event_type") == "view", F.col("value") + 1).otherwise(F.col("value"))
    kind = F.when(F.col("event_type") == "error", "click").otherwise(F.col("event_type"))
    old = e.where("value >= 25").groupBy("user_id", "ts").agg(F.min("value").alias("value"), F.min("event_type").alias("kind"))
    return old, e.where("value <= 450").groupBy("user_id", "ts").agg(F.min(value).alias("value"), F.min(kind).alias("kind"))


def _compared(s, d):
    wanted = t(s, d, "customer").select(F.col("c_custkey").alias("user_id"), F.lit("click").alias("kind"))
    return reconcile.compared(*_partitions(s, d), ["user_id", "ts"], ["value"], ["kind"], F.expr("ts >= timestamp_ntz'2024-01-05' AND ts < timestamp_ntz'2024-01-20'"), wanted)


_REPORT = f"""SELECT count(b_n) AS rows_before, count(a_n) AS rows_after, 0::BIGINT AS repeated_before, 0::BIGINT AS repeated_after, count(*) FILTER (WHERE b_n IS NULL) AS added, count(*) FILTER (WHERE a_n IS NULL) AS removed,
count(*) FILTER (WHERE changed) AS changed, count(*) FILTER (WHERE described) AS metadata_changed, count(*) FILTER (WHERE b_n IS NULL AND NOT inside) AS added_outside, count(*) FILTER (WHERE changed AND NOT inside) AS changed_outside,
count(*) FILTER (WHERE described AND NOT (a_kind = 'click' AND user_id IN (SELECT c_custkey FROM customer))) AS metadata_unexpected, true AS balanced
FROM (SELECT user_id, ({_IN_WINDOW}) AS inside, b.n AS b_n, a.n AS a_n, a.kind AS a_kind, a.n = 1 AND b.n = 1 AND a.value IS DISTINCT FROM b.value AS changed, a.n = 1 AND b.n = 1 AND a.kind IS DISTINCT FROM b.kind AS described
FROM (SELECT *, 1 AS n FROM ({_OLD})) b FULL JOIN (SELECT *, 1 AS n FROM ({_NEW})) a USING (user_id, ts))"""


@query(_REPORT)
def partition_report(s, d):
    return reconcile.report(_compared(s, d))


@query(_REPORT)
def sharded_report(s, d):
    dealt = _compared(s, d).withColumn("shard", reconcile.shard(F.col("user_id"), 16))
    return reconcile.combined(reconcile.report(dealt, "shard"))


@query(f"SELECT violation, n FROM (UNPIVOT ({_REPORT}) ON repeated_before, repeated_after, removed, added_outside, changed_outside, metadata_unexpected INTO NAME violation VALUE n) WHERE n > 0")
def partition_violations(s, d):
    return reconcile.violations(reconcile.report(_compared(s, d)))


@query("""WITH l AS (SELECT c_custkey AS user_id, c_mktsegment AS kind FROM customer WHERE c_acctbal > 0), r AS (SELECT c_custkey AS user_id FROM customer WHERE c_nationkey = 3)
SELECT user_id, kind FROM l WHERE user_id NOT IN (SELECT user_id FROM r) UNION ALL
SELECT user_id, arg_max(event_type, (ts, event_type)) AS kind FROM events WHERE user_id NOT IN (SELECT user_id FROM l) AND user_id NOT IN (SELECT user_id FROM r) GROUP BY user_id""")
def station_fetch_set(s, d):
    c = t(s, d, "customer").withColumn("user_id", F.col("c_custkey"))
    rows = t(s, d, "events").withColumn("kind", F.col("event_type"))
    return reconcile.fetch_set(c.where("c_acctbal > 0").withColumn("kind", F.col("c_mktsegment")), rows, "user_id", "ts", "kind", c.where("c_nationkey = 3"))


@query("SELECT DISTINCT md5(text) AS text_id FROM documents WHERE text IS NOT NULL AND lang = 'en' EXCEPT SELECT md5(text) FROM documents WHERE text IS NOT NULL AND n_chars >= 200")
def dropped_payloads(s, d):
    rows = t(s, d, "documents").where("text IS NOT NULL").withColumn("text_id", F.md5(F.col("text").cast("binary")))
    return reconcile.dropped(rows.where("lang = 'en'"), rows.where("n_chars >= 200"), "text_id")


@query("SELECT a.user_id, a.w AS was, b.w AS mark FROM (SELECT user_id, max(ts) AS w FROM events WHERE event_type = 'click' GROUP BY 1) a LEFT JOIN (SELECT user_id, max(ts) AS w FROM events WHERE event_type = 'view' GROUP BY 1) b USING (user_id) WHERE b.w IS NULL OR b.w < a.w")
def watermark_regressions(s, d):
    marks = lambda kind: t(s, d, "events").where(F.col("event_type") == kind).groupBy("user_id").agg(F.max("ts").alias("mark"))
    return reconcile.regressed(marks("click"), marks("view"), "user_id", "mark")


@query("SELECT count(DISTINCT user_id) AS present, (SELECT count(*) FROM customer) AS expected, (SELECT count(*) FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)) AS missing, count(DISTINCT user_id) FILTER (WHERE user_id NOT IN (SELECT c_custkey FROM customer)) AS extra FROM events")
def station_coverage(s, d):
    return checks.station_coverage(t(s, d, "events"), t(s, d, "customer").select(F.col("c_custkey").alias("user_id")), "user_id")


@query("""WITH g AS (SELECT user_id, ts, epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) AS step FROM events),
u AS (SELECT user_id, count(*) / (floor((max(epoch_us(ts)) - min(epoch_us(ts))) / 86400000000) + 1) AS per_day, max(step) AS gap FROM g GROUP BY user_id)
SELECT count(*) AS stations, count(*) FILTER (WHERE per_day < 3) AS sparse, count(*) FILTER (WHERE gap > 48 * 3600000000) AS gapped, round(median(per_day), 7) AS median_per_day FROM u""")
def temporal_completeness(s, d):
    return checks.temporal_completeness(t(s, d, "events"), "user_id", "ts", 3).withColumn("median_per_day", F.round("median_per_day", 7))


@query(f"SELECT count(*) AS located, count(*) FILTER (WHERE NOT (longitude BETWEEN -125 AND -66 AND latitude BETWEEN 24 AND 50) AND NOT (longitude BETWEEN 170 AND 180 AND latitude BETWEEN 50 AND 55)) AS outside FROM {_PLACES}")
def location_boxes(s, d):
    return checks.outside_boxes(_places(s, d), "longitude", "latitude", [(-125, 24, -66, 50), (170, 50, 180, 55)])


@query("SELECT DISTINCT c_nationkey AS code FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)")
def unknown_region_codes(s, d):
    return checks.unknown_codes(t(s, d, "customer").select(F.col("c_nationkey").alias("code")), "code", t(s, d, "nation").where("n_regionkey < 3").select(F.col("n_nationkey").alias("code")))


@query(f"SELECT station, longitude, latitude FROM {_PLACES}")
def wkb_round_trip(s, d):
    xy = C.wkb_xy(C.wkb_point(F.col("longitude"), F.col("latitude")))
    return _places(s, d).select("station", xy["x"].alias("longitude"), xy["y"].alias("latitude"))


@query(f"SELECT count(*) AS rows, count(*) FILTER (WHERE latitude < 0) AS nulls, count(*) FILTER (WHERE latitude >= 0) AS points, 0::BIGINT AS others FROM {_PLACES}")
def geometry_kinds(s, d):
    return checks.geometry_check(_places(s, d).withColumn("geometry", C.wkb_point(F.col("longitude"), F.when(F.col("latitude") >= 0, F.col("latitude")))))


@query("SELECT event_id, sha256(concat_ws(chr(1), user_id::VARCHAR, event_type, coalesce(props, chr(2)))) AS revision_id FROM events")
def content_revision_ids(s, d):
    return t(s, d, "events").select("event_id", C.content_id("user_id", "event_type", "props").alias("revision_id"))


@query("""WITH e AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, count(DISTINCT ts) AS expected FROM events GROUP BY 1, 2),
n AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, event_type AS variable, count(*) AS n, count(*) FILTER (WHERE value > 100) AS good FROM events GROUP BY 1, 2, 3)
SELECT e.user_id, e.day, v.variable, expected, least(coalesce(n, 0), expected) AS observed, least(coalesce(good, 0), expected) AS accepted,
CASE WHEN coalesce(n, 0) = 0 THEN 'absent' WHEN least(coalesce(good, 0), expected) / expected < 0.8 THEN 'degraded' ELSE 'present' END AS state
FROM e CROSS JOIN (VALUES ('click'), ('view'), ('purchase')) v(variable) LEFT JOIN n USING (user_id, day, variable)""")
def capability_daily_rows(s, d):
    e = t(s, d, "events").withColumn("day", C.day(F.col("ts")))
    return sequences.daily_rows(e, "user_id", "day", "ts", "event_type", F.col("value") > 100, ["click", "view", "purchase"]).withColumnRenamed("event_type", "variable")


# Registers its queries here; it needs the names above.
from galefold.plans import intake  # noqa: E402, F401
