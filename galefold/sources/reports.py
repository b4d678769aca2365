"""Raw reports to rows: hourly CSV, climate GeoJSON, observation XML; and wide to long."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galefold.functions.columns import blank_to_null, content_id, number, present, trace
from galefold.operators.reconcile import station_identity
from galefold.schema import MEASURES

# Fields of each source with variable, unit, statistic, period in seconds and multiplier.
HOURLY_FIELDS = [
    ("tmpc", "air_temperature", "degC", "instantaneous", None, 1.0), ("dwpc", "dew_point_temperature", "degC", "instantaneous", None, 1.0), ("relh", "relative_humidity", "percent", "instantaneous", None, 1.0),
    ("drct", "wind_direction", "degree", "instantaneous", None, 1.0), ("sknt", "wind_speed", "knot", "mean", None, 1.0), ("gust", "wind_gust", "knot", "maximum", None, 1.0), ("p01m", "precipitation", "mm", "sum", 3600.0, 1.0),
]
CLIMATE_FIELDS = [
    ("TEMP", "air_temperature", "degC", "instantaneous", None, 1.0), ("DEW_POINT_TEMP", "dew_point_temperature", "degC", "instantaneous", None, 1.0), ("RELATIVE_HUMIDITY", "relative_humidity", "percent", "instantaneous", None, 1.0),
    ("WIND_DIRECTION", "wind_direction", "degree", "instantaneous", None, 10.0), ("WIND_SPEED", "wind_speed", "km/h", "mean", None, 1.0), ("PRECIP_AMOUNT", "precipitation", "mm", "sum", 3600.0, 1.0),
]


# Flags of climate fields without a number.
NO_DATA = ["NA", "ND"]


def hourly_csv(frame: DataFrame) -> DataFrame:
    """Typed wide rows from all-text rows of an hourly CSV; reports without tmpf are dropped, traces are 0 with a flag."""
    numbers = {m: F.when(trace(F.col(m)), 0.0).otherwise(number(F.col(m))) if m in ("p01i", "p01m") else number(F.col(m)) for m in MEASURES}
    typed = frame.select(
        "station", F.try_to_timestamp(F.col("valid"), F.lit("yyyy-MM-dd HH:mm")).alias("valid"), number(F.col("lon")).alias("longitude"), number(F.col("lat")).alias("latitude"),
        *[c.alias(m) for m, c in numbers.items()], blank_to_null(F.col("wxcodes")).alias("wxcodes"), trace(F.col("p01m")).alias("is_trace"),
    )
    return typed.where("tmpf IS NOT NULL")


def read_hourly_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of CSV files in any order of columns; the header (one line, read first) must have all of them."""
    columns = ["station", "valid", *MEASURES, "lon", "lat", "wxcodes"]
    lines = spark.read.option("header", "true").csv(path)
    if missing := set(columns) - set(lines.columns):
        raise ValueError(f"the header lacks {sorted(missing)}")
    return hourly_csv(lines.select(*columns))


def climate_features(payloads: DataFrame, text: str = "content") -> DataFrame:
    """A row for each feature of GeoJSON FeatureCollections: id, longitude, latitude, properties map."""
    schema = "struct<features:array<struct<id:string,geometry:struct<coordinates:array<double>>,properties:map<string,string>>>>"
    each = payloads.select(F.explode(F.from_json(F.col(text).cast("string"), schema)["features"]).alias("f"))
    return each.select("f.id", F.col("f.geometry.coordinates")[0].alias("longitude"), F.col("f.geometry.coordinates")[1].alias("latitude"), F.col("f.properties").alias("properties"))


def flagged(flag: Column) -> Column:
    """Whether a climate flag says that the number isn't one: not available, or no data."""
    return F.coalesce(F.upper(F.trim(flag)).isin(NO_DATA), F.lit(False))


def climate_long(features: DataFrame) -> DataFrame:
    """Long rows of climate features; a flag T marks a trace and keeps its number."""
    p = F.col("properties")
    parts = [
        F.struct(F.lit(v).alias("variable"), (F.when(~flagged(p[f"{f}_FLAG"]), number(p[f])) * k).alias("value_float"), F.lit(u).alias("unit"), F.lit(s).alias("statistic"), F.lit(sec).cast("double").alias("period_seconds"), F.coalesce(p[f"{f}_FLAG"] == "T", F.lit(False)).alias("is_trace"))
        for f, v, u, s, sec, k in CLIMATE_FIELDS
    ]
    rows = features.select(p["CLIMATE_IDENTIFIER"].alias("station_id"), F.try_to_timestamp(p["UTC_DATE"]).alias("observed_at"), F.explode(F.array(*parts)).alias("m"))
    return rows.select("station_id", "observed_at", "m.*").where("value_float IS NOT NULL")


ELEMENT = "array<struct<_name:string,_uom:string,_value:string>>"
OBSERVATION = f"struct<metadata:struct<set:struct<`identification-elements`:struct<element:{ELEMENT}>>>,resultTime:struct<TimeInstant:struct<timePosition:string>>,result:struct<elements:struct<element:{ELEMENT}>>>"


def observation_xml(payloads: DataFrame, text: str = "content", hint: Column | None = None) -> DataFrame:
    """Rows (provider, station, result_time, name, uom, value) of observation collections in XML.

    Spark's XML parser reads the whole collection, whatever prefixes its namespaces have; a sentinel is a
    missing value. ``hint`` is the provider of payloads that name none.
    """
    parsed = F.from_xml(F.col(text).cast("string"), f"struct<member:array<struct<Observation:{OBSERVATION}>>>", {"ignoreNamespace": "true"})
    each = payloads.select(F.explode(parsed["member"]).alias("m"), (hint if hint is not None else F.lit(None).cast("string")).alias("hint")).select("m.Observation.*", "hint")
    elements = F.expr("metadata.`set`.`identification-elements`.element")
    ids = F.map_from_entries(F.transform(elements, lambda e: F.struct(e["_name"], e["_value"])))
    rows = each.select(ids.alias("ids"), "hint", F.try_to_timestamp(F.col("resultTime.TimeInstant.timePosition")).alias("result_time"), F.explode("result.elements.element").alias("e"))
    own = lambda name: F.try_element_at("ids", F.lit(name))
    station = station_identity(own("msc_id"), own("data_pvdr"), own("tc_id"), own("stn_id"), F.col("hint"))
    return rows.select(F.coalesce(own("data_pvdr"), F.col("hint")).alias("provider"), station.alias("station"), "result_time", F.col("e._name").alias("name"), F.col("e._uom").alias("uom"), present(F.col("e._value")).alias("value"))


def long_rows(wide: DataFrame, fields: list[tuple], keys: list[str]) -> DataFrame:
    """Wide to long by a mapping; of fields that map to one variable, the first with a value stays."""
    parts = F.array(*[F.struct(F.lit(i).alias("ordinal"), F.lit(v).alias("variable"), (F.col(f) * k).alias("value_float"), F.lit(u).alias("unit"), F.lit(s).alias("statistic"), F.lit(sec).cast("double").alias("period_seconds")) for i, (f, v, u, s, sec, k) in enumerate(fields)])
    some = F.filter(parts, lambda m: m["value_float"].isNotNull())
    firsts = F.filter(some, lambda m: ~F.exists(some, lambda o: (o["variable"] == m["variable"]) & (o["ordinal"] < m["ordinal"]))) if len({f[1] for f in fields}) < len(fields) else some
    return wide.select(*keys, F.explode(firsts).alias("m")).select(*keys, "m.variable", "m.value_float", "m.unit", "m.statistic", "m.period_seconds")


def with_revisions(rows: DataFrame, record: list[str], content: list[str], payload: list[str]) -> DataFrame:
    """source_record_id, revision_id (of the content) and occurrence_id (of the content in its payload)."""
    own = rows.withColumn("source_record_id", content_id(*record)).withColumn("revision_id", content_id(*record, *content))
    return own.withColumn("occurrence_id", content_id(*record, *content, *payload))


def bounded_quality(value: Column, low: Column, high: Column, future: Column) -> tuple[Column, Column]:
    """Quality and reasons of a value by physical bounds and time of observation."""
    off = F.coalesce(~value.between(low, high), F.lit(False))
    reasons = F.nullif(F.concat_ws(";", F.when(off, "physical_bounds"), F.when(future, "future_observation")), F.lit(""))
    return F.when(off | future, "suspect").otherwise("accepted"), reasons
