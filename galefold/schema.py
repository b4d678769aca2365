"""Fixed schemas, domains and record invariants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Measurements of the wide table, and the domains of the long one.
MEASURES = ["tmpf", "tmpc", "dwpf", "dwpc", "relh", "drct", "sknt", "gust", "alti", "mslp", "vsby", "p01i", "p01m"]
METADATA = ["name", "elevation", "country", "county", "wfo", "tzname"]
QUALITIES = ["accepted", "suspect", "rejected"]
VALUE_STATES = ["observed", "missing", "not_reported"]
CAPABILITY_STATES = ["present", "degraded", "absent"]


def _struct(text: str) -> T.StructType:
    """``name type`` pairs; works before any session exists."""
    kinds = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in (x.split() for x in text.split(","))])


WIDE = T.StructType(
    [T.StructField("station", T.StringType()), T.StructField("valid", T.TimestampType()), T.StructField("longitude", T.DoubleType()), T.StructField("latitude", T.DoubleType()), T.StructField("state", T.StringType())]
    + [T.StructField(m, T.DoubleType()) for m in MEASURES]
)
WIDE_V1 = T.StructType([*WIDE.fields, T.StructField("wxcodes", T.StringType())])
NORMALIZED = _struct(
    "source string, station_id string, source_station_id string, source_record_id string, revision_id string, supersedes_revision_id string, variable string, value_float double, value_text string, "
    "unit string, value_state string, statistic string, observed_at timestamp, available_at timestamp, period_seconds double, quality string, quality_reason string, is_trace boolean, "
    "raw_uri string, raw_sha256 string, ingested_at timestamp, network string"
)
# Columns of the other record schemas.
RAW_MANIFEST = _struct("source string, uri string, sha256 string, ingested_at timestamp, source_published_at timestamp, size_bytes bigint, media_type string, attribution_source string")
STATION_MAPPING = _struct("source string, source_station_id string, canonical_station_id string, method string, valid_from timestamp, valid_to timestamp")
ATTRIBUTION = _struct("source string, title string, url string, license_name string, license_url string")
CAPABILITY = _struct("source string, source_station_id string, variable string, state string, valid_from timestamp, valid_to timestamp, expected_count bigint, observed_count bigint, accepted_count bigint, reason string")
RECORD_SCHEMAS = {"normalized": NORMALIZED, "raw_manifest": RAW_MANIFEST, "station_mapping": STATION_MAPPING, "attribution": ATTRIBUTION, "capability": CAPABILITY}
MANIFEST = _struct("source string, uri string, sha256 string, ingested_at timestamp, source_published_at timestamp, size bigint, media_type string, path string")


def conform(frame: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in its order and types; absent ones are null, others are dropped."""
    return frame.select(*[(F.col(f.name) if f.name in frame.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def conform_to(frame: DataFrame, base: DataFrame) -> DataFrame:
    """``frame`` in the columns, order and types of ``base``; a column it lacks, or text that is to be a number or time, is an error.

    Numbers and times aren't turned into text silently either.
    """
    kinds = dict(frame.dtypes)
    if missing := [c for c in base.columns if c not in kinds]:
        raise ValueError(f"columns are missing: {missing}")
    for c, kind in base.dtypes:
        if kind != kinds[c] and "string" in (kind, kinds[c]) and kinds[c] != "void":
            raise ValueError(f"{c} is {kinds[c]}, not {kind}")
    return frame.select(*[F.col(c).cast(kind).alias(c) for c, kind in base.dtypes])


def write_records(frame: DataFrame, kind: str, path: str, mode: str = "errorifexists") -> None:
    """Write a table of one of the record schemas, with its columns and types."""
    missing, extra = compared(frame, RECORD_SCHEMAS[kind])
    if missing or extra:
        raise ValueError(f"{kind}: columns missing {sorted(missing)}, unknown {sorted(extra)}")
    conform(frame, RECORD_SCHEMAS[kind]).write.mode(mode).option("compression", "zstd").parquet(path)


def read_records(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """A table of one of the record schemas; columns that the files lack or that it doesn't know are an error."""
    missing, extra = compared(spark.read.parquet(path), RECORD_SCHEMAS[kind])
    if missing or extra:
        raise ValueError(f"{path}: columns missing {sorted(missing)}, unknown {sorted(extra)}")
    return spark.read.schema(RECORD_SCHEMAS[kind]).parquet(path)


def compared(frame: DataFrame, schema: T.StructType) -> tuple[set[str], set[str]]:
    """Names that the frame lacks, and names that the schema doesn't know."""
    return set(schema.names) - set(frame.columns), set(frame.columns) - set(schema.names)


def violations(rows: DataFrame) -> DataFrame:
    """One row for each broken invariant of a normalized table: invariant, n."""
    observed = F.col("value_state") == "observed"
    value = F.col("value_float").isNotNull() | F.col("value_text").isNotNull()
    rules: dict[str, Column] = {
        "sha256": ~F.col("raw_sha256").rlike("^[0-9a-f]{64}$"),
        "quality domain": ~F.col("quality").isin(QUALITIES),
        "state domain": ~F.col("value_state").isin(VALUE_STATES),
        "observed after available": (F.col("observed_at") > F.col("available_at")) & (F.col("quality") == "accepted"),
        "available after ingested": F.col("available_at") > F.col("ingested_at"),
        "observed without value": observed & ~value,
        "value without observation": ~observed & (value | F.col("is_trace")),
        "period": F.col("period_seconds") <= 0,
        "supersedes itself": F.col("revision_id") == F.col("supersedes_revision_id"),
    }
    counts = rows.agg(*[F.count_if(F.coalesce(rule, F.lit(False))).alias(name) for name, rule in rules.items()])
    return counts.unpivot([], list(rules), "invariant", "n").where("n > 0")
