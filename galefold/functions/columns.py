"""Column expressions of the weather domain; all of them stay within generated code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Present-weather codes.
DESCRIPTORS = ["MI", "BC", "PR", "DR", "BL", "SH", "TS", "FZ"]
PRECIPITATION = ["DZ", "RA", "SN", "SG", "IC", "PL", "GR", "GS", "UP"]
MISSING_TEXTS = ["", "MSNG", "NA", "NULL"]
EARTH_KM = 6371.0


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def present(c: Column) -> Column:
    """Text that isn't one of the sentinels for missing."""
    return F.when(~F.upper(F.trim(c)).isin(MISSING_TEXTS), F.trim(c))


def finite(c: Column) -> Column:
    """NaN and infinities as null, the one kind of missing."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def number(c: Column) -> Column:
    """A plain decimal number, else null; Spark's own cast would also take 1d, inf and NaN."""
    text = F.trim(c)
    return finite(F.when(text.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), text.try_cast("double")))


def trace(c: Column) -> Column:
    return F.coalesce((F.upper(F.trim(c)) == "T") | (number(c) == 0.0001), F.lit(False))


def celsius(c: Column) -> Column:
    return (c - 32) * 5 / 9


def hour_label(ts: Column) -> Column:
    """The end of the hour an instant belongs to; a full hour is its own label."""
    return (F.date_trunc("hour", ts - F.expr("interval 1 microsecond")) + F.expr("interval 1 hour")).cast("timestamp_ntz")


def day(ts: Column) -> Column:
    return F.date_trunc("day", ts).cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def precipitating(text: Column) -> Column:
    """Whether a present-weather text reports precipitation on the station.

    Tokens with VC or beginning with RE don't count, nor drifting or blowing; after one leading
    descriptor only precipitation codes may remain.
    """
    bare = lambda t: F.regexp_replace(t, r"^[+-]+", "")
    rest = lambda t: F.regexp_replace(t, f"^({'|'.join(DESCRIPTORS)})", "")
    counts = lambda t: ~F.contains(bare(t), F.lit("VC")) & ~bare(t).rlike("^(RE|DR|BL)") & rest(bare(t)).rlike(f"^({'|'.join(PRECIPITATION)})+$")
    return F.coalesce(F.exists(F.split(F.upper(F.trim(text)), r"\s+"), counts), F.lit(False))


def haversine(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(EARTH_KM) * 2 * F.asin(F.sqrt(half))


def fingerprint(*columns: str) -> Column:
    """Row hash in which the place of a null matters."""
    return F.xxhash64(*[x for c in columns for x in (F.col(c).isNull(), F.col(c))])


def content_id(*columns: str) -> Column:
    """sha256 of the columns as text, with marks for null."""
    return F.sha2(F.concat_ws("\u0001", *[F.when(F.col(c).isNull(), F.lit("\u0002")).otherwise(F.col(c).cast("string")) for c in columns]), 256)


def json_id(**fields: Column) -> Column:
    """sha256 of the fields as JSON with sorted keys; null is null."""
    return F.sha2(F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"}), 256)


def utc(text: Column) -> Column:
    """An ISO time with Z, an offset or neither (UTC); null for other texts. The session's zone has to be UTC."""
    return F.try_to_timestamp(text)


def zoned(text: Column) -> Column:
    """Likewise, but null without a zone."""
    return F.when(text.rlike(r"(Z|[+-][0-9]{2}:?[0-9]{2})$"), utc(text))


def has_reason(reasons: Column, name: str) -> Column:
    return F.coalesce(F.contains(reasons, F.lit(name)), F.lit(False))


def joined_reasons(*reasons: Column) -> Column:
    return F.nullif(F.concat_ws(";", *reasons), F.lit(""))


def speed_bin(c: Column) -> Column:
    edges = [0, 5, 10, 15, 20, 25, 50]
    out = F.lit(None).cast("int")
    for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        out = F.when((c >= lo) & (c < hi), i).otherwise(out)
    return out


def direction_bin(c: Column) -> Column:
    """16 sectors; 360 belongs to the last."""
    return F.least(F.floor(c / 22.5), F.lit(15)).cast("int")


def wkb_point(lon: Column, lat: Column) -> Column:
    """Little-endian WKB of a point, null if a coordinate is missing; from doubles' bits, without a UDF."""
    return F.when(lon.isNotNull() & lat.isNotNull(), F.unhex(F.concat(F.lit("0101000000"), _hex_double(lon), _hex_double(lat))))


def _hex_double(c: Column) -> Column:
    magnitude = F.abs(c)
    exponent = F.when(magnitude == 0, F.lit(0)).otherwise(F.floor(F.log2(magnitude)))
    # log2 may round up at a power of two
    exponent = F.when((magnitude > 0) & (F.pow(F.lit(2.0), exponent) > magnitude), exponent - 1).otherwise(exponent)
    fraction = F.when(magnitude == 0, F.lit(0.0)).otherwise(magnitude / F.pow(F.lit(2.0), exponent) - 1)
    mantissa = (fraction * F.lit(2.0**52)).cast("bigint")
    biased = F.when(magnitude == 0, F.lit(0)).otherwise(exponent + 1023).cast("bigint")
    bits = F.shiftleft(biased, 52).bitwiseOR(mantissa)
    bits = F.when(c < 0, bits.bitwiseOR(F.lit(-(1 << 63)))).otherwise(bits)
    return bound(F.lpad(F.hex(bits), 16, "0"), lambda big: F.concat(*[F.substring(big, i, 2) for i in range(15, 0, -2)]))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once, however often it is used; nested expressions would multiply otherwise."""
    return F.transform(F.array(value), use)[0]


def wkb_xy(geometry: Column) -> Column:
    """Longitude and latitude of a little-endian WKB point, null for anything else."""

    def parts(hexed: Column) -> Column:
        point = hexed.rlike("^0101000000[0-9A-F]{32}$")
        return F.when(point, F.struct(_double_of(F.substring(hexed, 11, 16)).alias("x"), _double_of(F.substring(hexed, 27, 16)).alias("y")))

    return bound(F.hex(geometry), parts)


def _double_of(little: Column) -> Column:
    """The double of 16 hex digits in little-endian order."""

    def value(bits: Column) -> Column:
        exponent = F.shiftright(bits, 52).bitwiseAND(F.lit(2047))
        fraction = bits.bitwiseAND(F.lit((1 << 52) - 1)) / F.lit(2.0**52)
        size = F.when(exponent == 0, fraction * F.lit(2.0**-1022)).otherwise((fraction + 1) * F.pow(F.lit(2.0), (exponent - 1023).cast("double")))
        return F.when(bits < 0, -size).otherwise(size)

    big = F.concat(*[F.substring(little, i, 2) for i in range(15, 0, -2)])
    return bound(F.conv(big, 16, -10).cast("bigint"), value)
