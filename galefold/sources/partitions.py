"""Year partitions: pruned reads, sorted writes, information from file metadata, nanosecond repair."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from galefold.functions.columns import wkb_point
from galefold.sources.workspace import path_and_files


def in_range(frame: DataFrame, start: str, end: str, time: str) -> DataFrame:
    first, last = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    kind = frame.schema[time].dataType
    years = F.col("year").between(F.year(first), F.year(last - F.expr("interval 1 microsecond")))
    return frame.where(years).where((F.col(time) >= first.cast(kind)) & (F.col(time) < last.cast(kind)))


def read_years(spark: SparkSession, root: str, start: str, end: str, time: str = "valid", schema: T.StructType | None = None) -> DataFrame:
    """Rows with ``start <= time < end``; only the years of the range are listed and read."""
    return in_range((spark.read.schema(schema) if schema else spark.read).parquet(root), start, end, time)


def with_geometry(frame: DataFrame) -> DataFrame:
    """WKB point and covering bbox from longitude and latitude."""
    lon, lat = F.col("longitude"), F.col("latitude")
    box = F.when(lon.isNotNull() & lat.isNotNull(), F.struct(lon.alias("xmin"), lat.alias("ymin"), lon.alias("xmax"), lat.alias("ymax")))
    return frame.withColumn("geometry", wkb_point(lon, lat)).withColumn("bbox", box)


def write_years(frame: DataFrame, root: str, rows_per_file: int = 2_000_000, keys: tuple[str, ...] = ("station", "valid"), mode: str = "overwrite", files: int | None = None) -> None:
    """ZSTD Parquet by year, sorted by the keys within files; only the years at hand are replaced.

    Years are dealt by ranges of year and first key, about ``rows_per_file`` rows each, so that no task writes
    a whole large year; the time breaks ties, so that a station that holds most rows is dealt as well.
    ``files``: how many in all; without it, the rows are counted first.
    """
    rows = frame.withColumn("year", F.year(keys[-1]))
    n = files or max(1, -(-frame.count() // rows_per_file))
    dealt = rows.repartitionByRange(n, "year", *keys)
    dealt.sortWithinPartitions("year", *keys).write.mode(mode).option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("year").parquet(root)


def create_year(frame: DataFrame, root: str, year: int, keys: tuple[str, ...] = ("station", "valid")) -> None:
    """Write one year that must not be there yet."""
    frame.where(F.year(keys[-1]) == year).repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("errorifexists").option("compression", "zstd").parquet(f"{root}/year={year}")


def compact_year(spark: SparkSession, root: str, year: int, to: str, keys: tuple[str, ...] = ("station", "valid"), files: int = 1, block_bytes: int = 128 << 20) -> None:
    """Write one year again as ``files`` files in the order of the keys, with row groups of ``block_bytes``.

    One file means one task that sorts (and spills) the whole year; leave it at more for large years.
    """
    rows = spark.read.option("basePath", root).parquet(f"{root}/year={year}").drop("year")
    dealt = rows.coalesce(1) if files == 1 else rows.repartitionByRange(files, *keys)
    dealt.sortWithinPartitions(*keys).write.mode("errorifexists").option("compression", "zstd").option("parquet.block.size", block_bytes).parquet(to)


def years_of(spark: SparkSession, root: str) -> list[int]:
    """The years that the dataset has."""
    place, files = path_and_files(spark, root)
    if not files.exists(place):
        return []
    names = [x.getPath().getName() for x in files.listStatus(place) if x.isDirectory()]
    return sorted(int(n[5:]) for n in names if n.startswith("year=") and n[5:].isdecimal())


def read_year(spark: SparkSession, root: str, year: int) -> DataFrame | None:
    """One year's rows; None if it isn't there or can't be read."""
    if year not in years_of(spark, root):
        return None
    try:
        return spark.read.option("basePath", root).parquet(f"{root}/year={year}")
    except (PySparkException, Py4JJavaError):
        return None


def readable_years(spark: SparkSession, root: str, start: str, end: str, time: str = "valid", schema: T.StructType | None = None) -> DataFrame:
    """``read_years``, but files that can't be read are skipped (Spark logs each)."""
    reader = (spark.read.schema(schema) if schema else spark.read).option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    return in_range(reader.parquet(root), start, end, time)


def micro_times(frame: DataFrame) -> DataFrame:
    """Nanosecond longs (read with nanosAsLong) of columns named ``valid`` or ending in ``_at`` as timestamps."""
    long_times = {f.name: F.timestamp_micros(F.floor(F.col(f.name) / 1000).cast("bigint")) for f in frame.schema if f.dataType == T.LongType() and (f.name == "valid" or f.name.endswith("_at"))}
    return frame.withColumns(long_times)


def dataset_info(frame: DataFrame) -> DataFrame:
    """partitions, files, bytes, first and last year of a dataset read by year; the rows aren't decoded, only counted."""
    files = frame.groupBy("year", "_metadata.file_path", "_metadata.file_size").agg(F.count("*").alias("n"))
    return files.agg(F.count_distinct("year").alias("partitions"), F.count("*").alias("files"), F.sum("file_size").alias("bytes"), F.sum("n").alias("rows"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))


def out_of_order(frame: DataFrame, *keys: str) -> DataFrame:
    """Files whose rows don't ascend strictly by ``keys`` in file order."""
    from pyspark.sql import Window

    rows = frame.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), F.struct(*keys).alias("k"))
    back = F.col("k") <= F.lag("k").over(Window.partitionBy("file").orderBy("at"))
    return rows.withColumn("_b", back).where("_b").groupBy("file").count()
