"""Streams of reports into a keyed table: deduplicated, never dropped for lateness, exactly once a batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from galefold.operators.frames import first_of, rebased, upsert, withheld
from galefold.sources.payloads import malformed
from galefold.sources.workspace import path_and_files


class VersionedTable:
    """A keyed table in parts, as numbered versions; a reader takes the newest whole one, so a failed batch leaves no trace.

    A version writes only the parts that its batch touches, under its own folder; its list (``versions/<n>``)
    says for every part which version's folder holds it. The list is written last. Folders that neither the newest nor the
    version before it names are removed, so a batch that is played again still finds its base.
    ``part``: SQL expression of a row's part, e.g. its month; one part if not given.
    """

    def __init__(self, spark: SparkSession, root: str, part: str = "0"):
        self.spark, self.root, self.part = spark, root, part

    def _names(self, folder: str) -> list[str]:
        place, files = path_and_files(self.spark, f"{self.root}/{folder}")
        return [x.getPath().getName() for x in files.listStatus(place)] if files.exists(place) else []

    def versions(self) -> list[int]:
        found = [int(n) for n in self._names("versions") if n.isdecimal()]
        return sorted(n for n in found if "_SUCCESS" in self._names(f"versions/{n}"))

    def newest(self) -> int | None:
        return max(self.versions(), default=None)

    def parts(self, version: int | None) -> dict[str, int]:
        """Part and the version whose folder holds it."""
        return {} if version is None else {r["part"]: r["version"] for r in self.spark.read.json(f"{self.root}/versions/{version}", schema="part string, version int").collect()}

    def _folders(self, parts: dict[str, int]) -> list[str]:
        return [f"{self.root}/v{version}/part={part}" for part, version in parts.items()]

    def read(self, version: int | None = None, only: set[str] | None = None, schema: T.StructType | None = None) -> DataFrame | None:
        """The rows of a version (the newest if not given), or of some of its parts; None if there are none."""
        held = self.parts(self.newest() if version is None else version)
        chosen = self._folders({k: v for k, v in held.items() if only is None or k in only})
        reader = self.spark.read.schema(schema) if schema else self.spark.read
        return reader.parquet(*chosen) if chosen else None

    def upsert(self, batch: DataFrame, version: int, keys: list[str], order: list[str]) -> None:
        """Make ``batch`` the given version; an earlier try at it is replaced."""
        before = max((n for n in self.versions() if n < version), default=None)
        held = self.parts(before)
        named = batch.withColumn("part", F.expr(self.part).cast("string"))
        touched = {r["part"] for r in named.select("part").distinct().collect()}  # parts, not rows
        base = self.read(before, touched, batch.schema) if touched and before is not None else None
        merged = upsert(base, batch, keys, [F.col(c).desc_nulls_last() for c in order]) if base is not None else first_of(batch, keys, [F.col(c).desc_nulls_last() for c in order])
        merged.withColumn("part", F.expr(self.part).cast("string")).write.mode("overwrite").partitionBy("part").parquet(f"{self.root}/v{version}")
        now = held | dict.fromkeys(touched, version)
        self.spark.createDataFrame(sorted(now.items()), "part string, version int").coalesce(1).write.mode("overwrite").json(f"{self.root}/versions/{version}")
        self._tidy(set(self._folders(now)) | set(self._folders(held)), {version, before})

    def _tidy(self, used: set[str], lists: set[int | None]) -> None:
        for folder in self._names(""):
            if not (folder.startswith("v") and folder[1:].isdecimal()):
                continue
            parts = [n for n in self._names(folder) if n.startswith("part=")]
            gone = [n for n in parts if f"{self.root}/{folder}/{n}" not in used]
            for name in [f"{folder}/{n}" for n in gone] if len(gone) < len(parts) else [folder]:
                place, files = path_and_files(self.spark, f"{self.root}/{name}")
                files.delete(place, True)
        for n in self.versions():
            if n not in lists:
                place, files = path_and_files(self.spark, f"{self.root}/versions/{n}")
                files.delete(place, True)


def upsert_stream(spark: SparkSession, folder: str, schema: T.StructType, keys: list[str], order: list[str], table: VersionedTable, checkpoint: str, files_per_batch: int = 1) -> StreamingQuery:
    """Start a run over all files at hand: each micro-batch becomes the next version of ``table``.

    The version is the batch's number, so a batch that is played again replaces its own result.
    """
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    apply = lambda batch, number: table.upsert(batch, number, keys, order)
    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


class Conflict(Exception):
    """Someone else published a version since the one that a change was based on."""


def published(read: Callable[[], tuple[int, DataFrame]], publish: Callable[[int, DataFrame], None], fetched: DataFrame, keys: list[str], columns: list[str], attempts: int = 3) -> tuple[int, DataFrame]:
    """Optimistic commit: (attempts used, withheld keys).

    ``read`` gives the current version and its rows, ``publish`` the next rows over that version or raises
    ``Conflict``. After a conflict the fetched rows are rebased on what is current then: keys that someone else
    changed meanwhile are withheld, and stay so. The last conflict is raised.
    """
    version, base = read()
    held = base.select(*keys).limit(0).withColumn("kind", F.lit(""))
    current = base
    for attempt in range(1, attempts + 1):
        try:
            publish(version, rebased(current, fetched, held, keys))
            return attempt, held
        except Conflict:
            if attempt == attempts:
                raise
            version, current = read()
            held = withheld(base, current, fetched, keys, columns, held)
    raise ValueError("no attempt was allowed")


def quarantining_stream(source: DataFrame, text: str, json_schema: str, required: list[str], good: str, bad: str, checkpoint: str) -> StreamingQuery:
    """Split each batch of JSON texts into parsed rows and quarantined ones; the source's offset advances only when both are written."""

    def apply(batch: DataFrame, number: int) -> None:
        fine, broken = malformed(batch, text, json_schema, required)
        fine.select("parsed.*").write.mode("overwrite").parquet(f"{good}/batch={number}")
        broken.write.mode("overwrite").parquet(f"{bad}/batch={number}")

    return source.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def load_status(years: DataFrame, done: DataFrame) -> DataFrame:
    """(year, status, records, stations) of a load that may be resumed: years with rows are completed, others pending."""
    known = done.groupBy("year").agg(F.count("*").alias("records"), F.count_distinct("station").alias("stations"))
    return years.join(known, "year", "left").select("year", F.when(F.col("records").isNull(), "pending").otherwise("completed").alias("status"), F.coalesce("records", F.lit(0).cast("bigint")).alias("records"), F.coalesce("stations", F.lit(0).cast("bigint")).alias("stations"))


def load_summary(status: DataFrame) -> DataFrame:
    """total_years, completed, total_records (sum), total_stations (most of a year)."""
    done = F.col("status") == "completed"
    return status.agg(F.count("*").alias("total_years"), F.count_if(done).alias("completed"), F.coalesce(F.sum(F.when(done, F.col("records"))), F.lit(0)).alias("total_records"), F.coalesce(F.max(F.when(done, F.col("stations"))), F.lit(0).cast("bigint")).alias("total_stations"))


def hourly_stream(source: DataFrame, time: str, key: str, late: str = "72 hours") -> DataFrame:
    """Approximate distinct keys of each hour, with a watermark for late reports."""
    return source.withWatermark(time, late).groupBy(F.window(time, "1 hour")).agg(F.approx_count_distinct(key).alias("stations"), F.count("*").alias("reports"))


def session_stream(source: DataFrame, time: str, key: str, gap: str = "25 hours", late: str = "72 hours") -> DataFrame:
    return source.withWatermark(time, late).groupBy(key, F.session_window(time, gap)).agg(F.count("*").alias("reports"))


def once(source: DataFrame, time: str, keys: list[str], late: str = "72 hours") -> DataFrame:
    """At-least-once input to once each, by payload identity."""
    return source.withWatermark(time, late).dropDuplicatesWithinWatermark(keys)
