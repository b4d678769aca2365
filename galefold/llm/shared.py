"""What the training-data operators share: tables in the cluster's shared folder, text access, packing of batches."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: ``spark.checkpoint.dir`` of the session.

    Where a session on one machine (a local master) names none, a folder of that machine serves; a cluster must name one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: it must name a folder that the driver and all executors share")
        named = f"{tempfile.gettempdir()}/galefold-{spark.sparkContext.applicationId}"
    return named.rstrip("/")


#: Tables of so many rows at most are held by the driver (each a few MB) instead of being written.
FEW_ROWS = 1 << 16

#: Scratches made while a ``temporary`` block is open, by block.
_OPEN: list[list[Scratch]] = []


@contextmanager
def temporary() -> Iterator[None]:
    """Removes at its end the tables of every ``Scratch`` made inside: for frames that are written out before that."""
    _OPEN.append([])
    try:
        yield
    finally:
        for scratch in _OPEN.pop():
            scratch.drop()


class Scratch:
    """Tables written to the shared folder to cut lineage: they survive the loss of any executor."""

    def __init__(self, spark: SparkSession, tag: str):
        self.spark, self.root, self.made = spark, f"{shared_dir(spark)}/galefold-{tag}-{uuid.uuid4().hex}", 0
        self.paths: dict[int, str] = {}
        self.frames: list[DataFrame] = []  # keeps the numbers of ``paths`` from being given again
        if _OPEN:
            _OPEN[-1].append(self)

    def keep(self, frame: DataFrame, rows: int | None = None) -> DataFrame:
        """Write ``frame`` and return it as read from there.

        ``rows``: a number of rows that it can't exceed, if the caller has one. Where those are few, the driver holds them.
        """
        if rows is not None and rows <= FEW_ROWS:
            return self.spark.createDataFrame(frame.toArrow(), frame.schema)
        self.made += 1
        path = f"{self.root}/{self.made:03d}"
        frame.write.parquet(path)
        read = self.spark.read.schema(frame.schema).parquet(path)
        self.paths[id(read)] = path
        self.frames.append(read)
        return read

    def drop(self, *frames: DataFrame) -> None:
        """Remove the tables of ``frames``, or every table written so far; only for when nothing reads them any more."""
        for path in [self.paths.pop(id(x)) for x in frames] if frames else [self.root]:
            removed(self.spark, path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


def listed_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the finished tables (those with a ``_SUCCESS`` file) right below a folder; none if there is no folder."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    place = hadoop.Path(path)
    files = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(place):
        return []
    found = [x.getPath() for x in files.listStatus(place) if x.isDirectory()]
    return sorted(x.getName() for x in found if files.exists(hadoop.Path(x, "_SUCCESS")))


@cache
def _trim() -> Callable[[int], int]:
    """The C library's ``malloc_trim``, or nothing where it has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError):
        return lambda _: 0


def release() -> None:
    """Give memory that earlier batches held back to the system; a worker that is used again would keep it."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def texts_of(column: pa.Array) -> list[str | None]:
    """Python strings of an Arrow string column; bytes that are no UTF-8 become replacement characters."""
    if column.nbytes > 1 << 20:
        release()
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if x is None else x.decode("utf-8", "replace") for x in column.cast(pa.binary()).to_pylist()]


def text_slices(column: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, list[str | None]]]:
    """(place of the first, texts): a column's texts in slices of about ``most`` bytes, so that few are Python strings at once."""
    for lo, hi in runs(pc.binary_length(column).fill_null(0).to_pylist(), most):
        yield lo, texts_of(column.slice(lo, hi - lo))
    release()


def each_text(column: pa.Array) -> Iterator[str | None]:
    """A column's texts one by one, of which few are Python strings at once."""
    for _, texts in text_slices(column):
        yield from texts


def runs(lengths: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive items whose lengths add up to ``most`` at most, or that hold a single item."""
    begin, total = 0, 0
    for i, n in enumerate(lengths):
        if i > begin and total + n > most:
            yield begin, i
            begin, total = i, 0
        total += n
    if begin < len(lengths):
        yield begin, len(lengths)


def type_of(frame: DataFrame, column: str) -> str:
    return frame.schema[column].dataType.simpleString()
