"""Where intermediate tables go, and when a table may be broadcast."""

from __future__ import annotations

import atexit
import shutil
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import cache, reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Upper bound, in bytes of row values, for a table that is sent to every executor.
BROADCAST_BYTES = 64 * 1024 * 1024


@cache
def _own_folder(warehouse: str) -> str:
    """A folder of this process below the warehouse; removed at its end if it is local."""
    folder = f"{warehouse.rstrip('/')}/scratch-{uuid.uuid4().hex}"
    if "://" not in folder:
        atexit.register(shutil.rmtree, folder.removeprefix("file:"), ignore_errors=True)
    return folder


def scratch_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; unset, one in the warehouse.

    Executors read what others wrote, so on a cluster the folder has to be a shared one: a
    warehouse on a machine's own disk is taken in local mode only, and is an error elsewhere.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    warehouse = spark.conf.get("spark.sql.warehouse.dir")
    master = spark.sparkContext.master
    alone = master.startswith("local") and not master.startswith("local-cluster")
    if not alone and ("://" not in warehouse or warehouse.startswith("file:")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _own_folder(warehouse)


_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


@contextmanager
def cleared_scratch(spark: SparkSession) -> Iterator[None]:
    """Removes at the end what ``materialize`` wrote within, for jobs with results of their own."""
    token = _written.set([])
    try:
        yield
    finally:
        paths = _written.get()
        _written.reset(token)
        for path in paths:
            delete_folder(spark, path)


def file_system(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of a path, and the path as it takes it."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library has written; nothing happens if it is not there."""
    files, place = file_system(spark, path)
    files.delete(place, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """What is written within leaves no shuffle files: nothing reads those of a finished write again."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def _write(df: DataFrame, label: str) -> str:
    spark = df.sparkSession
    path = f"{scratch_folder(spark)}/haplospark/{label}-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.option("compression", "zstd").parquet(path)
    if (paths := _written.get()) is not None:
        paths.append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared folder and continue from the written table.

    This cuts the lineage for good: a lost executor costs a re-read of the table and not a
    re-run of what led to it.
    """
    path = _write(df, label)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Step = Callable[[DataFrame], DataFrame]


def steps(bounded: bool) -> Step:
    """How a job of several shuffles of the same rows goes on between them.

    With lookups that are broadcast there is one shuffle, and the rows go on as they are. Otherwise
    they are written, narrow in columns, and what the step before wrote is deleted: the
    disk holds one shuffle at a time and not all of them. Each step is to be made of the one before
    alone.
    """
    last: list[str] = []

    def step(df: DataFrame) -> DataFrame:
        if bounded:
            return df
        path = _write(df, "step")
        while last:
            delete_folder(df.sparkSession, last.pop())
        last.append(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)

    return step


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of a row's values, with an allowance for what surrounds each."""
    widths = [F.octet_length(F.col(f"`{c}`").cast("string")) for c in df.columns]
    return reduce(add, [F.coalesce(w, F.lit(0)) + 16 for w in widths]).cast("bigint")


def broadcast_if_bounded(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Mark a written table for broadcast if its values stay within ``max_bytes``.

    Above that it comes back unmarked and joins with it shuffle; adaptive execution then
    splits skewed keys.
    """
    used = df.agg(F.sum(_row_bytes(df)).alias("bytes")).first()["bytes"] or 0
    return F.broadcast(df) if used <= max_bytes else df


def settle(df: DataFrame, label: str, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """A lookup table written once, its size added up on the way, then as above."""
    return settle_sized(df, label, max_bytes)[0]


def settle_sized(df: DataFrame, label: str, max_bytes: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """The same, and whether it is marked for broadcast."""
    size = Observation()
    measured = df.observe(size, F.sum(_row_bytes(df)).alias("bytes"))
    written = materialize(measured, label)
    bounded = (size.get["bytes"] or 0) <= max_bytes
    return (F.broadcast(written) if bounded else written), bounded
