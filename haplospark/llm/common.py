"""What the operators of this subpackage share: inputs, shipping of code, shared files."""

from __future__ import annotations

import io
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path
from sys import getsizeof

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

import haplospark
from haplospark.scratch import scratch_folder

#: Characters that separate words, as a regular expression class without brackets.
WORD_GAP = r"\x20\x09-\x0D"

#: Rows of an Arrow batch where whole documents go through Python and back.
SHORT_BATCH = 1000

#: Longest key that is remembered, and bytes of a dictionary's entry besides key and value.
LONGEST_KEY, ENTRY_BYTES = 64, 100

_shipped: set[str] = set()
_caches: dict[str, Callable[[], None]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the given folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_file_system(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a shared folder, and the folder's path within it."""
    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return fs.LocalFileSystem(), str(Path(path).absolute())


def new_shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder below the one that the session names for checkpoints."""
    return f"{scratch_folder(spark)}/haplospark/{label}-{uuid.uuid4().hex}"


def short_batches(spark: SparkSession) -> None:
    """Let whole documents travel in batches of ``SHORT_BATCH``, unless the application is
    configured otherwise: thousands of long texts at once, in and out, fill a worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, str(SHORT_BATCH))


class Remembered(dict):
    """Values by key, each made when it is first asked for, within a bound in bytes.

    When half of the bound is used, all become the older ones; of these, those that are asked for
    again come back. Values longer than ``LONGEST_KEY`` characters of key are not kept.
    """

    def __init__(self, make: Callable, most_bytes: int):
        super().__init__()
        self.make, self.half = make, most_bytes // 2
        self.older: dict = {}
        self.used = 0

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_KEY:
            size = getsizeof(key) + getsizeof(value) + ENTRY_BYTES
            if self.used + size > self.half:
                self.older = dict(self)
                self.clear()
                self.used = 0
            self[key] = value
            self.used += size
        return value


def forgets(module: str, clear: Callable[[], None]) -> None:
    """Note how to empty what a module remembers in a worker."""
    _caches[module] = clear


def _take_turn(module: str) -> None:
    """Workers are used again by other operators: what those remember has to go."""
    for name, clear in _caches.items():
        if name != module:
            clear()
    pa.default_memory_pool().release_unused()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    The functions that run there keep caches in their modules, which outlive a task as long
    as the module is imported and not sent along with every task.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(haplospark.__file__).parent
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, str(Path(root.name) / source.relative_to(root)))
    folder = new_shared_folder(spark, "code")
    files, path = shared_file_system(folder)
    files.create_dir(path, recursive=True)
    with files.open_output_stream(f"{path}/haplospark.zip") as out:
        out.write(packed.getvalue())
    context.addPyFile(f"{folder}/haplospark.zip")
    _shipped.add(context.applicationId)


def map_batches(
    df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str
) -> DataFrame:
    """Apply a function of one Arrow batch to every batch of ``df``."""
    ship(df.sparkSession)

    module = function.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _take_turn(module)
        for batch in batches:
            yield function(batch)

    return df.mapInArrow(run, schema)


def map_partitions(
    df: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Apply a function of all batches of a partition, in order."""
    ship(df.sparkSession)

    module = function.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _take_turn(module)
        yield from function(batches)

    return df.mapInArrow(run, schema)
