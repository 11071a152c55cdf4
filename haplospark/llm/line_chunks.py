"""Removal of multi-line passages that occur elsewhere, by content-defined chunks of lines.

The lines of a text that have words are hashed, and a rolling hash over the last ``REACH`` line
hashes says where a chunk ends: wherever it is not divisible by ``DIVISOR``, after ``MOST_LINES``
lines at the latest, and on either side of a line of more than ``LONG_WORDS`` words. Boundaries
depend on nearby lines alone, so inserted or missing lines shift none beyond their surroundings,
and they are dense, so that a passage of few lines holds a whole chunk.

Chunks are counted over all documents. Of one that occurs again, the first occurrence stays: in
the smallest doc_id (null last), then text hash, then place. Every other is a seed, after its
bytes were compared: chunks are grouped by their whole text as well as by hash. A seed grows
line by line both ways, as long as the lines are those around the first occurrence, by up to
``MOST_LINES`` each way: a passage's outermost whole chunk is no further from its ends. What has
grown to two lines, or is one long line, is a repeat. Runs of repeats go if they have
``LEAST_WORDS`` words; a text without a line that is left is emptied.

Three passes over the documents: hashes of chunks, texts of the repeated ones with the hashes (64
bits) of the lines around them, and removal. Only hashes of all chunks and texts of repeated ones
are shuffled; counts and first places are combined before they are.

Defined cases: a null text stays null; blank lines are not compared, and go within repeats only
or where nothing else is left; rows that repeat a doc_id and text are treated alike and, where
they are first, both keep it; columns may have any names; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplospark.llm.common import map_batches, short_batches
from haplospark.scratch import materialize, settle

REACH = 2
DIVISOR = 8
MOST_LINES = 8
LONG_WORDS = 50
LEAST_WORDS = 10
#: Most bytes of first occurrences that are broadcast.
FIRSTS_BYTES = 8 << 20
_BASE, _MASK = 0x9E3779B97F4A7C15, (1 << 64) - 1
_DIGEST = 8


def boundaries(hashes: list[int], long: list[bool]) -> list[int]:
    """Numbers of lines at which chunks end (exclusive), the last included.

    The rolling hash is a polynomial over the last ``REACH`` line hashes: a new line is
    added after a multiplication, and the line that leaves is taken off again.
    """
    ends, rolled, leaving = [], 0, pow(_BASE, REACH, 1 << 64)
    for k, h in enumerate(hashes):
        rolled = (rolled * _BASE + h) & _MASK
        if k >= REACH:
            rolled = (rolled - hashes[k - REACH] * leaving) & _MASK
        if long[k] and k and (not ends or ends[-1] != k):
            ends.append(k)
        start = ends[-1] if ends else 0
        if long[k] or (rolled >> 32) % DIVISOR or k + 1 - start >= MOST_LINES:
            ends.append(k + 1)
    if hashes and (not ends or ends[-1] != len(hashes)):
        ends.append(len(hashes))
    return ends


class Lines:
    """The lines of a text that have words, and their chunks."""

    def __init__(self, raw: bytes):
        self.all = raw.split(b"\n")
        counts = [len(line.split()) for line in self.all]
        self.places = [k for k, n in enumerate(counts) if n]
        self.full = [self.all[k] for k in self.places]
        self.words = [counts[k] for k in self.places]
        self.ends = boundaries([xxhash.xxh3_64_intdigest(line) for line in self.full], [n > LONG_WORDS for n in self.words])

    def chunks(self) -> list[tuple[int, int]]:
        """First line and line after the last, among those with words."""
        return list(zip([0, *self.ends[:-1]], self.ends, strict=False))

    def text(self, start: int, stop: int) -> bytes:
        return b"\n".join(self.full[start:stop])

    def around(self, start: int, stop: int) -> tuple[bytes, bytes]:
        """Hashes of the lines before, the nearest first, and of those behind."""
        before = self.full[max(start - MOST_LINES, 0) : start][::-1]
        behind = self.full[stop : stop + MOST_LINES]
        return b"".join(map(xxhash.xxh3_64_digest, before)), b"".join(map(xxhash.xxh3_64_digest, behind))

    def without(self, repeats: list[tuple[int, int]]) -> tuple[bytes, int]:
        """The text without runs of the given repeats, and how many lines went."""
        covered = [False] * (len(self.full) + 1)
        for low, high in repeats:
            if high - low > 1 or self.words[low] > LONG_WORDS:
                covered[low:high] = [True] * (high - low)
        gone, start = set(), 0
        for k, inside in enumerate(covered):
            if inside:
                continue
            if sum(self.words[start:k]) >= LEAST_WORDS:
                gone.update(range(self.places[start], self.places[k - 1] + 1))
            start = k + 1
        if not gone:
            return b"\n".join(self.all), 0
        kept = [line for k, line in enumerate(self.all) if k not in gone]
        if not any(line.split() for line in kept):
            return b"", len(self.all)
        return b"\n".join(kept), len(gone)


def _hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row per chunk: its document's key, 128 bits of hash, its place."""
    rows, hashes, places = [], [], []
    for k, text in enumerate(batch.column(1)):
        raw = text.as_py()
        if raw is None:
            continue
        lines = Lines(raw)
        for start, stop in lines.chunks():
            rows.append(k)
            hashes.append(xxhash.xxh3_128_digest(lines.text(start, stop)))
            places.append(start)
    keys = batch.column(0).take(pa.array(rows, pa.int64()))
    both = np.frombuffer(b"".join(hashes), "<i8").reshape(-1, 2)
    columns = [keys, pa.array(both[:, 0]), pa.array(both[:, 1]), pa.array(places, pa.int32())]
    return pa.RecordBatch.from_arrays(columns, ["_key", "h1", "h2", "place"])


def _texts(batch: pa.RecordBatch) -> pa.RecordBatch:
    """A row per wanted chunk with its text and the hashes around it."""
    rows, found = [], []
    for k, (raw, wanted) in enumerate(zip(batch.column(1), batch.column(2), strict=True)):
        lines, wanted = Lines(raw.as_py()), set(wanted.as_py())
        for start, stop in lines.chunks():
            if start in wanted:
                rows.append(k)
                found.append((start, stop - start, lines.text(start, stop), *lines.around(start, stop)))
    keys = batch.column(0).take(pa.array(rows, pa.int64()))
    columns = zip(*found, strict=True) if found else ((),) * 5
    kinds = [pa.int32()] * 2 + [pa.binary()] * 3
    return pa.RecordBatch.from_arrays(
        [keys, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], ["_key", "place", "lines", "chunk", "before", "behind"]
    )


def alike(a: bytes, b: bytes) -> int:
    """How many lines have equal hashes before the first that has not."""
    most = min(len(a), len(b)) // _DIGEST
    return next((k for k in range(most) if a[k * _DIGEST : (k + 1) * _DIGEST] != b[k * _DIGEST : (k + 1) * _DIGEST]), most)


def _grown(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Seeds with the lines next to them that are alike at the first occurrence: ``low`` and ``high``."""
    low, high = [], []
    for place, lines, before, behind, first_before, first_behind in zip(*(c.to_pylist() for c in batch.columns[1:]), strict=True):
        low.append(place - alike(before, first_before))
        high.append(place + lines + alike(behind, first_behind))
    return pa.RecordBatch.from_arrays(
        [batch.column(0), pa.array(low, pa.int32()), pa.array(high, pa.int32())], ["_key", "low", "high"]
    )


def _removed(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts, gone = [], []
    for raw, seeds in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1), strict=True):
        raw, seeds, n = raw.as_py(), seeds.as_py(), 0
        if raw is not None and seeds:
            raw, n = Lines(raw).without([(s["low"], s["high"]) for s in seeds])
        texts.append(raw)
        gone.append(n)
    columns = [*batch.columns[:-2], pa.array(texts, pa.binary()).cast(pa.string()), pa.array(gone, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-2], "_text", "_gone"])


def _key(doc_id: Column, text: Column) -> Column:
    """What tells documents apart and puts them in order."""
    return F.struct(doc_id.isNull().alias("none"), doc_id.cast("bigint").alias("id"), F.xxhash64(text).alias("hash"))


_KEY = "_key struct<none: boolean, id: bigint, hash: bigint>"


def seeds(documents: DataFrame) -> DataFrame:
    """``_key`` of the documents with repeated chunks, and ``_seeds``, the lines from ``low`` to ``high`` that these grew to."""
    narrow = documents.select(
        _key(documents["doc_id"], documents["text"]).alias("_key"), documents["text"].cast("binary").alias("_bytes")
    )
    hashes = materialize(map_batches(narrow, _hashed, f"{_KEY}, h1 bigint, h2 bigint, place int"), "chunks")
    repeated = settle(
        hashes.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n"), "repeated"
    )
    places = settle(
        hashes.join(repeated, ["h1", "h2"], "left_semi").groupBy("_key").agg(F.collect_set("place").alias("_wanted")),
        "places",
    )
    texts = materialize(
        map_batches(
            narrow.join(places, "_key").select("_key", "_bytes", "_wanted"),
            _texts,
            f"{_KEY}, place int, lines int, chunk binary, before binary, behind binary",
        ),
        "texts",
    )
    # written by itself, so that a join that shuffles can split a chunk that is everywhere
    firsts = settle(
        texts.groupBy("chunk")
        .agg(F.min(F.struct("_key", "place", "before", "behind")).alias("_first"), F.count(F.lit(1)).alias("_times"))
        .where("_times > 1"),
        "firsts",
        FIRSTS_BYTES,
    )
    other = (F.col("_key") != F.col("_first._key")) | (F.col("place") != F.col("_first.place"))
    around = [texts["before"], texts["behind"], F.col("_first.before").alias("b"), F.col("_first.behind").alias("e")]
    later = texts.join(firsts, "chunk").where(other).select("_key", "place", "lines", *around)
    grown = map_batches(later, _grown, f"{_KEY}, low int, high int")
    return settle(grown.groupBy("_key").agg(F.collect_set(F.struct("low", "high")).alias("_seeds")), "seeds")


def _cut(documents: DataFrame) -> tuple[DataFrame, list[Column]]:
    """Documents with names by place and ``_gone`` lines, and their columns under their own names."""
    short_batches(documents.sparkSession)
    names = {c: f"c{k}" for k, c in enumerate(documents.columns)}
    plain = documents.toDF(*names.values())
    text = plain[names["text"]]
    joined = plain.withColumn("_key", _key(plain[names["doc_id"]], text)).join(seeds(documents), "_key", "left")
    others = [f for f in plain.schema.fields if f.name != names["text"]]
    cut = map_batches(
        joined.select(*(f.name for f in others), F.col(names["text"]).cast("binary").alias("_bytes"), "_seeds"),
        _removed,
        "".join(f"{f.name} {f.dataType.simpleString()}, " for f in others) + "_text string, _gone bigint",
    )

    def column(name: str) -> Column:
        if name == "text":
            return F.col("_text")
        if name == "n_chars":
            kind = plain.schema[names[name]].dataType
            return F.coalesce(F.length("_text").cast(kind), F.col(names[name]))
        return F.col(names[name])

    return cut, [column(c).alias(c) for c in documents.columns]


def remove_repeats(documents: DataFrame) -> DataFrame:
    """Documents with ``text`` cut, ``n_chars`` (if there) counted anew, and ``_gone`` lines."""
    cut, columns = _cut(documents)
    return cut.select(*columns, "_gone")


def dedup_lines(documents: DataFrame) -> DataFrame:
    """The documents with repeated passages cut, with the columns they came with."""
    cut, columns = _cut(documents)
    return cut.select(*columns)


def line_dedup_report(documents: DataFrame) -> DataFrame:
    """Per document: doc_id, the text that stays, and how many lines went."""
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return remove_repeats(narrow).withColumnRenamed("_gone", "lines_removed")
