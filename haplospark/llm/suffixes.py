"""Removal of byte strings of ``LENGTH`` that occur more than once, by prefix-free parsing.

Texts are cut into phrases where a rolling hash over ``GRAM`` bytes is divisible by
``MODULUS``. A phrase runs from one trigger to the end of the next, so phrases overlap by a
trigger, no phrase is the start of another, and equal strings are cut alike.

1. Phrases are counted by name over all documents. A window (a string of ``LENGTH`` bytes)
   that holds a phrase which occurs once cannot repeat; all others are candidates.
2. Candidates lie in blocks, those with the same first trigger. Blocks are counted by a name
   of 128 bits for all their bytes: windows of a block that occurs again are repeated.
   What is left, blocks that occur once, is where repeated passages begin or end, and next to
   them. Only these are told back to their texts: all other candidates are repeated.
3. Blocks that occur once, and one of every repeated block with the same first phrase, meet
   by that phrase. There, ``corpus_order`` sorts their windows as a suffix array would: by the
   rank of the rest of the phrase that the window starts in (suffix array of the dictionary),
   then by the rank of what follows (suffix array of the parse), with the lengths of common
   prefixes of neighbours. A window that shares ``LENGTH`` bytes with a neighbour is repeated.
4. Windows without a whole phrase (in texts with hardly a trigger), and those at a first
   phrase with more than ``GROUP_ROWS`` such blocks, are counted by names of 128 bits each,
   added up before they are shuffled: no phrase gathers more rows in a task than that.

Texts are shuffled once, into buckets that later joins read in place. Otherwise names are
shuffled, 8 bytes for each phrase, and the bytes of the blocks of step 3. A document is one
value, and its repeats meet in one row.

Defined cases: a null text is empty; texts shorter than ``LENGTH`` have no windows; rows that
repeat a doc_id and text are occurrences of their own; equal documents go whole; an empty
table gives no rows; other columns than doc_id and text are not looked at.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplospark.llm.common import map_batches, map_partitions, new_shared_folder, short_batches
from haplospark.scratch import materialize, settle
from haplospark.sources.layout import write_bucketed

LENGTH = 400
GRAM, MODULUS = 16, 48
#: Most blocks of one first phrase that are sorted together, and bytes sorted at once.
GROUP_ROWS, CHUNK_BYTES = 4096, 4 << 20
_STEP = 1 << 21
#: Windows without a phrase that are compared with each other at once.
BARE = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_VALUES = np.array([xxhash.xxh64_intdigest(bytes([b]), 42) for b in range(256)], np.uint64)


def gram_hashes(raw: np.ndarray) -> np.ndarray:
    """The polynomial rolling hash of ``GRAM`` bytes at every place, by doubling."""
    hashes, width = _VALUES[raw], 1
    while width < GRAM:
        hashes = hashes[:-width] * np.uint64(pow(_BASE, width, 1 << 64)) + hashes[width:]
        width *= 2
    return hashes


def triggers(raw: np.ndarray) -> np.ndarray:
    """Places whose ``GRAM`` bytes are a trigger, in order."""
    found = []
    for at in range(0, len(raw) - GRAM + 1, _STEP):
        mixed = gram_hashes(raw[at : at + _STEP + GRAM - 1]) * np.uint64(_BASE) >> np.uint64(32)
        found.append(np.flatnonzero(mixed % np.uint64(MODULUS) == 0) + at)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def triggers_of(texts: list[bytes]) -> list[np.ndarray]:
    """The triggers within each text, all found at once."""
    stops = np.cumsum([len(t) for t in texts], dtype=np.int64)
    starts = stops - [len(t) for t in texts]
    places = triggers(np.frombuffer(b"".join(texts), np.uint8))
    cuts = np.searchsorted(places, stops)
    first = np.searchsorted(places, starts)
    found = []
    for k, start in enumerate(starts.tolist()):
        own = places[first[k] : cuts[k]] - start
        found.append(own[own + GRAM <= len(texts[k])])
    return found


def phrase_names(raw: bytes, at: np.ndarray) -> list[int]:
    """The 64-bit names of the phrases between triggers."""
    places = at.tolist()
    return [xxhash.xxh3_64_intdigest(raw[a : b + GRAM]) for a, b in zip(places, places[1:], strict=False)]


def candidates(size: int, at: np.ndarray, repeated: np.ndarray) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """Blocks (first phrase, first window, windows) and runs of windows without a phrase.

    ``repeated`` numbers the phrases that occur again.
    """
    windows, count = size - LENGTH + 1, len(at)
    if windows <= 0:
        return [], []
    phrases = max(count - 1, 0)
    # where windows start to hold a phrase as a whole, and the next phrase that occurs once
    whole = at[1:] + GRAM - LENGTH
    alone = np.ones(phrases + 1, bool)
    alone[repeated] = False
    until = np.append(whole, windows)
    until[:phrases][~alone[:phrases]] = windows
    until = np.minimum.accumulate(until[::-1])[::-1]  # limits grow along the text
    first = np.concatenate([[0], at + 1])[: count + 1]
    after = np.minimum(np.append(at + 1, windows), windows)
    blocks, bare = [], []
    low = np.maximum(first[:phrases], whole)
    high = np.minimum(after[:phrases], until[:phrases])
    for k in np.flatnonzero(high > low).tolist():
        blocks.append((k, int(low[k]), int(high[k] - low[k])))
    holds = np.append(whole, np.full(count + 1 - phrases, windows))
    free = np.minimum(after, holds)
    for k in np.flatnonzero(free > first).tolist():
        bare.append((int(first[k]), int(free[k] - first[k])))
    return blocks, bare


def suffix_ranks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ranks of all suffixes of the texts in one array, and where each text starts in it.

    Prefix doubling: ranks by the first byte, the first two, four, and so on. A suffix ends with
    its text, so equal suffixes of different texts have equal ranks.
    """
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    starts = np.cumsum(sizes) - sizes
    flat = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8).astype(np.int64) + 1
    ends = np.repeat(starts + sizes - 1, sizes)
    flat[starts + sizes - 1] = 0
    places, ranks, step = np.arange(len(flat)), flat, 1
    while step < sizes.max():
        both = ranks * (ranks.max() + 1) + ranks[np.minimum(places + step, ends)]
        ranks = np.unique(both, return_inverse=True)[1].reshape(-1)
        step *= 2
    return ranks, starts


def _common(a: bytes, b: bytes) -> int:
    """The length of the common prefix."""
    low, high = 0, min(len(a), len(b))
    if a[:high] == b[:high]:
        return high
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid)
    return low


class _Least:
    """Least values of ranges, from tables for ranges of 1, 2, 4, ... entries."""

    def __init__(self, values: np.ndarray):
        self.tables = [values]
        while 2 * (step := 1 << len(self.tables) - 1) <= len(values):
            last = self.tables[-1]
            self.tables.append(np.minimum(last[:-step], last[step:]))

    def between(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        level = np.frexp((stop - start).astype(np.float64))[1] - 1
        found = np.empty(len(start), np.int64)
        for k, table in enumerate(self.tables):
            mine = level == k
            found[mine] = np.minimum(table[start[mine]], table[stop[mine] - (1 << k)])
        return found


def corpus_order(texts: list[bytes], cuts: list[int], counts: list[int]) -> np.ndarray:
    """Which windows occur more than once; those of each text follow those of the one before.

    Text k has ``counts[k]`` windows, from its first byte on; its first trigger is at ``cuts[k]``,
    at or behind the last window's start.
    """
    heads = [t[: c + GRAM] for t, c in zip(texts, cuts, strict=True)]
    tails = [t[c:] for t, c in zip(texts, cuts, strict=True)]
    parse = []
    for tail, at in zip(tails, triggers_of(tails), strict=True):
        places = [*at.tolist(), len(tail)]
        parse.append([tail[a : b + GRAM] for a, b in zip(places, places[1:], strict=False)])
    dictionary = {p: k for k, p in enumerate(sorted({p for phrases in parse for p in phrases}))}
    ranked = [tuple(dictionary[p] for p in phrases) for phrases in parse]
    # suffix array of the parse: the texts behind the first trigger, and their common prefixes
    order = {r: k for k, r in enumerate(sorted(set(ranked)))}
    follows = np.array([order[r] for r in ranked], np.int64)
    text_of = dict(zip(ranked, tails, strict=True))
    sorted_tails = [text_of[r] for r in order]
    shared = np.array([0, *map(_common, sorted_tails, sorted_tails[1:])], np.int64)
    # suffix array of the dictionary: the phrases that windows start in
    distinct = {h: k for k, h in enumerate(dict.fromkeys(heads))}
    ranks, starts = suffix_ranks(list(distinct))
    number = np.array([distinct[h] for h in heads], np.int64)

    counted = np.array(counts, np.int64)
    row = np.repeat(np.arange(len(texts)), counted)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(counted) - counted, counted)
    suffix = ranks[starts[number[row]] + offset]
    behind = follows[row]
    needed = LENGTH - (np.array(cuts, np.int64)[row] - offset)
    # corpus order
    sequence = np.lexsort((behind, suffix))
    suffix, behind, needed = suffix[sequence], behind[sequence], needed[sequence]
    alike = np.flatnonzero(suffix[1:] == suffix[:-1])
    a, b = behind[alike], behind[alike + 1]
    reach = np.full(len(alike), LENGTH, np.int64)
    apart = np.flatnonzero(a < b)
    if len(apart):
        reach[apart] = _Least(shared).between(a[apart] + 1, b[apart] + 1)
    equal = alike[reach >= needed[alike]]
    found = np.zeros(len(row), bool)
    found[sequence[equal]] = True
    found[sequence[equal + 1]] = True
    return found


def _runs(flags: np.ndarray) -> Iterator[tuple[int, int]]:
    """Start and length of every run of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    for start, stop in edges.reshape(-1, 2).tolist():
        yield start, stop - start


_KEY = "k1 bigint, k2 bigint"


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.to_pylist()]


def _parsed(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Names of the phrases of each text; the columns are a key of two, the bytes and their copies."""
    texts = _texts(batch.column(2))
    names = [
        np.array(phrase_names(raw, at), np.uint64).view(np.int64) for raw, at in zip(texts, triggers_of(texts), strict=True)
    ]
    sizes = np.concatenate([[0], np.cumsum([len(n) for n in names])]).astype(np.int32)
    flat = np.concatenate(names) if names else np.zeros(0, np.int64)
    column = pa.ListArray.from_arrays(pa.array(sizes), pa.array(flat))
    return pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column(3), column], ["k1", "k2", "times", "names"])


def _two(digest: bytes) -> tuple[int, int]:
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _bare(raw: bytes, first: int, count: int, copies: int) -> Iterator[tuple]:
    """Rows for a run of windows without a phrase, those of periodic texts counted at once."""
    names = [xxhash.xxh3_128_digest(raw[k : k + LENGTH]) for k in range(first, first + count)]
    times = Counter(names)
    place = dict(zip(reversed(names), range(first + count - 1, first - 1, -1), strict=True))
    for name, n in times.items():
        yield None, *_two(name), place[name], 1, n * copies


def _cells(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Candidates: blocks with their first phrase, and windows without one, by name."""
    texts, rows, found = _texts(batch.column(2)), [], []
    copies, numbers = batch.column(3).to_pylist(), batch.column(4).to_pylist()
    for k, (raw, at, copy, repeated) in enumerate(zip(texts, triggers_of(texts), copies, numbers, strict=True)):
        blocks, bare = candidates(len(raw), at, np.array(repeated or [], np.int64))
        for phrase, start, count in blocks:
            name = xxhash.xxh3_64_intdigest(raw[at[phrase] : at[phrase + 1] + GRAM])
            name -= (name >> 63) << 64
            found.append((name, *_two(xxhash.xxh3_128_digest(raw[start : start + count - 1 + LENGTH])), start, count, copy))
        for first, count in bare:
            for start in range(first, first + count, BARE):
                found.extend(_bare(raw, start, min(BARE, first + count - start), copy))
        rows.extend([k] * (len(found) - len(rows)))
    columns = zip(*found, strict=True) if found else ((),) * 6
    kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.int64()]
    keys = batch.select([0, 1]).take(pa.array(rows, pa.int64())).columns
    names = ["k1", "k2", "phrase", "h1", "h2", "start", "count", "times"]
    return pa.RecordBatch.from_arrays([*keys, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names)


def _drawn(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Bytes of the wanted blocks; of those in large groups, the names of their windows."""
    texts, rows, found = _texts(batch.column(2)), [], []
    for k, (raw, at, wanted) in enumerate(zip(texts, triggers_of(texts), batch.column(3).to_pylist(), strict=True)):
        for cell in wanted:
            start, count, phrase = cell["start"], cell["count"], cell["phrase"]
            if cell["large"]:
                for place in range(start, start + count):
                    h1, h2 = _two(xxhash.xxh3_128_digest(raw[place : place + LENGTH]))
                    found.append((None, h1, h2, place, 1, cell["known"], None, None))
                    rows.append(k)
                continue
            cut = int(at[np.searchsorted(at, start)]) - start
            text = raw[start : start + count - 1 + LENGTH]
            found.append((phrase, None, None, start, count, cell["known"], cut, text))
            rows.append(k)
    columns = zip(*found, strict=True) if found else ((),) * 8
    kinds = [pa.int64()] * 3 + [pa.int32()] * 2 + [pa.bool_(), pa.int32(), pa.binary()]
    keys = batch.select([0, 1]).take(pa.array(rows, pa.int64())).columns
    names = ["k1", "k2", "phrase", "h1", "h2", "start", "count", "known", "cut", "bytes"]
    return pa.RecordBatch.from_arrays([*keys, *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))], names)


_MARKS = f"{_KEY}, start int, count int"


def _sorted_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of the blocks of a partition, which come in order of their phrase.

    Groups are gathered until they have ``CHUNK_BYTES``; a chunk ends with a group.
    """
    rows: list[tuple] = []
    held, last = 0, None

    def solved() -> pa.RecordBatch:
        k1, k2, places, counts, known, cuts, texts = zip(*rows, strict=True)
        flags, at, out = corpus_order(list(texts), list(cuts), list(counts)), 0, []
        for k, (place, old, count) in enumerate(zip(places, known, counts, strict=True)):
            if not old:
                out.extend((k1[k], k2[k], place + start, size) for start, size in _runs(flags[at : at + count]))
            at += count
        columns = zip(*out, strict=True) if out else ((),) * 4
        kinds = [pa.int64()] * 2 + [pa.int32()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["k1", "k2", "start", "count"]
        )

    for batch in batches:
        for phrase, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if phrase != last and held > CHUNK_BYTES:
                yield solved()
                rows, held = [], 0
            last = phrase
            rows.append(tuple(row))
            held += len(row[-1])
    if rows:
        yield solved()


def distinct_texts(documents: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``doc_id``, ``bytes`` and ``times``: every doc_id and text once, bucketed by key.

    Rows that repeat are added up before they are shuffled. All later joins with documents are
    by this key and leave the texts where they are.
    """
    text = F.coalesce(documents["text"], F.lit("")).cast("binary")
    rows = documents.select(documents["doc_id"].cast("bigint").alias("doc_id"), text.alias("bytes")).select(
        F.xxhash64("bytes").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "bytes").alias("k2"), "doc_id", "bytes"
    )
    once = rows.groupBy("k1", "k2").agg(
        F.first("doc_id").alias("doc_id"), F.first("bytes").alias("bytes"), F.count(F.lit(1)).alias("times")
    )
    return write_bucketed(once, new_shared_folder(documents.sparkSession, "texts"), ["k1", "k2"], True)


_CELL = ["k1", "k2", "phrase", "start", "count"]


def candidate_cells(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct blocks and windows without a phrase, with their ``times`` and one place each, and
    the ``repeated`` phrases of each text, which tell its candidates."""
    docs = texts.where(F.octet_length("bytes") >= LENGTH)
    parsed = materialize(
        map_batches(docs.select("k1", "k2", "bytes", "times"), _parsed, f"{_KEY}, times bigint, names array<bigint>"), "parsed"
    )
    phrases = parsed.select("times", F.explode("names").alias("name"))
    again = settle(phrases.groupBy("name").agg(F.sum("times").alias("n")).where("n > 1").select("name"), "again")
    numbered = parsed.select("k1", "k2", F.posexplode("names").alias("number", "name")).join(again, "name", "left_semi")
    repeated = _beside(numbered.groupBy("k1", "k2").agg(F.collect_set("number").alias("repeated")), "repeated")
    cells = map_batches(
        docs.join(repeated, ["k1", "k2"], "left").select("k1", "k2", "bytes", "times", "repeated"),
        _cells,
        f"{_KEY}, phrase bigint, h1 bigint, h2 bigint, start int, count int, times bigint",
    )
    # the first values of all columns are those of one row
    places = [F.first(c).alias(c) for c in _CELL]
    return materialize(cells.groupBy("h1", "h2").agg(F.sum("times").alias("times"), *places), "cells"), repeated


def repeats_of_single_blocks(texts: DataFrame, cells: DataFrame) -> DataFrame:
    """Runs of windows of blocks that occur once, which occur again in other blocks: ``k1`` and
    ``k2`` of the text, ``start`` and ``count``."""
    keys = ["k1", "k2"]
    blocks = cells.where(F.col("phrase").isNotNull()).withColumn("known", F.col("times") > 1)
    single = blocks.where("NOT known")
    open_phrases = settle(single.select("phrase").distinct(), "open")
    partners = blocks.where("known").join(open_phrases, "phrase", "left_semi")
    wanted = materialize(single.select(*_CELL, "known").unionByName(partners.select(*_CELL, "known")), "wanted")
    sizes = wanted.groupBy("phrase").agg(F.count(F.lit(1)).alias("n"))
    large = settle(sizes.where(F.col("n") > GROUP_ROWS).select("phrase", F.lit(True).alias("large")), "large")
    cell = F.struct("start", "count", "phrase", "known", F.coalesce("large", F.lit(False)).alias("large"))
    by_text = _beside(wanted.join(large, "phrase", "left").groupBy(*keys).agg(F.collect_list(cell).alias("wanted")), "by-text")
    drawn = materialize(
        map_batches(
            texts.join(by_text, keys).select(*keys, "bytes", "wanted"),
            _drawn,
            f"{_KEY}, phrase bigint, h1 bigint, h2 bigint, start int, count int, known boolean, cut int, bytes binary",
        ),
        "drawn",
    )
    groups = drawn.where(F.col("phrase").isNotNull()).repartition("phrase").sortWithinPartitions("phrase")
    ordered = map_partitions(groups.select("phrase", *keys, "start", "count", "known", "cut", "bytes"), _sorted_groups, _MARKS)
    windows = drawn.where(F.col("phrase").isNull()).select(*keys, "h1", "h2", "start", "known")
    twice = settle(windows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h1", "h2"), "twice")
    by_name = windows.where("NOT known").join(twice, ["h1", "h2"], "left_semi").select(*keys, "start", F.lit(1).alias("count"))
    return ordered.unionByName(by_name)


def _beside(side: DataFrame, label: str) -> DataFrame:
    """A written table to join with the texts, which are streamed past it unsorted."""
    return materialize(side, label).hint("shuffle_hash")


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The columns are doc_id, times, bytes, repeated phrases, and what is known of single cells.

    All candidates of a text occur again but those in single cells; of these, the marked runs do.
    """
    texts, spans, kept = _texts(batch.column(2)), [], []
    numbers, singles = batch.column(3).to_pylist(), batch.column(4).to_pylist()
    for raw, at, repeated, cells in zip(texts, triggers_of(texts), numbers, singles, strict=True):
        blocks, bare = candidates(len(raw), at, np.array(repeated or [], np.int64))
        again = np.zeros(max(len(raw) - LENGTH + 1, 0), bool)
        for start, count in [*((start, count) for _, start, count in blocks), *bare]:
            again[start : start + count] = True
        for cell in sorted(cells or [], key=lambda cell: cell["again"]):
            again[cell["start"] : cell["start"] + cell["count"]] = cell["again"]
        own: list[list[int]] = []
        for start, count in _runs(again):
            stop = start + count - 1 + LENGTH
            if own and start <= own[-1][1]:
                own[-1][1] = stop
            else:
                own.append([start, stop])
        edges = [0, *(e for span in own for e in span), len(raw)]
        spans.append([{"start": a, "stop": b} for a, b in own])
        kept.append(b"".join(raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    sizes = pa.array([len(t) for t in texts], pa.int64())
    columns = [batch.column(0), batch.column(1), sizes, pa.array(spans, kind), pa.array(kept, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "times", "n_bytes", "spans", "kept"])


def _cut_texts(documents: DataFrame) -> DataFrame:
    """What is left of every doc_id and text, and the ``times`` that these occur."""
    short_batches(documents.sparkSession)
    texts = distinct_texts(documents)
    cells, repeated = candidate_cells(texts)
    single = cells.where("times = 1").select("k1", "k2", "start", "count", F.lit(False).alias("again"))
    marks = repeats_of_single_blocks(texts, cells).withColumn("again", F.lit(True))
    told = single.unionByName(marks).groupBy("k1", "k2").agg(F.collect_list(F.struct("start", "count", "again")).alias("told"))
    return map_batches(
        texts.join(repeated, ["k1", "k2"], "left")
        .join(_beside(told, "told"), ["k1", "k2"], "left")
        .select("doc_id", "times", "bytes", "repeated", "told"),
        _cut,
        "doc_id bigint, times bigint, n_bytes bigint, spans array<struct<start: bigint, stop: bigint>>, kept binary",
    )


def _every_row(cut: DataFrame) -> DataFrame:
    """A row for each time that a doc_id and text occur."""
    return cut.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("_row", "times")


def without_repeated_strings(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, the removed ``spans`` (start, stop) and the ``kept`` bytes."""
    return _every_row(_cut_texts(documents))


def repeated_string_report(documents: DataFrame) -> DataFrame:
    """Per document: what went and a digest of what is left."""
    figures = _cut_texts(documents).select(
        "doc_id",
        "times",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
    return _every_row(figures)
