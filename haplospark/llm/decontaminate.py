"""Test items found in documents within an edit budget.

Texts are lower-cased and white space is collapsed. An item of n characters may be off by
``budget(n)`` edits; cut into one piece more than that, one piece at least must occur
unchanged. All pieces of a block of items form one Aho-Corasick automaton, which passes over
each text once; around every hit the item is compared by Myers' bit-parallel distance, in
the window where it must lie.

Items go to the executors in blocks of bounded size, one pass over the documents each, so
any number of items can be searched.

Defined cases: a null or blank text matches nothing, nor does an empty item; equal items
are each reported; null or repeated doc_ids each give their rows; no items, no matches.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplospark.llm.common import forgets, map_batches, ship, short_batches

#: Edits allowed for each so many characters of an item.
CHARS_PER_EDIT = 12
#: Most characters of items that are searched in one pass.
BLOCK_CHARS = 4 << 20


def normalize(text: str) -> str:
    return " ".join(text.lower().split())


def budget(length: int) -> int:
    return length // CHARS_PER_EDIT


def pieces(item: str) -> list[tuple[int, str]]:
    """One piece more than the item's budget, nearly equal, with their places."""
    count = budget(len(item)) + 1
    cuts = [len(item) * k // count for k in range(count + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


class Pattern:
    """An item for Myers' distance: bit k of a character's mask is set where it stands."""

    def __init__(self, item: str):
        self.size, self.budget = len(item), budget(len(item))
        self.masks: dict[str, int] = defaultdict(int)
        for k, char in enumerate(item):
            self.masks[char] |= 1 << k
        self.masks = dict(self.masks)

    def best(self, text: str) -> tuple[int, int]:
        """The least distance to a substring of ``text``, and where the first such one ends."""
        full, last = (1 << self.size) - 1, 1 << (self.size - 1)
        up, down, score = full, 0, self.size
        best, stop = score, 0
        find = self.masks.get
        for at, char in enumerate(text, 1):
            same = find(char, 0)
            vertical = same | down
            diagonal = (((same & up) + up) ^ up) | same
            rises = down | (full & ~(diagonal | up))
            falls = up & diagonal
            if rises & last:
                score += 1
            elif falls & last:
                score -= 1
                if score < best:
                    best, stop = score, at
            rises <<= 1
            falls <<= 1
            up = (falls | ~(vertical | rises)) & full
            down = rises & vertical & full
        return best, stop


class Searcher:
    """All items of a block."""

    def __init__(self, items: tuple[tuple[int, str], ...]):
        self.ids, self.items = [i for i, _ in items], [t for _, t in items]
        self.patterns = [Pattern(t) for t in self.items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, item in enumerate(self.items):
            for at, piece in pieces(item):
                places[piece].append((k, at))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()
        self.any = bool(places)

    def windows(self, text: str) -> dict[int, list[tuple[int, int]]]:
        """Per item, disjoint windows of the text that its hits allow."""
        found: dict[int, list[tuple[int, int]]] = {}
        for end, (size, where) in self.automaton.iter(text):
            begin = end + 1 - size
            for k, at in where:
                pattern = self.patterns[k]
                start = begin - at - pattern.budget
                stop = begin - at + pattern.size + pattern.budget
                found.setdefault(k, []).append((max(start, 0), min(stop, len(text))))
        for k, spans in found.items():
            spans.sort()
            joined = spans[:1]
            for start, stop in spans[1:]:
                if start <= joined[-1][1]:
                    joined[-1] = (joined[-1][0], max(stop, joined[-1][1]))
                else:
                    joined.append((start, stop))
            found[k] = joined
        return found

    def matches(self, text: str) -> Iterator[tuple[int | None, int, int]]:
        """Item id, least distance and end of the first best match, of items within budget."""
        if not self.any:
            return
        for k, spans in sorted(self.windows(text).items()):
            at = text.find(self.items[k])
            if at >= 0:
                yield self.ids[k], 0, at + self.patterns[k].size
                continue
            pattern = self.patterns[k]
            best = min((d, start + stop) for start, end in spans for d, stop in [pattern.best(text[start:end])])
            if best[0] <= pattern.budget:
                yield self.ids[k], *best


@lru_cache(maxsize=4)
def _searcher(items: tuple[tuple[int, str], ...]) -> Searcher:
    return Searcher(items)


forgets(__name__, _searcher.cache_clear)


def _blocks(benchmark: DataFrame, most: int) -> Iterator[tuple[tuple[int, str], ...]]:
    """Normalised items in blocks, fetched one partition at a time."""
    block, size = [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.coalesce("text", F.lit(""))).toLocalIterator():
        item = normalize(row[1])
        if not item:
            continue
        if block and size + len(item) > most:
            yield tuple(block)
            block, size = [], 0
        block.append((row[0], item))
        size += len(item)
    if block:
        yield tuple(block)


def find_matches(
    documents: DataFrame, benchmark: DataFrame, *keep: Column | str, block_chars: int = BLOCK_CHARS
) -> DataFrame:
    """A row per document and item within budget: the kept columns, item_id, distance,
    and ``stop``, the end of the first best match in the normalised text."""
    ship(documents.sparkSession)
    narrow = documents.select(*keep, F.col("text").alias("_text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in narrow.schema.fields[:-1])
    schema = f"{kept}item_id bigint, distance int, stop bigint"
    found = None
    for items in _blocks(benchmark, block_chars):
        part = map_batches(narrow, _matcher(items), schema)
        found = part if found is None else found.unionAll(part)
    if found is None:
        return narrow.sparkSession.createDataFrame([], schema)
    return found


def _matcher(items: tuple[tuple[int, str], ...]):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        searcher, rows, found = _searcher(items), [], []
        for k, text in enumerate(batch.column("_text")):
            for match in searcher.matches(normalize(text.as_py() or "")):
                rows.append(k)
                found.append(match)
        taken = batch.take(pa.array(rows, pa.int64()))
        ids, distances, stops = zip(*found, strict=True) if found else ((), (), ())
        return pa.RecordBatch.from_arrays(
            [*taken.columns[:-1], pa.array(ids, pa.int64()), pa.array(distances, pa.int32()), pa.array(stops, pa.int64())],
            [*taken.schema.names[:-1], "item_id", "distance", "stop"],
        )

    return run


def without_matches(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The documents in which no item is found, with the columns they came with."""
    short_batches(documents.sparkSession)
    names = [f"c{k}" for k in range(len(documents.columns))]
    clean = documents.toDF(*names)
    text = names[documents.columns.index("text")]
    for items in _blocks(benchmark, block_chars):
        clean = map_batches(clean, _filter(items, names.index(text)), clean.schema)
    return clean.toDF(*documents.columns)


def _filter(items: tuple[tuple[int, str], ...], column: int):
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        searcher = _searcher(items)
        clean = [
            next(searcher.matches(normalize(text.as_py() or "")), None) is None
            for text in batch.column(column)
        ]
        return batch.filter(pa.array(clean, pa.bool_()))

    return run
