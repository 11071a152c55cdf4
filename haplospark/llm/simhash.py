"""SimHash fingerprints, linked through pivot distance tables.

Fingerprints are taken over 3-word shingles (the contract of this operator; repeats count).
Equal fingerprints are one class from the start, so links are sought between distinct
fingerprints only, each with its distances to 16 reference fingerprints. By the triangle
inequality two fingerprints within ``RADIUS`` bits differ by at most that in every distance:
pairs with a larger maximum coordinate difference are discarded, the others verified.

Distances alone give no key to join on, and all pairs are out of the question. Pairs are
therefore looked for among fingerprints that agree in two quarters of their bits: two
differing bits leave two of four quarters untouched, so no link is lost. A crowded cell is
cut into pieces, every two of which meet in a task of their own. What leaves a task is a
spanning forest of the links it found, never the pairs.

``keep_one_of_each`` has a rule of its own: texts are near copies whose sets of lower-case
five-word shingles have a Jaccard similarity of ``LEAST_SIMILAR`` or more. Candidates are
fingerprints of these sets within ``RADIUS`` bits, found as above, and sets that share one of
their rarest shingles, as many of each as two such sets cannot differ in. Of these, pairs whose
sizes or parities are too far apart for the similarity are discarded, which loses none. The
components of candidates are cut into pieces, and all pairs in each two pieces are verified by
their sets, those within ``WIDE_RADIUS`` bits first, unless texts in between already link them.

Defined cases: a null or empty text, or one of white space only, has fingerprint zero and
links like any other; fewer than three words make one shingle; a null doc_id takes part,
but never names a component unless all ids in it are null; repeated rows each give a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import chain, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haplospark.llm.common import map_batches, map_partitions
from haplospark.llm.components import connected_components
from haplospark.scratch import materialize, settle

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 2
PIVOTS = 16
#: Most fingerprints of a cell that are compared at once.
PIECE = 4096
#: The near copies of ``keep_one_of_each``.
COPY_WORDS = 5
LEAST_SIMILAR = 0.8
WIDE_RADIUS = 20
#: The same similarity in whole numbers.
_PART, _WHOLE = Fraction(LEAST_SIMILAR).limit_denominator(1000).as_integer_ratio()
#: Shingles are counted by this many leading bits of their hashes, in so many slices, to tell rare ones.
COUNT_BITS, COUNT_SLICES = 18, 64
#: Most bits of a set's parity.
MOST_PARITY = 1 << 16
#: Most sets of a candidate component that one of its pieces has.
SETS = 256
_SLICE = 128
Forest = Callable[[np.ndarray, np.ndarray], Iterator[tuple[int, int]]]
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def pivots(count: int = PIVOTS) -> list[int]:
    """Reference fingerprints, as signed 64-bit integers: hashes of their numbers."""
    return [
        int(np.uint64(xxhash.xxh64_intdigest(str(k).encode(), seed=SEED)).astype(np.int64))
        for k in range(count)
    ]


def shingles(text: bytes, words: int = SHINGLE_WORDS) -> list[bytes]:
    """Lower-case shingles of a UTF-8 text; the white space of words is ASCII only."""
    found = text.translate(_LOWER).split()
    if len(found) <= words:
        return [b" ".join(found)] if found else []
    return [b" ".join(found[k : k + words]) for k in range(len(found) - words + 1)]


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint, unsigned; bit k is set if over half the hashes have it."""
    hashes = [xxhash.xxh64_intdigest(s, SEED) for s in shingles(text)]
    counts, half = np.zeros(64, np.int64), len(hashes) / 2
    for at in range(0, len(hashes), 8192):
        piece = np.array(hashes[at : at + 8192], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts > half, bitorder="little").tobytes(), "little")


def _fingerprints(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts = batch.column(batch.num_columns - 1)
    found = np.array([fingerprint(t.as_py() or b"") for t in texts], np.uint64)
    columns = [*batch.columns[:-1], pa.array(found.view(np.int64))]
    return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "_fp"])


def fingerprints(documents: DataFrame, *keep: Column) -> DataFrame:
    """The kept columns and ``_fp``, the fingerprint as a signed 64-bit integer."""
    narrow = documents.select(*keep, F.col("text").cast("binary").alias("_bytes"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:-1])
    return map_batches(narrow, _fingerprints, f"{schema}, _fp bigint")


def _with_distances(distinct: DataFrame, *keep: str) -> DataFrame:
    """Distances to the pivots, eight to an integer, after the columns to keep."""
    def packed(some: list[int]) -> Column:
        total = F.lit(0).cast("long")
        for k, pivot in enumerate(some):
            apart = F.bit_count(F.col("_fp").bitwiseXOR(F.lit(pivot)))
            total = total.bitwiseOR(F.shiftleft(apart.cast("long"), 8 * k))
        return total

    refs = pivots()
    return distinct.select(*keep, "_fp", packed(refs[:8]).alias("_d0"), packed(refs[8:]).alias("_d1"))


def _cells(table: DataFrame) -> DataFrame:
    """Each fingerprint in the six cells given by two quarters of its bits."""
    masks = []
    for quarters in combinations(range(4), 2):
        mask = sum(0xFFFF << (16 * q) for q in quarters)
        masks.append(mask - (1 << 64) if mask >> 63 else mask)
    keys = F.array(
        *[
            F.struct(F.lit(k).cast("byte").alias("kind"), F.col("_fp").bitwiseAND(F.lit(m)).alias("part"))
            for k, m in enumerate(masks)
        ]
    )
    return table.select("*", F.explode(keys).alias("_cell")).select("_fp", "_d0", "_d1", "_cell.*")


def _meetings(own: Column, pieces: Column) -> Column:
    """The pairs ``a``, ``b`` of pieces of a group in which a row of piece ``own`` takes part."""
    return F.transform(
        F.sequence(F.lit(0), pieces - 1),
        lambda other: F.struct(F.least(own, other).alias("a"), F.greatest(own, other).alias("b")),
    )


def _in_pieces(cells: DataFrame, piece: int) -> DataFrame:
    """Adds ``a`` and ``b``: the two pieces of the cell that meet, 0 and 0 if it is not cut."""
    crowded = settle(
        cells.groupBy("kind", "part").count().where(F.col("count") > piece), "crowded"
    ).withColumn("_pieces", F.ceil(F.col("count") / piece).cast("int"))
    joined = cells.join(crowded, ["kind", "part"], "left")
    own = F.pmod(F.xxhash64("_fp"), F.col("_pieces")).cast("int")
    meets = _meetings(own, F.col("_pieces"))
    alone = F.array(F.struct(F.lit(0).alias("a"), F.lit(0).alias("b")))
    return joined.select(
        "kind", "part", "_fp", "_d0", "_d1", F.explode(F.coalesce(meets, alone)).alias("_meet")
    ).select("kind", "part", "_meet.*", "_fp", "_d0", "_d1")


def links_within(fps: np.ndarray, distances: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints, as positions.

    Rows are taken in order of their first distance; a slice meets only the rows after it
    whose first distance is near enough.
    """
    order = np.argsort(distances[:, 0], kind="stable")
    first = distances[order, 0].astype(np.int64)
    parent = list(range(len(fps)))

    def root(k: int) -> int:
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for at in range(0, len(order), _SLICE):
        rows = order[at : at + _SLICE]
        stop = int(np.searchsorted(first, first[at + len(rows) - 1] + radius, "right"))
        others = order[at:stop]
        near = np.ones((len(rows), len(others)), bool)
        for pivot in range(distances.shape[1]):
            apart = distances[rows, pivot][:, None] - distances[others, pivot][None, :]
            near &= np.abs(apart) <= radius
        a, b = np.nonzero(near)
        a, b = rows[a], others[b]
        linked = (a != b) & (np.bitwise_count(fps[a] ^ fps[b]) <= radius)
        for x, y in zip(a[linked].tolist(), b[linked].tolist(), strict=True):
            rx, ry = root(x), root(y)
            if rx != ry:
                parent[rx] = ry
                yield x, y


def _linked(batches: Iterator[pa.RecordBatch], forest: Forest = links_within) -> Iterator[pa.RecordBatch]:
    """Links within each run of equal (kind, part, a, b); runs may span batches."""
    held: list[np.ndarray] = []

    def solved(blocks: list[np.ndarray]) -> pa.RecordBatch | None:
        rows = np.concatenate(blocks)
        fps = rows[:, 4].astype(np.uint64)
        distances = np.ascontiguousarray(rows[:, 5:7]).view(np.uint8).astype(np.int16)
        found = list(forest(fps, distances))
        if not found:
            return None
        pairs = rows[np.array(found), 4]
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    for batch in batches:
        rows = np.stack(
            [c.cast(pa.int64()).to_numpy(zero_copy_only=False) for c in batch.columns], axis=1
        )
        if not len(rows):
            continue
        starts = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(axis=1)) + 1
        edges = [0, *starts.tolist(), len(rows)]
        if held and (held[0][0, :4] != rows[0, :4]).any():
            if sum(map(len, held)) > 1 and (out := solved(held)):
                yield out
            held = []
        for start, stop in zip(edges[:-2], edges[1:-1], strict=True):
            if stop - start + sum(map(len, held)) > 1 and (out := solved([*held, rows[start:stop]])):
                yield out
            held = []
        held.append(rows[edges[-2] :])
    if held and sum(map(len, held)) > 1 and (out := solved(held)):
        yield out


def fingerprint_links(distinct: DataFrame, piece: int = PIECE) -> DataFrame:
    """Links (u, v) that connect all distinct fingerprints within ``RADIUS`` of each other."""
    cells = _in_pieces(_cells(_with_distances(distinct)), piece)
    keys = ["kind", "part", "a", "b"]
    runs = cells.repartition(*keys).sortWithinPartitions(*keys, "_fp")
    return map_partitions(runs, _linked, "u bigint, v bigint")


def near_duplicates(marked: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """``_fp``, and the smallest id of its component, from a table with ids and ``_fp``."""
    classes = materialize(
        marked.groupBy("_fp").agg(F.min(id_column).alias("_least")), "fingerprints"
    )
    roots = materialize(connected_components(fingerprint_links(classes)), "components")
    named = classes.join(roots, classes["_fp"] == roots["node"], "left").select(
        "_fp", F.coalesce("root", "_fp").alias("_root"), "_least"
    )
    least = named.groupBy("_root").agg(F.min("_least").alias("component_id"))
    return named.join(least, "_root").select("_fp", "component_id")


def simhash_components(documents: DataFrame) -> DataFrame:
    """Per document: its fingerprint in hex, and the smallest doc_id of its component."""
    marked = materialize(fingerprints(documents, F.col("doc_id")), "marked")
    return marked.join(near_duplicates(marked), "_fp").select(
        "doc_id",
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def shingle_set(text: bytes) -> np.ndarray:
    """The hashes of a text's five-word shingles, each once, in order."""
    return np.unique(np.array([xxhash.xxh64_intdigest(g, SEED) for g in shingles(text, COPY_WORDS)], np.uint64))


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sets in order have a Jaccard similarity of ``LEAST_SIMILAR`` or more."""
    if min(len(a), len(b)) < LEAST_SIMILAR * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both >= LEAST_SIMILAR * (len(a) + len(b) - both)


def shingle_counts(texts: DataFrame) -> np.ndarray:
    """How common shingles are, as bytes on a scale of logarithms by the leading bits of their hashes.

    It sets an order of shingles alone: which one does not change what is found.
    """
    width = (1 << COUNT_BITS) // COUNT_SLICES

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, held = np.zeros(1 << COUNT_BITS, np.int64), []

        def add() -> None:
            leading = np.concatenate([np.zeros(0, np.int64), *held])
            np.add(counts, np.bincount(leading, minlength=len(counts)), out=counts)
            held.clear()

        for batch in batches:
            for text in batch.column(0):
                held.append((shingle_set(text.as_py() or b"") >> np.uint64(64 - COUNT_BITS)).astype(np.int64))
                if len(held) == 1000:
                    add()
        add()
        parts = [counts[k * width : (k + 1) * width].tobytes() for k in range(COUNT_SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(COUNT_SLICES), pa.int32()), pa.array(parts, pa.binary())], ["slice", "counts"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                totals[k] = totals.get(k, 0) + np.frombuffer(part, np.int64)
        columns = [pa.array(totals.keys(), pa.int32()), pa.array([t.tobytes() for t in totals.values()], pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, ["slice", "counts"])

    schema = "slice int, counts binary"
    slices = map_partitions(map_partitions(texts, counted, schema).repartition("slice"), summed, schema).collect()
    found = np.zeros((COUNT_SLICES, width), np.int64)
    for row in slices:
        found[row["slice"]] = np.frombuffer(row["counts"], np.int64)
    return np.minimum(np.log2(found.ravel() + 1) * 8, 255).astype(np.uint8)


def rarest(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The rarest shingles of a set, in one order for all sets.

    A similar set has all but a few of this set's shingles, so it has one of these; and where both
    are cut in the same order, one is among the rarest of both.
    """
    few = len(hashes) + 1 + -len(hashes) * _PART // _WHOLE if len(hashes) else 0
    order = np.argsort(counts[hashes >> np.uint64(64 - COUNT_BITS)], kind="stable")
    return hashes[order[:few]].view(np.int64)


def parity(hashes: np.ndarray) -> bytes:
    """Whether an odd number of hashes ends in each number: bits for about as many as there are hashes.

    Every hash that one of two sets has alone changes one bit, so two parities differ in no
    more bits than the sets in hashes.
    """
    width = min(max(64, 1 << max(len(hashes) - 1, 0).bit_length()), MOST_PARITY)
    odd = np.bincount((hashes & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _set_fingerprint(hashes: np.ndarray) -> int:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 8192):
        piece = hashes[at : at + 8192].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def _signed(batch: pa.RecordBatch, counts: np.ndarray) -> pa.RecordBatch:
    fps, whole, sizes, parities, few = [], [], [], [], []
    for text in batch.column(batch.num_columns - 1):
        hashes = shingle_set(text.as_py() or b"")
        fps.append(_set_fingerprint(hashes))
        whole.append(xxhash.xxh64_intdigest(hashes.tobytes(), SEED))
        sizes.append(len(hashes))
        parities.append(parity(hashes))
        few.append(rarest(hashes, counts))
    both = [pa.array(np.array(c, np.uint64).view(np.int64)) for c in (fps, whole)]
    others = [pa.array(sizes, pa.int32()), pa.array(parities, pa.binary()), pa.array(few, pa.list_(pa.int64()))]
    columns = [*batch.columns[:-1], *both, *others]
    return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "_fp", "_set", "_size", "_parity", "_rarest"])


def _sets(batch: pa.RecordBatch) -> pa.RecordBatch:
    found = [shingle_set(t.as_py() or b"").tobytes() for t in batch.column(batch.num_columns - 1)]
    columns = [*batch.columns[:-1], pa.array(found, pa.binary())]
    return pa.RecordBatch.from_arrays(columns, [*batch.schema.names[:-1], "_hashes"])


def _forest(count: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[tuple[int, int]]:
    """A spanning forest over rows; ``near`` says which of the given earlier rows link to a row.

    It is asked in short runs, and never for rows that are linked already.
    """
    label, run = np.arange(count), 256
    for k in range(1, count):
        at = 0
        while at < k:
            others = np.arange(at, min(k, at + run))
            others = others[label[others] != label[k]]
            for other in others[near(k, others)].tolist() if len(others) else ():
                if label[other] != label[k]:
                    label[label == label[other]] = label[k]
                    yield k, other
            at += run


def wide_links(fps: np.ndarray, distances: np.ndarray) -> Iterator[tuple[int, int]]:
    """A spanning forest of the fingerprints within ``WIDE_RADIUS``, after the pivots' filter."""

    def near(k: int, others: np.ndarray) -> np.ndarray:
        close = (np.abs(distances[others] - distances[k]) <= WIDE_RADIUS).all(axis=1)
        return close & (np.bitwise_count(fps[others] ^ fps[k]) <= WIDE_RADIUS)

    return _forest(len(fps), near)


def close_sets(sizes: list[int], parities: list[bytes]) -> Iterator[tuple[int, int]]:
    """A spanning forest of the sets whose sizes and parities do not rule their similarity out."""
    order = sorted(range(len(sizes)), key=sizes.__getitem__)
    bits = [(8 * len(p), int.from_bytes(p, "little")) for p in parities]
    label = list(range(len(sizes)))

    def root(k: int) -> int:
        while label[k] != k:
            label[k] = label[label[k]]
            k = label[k]
        return k

    def apart(a: int, b: int) -> int:
        (wa, x), (wb, y) = bits[a], bits[b]
        while wa > wb:  # the upper half of the numbers goes to the lower one
            wa //= 2
            x = (x >> wa) ^ (x & ((1 << wa) - 1))
        while wb > wa:
            wb //= 2
            y = (y >> wb) ^ (y & ((1 << wb) - 1))
        return (x ^ y).bit_count()

    least = 0
    for at, k in enumerate(order):
        while sizes[order[least]] * _WHOLE < sizes[k] * _PART:
            least += 1
        for other in order[least:at]:
            a, b = root(k), root(other)
            if a != b and apart(k, other) * (_WHOLE + _PART) <= (sizes[k] + sizes[other]) * (_WHOLE - _PART):
                label[a] = b
                yield k, other


def _close_linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of close sets within each run of equal (part, a, b); runs may span batches."""
    run, fps, sizes, parities, found = None, [], [], [], []

    def told() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.int64()) for k in (0, 1)], ["u", "v"])

    def solved() -> None:
        if len(fps) > 1:
            found.extend((fps[x], fps[y]) for x, y in close_sets(sizes, parities) if fps[x] != fps[y])

    for batch in batches:
        for *key, fp, size, odd in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != run:
                solved()
                run, fps, sizes, parities = key, [], [], []
            fps.append(fp)
            sizes.append(size)
            parities.append(odd)
        if found:
            yield told()
            found.clear()
    solved()
    yield told()


def rare_links(signed: DataFrame) -> DataFrame:
    """Links (u, v) of fingerprints whose sets share one of their rarest shingles and are close.

    They connect every two sets at ``LEAST_SIMILAR``. Shingles that one set alone has are dropped
    first; a crowded one is cut into pieces, every two of which meet.
    """
    distinct = materialize(signed.drop("_key", "_node").dropDuplicates(["_fp", "_set"]), "distinct")
    cells = distinct.select("_fp", "_set", F.explode("_rarest").alias("part"))
    sharing = F.count(F.lit(1)).over(Window.partitionBy("part"))
    shared = materialize(cells.withColumn("_sharing", sharing).where("_sharing > 1"), "shared")
    pieces = F.ceil(F.col("_sharing") / PIECE).cast("int")
    own = F.pmod(F.xxhash64("_set"), pieces).cast("int")
    whole = shared.join(distinct.select("_fp", "_set", "_size", "_parity"), ["_fp", "_set"])
    met = whole.select("part", F.explode(_meetings(own, pieces)).alias("_meet"), "_set", "_fp", "_size", "_parity")
    keys = ["part", "a", "b"]
    runs = met.select("part", "_meet.*", "_set", "_fp", "_size", "_parity").repartition(*keys)
    ordered = runs.sortWithinPartitions(*keys, "_set").drop("_set")
    return map_partitions(ordered, _close_linked, "u bigint, v bigint").distinct()


def similar_links(sets: list[np.ndarray], first: Iterator[tuple[int, int]] = ()) -> Iterator[tuple[int, int]]:
    """A spanning forest of the similar sets; ``first`` are pairs to look at before the others."""
    label = list(range(len(sets)))

    def root(k: int) -> int:
        while label[k] != k:
            label[k] = label[label[k]]
            k = label[k]
        return k

    for k, other in chain(first, ((k, other) for k in range(1, len(sets)) for other in range(k))):
        a, b = root(k), root(other)
        if a != b and similar(sets[k], sets[other]):
            label[a] = b
            yield k, other


def _likely_pairs(fps: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs that connect fingerprints within ``WIDE_RADIUS``."""
    prints = np.array(fps, np.uint64)
    refs = np.array(pivots()).astype(np.uint64)
    return wide_links(prints, np.bitwise_count(prints[:, None] ^ refs[None, :]).astype(np.int16))


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of similar sets within each run of equal (_root, a, b); runs may span batches."""
    run, nodes, sets = None, [], []

    def solved() -> pa.RecordBatch:
        fps = [int(node.partition("-")[0], 16) for node in nodes]
        found = [(nodes[x], nodes[y]) for x, y in similar_links(sets, _likely_pairs(fps))]
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in found], pa.string()) for k in (0, 1)], ["u", "v"])

    for batch in batches:
        for *key, node, hashes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if key != run:
                if len(sets) > 1:
                    yield solved()
                run, nodes, sets = key, [], []
            nodes.append(node)
            sets.append(np.frombuffer(hashes, np.uint64))
    if len(sets) > 1:
        yield solved()


def similar_links_of(documents: DataFrame, key: Column, signed: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """Verified links (u, v) of nodes, the distinct sets of ``signed``.

    Candidates are fingerprints within ``RADIUS``, found by the method of ``near_duplicates``, and those
    that ``others`` links.
    """
    links = fingerprint_links(materialize(signed.select("_fp").distinct(), "fingerprints"))
    if others is not None:
        links = links.unionByName(others)
    roots = materialize(connected_components(links), "candidates")
    nodes = signed.groupBy("_node", "_fp").agg(F.min("_key").alias("_key"))
    rooted = materialize(
        nodes.join(roots, nodes["_fp"] == roots["node"], "left").select(
            "_node", "_key", F.coalesce("root", "_fp").alias("_root")
        ),
        "rooted",
    )
    groups = settle(rooted.groupBy("_root").agg(F.count(F.lit(1)).alias("_count")).where("_count > 1"), "groups")
    pieces = F.ceil(F.col("_count") / SETS).cast("int")
    own = F.pmod(F.xxhash64("_node"), pieces).cast("int")
    wanted = settle(rooted.join(groups, "_root").select("_key", "_node", "_root", pieces.alias("_pieces"), own.alias("_own")), "wanted")
    texts = documents.select(key.alias("_key"), F.col("text").cast("binary").alias("_bytes"))
    fields = "_root bigint, _pieces int, _own int, _node string, _hashes binary"
    sets = materialize(
        map_batches(
            texts.join(wanted, "_key").select("_root", "_pieces", "_own", "_node", "_bytes"), _sets, fields
        ).dropDuplicates(["_node"]),
        "sets",
    )
    meets = _meetings(F.col("_own"), F.col("_pieces"))
    met = sets.select("_root", F.explode(meets).alias("_meet"), "_node", "_hashes").select(
        "_root", "_meet.*", "_node", "_hashes"
    )
    ordered = met.repartition("_root", "a", "b").sortWithinPartitions("_root", "a", "b", "_node")
    return map_partitions(ordered, _verified, "u string, v string")


def keep_one_of_each(documents: DataFrame) -> DataFrame:
    """The documents with one of each component of near copies: that with the smallest doc_id.

    Rows that repeat a doc_id and text are copies too, and one of them stays. Where several
    texts share the smallest doc_id, that with the smallest hash stays.
    """
    hashed = F.xxhash64(F.coalesce(documents["text"], F.lit("")))
    key = F.struct(
        documents["doc_id"].isNull().alias("none"), documents["doc_id"].alias("id"), hashed.alias("hash")
    )
    narrow = documents.select(key.alias("_key"), F.col("text").cast("binary").alias("_bytes"))
    kind = narrow.schema["_key"].dataType.simpleString()
    counts = shingle_counts(narrow.select("_bytes"))

    def sign(batch: pa.RecordBatch) -> pa.RecordBatch:
        return _signed(batch, counts)

    schema = f"_key {kind}, _fp bigint, _set bigint, _size int, _parity binary, _rarest array<bigint>"
    found = map_batches(narrow, sign, schema)
    marked = materialize(found.withColumn("_node", F.concat(F.hex("_fp"), F.lit("-"), F.hex("_set"))), "signed")
    roots = materialize(connected_components(similar_links_of(documents, key, marked, rare_links(marked))), "components")
    named = marked.select("_key", "_node").join(roots, marked["_node"] == roots["node"], "left").select(
        "_key", F.coalesce("root", "_node").alias("_root")
    )
    least = named.groupBy("_root").agg(F.min("_key").alias("_least"))
    others = named.join(least, "_root").where("_key <> _least")
    losers = settle(others.select("_key.id", "_key.hash").distinct(), "losers")
    same = documents["doc_id"].eqNullSafe(losers["id"]) & (hashed == losers["hash"])
    kept = documents.join(losers, same, "left_anti")
    if marked.groupBy("_key").count().where("count > 1").isEmpty():
        return kept
    # names by place cannot clash with the one that is added
    names = {c: f"c{k}" for k, c in enumerate(documents.columns)}
    plain = kept.toDF(*names.values())
    hashed = plain.withColumn("_hash", F.xxhash64(F.coalesce(names["text"], F.lit(""))))
    return hashed.dropDuplicates([names["doc_id"], "_hash"]).drop("_hash").toDF(*documents.columns)
