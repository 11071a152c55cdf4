"""The trie of conversations: who shares which first turns, and what sharing saves.

A conversation is a path of turns, each named by 128 bits of the SHA-256 of its role and
text. Paths are sorted, equal ones by conversation, and cut into shards at splitters taken
from a sample. In this order a node, the conversations that start alike, is a run of rows.
A run that reaches over a border holds both neighbours of the splitter there, so its turns
are the splitter's first turns: the trie of the splitters' paths, the skeleton, is sent to
every task, and tells it which of its nodes may go on elsewhere. All other nodes are
finished where they are, from a stack of the open ones. Of skeleton nodes a shard hands on
what it has, which is added up per node; their subtrees are put together from the deepest
up, in one pass over as many rows as the skeleton has.

Bounds. A splitter keeps ``SPLITTER_TURNS`` turns of its path at most, so the skeleton has
no more than that times the number of shards; a splitter that was cut stands before all
paths that go on from it. Where shards are cut changes no result. The ids that end at a
node of several shards, in order, meet as text in one task that hashes it piece by piece, as
the hash asks for. A conversation's names (16 bytes and a length a turn) are one value (2 GB).

Defined cases: null roles and texts are empty; turns are ordered by number, nulls first,
equal numbers by the hash of role and text; a conversation without turns is a member of the
root alone; rows without conv_id belong to no conversation and are left out; other columns are not
looked at; an empty table has no node.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplospark.llm.common import map_batches, map_partitions
from haplospark.scratch import materialize, settle

#: Bytes of a turn's name, most turns of a splitter, sampled paths for each shard.
NAME, SPLITTER_TURNS, SAMPLED = 16, 256, 32
#: Bytes of ids that are handed on at once, and rows of a batch.
ENDS_BYTES, ROWS = 1 << 16, 4096
#: Conversations of a family share its first turns; most turns that are taken from there.
FAMILY, MOST_SHARED = 5, 8


def turn_names(conversations: DataFrame) -> DataFrame:
    """``conv_id`` and ``turns``, in order: turn, name, bytes of the text."""
    role, text = (F.coalesce(conversations[c].cast("string"), F.lit("")) for c in ("role", "text"))
    whole = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    name = F.unhex(F.substring(F.sha2(whole.cast("binary"), 256), 1, 2 * NAME))
    rows = conversations.where(conversations["conv_id"].isNotNull()).select(
        conversations["conv_id"].cast("bigint").alias("conv_id"),
        F.struct(
            conversations["turn"].cast("bigint").alias("turn"),
            name.alias("name"),
            F.octet_length(text).cast("bigint").alias("bytes"),
        ).alias("turn"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))


def paths_of(named: DataFrame) -> DataFrame:
    """``conv_id``, ``path`` (the names in one) and ``sizes`` of conversations with ``turns``."""
    digits = F.transform("turns", lambda turn: F.hex(turn["name"]))
    return named.select(
        "conv_id",
        F.unhex(F.array_join(digits, "")).alias("path"),
        F.transform("turns", lambda turn: turn["bytes"]).alias("sizes"),
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """The paths of conversations that start with turns of the first one of their family."""
    own = materialize(turn_names(conversations), "turns")
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, MOST_SHARED).alias("head")
    )
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % (MOST_SHARED + 1)).cast("int")
    joined = own.join(heads, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("first"), "left").select(
        "conv_id", "turns", F.coalesce("head", F.slice("turns", 1, 0)).alias("head"), shared.alias("h")
    )
    turns = F.concat(
        F.slice("head", F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))
    )
    return paths_of(joined.select("conv_id", turns.alias("turns")))


Splitter = tuple[bytes, int]


def splitters_of(paths: DataFrame, shards: int) -> list[Splitter]:
    """Up to ``shards`` - 1 borders from a sample by hash: a path, and the first id behind it."""
    most = NAME * SPLITTER_TURNS
    sample = (
        paths.orderBy(F.xxhash64("conv_id"), "conv_id")
        .select(
            F.substring("path", 1, most).alias("path"),
            # smaller than all ids: whatever goes on from a path that was cut lies behind it
            F.when(F.octet_length("path") > most, F.lit(-(1 << 63))).otherwise(F.col("conv_id")).alias("id"),
        )
        .limit(SAMPLED * shards)
        .collect()
    )
    ordered = sorted((bytes(r["path"]), r["id"]) for r in sample)
    chosen = {ordered[len(ordered) * k // shards] for k in range(1, shards)} if ordered else set()
    return sorted(chosen)


def shared_turns(a: bytes, b: bytes) -> int:
    """How many first turns two paths share."""
    most = min(len(a), len(b)) // NAME
    if a[: most * NAME] == b[: most * NAME]:
        return most
    low, high = 0, most  # the first ``low`` are equal, the first ``high`` are not
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if a[low * NAME : mid * NAME] == b[low * NAME : mid * NAME] else (low, mid)
    return low


_FIELDS = [
    ("kind", pa.int8()),
    ("key", pa.binary()),
    ("parent_key", pa.binary()),
    ("conv_id", pa.int64()),
    ("depth", pa.int64()),
    ("parent_conv_id", pa.int64()),
    ("n_convs", pa.int64()),
    ("n_children", pa.int64()),
    ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()),
    ("ends_sha256", pa.string()),
    ("last_bytes", pa.int64()),
    ("shard", pa.int32()),
    ("part", pa.int32()),
    ("ids", pa.binary()),
]
_SCHEMA = pa.schema(_FIELDS)
_DDL = (
    "kind tinyint, key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, ends_sha256 string, last_bytes bigint, shard int, part int, ids binary"
)
#: What a row of a shard is.
FINISHED, BELOW_SKELETON, PARTIAL, ENDS = range(4)


def _key(path: bytes, depth: int) -> bytes:
    return hashlib.sha256(path[: depth * NAME]).digest()[:NAME]


class _Node:
    """An open node of a shard's stack; sums are over what is closed below it."""

    __slots__ = ("bytes", "children", "convs", "ends", "ids", "key", "kept", "least", "leaves", "part", "saved", "waiting")

    def __init__(self, size: int, key: bytes | None):
        self.bytes, self.key = size, key
        self.convs = self.children = self.leaves = self.saved = self.part = self.kept = 0
        self.least: int | None = None
        self.ends = None if key else hashlib.sha256()
        self.ids: list[bytes] = []
        self.waiting: list[list] = []  # closed children, until the smallest member is known


class Shard:
    """Nodes of the paths of one shard, which come in order."""

    def __init__(self, number: int, borders: list[bytes]):
        self.number, self.borders = number, borders
        self.stack: list[_Node] = []
        self.path = b""
        self.rows: list[tuple] = []

    def add(self, conv_id: int, path: bytes, sizes: list[int]) -> None:
        turns = len(path) // NAME
        # a prefix of a border's path, the root at least, may go on in another shard
        deepest = max((shared_turns(path, border) for border in self.borders), default=-1)
        shared = shared_turns(self.path, path) if self.stack else -1
        self.close(shared)
        for depth in range(shared + 1, turns + 1):
            self.stack.append(_Node(sizes[depth - 1] if depth else 0, _key(path, depth) if depth <= deepest else None))
        self.path = path
        node, written = self.stack[-1], b"%d" % conv_id
        node.least = conv_id if node.least is None else min(node.least, conv_id)
        node.convs += 1
        if node.key is None:
            node.ends.update(b"," + written if node.kept else written)
            node.kept = 1
        else:
            node.ids.append(written)
            node.kept += len(written) + 1
            if node.kept > ENDS_BYTES:
                self._hand_on_ids(node)

    def _hand_on_ids(self, node: _Node) -> None:
        self.rows.append((ENDS, node.key, *[None] * 10, self.number, node.part, b",".join(node.ids)))
        node.ids, node.kept, node.part = [], 0, node.part + 1

    def close(self, depth: int) -> None:
        """Close the open nodes that are deeper than ``depth``."""
        while len(self.stack) > depth + 1:
            node, at = self.stack.pop(), len(self.stack)
            parent = self.stack[-1] if self.stack else None
            if parent:
                parent.convs += node.convs
                parent.least = node.least if parent.least is None else min(parent.least, node.least)
            if node.key is not None:
                if node.ids:
                    self._hand_on_ids(node)
                self.rows.append(
                    (PARTIAL, node.key, parent and parent.key, node.least, at, None, node.convs, node.children)
                    + (node.leaves, node.saved, None, node.bytes, None, None, None)
                )
                continue
            leaves = node.leaves or 1
            saved = node.saved + (node.convs - 1) * node.bytes
            if parent:
                parent.children += 1
                parent.leaves += leaves
                parent.saved += saved
            for row in node.waiting:
                row[5] = node.least
                self.rows.append(tuple(row))
            own = [FINISHED, None, None, node.least, at, None, node.convs, node.children, leaves, saved, node.ends.hexdigest()]
            own += [None] * 4
            if parent is None:
                self.rows.append(tuple(own))
            elif parent.key is None:
                parent.waiting.append(own)
            else:
                own[0], own[1] = BELOW_SKELETON, parent.key
                self.rows.append(tuple(own))

    def taken(self) -> pa.RecordBatch:
        rows, self.rows = self.rows, []
        columns = zip(*rows, strict=True) if rows else ((),) * len(_FIELDS)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _FIELDS, strict=True)], schema=_SCHEMA)


def _in_shards(batch: pa.RecordBatch, splitters: list[Splitter]) -> pa.RecordBatch:
    ids, paths = batch.column("conv_id").to_pylist(), batch.column("path").to_pylist()
    shards = [bisect_right(splitters, key) for key in zip(paths, ids, strict=True)]
    return pa.RecordBatch.from_arrays([*batch.columns, pa.array(shards, pa.int32())], [*batch.schema.names, "shard"])


def _walked(batches: Iterator[pa.RecordBatch], splitters: list[Splitter]) -> Iterator[pa.RecordBatch]:
    """The nodes of every shard of a partition."""
    shard = None
    for batch in batches:
        for number, conv_id, path, sizes in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard is None or shard.number != number:
                if shard is not None:
                    shard.close(-1)
                    yield shard.taken()
                shard = Shard(number, [s[0] for s in splitters[max(number - 1, 0) : number + 1]])
            shard.add(conv_id, path, sizes)
            if len(shard.rows) >= ROWS:
                yield shard.taken()
    if shard is not None:
        shard.close(-1)
        yield shard.taken()


def _hashed_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hash of the ids of each key, whose pieces come in order."""
    names, key, hashed = ["key", "ends_sha256"], None, None
    for batch in batches:
        for own, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if own != key:
                if key is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([hashed.hexdigest()])], names)
                key, hashed = own, hashlib.sha256(ids)
            else:
                hashed.update(b"," + ids)
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key]), pa.array([hashed.hexdigest()])], names)


def _put_together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Subtrees of the skeleton, whose nodes come from the deepest to the root."""
    below: dict[bytes, list[int]] = {}  # children, leaves and saved bytes that came from skeleton nodes
    for batch in batches:
        rows = []
        for key, parent, conv_id, depth, convs, children, leaves, saved, size in zip(
            *(c.to_pylist() for c in batch.columns), strict=True
        ):
            more = below.pop(key, (0, 0, 0))
            children += more[0]
            leaves = leaves + more[1] if children else 1
            saved += more[2] + (convs - 1) * size
            rows.append((key, parent, conv_id, depth, convs, children, leaves, saved))
            if parent is not None:
                sums = below.setdefault(parent, [0, 0, 0])
                for k, x in enumerate((1, leaves, saved)):
                    sums[k] += x
        columns = zip(*rows, strict=True) if rows else ((),) * 8
        kinds = [pa.binary()] * 2 + [pa.int64()] * 6
        names = ["key", "parent_key", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def prefix_trie(paths: DataFrame, shards: int | None = None) -> DataFrame:
    """A row per node of the trie of ``paths`` (columns conv_id, path and sizes).

    ``conv_id`` is the smallest member, ``parent_conv_id`` the parent's; ``saved_tokens`` counts the
    bytes of texts that need not be repeated, over the subtree.
    """
    spark = paths.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    paths = materialize(paths, "paths")
    borders = spark.sparkContext.broadcast(splitters_of(paths, shards))
    dealt = map_batches(
        paths.select("conv_id", "path", "sizes"),
        lambda batch: _in_shards(batch, borders.value),
        "conv_id bigint, path binary, sizes array<bigint>, shard int",
    )
    ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "path", "conv_id")
    walked = materialize(
        map_partitions(ordered.select("shard", "conv_id", "path", "sizes"), lambda b: _walked(b, borders.value), _DDL), "walked"
    )
    added = (
        walked.where(F.col("kind") == PARTIAL)
        .groupBy("key")
        .agg(
            F.max("parent_key").alias("parent_key"),
            F.min("conv_id").alias("conv_id"),
            F.max("depth").alias("depth"),
            *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
            F.max("last_bytes").alias("last_bytes"),
        )
    )
    skeleton = settle(
        map_partitions(
            added.repartition(1).sortWithinPartitions(F.col("depth").desc()),
            _put_together,
            "key binary, parent_key binary, conv_id bigint, depth bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved_tokens bigint",
        ),
        "skeleton",
    )
    pieces = walked.where(F.col("kind") == ENDS).select("key", "shard", "part", "ids")
    ends = settle(
        map_partitions(
            pieces.repartition("key").sortWithinPartitions("key", "shard", "part").select("key", "ids"),
            _hashed_ids,
            "key binary, ends_sha256 string",
        ),
        "ends",
    )
    parents = skeleton.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nobody = F.lit(hashlib.sha256().hexdigest())
    upper = (
        skeleton.join(parents, "parent_key", "left")
        .join(ends, "key", "left")
        .withColumn("ends_sha256", F.coalesce("ends_sha256", nobody))
    )
    # a column of the skeleton's size meets all nodes right below it
    border = (
        walked.where(F.col("kind") == BELOW_SKELETON)
        .drop("parent_key", "parent_conv_id")
        .withColumnRenamed("key", "parent_key")
        .join(parents, "parent_key")
    )
    return (
        walked.where(F.col("kind") == FINISHED).select(columns).unionByName(border.select(columns)).unionByName(upper.select(columns))
    )


def conversation_trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """The trie of the conversations, rebuilt by families."""
    return prefix_trie(rebuilt(conversations), shards)


#: The same in DuckDB; the checksum it lacks is made from its table of 256 steps.
TRIE_SQL = """
WITH RECURSIVE bits(i, n, v) AS (
  SELECT i, 0, i::BIGINT FROM range(256) r(i)
  UNION ALL
  SELECT i, n + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE n < 8),
steps AS (SELECT i, v FROM bits WHERE n = 8),
turns AS (
  SELECT conv_id, turn, strlen(coalesce(text, '')) AS size,
    sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS name
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, conv_id::VARCHAR AS s, list({'name': name, 'size': size} ORDER BY turn NULLS FIRST, name, size) AS turns
  FROM turns GROUP BY conv_id),
crc(conv_id, s, k, c) AS (
  SELECT conv_id, s, 0, 4294967295::BIGINT FROM own
  UNION ALL
  SELECT conv_id, s, k + 1, xor(v, c >> 8) FROM crc JOIN steps ON i = xor(c, ascii(s[k + 1])) & 255 WHERE k < length(s)),
heads AS (SELECT conv_id, xor(c, 4294967295) % 9 AS h FROM crc WHERE k = length(s)),
again AS (
  SELECT o.conv_id, list_concat(coalesce(f.turns, [])[1:h], o.turns[h + 1:]) AS turns
  FROM own o JOIN heads USING (conv_id) LEFT JOIN own f ON f.conv_id = o.conv_id - o.conv_id % 5),
members AS (
  SELECT conv_id, [x.name FOR x IN turns[1:d]] AS p, d, coalesce(turns[d].size, 0) AS size, d = len(turns) AS at_end
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM again)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * max(size) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (at_end), '')) AS ends_sha256
  FROM members GROUP BY p, d),
parents AS (SELECT p[1:d - 1] AS p, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL),
known AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN parents USING (p, d)),
below AS (
  SELECT p[1:k] AS p, k AS d, sum((n_children = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT p, n_children, saved, unnest(range(0, d + 1)) AS k FROM known) GROUP BY ALL)
SELECT k.conv_id, k.d AS depth, up.conv_id AS parent_conv_id, k.n_convs, k.n_children,
  b.n_leaves::BIGINT AS n_leaves, b.saved_tokens::BIGINT AS saved_tokens, k.ends_sha256
FROM known k JOIN below b USING (p, d) LEFT JOIN nodes up ON up.d = k.d - 1 AND up.p = k.p[1:k.d - 1]
"""
