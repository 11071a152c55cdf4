"""Shards of nearly equal bytes by Karmarkar-Karp differencing, groups kept whole.

A partial partition is a list of ``shards`` sums. Differencing takes the two with the
largest spread, lays the one over the other in opposite order, and puts the result back,
until one is left. It needs nothing but sums, so it is done in levels: groups are
differenced in blocks of bounded size, in parallel; what remains of each block is one
partial partition, and these are the items of the next level. A level divides their number
by up to ``BLOCK``.

Defined cases: documents with equal texts are one group, a null text counts as empty, its
size as 1 and its crc32 as 0; an empty table gives no rows. Rows alike in all they return
are interchangeable.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplospark.llm.common import map_partitions
from haplospark.operators.ranking import number_in_groups
from haplospark.scratch import materialize, settle

SHARDS = 8
#: Most partial partitions that are differenced in one go; bounds the memory of a task.
BLOCK = 1 << 16


def difference(items: list[list[int]]) -> tuple[list[int], list[list[int]]]:
    """Sums of the final partition, and for each item where each of its subsets went."""
    shards = len(items[0])
    ordered = [sorted(range(shards), key=lambda k: -sums[k]) for sums in items]
    heap = []
    for i, (sums, order) in enumerate(zip(items, ordered, strict=True)):
        down = [sums[k] for k in order]
        heap.append((down[-1] - down[0], i, down))
    heapq.heapify(heap)
    # node -> (left child, left places, right child, right places); places give the
    # subset of the node that holds subset k of the child
    joins: list[tuple[int, list[int], int, list[int]]] = []
    while len(heap) > 1:
        _, a, left = heapq.heappop(heap)
        _, b, right = heap[0]
        together = [x + y for x, y in zip(left, reversed(right), strict=True)]
        order = sorted(range(shards), key=lambda k: -together[k])
        place = [0] * shards
        for at, k in enumerate(order):
            place[k] = at
        down = [together[k] for k in order]
        node = len(items) + len(joins)
        joins.append((a, place, b, place[::-1]))
        heapq.heapreplace(heap, (down[-1] - down[0], node, down))
    _, root, sums = heap[0]
    where: list[list[int] | None] = [None] * (len(items) + len(joins))
    where[root] = list(range(shards))
    for at in range(len(joins) - 1, -1, -1):
        a, in_a, b, in_b = joins[at]
        final = where[len(items) + at]
        where[len(items) + at] = None
        where[a] = [final[k] for k in in_a]
        where[b] = [final[k] for k in in_b]
    places = []
    for i, order in enumerate(ordered):
        place = [0] * shards
        for at, k in enumerate(order):
            place[k] = where[i][at]
        places.append(place)
    return sums, places


def _level(block: int):
    """Differences the partial partitions of a task, block by block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nodes, items, number, task = [], [], 0, None

        def solved() -> pa.RecordBatch:
            sums, places = difference(items)
            return pa.RecordBatch.from_pydict(
                {
                    "node": nodes,
                    "places": pa.array(places, pa.list_(pa.int32())),
                    "parent": [f"{task}-{number}"] * len(nodes),
                    "sums": pa.array([sums] + [None] * (len(nodes) - 1), pa.list_(pa.int64())),
                }
            )

        for batch in batches:
            for node, sums, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                task = at
                nodes.append(node)
                items.append(sums)
                if len(nodes) == block:
                    yield solved()
                    nodes, items, number = [], [], number + 1
        if nodes:
            yield solved()

    return run


def _differenced(items: DataFrame, block: int, label: str) -> DataFrame:
    """One level: each node with its parent and the places of its subsets there."""
    largest = F.array_max("sums") - F.array_min("sums")
    tasks = items.sortWithinPartitions(largest.desc(), "node").select(
        "node", "sums", F.spark_partition_id().alias("task")
    )
    schema = "node string, places array<int>, parent string, sums array<bigint>"
    return materialize(map_partitions(tasks, _level(block), schema), label)


def assign_groups(groups: DataFrame, shards: int = SHARDS, block: int = BLOCK) -> DataFrame:
    """``node`` and ``bytes`` of indivisible groups to ``node`` and ``shard``.

    Partial partitions are the only thing that moves between levels: one row per block.
    """
    empty = F.array_repeat(F.lit(0).cast("long"), shards - 1)
    items = groups.select("node", F.concat(F.array("bytes"), empty).alias("sums"))
    levels = [_differenced(items, block, "shards")]
    while True:
        above = levels[-1].where("sums is not null").select(F.col("parent").alias("node"), "sums")
        if len(above.limit(2).collect()) < 2:
            break
        wanted = above.count() // block + 1
        levels.append(_differenced(above.repartition(wanted), block, "shards"))
    placed = levels[0].select("node", "parent", F.col("places")[0].alias("shard"))
    for level in levels[1:]:
        up = settle(
            level.select(F.col("node").alias("_up"), F.col("parent").alias("_next"), "places"), "levels"
        )
        placed = placed.join(up, placed["parent"] == up["_up"]).select(
            "node", F.col("_next").alias("parent"), F.get("places", F.col("shard")).alias("shard")
        )
    return placed.select("node", "shard")


def shard_documents(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Every document's shard under the law ``bytes``, and its gapless slot there.

    Copies are added up before the shuffle; the way back from group to row is an equi-join
    whose row side adaptive execution can split. Slots follow doc_id (null first).
    """
    text = F.coalesce("text", F.lit(""))
    rows = materialize(
        documents.select(
            "doc_id",
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.sha2(text, 256).alias("node"),
        ),
        "sizes",
    )
    groups = rows.groupBy("node").agg(F.sum("size").alias("bytes"))
    placed = rows.join(assign_groups(groups, shards), "node")
    order = [F.col("doc_id").asc_nulls_first(), F.col("node").asc()]
    return number_in_groups(placed, ["shard"], order, "number").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("number") - 1).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
