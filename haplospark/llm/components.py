"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haplospark.scratch import materialize


def _size(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, most_rounds: int = 200) -> DataFrame:
    """``node`` and ``root`` (the smallest node reachable) for every node of an edge.

    ``edges`` has columns u and v of one ordered type. Two steps alternate until nothing
    changes: each node links its larger neighbours to its smallest one, then its smaller
    neighbours. The number of edges never grows, and the rounds are few also for long
    chains. Smallest neighbours come from a grouping that combines before its shuffle; every
    round is written to the shared folder, so lineage stays short.
    """
    both = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    current = materialize(both.distinct(), "edges")
    size = _size(current)
    for _ in range(most_rounds):
        if not size[0]:
            break
        # larger neighbours of each node go to the smallest of it and all its neighbours
        around = current.union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select(
            F.col("u").alias("n"), F.least("u", "m").alias("m")
        )
        larger = (
            current.join(least, current["v"] == least["n"])
            .where("u <> m")
            .select("u", F.col("m").alias("v"))
            .distinct()
        )
        # smaller neighbours of each node, and the node, go to the smallest of them
        down = larger.groupBy("u").agg(F.min("v").alias("m"))
        joined = larger.join(down, "u")
        step = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").union(
            joined.select("u", F.col("m").alias("v"))
        )
        after = materialize(step.distinct(), "edges")
        grown = _size(after)
        if grown == size:
            break
        current, size = after, grown
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
