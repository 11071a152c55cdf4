"""Numbering rows within groups, and haplotype names from it."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haplospark import schemas as S
from haplospark.scratch import materialize


def number_in_groups(
    df: DataFrame, groups: list[str], order: list[Column], name: str
) -> DataFrame:
    """Add the 1-based number of each row within its group, in a total order.

    A window over the groups alone would put the largest group into one task. Instead the
    table is range-partitioned on group *and* order, which cuts large groups into slices of
    ordinary size, and written once so that the slices are fixed. Rows are numbered within
    (slice, group); a group that began in earlier slices adds the rows it had there. Only
    the groups cut by a slice border have such rows, so that table has fewer rows than
    there are slices and may be broadcast.
    """
    keys = [F.col(c) for c in groups]
    slices = materialize(
        df.repartitionByRange(*keys, *order)
        .withColumn("_slice", F.spark_partition_id())
        .sortWithinPartitions(*keys, *order),
        "slices",
    )
    earlier = (
        Window.partitionBy(*groups)
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        slices.groupBy("_slice", *groups)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(earlier))
        .where("_before > 0")
        .drop("_rows")
    )
    numbered = slices.withColumn(
        "_number",
        F.row_number().over(Window.partitionBy("_slice", *groups).orderBy(*order)),
    )
    left, right = numbered.alias("n"), F.broadcast(carried).alias("c")
    same_piece = reduce(
        and_, [F.col(f"n.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ["_slice", *groups]]
    )
    total = F.col("_number") + F.coalesce(F.col("_before"), F.lit(0))
    return left.join(right, same_piece, "left").select("n.*", total.alias(name)).drop(
        "_slice", "_number"
    )


def name_haplotypes(contigs: DataFrame) -> DataFrame:
    """Name the haplotypes of each amplicon and sample by descending read depth.

    Equal depths are ordered by contig key, gene and span, so names are reproducible. Only
    these keys are numbered, and written on the way; the numbers are joined back by them,
    starting with the contig key by which a summary is partitioned. ``contigs`` is read
    twice, so it should be a table, or cheap without its texts.
    """
    order = [
        F.col(S.DEPTH).desc(),
        F.col(S.CONTIG_ID).asc(),
        F.col(S.GENE).asc_nulls_first(),
        F.col(S.START).asc_nulls_first(),
        F.col(S.STOP).asc_nulls_first(),
    ]
    keys = [S.CONTIG_ID, S.AMPLICON, S.SAMPLE, S.DEPTH, S.GENE, S.START, S.STOP]
    numbered = number_in_groups(
        contigs.select(*keys), [S.AMPLICON, S.SAMPLE], order, "_rank"
    )
    left, right = contigs.alias("c"), numbered.alias("n")
    same = reduce(and_, [F.col(f"c.`{k}`").eqNullSafe(F.col(f"n.`{k}`")) for k in keys])
    label = F.concat(F.col(f"c.{S.AMPLICON}"), F.lit(" Haplotype "), F.col("_rank").cast("string"))
    return left.join(right, same).select(
        label.alias(S.HAPLOTYPE), *[F.col(f"c.`{c}`").alias(c) for c in contigs.columns]
    )
