"""Amplicon spans from a primer BED."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplospark import schemas as S


def amplicon_name(primer: Column) -> Column:
    """Primer name without its first ``_RIGHT`` and its first ``_LEFT``."""
    without_right = F.regexp_replace(primer, "^(.*?)_RIGHT", "$1")
    return F.regexp_replace(without_right, "^(.*?)_LEFT", "$1")


def amplicon_spans(bed: DataFrame) -> DataFrame:
    """One row per amplicon, gene, left start and right stop.

    Amplicons with several genes or several primers on one side fan out; a side without a
    primer leaves its position null. The primers are read once and grouped once: an amplicon
    has few of them, so its genes, starts and stops are collected and combined in its row.
    """
    name = F.col("RESPLICE_NAME")
    grouped = (
        bed.withColumn(S.AMPLICON, amplicon_name(name))
        .groupBy(S.AMPLICON)
        .agg(
            # as structs, because sets of plain values leave nulls out
            F.collect_set(F.struct(S.GENE)).alias("_genes"),
            F.collect_set(F.when(F.contains(name, F.lit("_LEFT")), F.struct(S.START))).alias("_starts"),
            F.collect_set(F.when(F.contains(name, F.lit("_RIGHT")), F.struct(S.STOP))).alias("_stops"),
        )
    )
    spread = grouped
    for side in ("_genes", "_starts", "_stops"):
        spread = spread.withColumn(side, F.explode_outer(side))
    return spread.select(
        F.col(f"_genes.{S.GENE}").alias(S.GENE),
        S.AMPLICON,
        F.col(f"_starts.`{S.START}`").alias(S.START),
        F.col(f"_stops.`{S.STOP}`").alias(S.STOP),
    )
