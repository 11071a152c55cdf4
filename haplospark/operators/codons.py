"""Codon numbers of nucleotide substitutions from annotated variants."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplospark.functions.labels import nucleotide_label
from haplospark.functions.numeric import joined_digits

#: 1-based place of the amino-acid change within a pipe-separated annotation.
AMINO_ACID_FIELD = 11


def codon_number(annotation: Column) -> Column:
    """Digits of the amino-acid change; null if the annotation is shorter or has none."""
    change = F.try_element_at(F.split(annotation, r"\|"), F.lit(AMINO_ACID_FIELD))
    return joined_digits(change)


def codon_columns() -> tuple[Column, Column]:
    """``NUC_SUB`` and ``CODON`` of rows with ref, pos, alt and info_ANN."""
    position = F.col("pos").try_cast("bigint")
    return (
        nucleotide_label(F.col("ref"), position, F.col("alt")).alias("NUC_SUB"),
        codon_number(F.col("info_ANN")).alias("CODON"),
    )


def mutation_codons(annotations: DataFrame) -> DataFrame:
    """Distinct (``NUC_SUB``, ``CODON``) pairs; a substitution may have several codons."""
    return annotations.select(*codon_columns()).dropna("any").distinct()
