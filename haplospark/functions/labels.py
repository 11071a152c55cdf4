"""Mutation labels and classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nucleotide_label(ref: Column, pos: Column, alt: Column) -> Column:
    """``REF-POS-ALT``; null as soon as one part is, so a contig without variants has none."""
    return F.concat(ref, F.lit("-"), pos.cast("string"), F.lit("-"), alt)


def amino_acid_label(
    gene: Column, ref_aa: Column, alt_aa: Column, codon: Column, pos: Column
) -> Column:
    """``Gene: REF-CODON-ALT``, or a label by nucleotide position where no codon is known."""
    by_codon = F.concat(ref_aa, F.lit("-"), codon.cast("string"), F.lit("-"), alt_aa)
    by_position = F.concat(
        ref_aa, F.lit(" -> "), alt_aa, F.lit(" at nuc. position "), pos.cast("string")
    )
    return F.concat(gene, F.lit(": "), F.when(codon.isNull(), by_position).otherwise(by_codon))


def mutation_flags(ref_aa: Column, alt_aa: Column) -> dict[str, Column]:
    """Three-valued class flags: a residue missing on one side only leaves the class unknown."""
    noncoding = ref_aa.isNull() & alt_aa.isNull()
    return {
        "Noncoding": noncoding,
        "Synonymous": (alt_aa == ref_aa) & ~noncoding,
        "Nonsynonymous": (alt_aa != ref_aa) & ~noncoding,
    }


def selection_signal(ratio: Column) -> Column:
    """Reading of a dN/dS ratio around its neutral value of 1."""
    return (
        F.when(ratio < 1, "purifying").when(ratio > 1, "positive").when(ratio == 1, "neutral")
    )
