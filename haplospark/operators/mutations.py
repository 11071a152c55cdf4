"""The long table: one row per contig and mutation."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplospark import schemas as S
from haplospark.functions.labels import amino_acid_label, mutation_flags, nucleotide_label
from haplospark.scratch import Step, steps


#: Width, in positions, of the pieces in which a contig's mutations are kept together.
BAND_WIDTH = 16384


def band_of(position: Column) -> Column:
    """The piece of a contig that a position lies in."""
    return F.floor(position / BAND_WIDTH)


def label_of(table: DataFrame) -> Column:
    """The nucleotide label of the table's rows."""
    return nucleotide_label(table["REF"], table["POS"], table["ALT"])


#: Cells of a variant that are packed, what separates them, and what stands for a null.
_CELLS = ["REGION", "REF", "ALT", "REF_AA", "ALT_AA"]
_SEPARATOR, _NULL = "\x01", "\x02"


def packed(variants: DataFrame) -> DataFrame:
    """Variants with their texts in one, which halves what a shuffle of them moves.

    ``_cells`` has the lengths of amplicon and sample within the contig key, and the cells. Rows whose
    key is not made of its parts, whose cells hold what separates them or which are not UTF-8 are kept in ``_plain``.
    """
    names = [F.col(c) for c in (S.AMPLICON, S.SAMPLE, S.CONTIG)]
    between = F.concat(names[0], F.lit("-"), names[1], F.lit("-"), names[2])
    cells = [F.coalesce(F.col(c), F.lit(_NULL)) for c in _CELLS]
    fits = [~F.contains(cell, F.lit(_SEPARATOR)) & F.coalesce(F.col(c) != _NULL, F.lit(True)) for c, cell in zip(_CELLS, cells, strict=True)]
    lengths = [F.length(n).cast("string") for n in names[:2]]
    texts = F.concat_ws(_SEPARATOR, *lengths, *cells)
    made = (F.col(S.CONTIG_ID) == between) & F.is_valid_utf8(F.concat(between, texts))
    simple = reduce(and_, fits, F.coalesce(made, F.lit(False)))
    plain = F.struct(*_CELLS, *names)
    return variants.select(
        S.CONTIG_ID,
        "POS",
        F.when(simple, texts).alias("_cells"),
        F.when(~simple, plain).alias("_plain"),
    )


def _cell(name: str) -> Column:
    """A text of packed rows, for a key."""
    place = F.lit(_CELLS.index(name) + 3)
    text = F.nullif(F.split_part(F.col("_cells"), F.lit(_SEPARATOR), place), F.lit(_NULL))
    return F.when(F.col("_plain").isNull(), text).otherwise(F.col(f"_plain.{name}"))


def _amplicon() -> Column:
    """The amplicon of packed rows, for a key."""
    length = F.substring_index("_cells", _SEPARATOR, 1).cast("int")
    return F.when(F.col("_plain").isNull(), F.substr(F.col(S.CONTIG_ID), F.lit(1), length)).otherwise(F.col(f"_plain.{S.AMPLICON}"))


def unpacked(rows: DataFrame) -> DataFrame:
    """Packed variants as they were, with all other columns."""
    others = [c for c in rows.columns if c not in (S.CONTIG_ID, "POS", "_cells", "_plain")]
    split = rows.withColumn("_texts", F.split("_cells", _SEPARATOR))
    length = [F.get("_texts", F.lit(k)).cast("int") for k in (0, 1)]
    key = F.col(S.CONTIG_ID)
    names = {
        S.AMPLICON: F.substr(key, F.lit(1), length[0]),
        S.SAMPLE: F.substr(key, length[0] + 2, length[1]),
        S.CONTIG: F.substr(key, length[0] + length[1] + 3),
    }
    texts = {c: F.nullif(F.get("_texts", F.lit(k + 2)), F.lit(_NULL)) for k, c in enumerate(_CELLS)}
    simple = F.col("_plain").isNull()
    found = {c: F.when(simple, t).otherwise(F.col(f"_plain.`{c}`")).alias(c) for c, t in (texts | names).items()}
    return split.select(*[found.get(c, F.col(f"`{c}`")) for c in S.VARIANT_COLUMNS], *[F.col(f"`{c}`") for c in others])


def dealt_distinct(rows: DataFrame) -> DataFrame:
    """Distinct rows with the band of their position, dealt by contig and band.

    That splits a hot contig, and the distinct and the summary's first step both go on with it.
    """
    return rows.withColumn(S.BAND, band_of(F.col("POS"))).repartition(S.CONTIG_ID, S.BAND).distinct()


def label_variants(variants: DataFrame) -> DataFrame:
    """Distinct variant rows with their nucleotide label and the band of their position."""
    rows = dealt_distinct(variants.select(*S.VARIANT_COLUMNS))
    return rows.withColumn("NUC_SUB", label_of(rows))


def attach_spans(variants: DataFrame, spans: DataFrame, amplicon: Column | None = None) -> DataFrame:
    """Add gene and span; an amplicon with several spans repeats its variants.

    ``amplicon`` gives the key of rows that do not have it as a column.
    """
    if amplicon is None:
        return variants.join(spans, S.AMPLICON, "left")
    known = spans.withColumnRenamed(S.AMPLICON, "_known")
    return variants.join(known, amplicon == F.col("_known"), "left").drop("_known")


def attach_codons(variants: DataFrame, codons: DataFrame, label: Column | None = None) -> DataFrame:
    """Add the codon number, null where none is known.

    Rows without a label, of contigs without variants, match nothing. They get a key of
    their own, so that a join that shuffles does not send them all to one task. Label and key
    are made where they are compared, and do not travel with the rows. ``label`` gives that of
    rows that have neither it nor its parts as columns.
    """
    if label is None:
        label = variants["NUC_SUB"] if "NUC_SUB" in variants.columns else label_of(variants)
    key = F.coalesce(label, F.concat(F.lit("\0"), variants[S.CONTIG_ID]))
    known = codons.select(F.col("NUC_SUB").alias("_known"), "CODON")
    return variants.join(known, key == F.col("_known"), "left").drop("_known")


def classify_mutations(variants: DataFrame, spans: DataFrame, codons: DataFrame, step: Step | None = None) -> DataFrame:
    """Label every mutation of every contig and class it by its residues.

    Both joins come before the rows are dealt by contig and band: lookups that are too large
    to broadcast shuffle the rows, narrow ones, once each, and the summary or the buckets go on
    with the last shuffle whatever the lookups' size. ``spans`` and ``codons`` are distinct, so the one
    distinct behind the joins is enough. ``POS`` and the band are kept behind the report's own
    columns: lists of mutations are ordered by the one and put together from the other. Rows travel
    ``packed``; ``step`` says how they go on between joins that shuffle them.
    """
    step = step or steps(True)
    label = nucleotide_label(_cell("REF"), F.col("POS"), _cell("ALT"))
    coded = step(attach_codons(packed(variants.select(*S.VARIANT_COLUMNS)), codons, label))
    rows = unpacked(dealt_distinct(step(attach_spans(coded, spans, _amplicon()))))
    joined = rows.withColumn("NUC_SUB", label_of(rows))
    label = amino_acid_label(
        F.col(S.GENE), F.col("REF_AA"), F.col("ALT_AA"), F.col("CODON"), F.col("POS")
    )
    return joined.withColumns(
        {"AA_SUB": label, **mutation_flags(F.col("REF_AA"), F.col("ALT_AA"))}
    ).select(*S.LONG_COLUMNS, "POS", S.BAND)
