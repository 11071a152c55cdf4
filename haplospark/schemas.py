"""Column names and table schemas shared by every module.

The names are fixed values: reports written by this library have to line up,
column by column, with the reports users already have.
"""

from __future__ import annotations

from pyspark.sql import types as T

AMPLICON = "Amplicon"
SAMPLE = "Sample ID"
CONTIG = "Contig"
CONTIG_ID = "Amplicon-Sample-Contig"
DEPTH = "Depth of Coverage"
START = "Start Position"
STOP = "Stop Position"
GENE = "Gene"
HAPLOTYPE = "Haplotype"
LENGTH = "Amplicon Length"
RATIO = "Crude dN/dS Ratio"
SIGNAL = "Selection Signal"

#: Number of the piece of a contig that a mutation lies in; not part of a report.
BAND = "_band"

NUC_LIST = "Nucleotide Substitutions"
NUC_COUNT = "Nuc Mut Count"
SYN_LIST = "Synonymous Mutations"
SYN_COUNT = "Syn count"
NONSYN_LIST = "Nonsynonymous Mutations"
NONSYN_COUNT = "Nonsyn count"

VARIANT_FIELDS = ["REGION", "POS", "REF", "ALT", "REF_AA", "ALT_AA"]
KEY_FIELDS = [AMPLICON, SAMPLE, CONTIG, CONTIG_ID]
VARIANT_COLUMNS = VARIANT_FIELDS + KEY_FIELDS

ANNOTATION_FIELDS = ["ref", "pos", "alt", "info_ANN"]

SPAN_COLUMNS = [GENE, AMPLICON, START, STOP]

LONG_COLUMNS = [
    "REGION",
    AMPLICON,
    SAMPLE,
    CONTIG,
    CONTIG_ID,
    "NUC_SUB",
    GENE,
    START,
    STOP,
    "AA_SUB",
    "Noncoding",
    "Synonymous",
    "Nonsynonymous",
]

MUTATION_COLUMNS = [NUC_LIST, NUC_COUNT, SYN_LIST, SYN_COUNT, NONSYN_LIST, NONSYN_COUNT]

SHORT_COLUMNS = [CONTIG_ID, AMPLICON, SAMPLE, GENE, START, STOP] + MUTATION_COLUMNS

REPORT_COLUMNS = (
    [HAPLOTYPE, AMPLICON, SAMPLE, GENE, START, STOP]
    + MUTATION_COLUMNS
    + [DEPTH, LENGTH, RATIO]
)

PRIMER_BED = T.StructType(
    [
        T.StructField("Ref", T.StringType()),
        T.StructField(START, T.LongType()),
        T.StructField(STOP, T.LongType()),
        T.StructField("NAME", T.StringType()),
        T.StructField("RESPLICE_NAME", T.StringType()),
        T.StructField("INDEX", T.StringType()),
        T.StructField(GENE, T.StringType()),
    ]
)
