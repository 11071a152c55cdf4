"""Contig keys from file names and from FASTA deflines.

Variant tables carry the contig in their file name, depths carry it in a sequence
header. Both sides have to arrive at the same ``amplicon-sample-contig`` text, so they
share the last steps below.

The steps are separate projections on purpose. Each one uses the columns of the one before
several times; written as a single expression they would multiply into generated code too
large for the JVM to compile.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haplospark import schemas as S


def tokens(text: Column, separator: str) -> Column:
    """Split on a literal separator, keeping empty tokens."""
    if not separator:
        raise ValueError("the separator must not be empty")
    return F.split(text, re.escape(separator))


def token_at(items: Column, index: int) -> Column:
    """Element at a 0-based index, counting from the end when negative; null outside."""
    return F.try_element_at(items, F.lit(index + 1 if index >= 0 else index))


def file_name(path: Column) -> Column:
    """Base name of a ``_metadata.file_path``, which arrives percent-encoded.

    A plus sign is literal in a path, while URL decoding reads it as a blank.
    """
    base = F.substring_index(path, "/", -1)
    return F.url_decode(F.replace(base, F.lit("+"), F.lit("%2B")))


def contig_id(amplicon: Column, sample: Column, contig: Column) -> Column:
    """The contig key; null as soon as one part is."""
    return F.concat(amplicon, F.lit("-"), sample, F.lit("-"), contig)


def _with_amplicon(df: DataFrame, text: str, separator: str) -> DataFrame:
    """Amplicon and key: what is left of ``text`` without sample and contig.

    Both are removed wherever they occur, then one separator at each edge.
    """
    nothing, width = F.lit(""), len(separator)
    rest, tail = F.col("_rest"), F.col("_tail")
    return (
        df.withColumn("_rest", F.replace(F.replace(text, S.SAMPLE, nothing), S.CONTIG, nothing))
        .withColumn(
            "_tail",
            F.when(rest.startswith(separator), F.substr(rest, F.lit(width + 1))).otherwise(rest),
        )
        .withColumn(
            S.AMPLICON,
            F.when(
                tail.endswith(separator), F.substr(tail, F.lit(1), F.length(tail) - width)
            ).otherwise(tail),
        )
        .withColumn(
            S.CONTIG_ID, contig_id(F.col(S.AMPLICON), F.col(S.SAMPLE), F.col(S.CONTIG))
        )
    )


def _with_name_tokens(
    files: DataFrame, suffix: str, separator: str, sample_index: int, contig_index: int
) -> DataFrame:
    stem = F.replace(file_name(F.col("path")), F.lit(suffix), F.lit(""))
    return (
        files.withColumn("_stem", stem)
        .withColumn("_tokens", tokens(F.col("_stem"), separator))
        .withColumn(S.SAMPLE, token_at(F.col("_tokens"), sample_index))
        .withColumn(S.CONTIG, token_at(F.col("_tokens"), contig_index))
    )


def _name_has_key() -> Column:
    # Two tokens are a sample and a contig without an amplicon between them.
    return (F.size("_tokens") != 2) & F.col(S.SAMPLE).isNotNull() & F.col(S.CONTIG).isNotNull()


def with_file_key(
    files: DataFrame,
    suffix: str = "_ivar.tsv",
    separator: str = "_",
    sample_index: int = 0,
    contig_index: int = -1,
) -> DataFrame:
    """Add the key of variant tables named ``<sample>_<amplicon>_<contig><suffix>``.

    Files whose name holds no key are left out; see ``without_file_key``.
    """
    parts = _with_name_tokens(files, suffix, separator, sample_index, contig_index)
    return _with_amplicon(parts.where(_name_has_key()), "_stem", separator).select(
        *files.columns, *S.KEY_FIELDS
    )


def without_file_key(
    files: DataFrame,
    suffix: str = "_ivar.tsv",
    separator: str = "_",
    sample_index: int = 0,
    contig_index: int = -1,
) -> DataFrame:
    """The files that ``with_file_key`` leaves out."""
    parts = _with_name_tokens(files, suffix, separator, sample_index, contig_index)
    return parts.where(~_name_has_key()).select(*files.columns)


def _with_label_tokens(deflines: DataFrame, marker: str) -> DataFrame:
    label = F.substring_index(F.replace("line", F.lit(">"), F.lit("")), " ", 1)
    return (
        deflines.withColumn("_label", label)
        .withColumn("_tokens", F.split("_label", "_"))
        .withColumn("_marked", F.filter("_tokens", lambda t: F.contains(t, F.lit(marker))))
    )


def _label_has_key() -> Column:
    """Three tokens or more, exactly one of them with the marker."""
    return (F.size("_tokens") > 2) & (F.size("_marked") == 1)


def with_defline_key(deflines: DataFrame, marker: str = "haplotype") -> DataFrame:
    """Add the key of header lines ``>sample_amplicon_<marker>... rest``.

    Lines without a key are left out; see ``without_defline_key``.
    """
    parts = (
        _with_label_tokens(deflines, marker)
        .where(_label_has_key())
        .withColumn(S.SAMPLE, F.get("_tokens", 0))
        .withColumn(S.CONTIG, F.get("_marked", 0))
    )
    return _with_amplicon(parts, "_label", "_").select(*deflines.columns, *S.KEY_FIELDS)


def without_defline_key(deflines: DataFrame, marker: str = "haplotype") -> DataFrame:
    """The lines that ``with_defline_key`` leaves out."""
    parts = _with_label_tokens(deflines, marker)
    return parts.where(~_label_has_key()).select(*deflines.columns)
