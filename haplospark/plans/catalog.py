"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haplospark import schemas as S
from haplospark.functions.keys import file_name, with_defline_key, with_file_key, without_file_key
from haplospark.functions.labels import (
    amino_acid_label,
    mutation_flags,
    nucleotide_label,
)
from haplospark.operators import codons as codon_ops
from haplospark.operators import depths as depth_ops
from haplospark.operators import mutations as mutation_ops
from haplospark.operators.dnds import crude_dnds
from haplospark.operators.duplicates import duplicate_keys
from haplospark.operators.ranking import name_haplotypes
from haplospark.operators.spans import amplicon_name, amplicon_spans
from haplospark.operators.summary import contig_ids, mutation_lists, summarize_contigs
from haplospark.plans import carriers, trees
from haplospark.plans.report import deep_contigs, haplotype_report, run_report, with_depth
from haplospark.plans.runs import read_output
from haplospark.scratch import Step, materialize, scratch_folder, settle, settle_sized, shuffles_freed, steps
from haplospark.sources.annotations import annotations_of_files
from haplospark.sources.digests import redundant_files
from haplospark.sources.fasta import deflines_of_files, undecodable_of_files
from haplospark.sources.files import list_files
from haplospark.sources.layout import numbered_as_written, read_region, write_bucketed, write_clustered
from haplospark.sources.resume import stage_files
from haplospark.sources.stage import stage, with_signal, write_report, write_stage
from haplospark.sources.variants import (
    IVAR_PATTERN,
    PARSED,
    bad_positions,
    parse_variant_files,
    parse_variants,
    variants_of_files,
)
from haplospark.streaming.ingest import ingest_variants

Query = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, Query] = {}


def query(build: Query) -> Query:
    REGISTRY[build.__name__] = build
    return build


def _spans(spark, sf_dir):
    return settle(amplicon_spans(carriers.primer_bed(spark, sf_dir)), "spans")


def _codons(spark, sf_dir):
    return codon_ops.mutation_codons(carriers.annotations(spark, sf_dir))


def _labelled(spark, sf_dir) -> tuple[DataFrame, DataFrame, Step]:
    """The long table, the spans it was joined with, and how what is made of it goes on."""
    spans, few = settle_sized(amplicon_spans(carriers.primer_bed(spark, sf_dir)), "spans")
    codons, bounded = settle_sized(_codons(spark, sf_dir), "codons")
    step = steps(few and bounded)
    return mutation_ops.classify_mutations(carriers.variants(spark, sf_dir), spans, codons, step), spans, step


def _long(spark, sf_dir):
    return _labelled(spark, sf_dir)[0]


def _lists(spark, sf_dir):
    long, _, step = _labelled(spark, sf_dir)
    return mutation_lists(long, step=step)


def _depths(spark, sf_dir):
    return depth_ops.contig_depths(carriers.deflines(spark, sf_dir))


def _short(spark, sf_dir):
    return summarize_contigs(*_labelled(spark, sf_dir))


def _deep(spark, sf_dir):
    long, spans, step = _labelled(spark, sf_dir)
    return crude_dnds(deep_contigs(long, spans, _depths(spark, sf_dir), step=step))


def _report(spark, sf_dir):
    return haplotype_report(
        carriers.variants(spark, sf_dir),
        amplicon_spans(carriers.primer_bed(spark, sf_dir)),
        _codons(spark, sf_dir),
        _depths(spark, sf_dir),
    )


def _rounded(df: DataFrame) -> DataFrame:
    """Logarithms differ in the last bit between engines; six digits are compared."""
    return df.withColumn(S.RATIO, F.round(S.RATIO, 6))


# --- sources -------------------------------------------------------------------------


@query
def variant_files_parse(spark, sf_dir):
    """Whole variant tables with differing headers, keyed by file name."""
    return variants_of_files(carriers.variant_files(spark, sf_dir)).select(
        *S.VARIANT_COLUMNS
    ).distinct()


@query
def annotation_files_parse(spark, sf_dir):
    """Whole annotation tables; those without a needed column are skipped."""
    return codon_ops.mutation_codons(annotations_of_files(carriers.annotation_files(spark, sf_dir)))


@query
def fasta_files_parse(spark, sf_dir):
    """Whole FASTA texts to depths."""
    return depth_ops.contig_depths(deflines_of_files(carriers.fasta_files(spark, sf_dir)))


@query
def contig_sentinel(spark, sf_dir):
    """Contigs without variants keep one row of nulls."""
    rows = variants_of_files(carriers.variant_files(spark, sf_dir))
    return rows.where(F.col("POS").isNull()).select(*S.KEY_FIELDS, "REGION", "REF", "ALT")


@query
def undecodable_texts(spark, sf_dir):
    """FASTA texts that are not UTF-8, which are skipped."""
    return undecodable_of_files(carriers.damaged_fasta_files(spark, sf_dir))


@query
def decodable_depths(spark, sf_dir):
    """Depths from the texts that are UTF-8."""
    return depth_ops.contig_depths(deflines_of_files(carriers.damaged_fasta_files(spark, sf_dir)))


def _stage_path(spark):
    return f"{scratch_folder(spark)}/haplospark/stage-{uuid.uuid4().hex}"


@query
def staged_variants(spark, sf_dir):
    """Distinct variants staged as a report run does, and found again by a second one."""
    path = _stage_path(spark)
    stage(spark, path, lambda: carriers.variants(spark, sf_dir).distinct(), arguments=sf_dir)
    return stage(spark, path, lambda: carriers.variants(spark, sf_dir), True, sf_dir)


def _tree_path(spark):
    return f"{scratch_folder(spark)}/haplospark/tree-{uuid.uuid4().hex}"


def _late() -> Column:
    """Half of the files, which turn up after the others."""
    return F.xxhash64("path") % 2 == 0


def _spoiled(files: DataFrame) -> DataFrame:
    """The same files with one more variant each, as before a correction."""
    line = F.lit("\nNC_045512.2\t1\tA\tC\tK\tN\tx")
    return files.withColumn("text", F.concat("text", line))


@query
def ingested_variants(spark, sf_dir):
    """A growing folder of variant tables, taken by a stream in two runs and several batches."""
    root, taken = _tree_path(spark), _stage_path(spark)
    files = materialize(trees.variant_tree(spark, sf_dir), "files")
    per_batch = max(files.count() // 5, 1)
    trees.write_tree(files.where(~_late()), root)
    ingest_variants(spark, root, taken, files_per_batch=per_batch)
    trees.write_tree(files.where(_late()), root)
    return ingest_variants(spark, root, taken, files_per_batch=per_batch).distinct()


@query
def resumed_variants(spark, sf_dir):
    """Variants staged from files of which half are corrected, some removed and some added later."""
    root, path = _tree_path(spark), _stage_path(spark)
    files = materialize(trees.variant_tree(spark, sf_dir), "files")
    parts = F.pmod(F.xxhash64("path", F.lit(1)), F.lit(3))
    other = files.withColumn("path", F.replace("path", F.lit("_ivar.tsv"), F.lit("-old_ivar.tsv")))
    trees.write_tree(_spoiled(files).where(_late()).unionByName(files.where(~_late() & (parts > 0))), root)
    trees.write_tree(other.where(parts == 1), root)

    def staged(resume):
        found = list_files(spark, root, IVAR_PATTERN)
        return stage_files(found, path, PARSED, parse_variants, resume, sf_dir)

    staged(False)
    trees.remove_tree(other.where(parts == 1), root)
    trees.write_tree(files.where(_late() | (parts == 0)), root)
    return staged(True).select(*S.VARIANT_COLUMNS).distinct()


def _order_of_name() -> Column:
    return F.regexp_extract("path", r"haplotype-(\d+)_ivar", 1).cast("bigint")


@query
def redundant_tables(spark, sf_dir):
    """Variant tables of every third contig, which stand under a second name, too.

    Texts of up to the median size are read whole, the others by line.
    """
    root = _tree_path(spark)
    files = materialize(trees.variant_tree(spark, sf_dir), "files")
    again = files.where(_order_of_name() % 3 == 0).withColumn("path", F.concat(F.lit("z/"), "path"))
    trees.write_tree(files.unionByName(again), root)
    size = files.agg(F.percentile_approx(F.octet_length("text"), 0.5)).first()[0]
    found = redundant_files(list_files(spark, root, IVAR_PATTERN, size))
    # contigs without variants are equal texts, too, and have their least path outside of z
    return found.where(F.contains("path", F.lit("/z/"))).select(file_name(F.col("path")).alias("name")).distinct()


@query
def bad_cells(spark, sf_dir):
    """Positions that are no integers: here those of contigs whose number ends in a six."""
    files = carriers.variant_files(spark, sf_dir)
    odd = F.replace("text", F.lit("NC_045512.2\t"), F.lit("NC_045512.2\t~"))
    spoiled = files.withColumn("text", F.when(F.col("path").rlike("6_ivar.tsv$"), odd).otherwise(F.col("text")))
    return bad_positions(parse_variant_files(spoiled))


# --- keys and labels -----------------------------------------------------------------


@query
def variants_projection(spark, sf_dir):
    return carriers.variants(spark, sf_dir).select(*S.VARIANT_COLUMNS).distinct()


@query
def path_tokens(spark, sf_dir):
    """Keys from encoded paths, with a plus sign in the sample and blanks in the folder."""
    name = F.concat_ws(
        "_", F.concat(S.SAMPLE, F.lit("+x")), F.col(S.AMPLICON), F.lit("r2"), F.col(S.CONTIG)
    )
    paths = carriers.contigs(spark, sf_dir).select(
        "o_orderkey", F.concat(F.lit("file:/a%20b/"), name, F.lit("_ivar.tsv")).alias("path")
    )
    return with_file_key(paths).select("o_orderkey", *S.KEY_FIELDS)


@query
def rejected_names(spark, sf_dir):
    """Variant tables whose name holds no contig key."""
    return without_file_key(carriers.variant_names(spark, sf_dir))


@query
def defline_key(spark, sf_dir):
    return with_defline_key(carriers.deflines(spark, sf_dir)).select(
        "path", F.col("position").alias("row"), *S.KEY_FIELDS
    )


@query
def defline_depth(spark, sf_dir):
    return carriers.deflines(spark, sf_dir).select(
        "path",
        F.col("position").alias("row"),
        depth_ops.defline_depth(F.col("line")).alias(S.DEPTH),
    )


@query
def defline_last_wins(spark, sf_dir):
    return _depths(spark, sf_dir)


@query
def defline_rejects(spark, sf_dir):
    return depth_ops.rejected_deflines(carriers.deflines(spark, sf_dir)).select(
        "path", F.col("position").alias("row"), "line"
    )


@query
def duplicate_contigs(spark, sf_dir):
    """Contigs with a depth in more than one file."""
    return duplicate_keys(_depths(spark, sf_dir), S.CONTIG_ID)


@query
def nuc_sub_label(spark, sf_dir):
    label = nucleotide_label(F.col("REF"), F.col("POS"), F.col("ALT"))
    return carriers.variants(spark, sf_dir).select(
        S.CONTIG_ID, "REF", "POS", "ALT", label.alias("NUC_SUB")
    )


# --- spans and codons ----------------------------------------------------------------


@query
def primer_first_replace(spark, sf_dir):
    return carriers.primer_bed(spark, sf_dir).select(
        "RESPLICE_NAME", S.START, amplicon_name(F.col("RESPLICE_NAME")).alias(S.AMPLICON)
    )


@query
def amplicon_span_table(spark, sf_dir):
    return amplicon_spans(carriers.primer_bed(spark, sf_dir)).orderBy(
        F.col(S.START).asc_nulls_first(), F.col(S.STOP).asc_nulls_first()
    )


@query
def annotation_codon(spark, sf_dir):
    return _codons(spark, sf_dir)


# --- long table ----------------------------------------------------------------------


@query
def variants_with_span(spark, sf_dir):
    labelled = mutation_ops.label_variants(carriers.variants(spark, sf_dir))
    return mutation_ops.attach_spans(labelled, _spans(spark, sf_dir)).select(
        S.CONTIG_ID, "NUC_SUB", "REF_AA", "ALT_AA", *S.SPAN_COLUMNS
    )


@query
def variants_with_codon(spark, sf_dir):
    labelled = mutation_ops.label_variants(carriers.variants(spark, sf_dir))
    codons = settle(_codons(spark, sf_dir), "codons")
    return mutation_ops.attach_codons(labelled, codons).select(
        S.CONTIG_ID, "NUC_SUB", "REF_AA", "ALT_AA", "CODON"
    )


@query
def aa_label(spark, sf_dir):
    labelled = mutation_ops.label_variants(carriers.variants(spark, sf_dir))
    joined = mutation_ops.attach_codons(
        mutation_ops.attach_spans(labelled, _spans(spark, sf_dir)),
        settle(_codons(spark, sf_dir), "codons"),
    )
    label = amino_acid_label(
        F.col(S.GENE), F.col("REF_AA"), F.col("ALT_AA"), F.col("CODON"), F.col("POS")
    )
    return joined.select(S.CONTIG_ID, "NUC_SUB", "CODON", S.GENE, label.alias("AA_SUB"))


@query
def mutation_class_flags(spark, sf_dir):
    flags = mutation_flags(F.col("REF_AA"), F.col("ALT_AA"))
    return (
        carriers.variants(spark, sf_dir)
        .select("REF_AA", "ALT_AA", *[c.alias(n) for n, c in flags.items()])
        .groupBy("REF_AA", "ALT_AA", *flags)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def long_table(spark, sf_dir):
    return _long(spark, sf_dir).select(*S.LONG_COLUMNS)


@query
def clustered_region(spark, sf_dir):
    """Variants at a twentieth of the positions, from a table that is clustered by them."""
    rows = mutation_ops.label_variants(carriers.variants(spark, sf_dir)).drop(S.BAND)
    path = _stage_path(spark)
    write_clustered(rows, path, ["POS", S.AMPLICON, S.CONTIG_ID])
    table = spark.read.parquet(path)
    last = table.agg(F.max("POS")).first()[0] or 0
    return read_region(table, start=last // 2, stop=last // 2 + last // 20)


@query
def staged_long_table(spark, sf_dir):
    """The long table as a report run writes it, read back."""
    with shuffles_freed(spark):
        return write_stage(_long(spark, sf_dir).select(*S.LONG_COLUMNS), _stage_path(spark))


# --- short table ---------------------------------------------------------------------


@query
def contig_id_table(spark, sf_dir):
    return contig_ids(_long(spark, sf_dir))


@query
def nuc_list_count(spark, sf_dir):
    return _lists(spark, sf_dir).select(S.CONTIG_ID, S.NUC_LIST, S.NUC_COUNT)


@query
def syn_list_count(spark, sf_dir):
    return _lists(spark, sf_dir).select(S.CONTIG_ID, S.SYN_LIST, S.SYN_COUNT)


@query
def nonsyn_list_count(spark, sf_dir):
    return _lists(spark, sf_dir).select(S.CONTIG_ID, S.NONSYN_LIST, S.NONSYN_COUNT)


@query
def contig_summary(spark, sf_dir):
    return _short(spark, sf_dir)


@query
def bucketed_summary(spark, sf_dir):
    """The short table from mutations in buckets, which are read without an exchange."""
    labelled, spans, _ = _labelled(spark, sf_dir)
    with shuffles_freed(spark):
        long = write_bucketed(labelled, _stage_path(spark), [S.CONTIG_ID, S.BAND], True)
    return summarize_contigs(long, spans)


@query
def depth_join(spark, sf_dir):
    contigs = contig_ids(_long(spark, sf_dir))
    return with_depth(contigs, _depths(spark, sf_dir))


@query
def crude_dnds_ratio(spark, sf_dir):
    short = _rounded(crude_dnds(_short(spark, sf_dir)))
    return short.select(
        S.CONTIG_ID, *S.SPAN_COLUMNS, S.SYN_COUNT, S.NONSYN_COUNT, S.LENGTH, S.RATIO
    )


# --- report --------------------------------------------------------------------------


@query
def haplotype_rank(spark, sf_dir):
    return name_haplotypes(materialize(_deep(spark, sf_dir), "deep")).select(
        S.HAPLOTYPE, S.CONTIG_ID, S.DEPTH, *S.SPAN_COLUMNS
    )


@query
def haplotype_report_table(spark, sf_dir):
    return _rounded(_report(spark, sf_dir))


@query
def selection_signal_bands(spark, sf_dir):
    return (
        with_signal(crude_dnds(_short(spark, sf_dir)))
        .groupBy(S.AMPLICON, S.SIGNAL)
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@query
def report_from_files(spark, sf_dir):
    """A whole run over a results folder, read back from what it published."""
    root, out = _tree_path(spark), _stage_path(spark)
    trees.write_tree(trees.results_tree(spark, sf_dir), root)
    run_report(spark, root, f"{root}/primers.bed", out)
    return _rounded(read_output(spark, out, "final_report").select(*S.REPORT_COLUMNS))


@query
def ordered_report_files(spark, sf_dir):
    """The report written in files of few rows; rows numbered as the files are read by name."""
    path = _stage_path(spark)
    with shuffles_freed(spark):
        write_report(_report(spark, sf_dir), path, file_rows=250)
    written = spark.read.parquet(path)
    return numbered_as_written(written).select(S.HAPLOTYPE, S.SAMPLE, S.START, S.DEPTH, "number")
