"""Amplicon haplotype reporting on Spark."""

from haplospark.operators.codons import mutation_codons
from haplospark.operators.depths import contig_depths, rejected_deflines
from haplospark.operators.dnds import crude_dnds
from haplospark.operators.duplicates import duplicate_keys
from haplospark.operators.mutations import classify_mutations
from haplospark.operators.ranking import name_haplotypes, number_in_groups
from haplospark.operators.spans import amplicon_spans
from haplospark.operators.summary import contig_ids, mutation_lists, summarize_contigs
from haplospark.plans.report import haplotype_report, report_from_long, run_report, sort_report
from haplospark.plans.runs import current_run, drop_old_runs, read_output
from haplospark.sources.annotations import read_annotations
from haplospark.sources.fasta import read_deflines, undecodable_files
from haplospark.sources.digests import redundant_files
from haplospark.sources.files import FileSet, duplicate_paths, files_at, files_left_out, find_files, find_sources, list_files, list_sources
from haplospark.sources.layout import numbered_as_written, ordered_files, read_region, write_clustered
from haplospark.sources.primers import read_primer_bed, rejected_primers
from haplospark.sources.stage import read_stage, stage, with_signal, write_report, write_stage
from haplospark.sources.resume import stage_files
from haplospark.sources.variants import bad_positions, parse_variants, read_variants, rejected_variant_files
from haplospark.streaming.ingest import ingest_variants, read_ingested

__all__ = [
    "FileSet",
    "amplicon_spans",
    "bad_positions",
    "classify_mutations",
    "contig_depths",
    "contig_ids",
    "crude_dnds",
    "current_run",
    "drop_old_runs",
    "duplicate_keys",
    "duplicate_paths",
    "files_at",
    "files_left_out",
    "find_files",
    "find_sources",
    "list_files",
    "list_sources",
    "haplotype_report",
    "ingest_variants",
    "mutation_codons",
    "mutation_lists",
    "name_haplotypes",
    "number_in_groups",
    "numbered_as_written",
    "ordered_files",
    "parse_variants",
    "read_annotations",
    "read_deflines",
    "read_ingested",
    "read_output",
    "read_primer_bed",
    "read_region",
    "read_stage",
    "read_variants",
    "redundant_files",
    "rejected_deflines",
    "rejected_primers",
    "rejected_variant_files",
    "report_from_long",
    "run_report",
    "sort_report",
    "stage",
    "stage_files",
    "summarize_contigs",
    "undecodable_files",
    "with_signal",
    "write_clustered",
    "write_report",
    "write_stage",
]
