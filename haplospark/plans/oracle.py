"""The expected result of every catalogue query, as SQL over the benchmark tables.

The statements start from the tables' columns. Names, paths, primers, annotations and
headers that the queries first write out as text and then parse do not occur here, except
where the text itself is the result.
"""

from __future__ import annotations

_CTES = {
    "contigs": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
               'QIA_' || o_custkey AS "Amplicon",
               'S' || (o_orderkey % 12) AS "Sample ID",
               'haplotype-' || o_orderkey AS "Contig",
               'QIA_' || o_custkey || '-S' || (o_orderkey % 12)
                   || '-haplotype-' || o_orderkey AS "Amplicon-Sample-Contig"
        FROM orders""",
    "mutations": """
        SELECT l_orderkey, 'NC_045512.2' AS "REGION", l_partkey AS "POS",
               substr('ACGT', CAST(1 + l_partkey % 4 AS INT), 1) AS "REF",
               substr('ACGT', CAST(1 + (l_partkey + 1 + l_suppkey % 3) % 4 AS INT), 1) AS "ALT",
               nullif(l_returnflag, 'N') AS "REF_AA",
               CASE WHEN l_returnflag = 'N' OR l_linenumber = 7 THEN NULL
                    WHEN l_linestatus = 'F' THEN l_returnflag ELSE 'Q' END AS "ALT_AA"
        FROM lineitem""",
    "all_variants": """
        SELECT m."REGION", m."POS", m."REF", m."ALT", m."REF_AA", m."ALT_AA",
               c."Amplicon", c."Sample ID", c."Contig", c."Amplicon-Sample-Contig"
        FROM contigs c LEFT JOIN mutations m ON c.o_orderkey = m.l_orderkey""",
    "variants": """
        SELECT DISTINCT *, "REF" || '-' || "POS" || '-' || "ALT" AS "NUC_SUB"
        FROM all_variants""",
    "parts": """
        SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS s, p_partkey * 400 + 1 AS l,
               CASE p_partkey % 23 WHEN 4 THEN 'OTHER_' ELSE 'QIA_' END || p_partkey AS a,
               CASE WHEN p_partkey % 10 = 3 THEN NULL WHEN p_partkey % 3 = 0 THEN 'S'
                    WHEN p_partkey % 3 = 1 THEN 'N' ELSE 'ORF1a' END AS g
        FROM part""",
    "genes": """
        SELECT k, a, g FROM parts
        UNION ALL SELECT k, a, 'ORF9b' FROM parts WHERE k % 11 = 3
        UNION ALL SELECT k, a, 'M' FROM parts WHERE k % 29 = 6""",
    "starts": """
        SELECT k, l AS st FROM parts
        UNION ALL SELECT k, l + 3 FROM parts WHERE k % 13 = 7""",
    "stops": "SELECT k, l + s AS sp FROM parts WHERE k % 17 <> 5",
    "spans": """
        SELECT g AS "Gene", a AS "Amplicon",
               st AS "Start Position", sp AS "Stop Position"
        FROM genes JOIN starts USING (k) LEFT JOIN stops USING (k)
        UNION ALL
        SELECT g, a || '_LEFT', l, NULL FROM parts WHERE k % 19 = 2""",
    "annotated": """
        SELECT "REF" || '-' || "POS" || '-' || "ALT" AS "NUC_SUB", "POS", p_size AS s, p_type AS t,
               p_partkey AS k
        FROM mutations JOIN part ON "POS" = p_partkey""",
    "codon_rows": """
        SELECT "NUC_SUB", "POS",
               CASE WHEN t = 'PROMO' THEN CAST(s || '' || s AS BIGINT)
                    ELSE CAST(s AS BIGINT) END AS "CODON"
        FROM annotated WHERE t IN ('ECONOMY', 'PROMO', 'SMALL') AND s % 9 <> 0
        UNION ALL
        SELECT "NUC_SUB", "POS", CAST('7' || s AS BIGINT) FROM annotated WHERE k % 29 = 1""",
    "codons": """SELECT DISTINCT "NUC_SUB", "CODON" FROM codon_rows""",
    "long_rows": """
        SELECT v.*, s."Gene", s."Start Position", s."Stop Position", c."CODON",
               s."Gene" || ': ' || CASE
                   WHEN c."CODON" IS NULL
                   THEN "REF_AA" || ' -> ' || "ALT_AA" || ' at nuc. position ' || "POS"
                   ELSE "REF_AA" || '-' || c."CODON" || '-' || "ALT_AA" END AS "AA_SUB",
               "REF_AA" IS NULL AND "ALT_AA" IS NULL AS "Noncoding",
               "ALT_AA" = "REF_AA" AND NOT ("REF_AA" IS NULL AND "ALT_AA" IS NULL)
                   AS "Synonymous",
               "ALT_AA" <> "REF_AA" AND NOT ("REF_AA" IS NULL AND "ALT_AA" IS NULL)
                   AS "Nonsynonymous"
        FROM variants v LEFT JOIN spans s USING ("Amplicon")
             LEFT JOIN codons c ON v."NUC_SUB" = c."NUC_SUB" """,
    "lists": """
        SELECT "Amplicon-Sample-Contig", "Amplicon", "Sample ID",
               string_agg("NUC_SUB", ', ' ORDER BY "POS", "NUC_SUB") AS "Nucleotide Substitutions",
               count("NUC_SUB") AS "Nuc Mut Count",
               string_agg("AA_SUB", ', ' ORDER BY "POS", "AA_SUB") FILTER (WHERE "Synonymous")
                   AS "Synonymous Mutations",
               nullif(count(*) FILTER (WHERE "Synonymous"), 0) AS "Syn count",
               string_agg("AA_SUB", ', ' ORDER BY "POS", "AA_SUB") FILTER (WHERE "Nonsynonymous")
                   AS "Nonsynonymous Mutations",
               nullif(count(*) FILTER (WHERE "Nonsynonymous"), 0) AS "Nonsyn count"
        FROM long_rows GROUP BY ALL""",
    "short": """
        SELECT l.*, s."Gene", s."Start Position", s."Stop Position"
        FROM lists l LEFT JOIN spans s USING ("Amplicon")""",
    "depths": """
        SELECT "Amplicon-Sample-Contig",
               CASE WHEN o_orderkey % 37 = 5 THEN o_orderkey % 97
                    WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT)
                    END AS "Depth of Coverage"
        FROM contigs
        UNION ALL
        SELECT "Amplicon-Sample-Contig", CAST(floor(o_totalprice) AS BIGINT) + 1
        FROM contigs WHERE o_orderkey % 41 = 7""",
    "deep": """
        SELECT s.*, d."Depth of Coverage"
        FROM short s JOIN (SELECT DISTINCT * FROM depths WHERE "Depth of Coverage" IS NOT NULL) d
             USING ("Amplicon-Sample-Contig")""",
    "ratio_steps": """
        SELECT *, "Stop Position" - "Start Position" AS "Amplicon Length",
               "Nonsyn count" / nullif(2 * ("Stop Position" - "Start Position") - "Syn count", 0)
                   AS pn,
               "Syn count" / nullif(2 * ("Stop Position" - "Start Position") - "Nonsyn count", 0)
                   AS ps
        FROM {ratio_source}""",
    "ratios": """
        SELECT * EXCLUDE (pn, ps),
               CASE WHEN pn < 0.75 THEN -0.75 * ln(1 - 4 * pn / 3) END
                   / CASE WHEN ps < 0.75 THEN -0.75 * ln(1 - 4 * ps / 3) END
                   AS "Crude dN/dS Ratio"
        FROM ratio_steps""",
    "ranked": """
        SELECT *, "Amplicon" || ' Haplotype ' || row_number() OVER (
                   PARTITION BY "Amplicon", "Sample ID"
                   ORDER BY "Depth of Coverage" DESC, "Amplicon-Sample-Contig" ASC,
                            "Gene" ASC NULLS FIRST, "Start Position" ASC NULLS FIRST,
                            "Stop Position" ASC NULLS FIRST) AS "Haplotype"
        FROM ratios""",
    "headers": """
        SELECT o_orderkey, 'file:/run/' || (o_custkey % 40) AS path, o_orderkey AS row,
               "Amplicon", "Sample ID", "Contig",
               CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END AS size
        FROM contigs
        UNION ALL
        SELECT o_orderkey, 'file:/run/' || (o_custkey % 40), o_orderkey + 1000000000,
               "Amplicon", "Sample ID", "Contig", o_orderkey % 97
        FROM contigs WHERE o_orderkey % 37 = 5
        UNION ALL
        SELECT o_orderkey, 'file:/run/' || (o_custkey % 40 + 100), o_orderkey,
               "Amplicon", "Sample ID", "Contig", CAST(floor(o_totalprice) AS BIGINT) + 1
        FROM contigs WHERE o_orderkey % 41 = 7
        UNION ALL
        SELECT o_orderkey, 'file:/run/' || (o_custkey % 40 + 200), o_orderkey,
               NULL, 'S1', NULL,
               CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS BIGINT) END
        FROM contigs WHERE o_orderkey % 53 = 9""",
    "texts": """
        SELECT path, (row % 1000000000) // 4096 AS file, arg_min("Sample ID", row) AS sample
        FROM headers GROUP BY ALL""",
}

_LONG = """"REGION", "Amplicon", "Sample ID", "Contig", "Amplicon-Sample-Contig", "NUC_SUB", "Gene",
       "Start Position", "Stop Position", "AA_SUB", "Noncoding", "Synonymous", "Nonsynonymous" """

_SHORT = """"Amplicon-Sample-Contig", "Amplicon", "Sample ID", "Gene", "Start Position",
       "Stop Position", "Nucleotide Substitutions", "Nuc Mut Count", "Synonymous Mutations",
       "Syn count", "Nonsynonymous Mutations", "Nonsyn count" """

_REPORT = """"Haplotype", "Amplicon", "Sample ID", "Gene", "Start Position", "Stop Position",
       "Nucleotide Substitutions", "Nuc Mut Count", "Synonymous Mutations", "Syn count",
       "Nonsynonymous Mutations", "Nonsyn count", "Depth of Coverage", "Amplicon Length",
       round("Crude dN/dS Ratio", 6) AS "Crude dN/dS Ratio" """


def _with(select: str, ratio_source: str = "deep") -> str:
    """``select`` behind the common table expressions up to the ones it needs."""
    ctes = ",\n".join(
        f"{name} AS ({body.format(ratio_source=ratio_source)})" for name, body in _CTES.items()
    )
    return f"WITH {ctes}\n{select}"


_VARIANTS = """SELECT DISTINCT "REGION", "POS", "REF", "ALT", "REF_AA", "ALT_AA", "Amplicon",
       "Sample ID", "Contig", "Amplicon-Sample-Contig" FROM all_variants"""

ORACLE: dict[str, str] = {
    "variant_files_parse": _with(_VARIANTS),
    "annotation_files_parse": _with(
        'SELECT DISTINCT "NUC_SUB", "CODON" FROM codon_rows WHERE "POS" % 14 <> 3'
    ),
    "fasta_files_parse": _with('SELECT "Amplicon-Sample-Contig", "Depth of Coverage" FROM depths'),
    "contig_sentinel": _with(
        """SELECT "Amplicon", "Sample ID", "Contig", "Amplicon-Sample-Contig",
                  CAST(NULL AS VARCHAR) AS "REGION", CAST(NULL AS VARCHAR) AS "REF",
                  CAST(NULL AS VARCHAR) AS "ALT"
           FROM contigs WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"""
    ),
    "undecodable_texts": _with(
        """SELECT path || '/' || file || '_haplotypes.fasta' AS path FROM texts
           WHERE sample = 'S1'"""
    ),
    "decodable_depths": _with(
        """SELECT * EXCLUDE (p) FROM (SELECT DISTINCT h."Amplicon" || '-' || h."Sample ID" || '-' || h."Contig"
                      AS "Amplicon-Sample-Contig",
                  last_value(h.size) OVER (PARTITION BY h.path, h.o_orderkey ORDER BY h.row
                      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
                      AS "Depth of Coverage", h.path AS p
           FROM headers h JOIN texts t
                ON h.path = t.path AND (h.row % 1000000000) // 4096 = t.file
           WHERE t.sample <> 'S1' AND h."Contig" IS NOT NULL)"""
    ),
    "staged_variants": _with(_VARIANTS),
    "ingested_variants": _with(_VARIANTS),
    "resumed_variants": _with(_VARIANTS),
    "variants_projection": _with(_VARIANTS),
    "redundant_tables": _with(
        """SELECT "Sample ID" || '_' || "Amplicon" || '_' || "Contig" || '_ivar.tsv' AS name
           FROM contigs WHERE o_orderkey % 3 = 0"""
    ),
    "bad_cells": _with(
        """SELECT 'file:/run%20' || ("POS" // 65536) || '/' || "Sample ID" || '_' || "Amplicon" || '_'
                      || "Contig" || '_ivar.tsv' AS path,
                  'POS = ~' || "POS" AS line, 'not an integer' AS reason
           FROM variants WHERE "Contig" LIKE '%6' AND "POS" IS NOT NULL"""
    ),
    "clustered_region": _with(
        """SELECT "REGION", "POS", "REF", "ALT", "REF_AA", "ALT_AA", "Amplicon", "Sample ID", "Contig",
                  "Amplicon-Sample-Contig", "NUC_SUB"
           FROM variants, (SELECT max(l_partkey) AS last FROM lineitem)
           WHERE "POS" BETWEEN last // 2 AND last // 2 + last // 20"""
    ),
    "path_tokens": _with(
        """SELECT o_orderkey, "Amplicon" || '_r2' AS "Amplicon",
                  "Sample ID" || '+x' AS "Sample ID", "Contig",
                  "Amplicon" || '_r2-' || "Sample ID" || '+x-' || "Contig"
                      AS "Amplicon-Sample-Contig"
           FROM contigs"""
    ),
    "rejected_names": _with(
        """SELECT 'file:/run/' || "Sample ID" || '_' || "Contig" || '_ivar.tsv' AS path
           FROM contigs WHERE o_orderkey % 11 = 3"""
    ),
    "defline_key": _with(
        """SELECT path, row, "Amplicon", "Sample ID", "Contig",
                  "Amplicon" || '-' || "Sample ID" || '-' || "Contig"
                      AS "Amplicon-Sample-Contig"
           FROM headers WHERE "Contig" IS NOT NULL"""
    ),
    "defline_depth": _with('SELECT path, row, size AS "Depth of Coverage" FROM headers'),
    "defline_last_wins": _with('SELECT "Amplicon-Sample-Contig", "Depth of Coverage" FROM depths'),
    "defline_rejects": _with(
        """SELECT path, row, '>S1_QIA_1_contig size=' || coalesce(CAST(size AS VARCHAR), 'low')
                  AS line
           FROM headers WHERE "Contig" IS NULL"""
    ),
    "duplicate_contigs": _with(
        """SELECT "Amplicon-Sample-Contig", count(*) AS count FROM depths
           GROUP BY 1 HAVING count(*) > 1"""
    ),
    "nuc_sub_label": _with(
        """SELECT "Amplicon-Sample-Contig", "REF", "POS", "ALT",
                  "REF" || '-' || "POS" || '-' || "ALT" AS "NUC_SUB" FROM all_variants"""
    ),
    "primer_first_replace": _with(
        """SELECT a || '_LEFT' AS "RESPLICE_NAME", l AS "Start Position", a AS "Amplicon" FROM parts
           UNION ALL SELECT a || '_RIGHT', l + s - 20, a FROM parts WHERE k % 17 <> 5
           UNION ALL SELECT a || '_LEFT', l, a FROM parts WHERE k % 11 = 3
           UNION ALL SELECT a || '_LEFT', l + 3, a FROM parts WHERE k % 13 = 7
           UNION ALL SELECT a || '_LEFT_LEFT', l, a || '_LEFT' FROM parts WHERE k % 19 = 2
           UNION ALL SELECT a, l, a FROM parts WHERE k % 29 = 6"""
    ),
    "amplicon_span_table": _with("SELECT * FROM spans"),
    "annotation_codon": _with("SELECT * FROM codons"),
    "variants_with_span": _with(
        """SELECT v."Amplicon-Sample-Contig", v."NUC_SUB", v."REF_AA", v."ALT_AA", "Amplicon",
                  s."Gene", s."Start Position", s."Stop Position"
           FROM variants v LEFT JOIN spans s USING ("Amplicon")"""
    ),
    "variants_with_codon": _with(
        """SELECT v."Amplicon-Sample-Contig", v."NUC_SUB", v."REF_AA", v."ALT_AA", c."CODON"
           FROM variants v LEFT JOIN codons c ON v."NUC_SUB" = c."NUC_SUB" """
    ),
    "aa_label": _with(
        """SELECT "Amplicon-Sample-Contig", "NUC_SUB", "CODON", "Gene", "AA_SUB"
           FROM long_rows"""
    ),
    "mutation_class_flags": _with(
        """SELECT "REF_AA", "ALT_AA",
                  "REF_AA" IS NULL AND "ALT_AA" IS NULL AS "Noncoding",
                  CASE WHEN "REF_AA" IS NULL AND "ALT_AA" IS NULL THEN FALSE
                       ELSE "REF_AA" = "ALT_AA" END AS "Synonymous",
                  CASE WHEN "REF_AA" IS NULL AND "ALT_AA" IS NULL THEN FALSE
                       ELSE "REF_AA" <> "ALT_AA" END AS "Nonsynonymous",
                  count(*) AS rows
           FROM all_variants GROUP BY ALL"""
    ),
    "long_table": _with(f"SELECT {_LONG} FROM long_rows"),
    "staged_long_table": _with(f"SELECT {_LONG} FROM long_rows"),
    "contig_id_table": _with(
        'SELECT "Amplicon-Sample-Contig", "Amplicon", "Sample ID" FROM contigs'
    ),
    "nuc_list_count": _with(
        """SELECT "Amplicon-Sample-Contig", "Nucleotide Substitutions", "Nuc Mut Count"
           FROM lists"""
    ),
    "syn_list_count": _with(
        """SELECT "Amplicon-Sample-Contig", "Synonymous Mutations", "Syn count" FROM lists"""
    ),
    "nonsyn_list_count": _with(
        """SELECT "Amplicon-Sample-Contig", "Nonsynonymous Mutations", "Nonsyn count"
           FROM lists"""
    ),
    "contig_summary": _with(f"SELECT {_SHORT} FROM short"),
    "bucketed_summary": _with(f"SELECT {_SHORT} FROM short"),
    "depth_join": _with(
        """SELECT c."Amplicon-Sample-Contig", c."Amplicon", c."Sample ID", d."Depth of Coverage"
           FROM contigs c JOIN (SELECT DISTINCT * FROM depths) d USING ("Amplicon-Sample-Contig")
           WHERE d."Depth of Coverage" IS NOT NULL"""
    ),
    "crude_dnds_ratio": _with(
        """SELECT "Amplicon-Sample-Contig", "Gene", "Amplicon", "Start Position",
                  "Stop Position", "Syn count", "Nonsyn count", "Amplicon Length",
                  round("Crude dN/dS Ratio", 6) AS "Crude dN/dS Ratio" FROM ratios""",
        ratio_source="short",
    ),
    "haplotype_rank": _with(
        """SELECT "Haplotype", "Amplicon-Sample-Contig", "Depth of Coverage", "Gene",
                  "Amplicon", "Start Position", "Stop Position" FROM ranked"""
    ),
    "haplotype_report_table": _with(f"SELECT {_REPORT} FROM ranked"),
    "report_from_files": _with(f"SELECT {_REPORT} FROM ranked"),
    "ordered_report_files": _with(
        """SELECT "Haplotype", "Sample ID", "Start Position", "Depth of Coverage",
                  row_number() OVER (ORDER BY "Sample ID" ASC NULLS FIRST, "Start Position" ASC NULLS FIRST,
                      "Depth of Coverage" DESC NULLS FIRST, "Nonsyn count" DESC NULLS FIRST,
                      "Haplotype" ASC NULLS FIRST) AS number
           FROM ranked"""
    ),
    "selection_signal_bands": _with(
        """SELECT "Amplicon",
                  CASE WHEN "Crude dN/dS Ratio" < 1 THEN 'purifying'
                       WHEN "Crude dN/dS Ratio" > 1 THEN 'positive'
                       WHEN "Crude dN/dS Ratio" = 1 THEN 'neutral' END AS "Selection Signal",
                  count(*) AS rows
           FROM ratios GROUP BY ALL""",
        ratio_source="short",
    ),
}
