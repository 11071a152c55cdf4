"""The benchmark tables shaped like the inputs of a report.

An order stands for a contig, its customer for the amplicon, and its line items for the
contig's variants; a part stands for an amplicon with its primers, and gives the annotations of the substitutions at its
position. Every view is a query over whole tables, so it grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from haplospark import schemas as S
from haplospark.sources.files import BYTE_ORDER_MARK


#: Columns of the benchmark tables that the views use, declared to save a look at the files.
TABLES = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_returnflag string, l_linestatus string",
    "part": "p_partkey bigint, p_type string, p_size int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def _text(name: str):
    return F.col(name).cast("string")


def _contig_names() -> list[Column]:
    """The parts of a contig key, from an order."""
    amplicon = F.concat(F.lit("QIA_"), _text("o_custkey"))
    sample = F.concat(F.lit("S"), (F.col("o_orderkey") % 12).cast("string"))
    contig = F.concat(F.lit("haplotype-"), _text("o_orderkey"))
    return [
        amplicon.alias(S.AMPLICON),
        sample.alias(S.SAMPLE),
        contig.alias(S.CONTIG),
        F.concat(amplicon, F.lit("-"), sample, F.lit("-"), contig).alias(S.CONTIG_ID),
    ]


def contigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the parts of a contig key."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", *_contig_names()
    )


def _variant_cells() -> list[Column]:
    """The cells of a variant, from a line item; all null where there is none."""
    position = F.col("l_partkey")
    bases = F.lit("ACGT")
    flag = F.col("l_returnflag")
    coding = (flag != "N") & (F.col("l_linenumber") != 7)
    return [
        position.alias("POS"),
        F.substring(bases, (1 + position % 4).cast("int"), F.lit(1)).alias("REF"),
        F.substring(
            bases,
            (1 + (position + 1 + F.col("l_suppkey") % 3) % 4).cast("int"),
            F.lit(1),
        ).alias("ALT"),
        F.nullif(flag, F.lit("N")).alias("REF_AA"),
        F.when(coding & (F.col("l_linestatus") == "F"), flag)
        .when(coding, "Q")
        .alias("ALT_AA"),
    ]


def mutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as variant cells, still with their order key."""
    region = F.lit("NC_045512.2").alias("REGION")
    return table(spark, sf_dir, "lineitem").select("l_orderkey", region, *_variant_cells())


def variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Variant rows of every contig; one without line items has a single row of nulls.

    Orders and line items meet as they are, so that only keys and flags are shuffled; names
    and cells are made from what has met.
    """
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    region = F.when(F.col("l_orderkey").isNotNull(), "NC_045512.2").alias("REGION")
    return (
        orders.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(region, *_variant_cells(), *_contig_names())
        .select(*S.VARIANT_COLUMNS)
    )


def variant_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as whole variant tables, a text per contig and 65536 positions.

    Odd contigs have their columns in another order and one column more; every fifth text
    starts with a byte-order mark, as files may.
    """
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in S.VARIANT_FIELDS}
    plain = list(S.VARIANT_FIELDS)
    other = ["ALT_AA", "EXTRA", "REF_AA", "ALT", "REF", "POS", "REGION"]
    line = F.when(
        F.col("l_orderkey") % 2 == 1,
        F.concat_ws("\t", *[cells.get(c, F.lit("x")) for c in other]),
    ).otherwise(F.concat_ws("\t", *[cells[c] for c in plain]))
    bodies = (
        mutations(spark, sf_dir)
        .select("l_orderkey", F.floor(F.col("POS") / 65536).alias("block"), line.alias("line"))
        .distinct()
        .groupBy("l_orderkey", "block")
        .agg(F.concat_ws("\n", F.collect_list("line")).alias("body"))
        .hint("merge")
    )
    header = F.when(F.col("o_orderkey") % 2 == 1, "\t".join(other)).otherwise("\t".join(plain))
    folder = F.concat(F.lit("file:/run%20"), F.coalesce(F.col("block"), F.lit(0)).cast("string"))
    name = F.concat(F.concat_ws("_", S.SAMPLE, S.AMPLICON, S.CONTIG), F.lit("_ivar.tsv"))
    return (
        contigs(spark, sf_dir)
        .join(bodies, F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .select(
            F.concat_ws("/", folder, name).alias("path"),
            F.concat(
                F.when(F.col("o_orderkey") % 5 == 2, BYTE_ORDER_MARK).otherwise(""),
                F.concat_ws("\n", header, "body"),
            ).alias("text"),
        )
    )


def primer_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A left and a right primer per part, with the irregularities of real panels.

    Some parts have primers of another panel, no right primer, a second left primer, a second
    gene, no gene, or a primer name without a side.
    """
    key, size = F.col("p_partkey"), F.col("p_size").cast("bigint")
    panel = F.when(key % 23 == 4, "OTHER_").otherwise("QIA_")
    amplicon = F.concat(panel, key.cast("string"))
    gene = F.when(key % 10 == 3, None).when(key % 3 == 0, "S").when(key % 3 == 1, "N").otherwise(
        "ORF1a"
    )
    left, right = key * 400 + 1, key * 400 + 1 + size

    def primer(condition, name, start, stop, its_gene):
        return F.when(
            condition,
            F.struct(
                F.lit("NC_045512.2").alias("Ref"),
                start.alias(S.START),
                stop.alias(S.STOP),
                F.concat(F.lit("primer_"), key.cast("string")).alias("NAME"),
                name.alias("RESPLICE_NAME"),
                F.lit("1").alias("INDEX"),
                its_gene.alias(S.GENE),
            ),
        )

    always = F.lit(True)
    left_name = F.concat(amplicon, F.lit("_LEFT"))
    right_name = F.concat(amplicon, F.lit("_RIGHT"))
    primers = F.array(
        primer(always, left_name, left, left + 20, gene),
        primer(key % 17 != 5, right_name, right - 20, right, gene),
        primer(key % 11 == 3, left_name, left, left + 20, F.lit("ORF9b")),
        primer(key % 13 == 7, left_name, left + 3, left + 23, gene),
        primer(key % 19 == 2, F.concat(left_name, F.lit("_LEFT")), left, left + 20, gene),
        primer(key % 29 == 6, amplicon, left, right, F.lit("M")),
    )
    return (
        table(spark, sf_dir, "part")
        .select(F.inline(primers))
        .where("RESPLICE_NAME IS NOT NULL")
    )


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotated substitutions, from the parts at the positions of the line items.

    Annotations outside of genes are short, some others have no codon, and some substitutions
    have two codons.
    """
    size = F.col("p_size")
    number = size.cast("string")
    effect = F.concat_ws(
        "|",
        F.col("ALT"),
        F.lit("missense_variant|MODERATE|S|GU280|transcript|T1|protein_coding|1/1|c.1A>C"),
    )
    change = (
        F.when(size % 9 == 0, "p.?")
        .when(
            F.col("p_type") == "PROMO",
            F.concat(F.lit("p.Lys"), number, F.lit("_Asp"), number, F.lit("del")),
        )
        .otherwise(F.concat(F.lit("p.Lys"), number, F.lit("Asn")))
    )
    full = F.concat(effect, F.lit("|"), change, F.lit("|100/4000"))
    coding = F.col("p_type").isin("ECONOMY", "PROMO", "SMALL")
    texts = F.array(
        F.when(coding, full).otherwise("C|intergenic_region|MODIFIER"),
        F.when(
            F.col("p_partkey") % 29 == 1,
            F.concat(effect, F.lit("|p.Asp7"), number, F.lit("Gly")),
        ),
    )
    return (
        mutations(spark, sf_dir)
        .select("POS", "REF", "ALT")
        .distinct()
        .join(table(spark, sf_dir, "part"), F.col("POS") == F.col("p_partkey"))
        .select(
            F.col("REF").alias("ref"),
            F.col("POS").cast("string").alias("pos"),
            F.col("ALT").alias("alt"),
            F.explode(texts).alias("info_ANN"),
        )
        .where("info_ANN IS NOT NULL")
    )


def annotation_files(spark: SparkSession, sf_dir: str, complete: bool = False) -> DataFrame:
    """Annotations of each position as a whole file; unless ``complete``, some miss a needed column.

    A position has one reference base, three alternatives and two annotations at most, so a
    file has no more than six distinct lines.
    """
    by_position = F.col("pos").cast("bigint")
    swapped = by_position % 2 == 0
    line = F.when(
        swapped, F.concat_ws("\t", "info_ANN", F.lit("PASS"), "alt", "ref", "pos")
    ).otherwise(F.concat_ws("\t", "pos", "ref", "alt", "info_ANN"))
    header = (
        F.when((by_position % 14 == 3) & F.lit(not complete), "\t".join(["pos", "ref", "other", "info_ANN"]))
        .when(swapped, "\t".join(["info_ANN", "filter", "alt", "ref", "pos"]))
        .otherwise("\t".join(["pos", "ref", "alt", "info_ANN"]))
    )
    return (
        annotations(spark, sf_dir)
        .select("pos", line.alias("line"))
        .distinct()
        .groupBy("pos")
        .agg(F.collect_list("line").alias("lines"))
        .select(
            F.concat(F.lit("file:/run/"), "pos", F.lit(".tvcf.tsv")).alias("path"),
            F.concat(header, F.lit("\r\n"), F.concat_ws("\r\n", "lines")).alias("text"),
        )
    )


def deflines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header lines of the contigs, in several files per run.

    Orders with status P have no numeric size. Some contigs are repeated later in their
    file, some turn up in a second file with another size, some headers hold no key.
    """
    key = F.col("o_orderkey")
    size = F.floor("o_totalprice")
    name = F.concat_ws("_", S.SAMPLE, S.AMPLICON, S.CONTIG)

    def line(label, value):
        return F.concat(F.lit(">"), label, F.lit(" size="), value)

    def header(condition, path, row, text):
        return F.when(
            condition,
            F.struct(
                F.concat(F.lit("file:/run/"), path.cast("string")).alias("path"),
                row.alias("position"),
                text.alias("line"),
            ),
        )

    file_number = F.col("o_custkey") % 40
    value = F.when(F.col("o_orderstatus") == "P", "low").otherwise(size.cast("string"))
    headers = F.array(
        header(F.lit(True), file_number, key, line(name, value)),
        header(
            key % 37 == 5, file_number, key + 1_000_000_000, line(name, (key % 97).cast("string"))
        ),
        header(key % 41 == 7, file_number + 100, key, line(name, (size + 1).cast("string"))),
        header(key % 53 == 9, file_number + 200, key, line(F.lit("S1_QIA_1_contig"), value)),
    )
    return contigs(spark, sf_dir).select(F.inline(headers)).where("path IS NOT NULL")


def fasta_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header lines as whole FASTA texts, those of 4096 orders and one run in a file each.

    An order has four headers at most.
    """
    order = F.floor(F.col("position") % 1_000_000_000 / 4096)
    entry = F.concat("line", F.lit("\nACGT\n"))
    return (
        deflines(spark, sf_dir)
        .groupBy("path", order.alias("order"))
        .agg(F.array_sort(F.collect_list(F.struct("position", entry.alias("entry")))).alias("e"))
        .select(
            F.concat("path", F.lit("/"), F.col("order"), F.lit("_haplotypes.fasta")).alias("path"),
            F.concat_ws("", F.col("e.entry")).alias("text"),
        )
    )


def damaged_fasta_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a byte that is not UTF-8 at the end of the texts that start with S1."""
    broken = F.concat(F.col("text").cast("binary"), F.unhex(F.lit("FF"))).cast("string")
    text = F.when(F.col("text").startswith(">S1_"), broken).otherwise(F.col("text"))
    return fasta_files(spark, sf_dir).withColumn("text", text)


def variant_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths of variant tables; every eleventh order's name lacks the amplicon."""
    whole = F.concat_ws("_", S.SAMPLE, S.AMPLICON, S.CONTIG)
    short = F.concat_ws("_", S.SAMPLE, S.CONTIG)
    name = F.when(F.col("o_orderkey") % 11 == 3, short).otherwise(whole)
    return contigs(spark, sf_dir).select(
        F.concat(F.lit("file:/run/"), name, F.lit("_ivar.tsv")).alias("path")
    )
