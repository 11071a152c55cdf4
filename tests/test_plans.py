"""Shapes of physical plans that have to hold at any size of data."""

import pytest
from pyspark.sql import functions as F

import haplospark as hs
from haplospark import schemas as S
from haplospark.operators import ranking
from haplospark.plans import carriers, catalog
from haplospark.plans.catalog import REGISTRY
from haplospark.sources.variants import variants_of_files

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", list(REGISTRY))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(REGISTRY[name](spark, SF))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "SinglePartition"):
        assert node not in plan, f"{node} in {name}"


def test_whole_files_are_parsed_without_a_shuffle(spark, tmp_path):
    (tmp_path / "S_A_h_ivar.tsv").write_text("REGION\tPOS\nr\t1\n")
    plan = plan_of(hs.read_variants(hs.find_files(spark, str(tmp_path), "*_ivar.tsv")))
    assert "Exchange" not in plan and "Join" not in plan


def test_key_of_a_file_is_made_before_its_rows(spark):
    files = spark.createDataFrame([("file:/S_A_h_ivar.tsv", "REGION\tPOS\nr\t1\n")], "path string, text string")
    plan = plan_of(variants_of_files(files))
    assert plan.index("Generate explode") < plan.index("UrlCodec")


def test_summary_reads_the_long_table_once(spark):
    long = hs.classify_mutations(
        carriers.variants(spark, SF),
        spark.createDataFrame([], "Gene string, Amplicon string, `Start Position` bigint, `Stop Position` bigint"),
        spark.createDataFrame([], "NUC_SUB string, CODON bigint"),
    )
    plan = plan_of(hs.mutation_lists(long))
    assert plan.count("lineitem.parquet") == 1
    assert plan.count("Aggregate(") <= 6


def test_variants_cross_the_network_once(spark):
    """From distinct variants to finished lists: dealt by contig and band, then pieces by contig."""
    variants = spark.createDataFrame(carriers.variants(spark, SF).rdd, carriers.variants(spark, SF).schema)
    spans = F.broadcast(spark.createDataFrame([], "Gene string, Amplicon string, `Start Position` bigint, `Stop Position` bigint"))
    codons = F.broadcast(spark.createDataFrame([], "NUC_SUB string, CODON bigint"))
    plan = plan_of(hs.mutation_lists(hs.classify_mutations(variants, spans, codons)))
    assert plan.count("Exchange hashpartitioning") == 2


def test_lists_go_on_with_mutations_joined_to_large_lookups(spark):
    """Rows and lookup once for each join, rows by contig and band, then pieces by contig."""
    variants = spark.createDataFrame(carriers.variants(spark, SF).rdd, carriers.variants(spark, SF).schema)
    spans = spark.createDataFrame([], "Gene string, Amplicon string, `Start Position` bigint, `Stop Position` bigint")
    codons = spark.createDataFrame([], "NUC_SUB string, CODON bigint")
    long = hs.classify_mutations(variants, spans.hint("merge"), codons.hint("merge"))
    assert plan_of(hs.mutation_lists(long)).count("Exchange hashpartitioning") == 6


def test_ranking_writes_keys_only(spark, monkeypatch):
    written = []
    real = ranking.materialize
    monkeypatch.setattr(ranking, "materialize", lambda df, label: written.append(df.columns) or real(df, label))
    assert "NUC_SUB" not in plan_of(REGISTRY["haplotype_rank"](spark, SF))
    assert len(written) == 1 and not set(written[0]) & set(S.MUTATION_COLUMNS)
    report = REGISTRY["haplotype_report_table"](spark, SF)
    assert report.columns == S.REPORT_COLUMNS and not set(written[1]) & set(S.MUTATION_COLUMNS)


def test_distinct_combines_before_its_shuffle(spark):
    plan = plan_of(carriers.variants(spark, SF).select(*S.VARIANT_COLUMNS).distinct())
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "HashAggregate" in line)
    assert "Exchange" in lines[at + 1] and "HashAggregate" in lines[at + 2]


def test_names_are_made_behind_the_join_of_orders_and_line_items(spark):
    plan = plan_of(carriers.variants(spark, SF).select(*S.VARIANT_COLUMNS))
    assert plan.index("haplotype-") < plan.index("Join")


def test_depth_comes_before_the_span(spark, monkeypatch):
    written = []
    monkeypatch.setattr(catalog, "materialize", lambda df, label: written.append(df) or df)
    REGISTRY["haplotype_rank"](spark, SF)
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    # the outermost join is that with the spans, which is a left one
    assert plan[plan.index("Join ") :].startswith("Join LeftOuter")


def test_scans_read_only_the_columns_in_use(spark):
    plan = plan_of(carriers.variants(spark, SF).select("POS", S.CONTIG_ID))
    assert "l_returnflag" not in plan and "o_totalprice" not in plan


def test_texts_travel_packed_to_large_lookups(spark):
    variants = spark.createDataFrame(carriers.variants(spark, SF).rdd, carriers.variants(spark, SF).schema)
    spans = spark.createDataFrame([], "Gene string, Amplicon string, `Start Position` bigint, `Stop Position` bigint")
    codons = spark.createDataFrame([], "NUC_SUB string, CODON bigint")
    long = hs.classify_mutations(variants, spans.hint("merge"), codons.hint("merge"))
    plan = long._jdf.queryExecution().optimizedPlan().toString()
    assert "_plain" in plan and plan.index("REF_AA") < plan.index("Join LeftOuter")
    below = plan[plan.index("Join LeftOuter") :].splitlines()
    joins = [k for k, line in enumerate(below) if "Join LeftOuter" in line]
    assert not any("REF_AA#" in line.split(" AS ")[-1] for line in below[: joins[1] + 1])
