"""Tables laid out for their readers: buckets, clusters, ordered files, equal files."""

import re
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import haplospark as hs
from haplospark import schemas as S
from haplospark.operators.mutations import label_variants
from haplospark.operators.summary import mutation_lists
from haplospark.plans import carriers
from haplospark.plans.catalog import _long, _report
from haplospark.scratch import materialize, scratch_folder
from haplospark.sources import digests
from haplospark.sources.layout import write_bucketed
from haplospark.sources.stage import write_report

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows_scanned(df):
    """Rows that the scans of a query gave on, after row groups were skipped."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    scans = plan.collectLeaves() if "AdaptiveSparkPlan" not in plan.nodeName() else plan.executedPlan().collectLeaves()
    return sum(scans.apply(k).metrics().apply("numOutputRows").value() for k in range(scans.size()))


@pytest.mark.parametrize("dealt", [True, False])
def test_lists_from_buckets_need_one_exchange_less(spark, rows, tmp_path, dealt):
    long = materialize(_long(spark, SF), "long")
    plain = mutation_lists(long, read=True)
    source = long.repartition(8, S.CONTIG_ID, S.BAND) if dealt else long
    lists = mutation_lists(write_bucketed(source, str(tmp_path / "b"), [S.CONTIG_ID, S.BAND], dealt))
    assert plan_of(lists).count("Exchange") == plan_of(plain).count("Exchange") - 1 == 1
    assert rows(lists) == rows(plain)
    assert len(list((tmp_path / "b").glob("*.parquet"))) <= 8
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("haplospark_")]


def test_depths_join_buckets_without_another_exchange_of_the_lists(spark, tmp_path):
    table = write_bucketed(_long(spark, SF), str(tmp_path / "b"), [S.CONTIG_ID, S.BAND], True)
    depths = materialize(carriers.contigs(spark, SF).select(S.CONTIG_ID, F.lit(1).alias(S.DEPTH)), "depths")
    joined = mutation_lists(table).join(depths.hint("merge"), S.CONTIG_ID)
    assert plan_of(joined).count("Exchange hashpartitioning") == 2


def test_region_reads_under_a_tenth(spark, tmp_path):
    variants = materialize(label_variants(carriers.variants(spark, "/root/testdata/sf0.01")).drop(S.BAND), "labelled")
    total = variants.count()
    path = str(tmp_path / "by-position")
    hs.write_clustered(variants, path, ["POS", S.AMPLICON, S.CONTIG_ID], group_rows=500)
    wanted = hs.read_region(spark.read.parquet(path), start=1000, stop=1040)
    assert 0 < wanted.count() == variants.where("POS BETWEEN 1000 AND 1040").count()
    assert rows_scanned(hs.read_region(spark.read.parquet(path), start=1000, stop=1040).select("POS", "ALT")) < 0.1 * total

    path = str(tmp_path / "by-amplicon")
    hs.write_clustered(variants, path, [S.AMPLICON, "POS", S.CONTIG_ID], group_rows=500)
    one = hs.read_region(spark.read.parquet(path), amplicon="QIA_700")
    assert 0 < one.count() == variants.where(F.col(S.AMPLICON) == "QIA_700").count()
    assert rows_scanned(hs.read_region(spark.read.parquet(path), amplicon="QIA_700").select("POS", "ALT")) < 0.1 * total


def test_report_in_order_over_many_files(spark, tmp_path):
    report = _report(spark, SF)
    write_report(report, str(tmp_path / "r"), file_rows=60)
    written = hs.read_stage(spark, str(tmp_path / "r"))
    files = hs.ordered_files(written).orderBy("file").collect()
    assert len(files) >= 20 and all(f["in_order"] and f["rows"] <= 60 for f in files)
    assert [f["before"] for f in files] == [sum(f["rows"] for f in files[:k]) for k in range(len(files))]
    numbered = hs.numbered_as_written(written).orderBy("number").drop("number", S.SIGNAL)
    assert numbered.collect() == hs.sort_report(report).collect()


def test_files_out_of_order_are_found(spark, tmp_path):
    report = materialize(_report(spark, SF), "report")
    write_report(report.repartition(5), str(tmp_path / "mixed"))
    assert not all(f["in_order"] for f in hs.ordered_files(hs.read_stage(spark, str(tmp_path / "mixed"))).collect())
    backwards = hs.sort_report(report).coalesce(1).select("*")
    write_report(backwards, str(tmp_path / "good"))
    assert all(f["in_order"] for f in hs.ordered_files(hs.read_stage(spark, str(tmp_path / "good"))).collect())


def names(found):
    return sorted(tuple(re.sub(r".*/", "", x) for x in (r["path"], r["same_as"])) for r in found.collect())


@pytest.mark.parametrize("whole_file_bytes", [1 << 25, 300, 0])
def test_equal_files_are_named(spark, tmp_path, whole_file_bytes):
    long = "".join(f"line {k} of a longer file\n" for k in range(400))
    texts = {
        "a": "x\n1\n", "b": "x\n2\n", "c_of_a": "x\n1\n", "d": long, "e_of_d": long, "f_of_d": long,
        "g": long.replace("line 7 ", "line 8 "), "h": "".join(reversed(long.splitlines(True))), "i": "alone",
    }
    for name, text in texts.items():
        (tmp_path / f"{name}.tsv").write_text(text)
    found = hs.redundant_files(hs.find_files(spark, str(tmp_path), "*.tsv", whole_file_bytes))
    assert names(found) == [("c_of_a.tsv", "a.tsv"), ("e_of_d.tsv", "d.tsv"), ("f_of_d.tsv", "d.tsv")]


def test_digests_do_not_depend_on_blocks(spark, tmp_path):
    (tmp_path / "a.tsv").write_text("".join(f"line {k}\n" for k in range(5000)))
    seen, before = set(), spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "4k", "999"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            files = hs.find_files(spark, str(tmp_path), "*.tsv", 0)
            assert size == "128m" or files.lines().select("position.block").distinct().count() > 5
            seen.add(digests.file_digests(files).first()["digest"])
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(seen) == 1


def test_files_with_a_size_of_their_own_are_not_opened(spark, tmp_path, monkeypatch):
    for k in range(5):
        (tmp_path / f"{k}.tsv").write_text("x" * (k + 1))
    monkeypatch.setattr(digests, "file_digests", lambda files: 1 / 0)
    assert hs.redundant_files(hs.find_files(spark, str(tmp_path), "*.tsv")).count() == 0


class _Session:
    """What ``scratch_folder`` asks of a session."""

    def __init__(self, master, warehouse, folder=None):
        self.sparkContext = SimpleNamespace(master=master)
        known = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": warehouse}
        self.conf = SimpleNamespace(get=lambda key, *default: known[key])


def test_scratch_is_shared_or_an_error(spark):
    assert scratch_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_folder(_Session("yarn", "file:/w", "hdfs://n/c")) == "hdfs://n/c"
    assert scratch_folder(_Session("yarn", "s3a://b/w")).startswith("s3a://b/w/scratch-")
    for master in ("yarn", "local-cluster[2,1,1024]", "spark://h:7077"):
        for warehouse in ("file:/w", "/w"):
            with pytest.raises(RuntimeError, match="checkpoint"):
                scratch_folder(_Session(master, warehouse))
