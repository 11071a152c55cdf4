"""Files that tasks list and open, against those that Spark's own sources find."""

import gzip
import os

import pytest
from pyspark.sql import functions as F
from test_ingest import add
from test_sources import HEADER, ODD_FILES

import haplospark as hs
from haplospark import schemas as S
from haplospark.sources import digests
from haplospark.sources import files as fs
from haplospark.sources.tables import header_problems

IVAR = "*_ivar.tsv*"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def tree(tmp_path):
    for name, text in ODD_FILES.items():
        data = text.encode()
        write(tmp_path / "a b+c%" / name, gzip.compress(data) if name.endswith(".gz") else data)
    for k, folder in enumerate(["x/y/z", "_old", ".hidden", "d é [1]", "k=_v", "_p=1"]):
        write(tmp_path / folder / f"S_ü{k}'~ {k}_h_ivar.tsv", HEADER + f"r\t{k}\tA\tC\tK\tN\n")
    for name in ("_S_A_h_ivar.tsv", ".S_A_h_ivar.tsv", "S_A_h_ivar.TSV", "S_A_h_ivar.tsv"):
        write(tmp_path / "x" / name, HEADER if name.startswith("_") else "")
    return str(tmp_path)


def test_listing_is_that_of_spark(spark, rows, tree):
    for pattern in (IVAR, "*_{ivar,other}.tsv", "x/y/*/*_ivar.tsv", "S_?[!A]*.tsv", "**/*_ivar.tsv"):
        ours, theirs = hs.list_files(spark, tree, pattern), hs.find_files(spark, tree, pattern)
        assert isinstance(ours, fs.ListedFiles) and rows(ours.listing()) == rows(theirs.listing())
        assert rows(ours.left_out(tree, pattern)) == rows(hs.files_left_out(spark, tree, pattern)) or "{" in pattern
    with pytest.raises(FileNotFoundError, match="nothing"):
        hs.list_files(spark, tree, "*_nothing.tsv")


def test_no_listing_on_the_driver(spark, tree):
    files = hs.list_files(spark, tree, IVAR)
    for found in (files.listing(), files.whole(), hs.list_files(spark, tree, "S_ü*_ivar.tsv", 0).lines()):
        assert "binaryFile" not in plan_of(found) and "FileScan text" not in plan_of(found)


@pytest.mark.parametrize("whole_file_bytes", [fs.WHOLE_FILE_BYTES, 60, 0])
def test_texts_are_those_of_spark(spark, rows, tree, whole_file_bytes):
    ours, theirs = (f(spark, tree, IVAR, whole_file_bytes) for f in (hs.list_files, hs.find_files))
    assert ours.count_large() == theirs.count_large() and rows(ours.large_paths()) == rows(theirs.large_paths())
    assert rows(ours.whole()) == rows(theirs.whole())
    assert rows(ours.lines(), "path", "line") == rows(theirs.lines(), "path", "line")
    assert rows(hs.read_variants(ours)) == rows(hs.read_variants(theirs))
    assert rows(header_problems(ours, S.VARIANT_FIELDS, [])) == rows(header_problems(theirs, S.VARIANT_FIELDS, []))


@pytest.mark.parametrize("block", ["1", "3", "8"])
def test_lines_at_every_cut(spark, tmp_path, block):
    """Ends of lines of all platforms, at all places of a block, and bytes that are not UTF-8."""
    text = b"\xef\xbb\xbfab\ncd\r\n\r\n\n\r\rlonger than a block\r\n\xff\xfe\x85x\x0b\x0c\n\xe2\x80\xa8y\rlast"
    for end in (b"", b"\r", b"\r\n"):
        write(tmp_path / "a.tsv", text + end)
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        theirs = hs.find_files(spark, str(tmp_path), "*.tsv", 0).lines()
        expected = [bytes(r[0]) for r in theirs.orderBy("position").select(F.col("line").cast("binary")).collect()]
        spark.conf.set("spark.sql.files.maxPartitionBytes", block)
        try:
            lines = hs.list_files(spark, str(tmp_path), "*.tsv", 0).lines()
            found = [bytes(r[0]) for r in lines.orderBy("position").select(F.col("line").cast("binary")).collect()]
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        assert found == expected


@pytest.mark.parametrize("whole_file_bytes", [1 << 25, 300, 0])
def test_equal_files(spark, tmp_path, whole_file_bytes):
    long = "".join(f"line {k} of a longer file\n" for k in range(400))
    for name, text in {"a": "x\n1\n", "b": "x\n2\n", "c": "x\n1\n", "d": long, "e": long, "f": long.replace("7 ", "8 ")}.items():
        (tmp_path / f"{name}.tsv").write_text(text)
    found = hs.redundant_files(hs.list_files(spark, str(tmp_path), "*.tsv", whole_file_bytes)).collect()
    assert sorted((os.path.basename(r["path"]), os.path.basename(r["same_as"])) for r in found) == [("c.tsv", "a.tsv"), ("e.tsv", "d.tsv")]


def test_only_files_of_a_shared_size_are_opened(spark, tmp_path, monkeypatch):
    for k in range(5):
        (tmp_path / f"{k}.tsv").write_text("x" * (k // 2 + 1))
    opened = []
    plain = digests.file_digests
    monkeypatch.setattr(digests, "file_digests", lambda files: opened.append(files.listing().count()) or plain(files))
    assert hs.redundant_files(hs.list_files(spark, str(tmp_path), "*.tsv")).count() == 2 and opened == [4]


def test_ingest_collects_no_names(spark, rows, tmp_path, monkeypatch):
    """Batches of the given length, opened by tasks; a late file with an early time is taken, too."""
    root, stage = tmp_path / "in", str(tmp_path / "stage")
    add(root, *range(1, 24))
    monkeypatch.setattr("haplospark.streaming.ingest.files_at", lambda *a: 1 / 0)
    assert hs.ingest_variants(spark, str(root), stage, files_per_batch=5).count() == 23
    batches = spark.read.parquet(stage).groupBy("batch").agg(F.countDistinct("path").alias("n"))
    assert rows(batches) == [(0, 5), (1, 5), (2, 5), (3, 5), (4, 3)]
    add(root / "late", 99)
    os.utime(root / "late" / "S1_Q_haplotype-99_ivar.tsv", (1e9, 1e9))
    assert hs.ingest_variants(spark, str(root), stage, files_per_batch=5).count() == 24
    assert hs.ingest_variants(spark, str(root), stage).count() == 24


def test_ingest_of_an_empty_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    assert hs.ingest_variants(spark, str(tmp_path / "in"), str(tmp_path / "stage")).count() == 0
    add(tmp_path / "in", 1)
    assert hs.ingest_variants(spark, str(tmp_path / "in"), str(tmp_path / "stage")).count() == 1
