"""Streaming ingest: every file once, also when a run is killed."""

import pytest
from pyspark.errors import StreamingQueryException

import haplospark as hs
from haplospark import schemas as S
from haplospark.streaming import ingest

HEADER = "REGION\tPOS\tREF\tALT\tREF_AA\tALT_AA\n"


def add(folder, *numbers, lines=1):
    folder.mkdir(parents=True, exist_ok=True)
    for k in numbers:
        body = "".join(f"r\t{10 * k + n}\tA\tC\tK\tN\n" for n in range(lines))
        (folder / f"S1_Q_haplotype-{k}_ivar.tsv").write_text(HEADER + body)


def test_growing_folder(spark, rows, tmp_path):
    """Three calls, large files among them, give the rows of one read of all files."""
    root, stage = tmp_path / "in", str(tmp_path / "stage")
    add(root / "a [1]", 1, 2)
    add(root / "b", 3, lines=50)
    options = {"files_per_batch": 2, "whole_file_bytes": 200}
    first = hs.ingest_variants(spark, str(root), stage, **options)
    assert first.columns == S.VARIANT_COLUMNS and first.count() == 52
    add(root / "c", 4, 5, 6)
    assert hs.ingest_variants(spark, str(root), stage, **options).count() == 55
    again = hs.ingest_variants(spark, str(root), stage, **options)
    assert rows(again) == rows(hs.read_variants(hs.find_files(spark, str(root), "*_ivar.tsv")))
    batches = sorted(p.name for p in (tmp_path / "stage").glob("batch=*"))
    assert batches == ["batch=0", "batch=1", "batch=2", "batch=3"]


def test_killed_between_write_and_commit(spark, rows, tmp_path, monkeypatch):
    root, stage = tmp_path / "in", str(tmp_path / "stage")
    add(root, 1, 2, 3)
    with monkeypatch.context() as broken:
        # after the rows are written, before the stream notes that the batch is done
        broken.setattr(ingest, "check_share", lambda *a: 1 / 0)
        with pytest.raises(StreamingQueryException):
            hs.ingest_variants(spark, str(root), stage)
    assert (tmp_path / "stage" / "batch=0" / "_SUCCESS").exists()
    add(root, 4)
    found = hs.ingest_variants(spark, str(root), stage)
    assert rows(found, S.CONTIG, "POS") == [(f"haplotype-{k}", 10 * k) for k in (1, 2, 3, 4)]


def test_bad_positions(spark, rows, tmp_path):
    root, stage = tmp_path / "in", str(tmp_path / "stage")
    add(root, 1)
    (root / "S1_Q_haplotype-9_ivar.tsv").write_text(HEADER + "r\t12a\tA\tC\tK\tN\n")
    with pytest.raises(StreamingQueryException, match="1 of 2 cells in POS"):
        hs.ingest_variants(spark, str(root), stage, most_bad=0.1)
    assert hs.ingest_variants(spark, str(root), stage, most_bad=0.5).count() == 2
    found = hs.bad_positions(hs.read_ingested(spark, stage))
    assert rows(found, "line", "reason") == [("POS = 12a", "not an integer")]
