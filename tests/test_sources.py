import gzip

import pytest

import haplospark as hs
from haplospark import schemas as S
from haplospark.sources import files as fs
from haplospark.sources.stage import is_complete, staged_arguments
from haplospark.sources.tables import header_problems

IVAR = "*_ivar.tsv"
HEADER = "REGION\tPOS\tREF\tALT\tREF_AA\tALT_AA\n"


@pytest.fixture
def tree(tmp_path):
    """A results folder with the irregularities a reader has to cope with."""
    root = tmp_path / "results"
    (root / "a b" / "deep").mkdir(parents=True)
    (root / ".hidden").mkdir()
    write(root / "S1_QIA_1_haplotype-1_ivar.tsv", HEADER + "r\t12\tA\tC\tK\tN\nr\t13\tA\tG\tNA\tNA\n")
    write(
        root / "a b" / "S1_QIA_1_haplotype-2_ivar.tsv",
        "EXTRA\tALT_AA\tREF_AA\tALT\tREF\tPOS\tREGION\r\nx\tN\tK\tC\tA\t12\tr\r\n\r\n"
        'y\t\t\t"+AC"\tA\t"14"\tr\r\n',
    )
    write(root / "a b" / "deep" / "007_QIA_2_haplotype-1_ivar.tsv", HEADER)
    write(root / "S+1_QIA_2_haplotype-1_ivar.tsv", "REGION\tPOS\tREF\tALT\nr\tx\tA\tC\n")
    write(root / ".x_QIA_2_haplotype-1_ivar.tsv", HEADER + "r\t1\tA\tC\tK\tN\n")
    write(root / ".hidden" / "S9_QIA_2_haplotype-1_ivar.tsv", HEADER + "r\t1\tA\tC\tK\tN\n")
    write(root / "S1_haplotype-9_ivar.tsv", HEADER + "r\t1\tA\tC\tK\tN\n")
    write(root / "S1_QIA_1_haplotype-3_IVAR.TSV", HEADER)
    write(root / "S1_QIA_1_haplotype-4_ivar.tsv", "")
    return str(root)


def write(path, text):
    path.write_bytes(text if isinstance(text, bytes) else text.encode())


def variant_rows(rows, df):
    return rows(df, S.CONTIG_ID, "POS", "REF", "ALT", "REF_AA", "ALT_AA")


EXPECTED = [
    ("QIA_1-S1-haplotype-1", 12, "A", "C", "K", "N"),
    ("QIA_1-S1-haplotype-1", 13, "A", "G", "NA", "NA"),
    ("QIA_1-S1-haplotype-2", 12, "A", "C", "K", "N"),
    ("QIA_1-S1-haplotype-2", 14, "A", "+AC", None, None),
    ("QIA_2-007-haplotype-1", None, None, None, None, None),
    ("QIA_2-S+1-haplotype-1", None, "A", "C", None, None),
]


@pytest.mark.parametrize("whole_file_bytes", [fs.WHOLE_FILE_BYTES, 60, 0])
def test_variants(spark, rows, tree, whole_file_bytes):
    """Read whole, partly by line, and all by line: the result is the same."""
    df = hs.read_variants(hs.find_files(spark, tree, IVAR, whole_file_bytes))
    assert df.columns == S.VARIANT_COLUMNS
    assert variant_rows(rows, df) == sorted(EXPECTED, key=repr)


ODD_FILES = {
    "S_A_mark_ivar.tsv": "\ufeff" + HEADER + "r\t1\tA\tC\tK\tN\n",
    "S_A_blank_ivar.tsv": "\n\n\r\n",
    "S_A_markonly_ivar.tsv": "\ufeff",
    "S_A_lone_ivar.tsv": HEADER.replace("\n", "\r") + "r\t2\tA\tC\tK\tN\rr\t3\tA\tC\tK\tN",
    "S_A_quoted_ivar.tsv": HEADER.replace("REGION", '"REGION"') + '"r"\t4\tA\t"C ""x"""\tK\tN\n',
    "S_A_spaced_ivar.tsv": "\n\n" + HEADER + "\n\nr\t5\tA\tC\tK\tN\n\n",
    "S_A_header_ivar.tsv": HEADER.strip(),
    "S_A_packed_ivar.tsv.gz": HEADER + "r\t6\tA\tC\tK\tN\n",
    "S_A_packedheader_ivar.tsv.gz": HEADER,
}


@pytest.mark.parametrize("whole_file_bytes", [fs.WHOLE_FILE_BYTES, 60, 0])
def test_odd_files_read_alike_at_every_size(spark, rows, tmp_path, whole_file_bytes):
    for name, text in ODD_FILES.items():
        data = text.encode()
        write(tmp_path / name, gzip.compress(data) if name.endswith(".gz") else data)
    files = hs.find_files(spark, str(tmp_path), "*_ivar.tsv*", whole_file_bytes)
    found = hs.read_variants(files, suffix="_ivar.tsv")
    assert rows(found, S.CONTIG, "REGION", "POS", "ALT") == sorted(
        [
            ("mark", "r", 1, "C"),
            ("lone", "r", 2, "C"),
            ("lone", "r", 3, "C"),
            ("quoted", "r", 4, 'C "x"'),
            ("spaced", "r", 5, "C"),
            ("header", None, None, None),
            ("packed.gz", "r", 6, "C"),
            ("packedheader.gz", None, None, None),
        ],
        key=repr,
    )
    problems = {r["path"].rsplit("/", 1)[1]: r["reason"] for r in header_problems(files, S.VARIANT_FIELDS, []).collect()}
    assert problems == {"S_A_blank_ivar.tsv": "no header", "S_A_markonly_ivar.tsv": "no header"}


@pytest.mark.parametrize("whole_file_bytes", [fs.WHOLE_FILE_BYTES, 0])
def test_odd_annotations_and_headers_read_alike(spark, rows, tmp_path, whole_file_bytes):
    ann = "A|m|M|S|g|t|x|p|1/1|c.1A>C|p.A10B|rest"
    body = f"ref\tpos\talt\tinfo_ANN\nA\t{{}}\tC\t{ann}\n"
    write(tmp_path / "a.tvcf.tsv", "\ufeff" + body.format(1))
    write(tmp_path / "b.tvcf.tsv.gz", gzip.compress(body.format(2).encode()))
    write(tmp_path / "c.tvcf.tsv", "\n")
    found = hs.read_annotations(hs.find_files(spark, str(tmp_path), "*.tvcf.tsv*", whole_file_bytes))
    assert rows(hs.mutation_codons(found)) == [("A-1-C", 10), ("A-2-C", 10)]
    write(tmp_path / "a.fasta", "\ufeff>S1_Q_1_haplotype-1 size=1\rACGT\r>S1_Q_1_haplotype-2 size=2")
    write(tmp_path / "b.fasta.gz", gzip.compress(b">S1_Q_1_haplotype-3 size=3\nA\n"))
    write(tmp_path / "c.fasta.gz", gzip.compress(b">S1_Q_1_haplotype-4 size=3\n\xff\n"))
    files = hs.find_files(spark, str(tmp_path), "*.fasta*", whole_file_bytes)
    assert [d for _, d in rows(hs.contig_depths(hs.read_deflines(files)))] == [1, 2, 3]
    assert hs.undecodable_files(files).count() == 1


def test_primers_that_do_not_parse(spark, rows, tmp_path):
    write(tmp_path / "p.bed", "r\t1\t 9 \tn\tA_LEFT\t1\tS\nr\t1\t9l\tn\tA_RIGHT\t1\tS\nr\t1\t2\n")
    path = str(tmp_path / "p.bed")
    assert rows(hs.read_primer_bed(spark, path), S.START, S.STOP, "RESPLICE_NAME") == [(1, 9, "A_LEFT")]
    assert rows(hs.rejected_primers(spark, path)) == [("r\t1\t2\t\t\t\t",), ("r\t1\t9l\tn\tA_RIGHT\t1\tS",)]


def test_large_files_are_scanned_twice_at_most(spark, tree, tmp_path):
    def text_scans(df):
        return df._jdf.queryExecution().executedPlan().toString().count("FileScan text")

    # heads are written while the plan is built, by one scan; the plan itself has another
    variants = hs.read_variants(hs.find_files(spark, tree, IVAR, 0))
    assert text_scans(variants) == 1
    write(tmp_path / "a_haplotypes.fasta", ">S1_Q_1_haplotype-1 size=1\nA\n")
    deflines = hs.read_deflines(hs.find_files(spark, str(tmp_path), "*.fasta", 0))
    assert text_scans(deflines) == 0 and deflines.count() == 1


def test_variants_over_many_splits(spark, rows, tmp_path):
    body = "".join(f"r\t{i}\tA\tC\tK\tN\n" for i in range(5000))
    write(tmp_path / "S1_A_haplotype-1_ivar.tsv", HEADER + body)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = hs.read_variants(hs.find_files(spark, str(tmp_path), IVAR, 0))
        found = [r.POS for r in df.select("POS").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted(found) == list(range(5000))


def test_null_value(spark, rows, tree):
    df = hs.read_variants(hs.find_files(spark, tree, IVAR), null_value="NA").where("POS = 13")
    assert rows(df, "REF_AA", "ALT_AA") == [(None, None)]


def test_rejected_names(spark, tree):
    found = hs.rejected_variant_files(hs.find_files(spark, tree, IVAR))
    assert [r.name for r in found.collect()] == ["S1_haplotype-9_ivar.tsv"]


def test_large_files_are_not_opened_by_the_whole_reader(spark, tree):
    # A sparse file larger than a single value may be: reading it whole would fail.
    with open(f"{tree}/S1_QIA_9_haplotype-1_ivar.tsv", "wb") as file:
        file.truncate(3 * 1024**3)
    files = hs.find_files(spark, tree, IVAR)
    assert files.whole().count() == 5
    assert files.count_large() == 1
    assert files.listing().count() == 6  # without the empty file


def test_listing(spark, rows, tree):
    def names(pattern):
        return [r[0] for r in rows(hs.find_files(spark, tree, pattern).listing(), "name")]

    found = names(IVAR)
    assert "S1_QIA_1_haplotype-2_ivar.tsv" in found
    assert not any(n.startswith(".") or n.endswith("TSV") for n in found)
    assert len(names("a b/*_ivar.tsv")) == 2
    assert names("**/*_ivar.tsv") == found
    with pytest.raises(ValueError):
        hs.find_files(spark, tree, "a/**/b/*.tsv")
    listed = hs.find_files(spark, tree, IVAR).listing()
    assert hs.duplicate_paths(listed).count() == 0
    assert hs.duplicate_paths(listed.union(listed.limit(1))).count() == 1


def test_listing_does_not_read_contents(spark, tree):
    listed = hs.find_files(spark, tree, IVAR).listing()
    assert "ReadSchema: struct<>" in listed._jdf.queryExecution().executedPlan().toString()


def test_no_files(spark, tree):
    with pytest.raises(FileNotFoundError, match="nothing"):
        hs.find_files(spark, tree, "*_nothing.tsv")
    with pytest.raises(FileNotFoundError, match="tvcf"):
        hs.find_sources(spark, tree, IVAR, "*.tvcf.tsv")
    assert len(hs.find_sources(spark, tree, IVAR, "*.TSV")) == 2


@pytest.mark.parametrize("whole_file_bytes", [fs.WHOLE_FILE_BYTES, 0])
def test_annotations(spark, rows, tmp_path, whole_file_bytes):
    ann = "A|m|M|S|g|t|x|p|1/1|c.1A>C|{}|rest"
    write(
        tmp_path / "one.tvcf.tsv",
        "ref\tpos\talt\tinfo_ANN\n"
        f"A\t12\tC\t{ann.format('p.Asp614Gly')}\n"
        f"A\t13\tG\t{ann.format('p.Lys3_Asp5del')}\n"
        f"A\t14\tG\t{ann.format('p.?')}\n"
        "A\t15\tG\ttoo|short\n"
        f"A\t16\t\t{ann.format('p.Asp1Gly')}\n"
        "A\t17\tT\t\n",
    )
    write(
        tmp_path / "two.tvcf.tsv",
        "info_ANN\tid\talt\tpos\tref\n"
        f"{ann.format('p.Asp614Gly')}\t.\tC\t12\tA\n"
        f"{ann.format('p.Asp7Gly')}\t.\tC\t12\tA\n",
    )
    write(tmp_path / "three.tvcf.tsv", f"ref\tpos\tinfo_ANN\nA\t1\t{ann.format('p.A1B')}\n")
    write(tmp_path / "four.tvcf.tsv", "ref\tpos\talt\tNUC_SUB\nA\t1\tC\tA-1-C\n")
    write(tmp_path / "five.tvcf.tsv", "ref\tpos\talt\tinfo_ANN\n")
    found = hs.read_annotations(
        hs.find_files(spark, str(tmp_path), "*.tvcf.tsv", whole_file_bytes)
    )
    assert rows(hs.mutation_codons(found)) == [
        ("A-12-C", 614),
        ("A-12-C", 7),
        ("A-13-G", 35),
    ]


@pytest.mark.parametrize("whole_file_bytes", [fs.WHOLE_FILE_BYTES, 0])
def test_depths(spark, rows, tmp_path, whole_file_bytes):
    write(
        tmp_path / "a_haplotypes.fasta",
        ">S1_Q_1_haplotype-1 size=120\r\nACGT\r\nAC\r\n>S1_Q_1_haplotype-2 size=7\r\nAC\r\n"
        ">S1_Q_1_haplotype-2 size=9\r\nAC\r\n>S1_Q_1_haplotype-3 size=9\r\nA\r\n"
        ">S1_Q_1_haplotype-3 size=many\r\nA\r\n>S1_Q_1_contig size=9\r\n",
    )
    write(tmp_path / "b_haplotypes.fasta", ">S1_Q_1_haplotype-1 size=120\nA\n>S1_Q_1_haplotype-2 size=1\n")
    write(tmp_path / "c_haplotypes.fasta", b">S1_Q_1_haplotype-8 size=120\nA\n\xff\xfe\n")
    files = hs.find_files(spark, str(tmp_path), "*_haplotypes.fasta", whole_file_bytes)
    deflines = hs.read_deflines(files)
    assert rows(hs.contig_depths(deflines)) == [
        ("Q_1-S1-haplotype-1", 120),
        ("Q_1-S1-haplotype-1", 120),
        ("Q_1-S1-haplotype-2", 1),
        ("Q_1-S1-haplotype-2", 9),
        ("Q_1-S1-haplotype-3", None),
    ]
    assert rows(hs.rejected_deflines(deflines), "line") == [(">S1_Q_1_contig size=9",)]
    skipped = hs.undecodable_files(files)
    assert [r.path.rsplit("/", 1)[1] for r in skipped.collect()] == ["c_haplotypes.fasta"]
    twice = hs.duplicate_keys(hs.contig_depths(deflines), S.CONTIG_ID)
    assert twice.count() == 2


def test_last_defline_wins_over_many_splits(spark, tmp_path):
    lines = "".join(f">S1_Q_1_haplotype-{i % 7} size={i}\nACGT\n" for i in range(4000))
    write(tmp_path / "a_haplotypes.fasta", lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        deflines = hs.read_deflines(
            hs.find_files(spark, str(tmp_path), "*_haplotypes.fasta", 0)
        )
        assert deflines.rdd.getNumPartitions() > 8
        found = {r[0]: r[1] for r in hs.contig_depths(deflines).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    last = {f"Q_1-S1-haplotype-{i % 7}": i for i in range(4000)}
    assert found == last


def test_stage_resume(spark, tmp_path):
    path = str(tmp_path / "stage")
    built = []

    def build(n):
        def run():
            built.append(n)
            return spark.range(n)

        return run

    assert not is_complete(spark, path)
    assert hs.stage(spark, path, build(3), resume=True).count() == 3
    assert is_complete(spark, path)
    assert hs.stage(spark, path, build(5), resume=True).count() == 3
    assert hs.stage(spark, path, build(5), resume=False).count() == 5
    (tmp_path / "stage" / "_SUCCESS").unlink()
    assert hs.stage(spark, path, build(2), resume=True).count() == 2
    assert hs.stage(spark, path, build(7), resume=True, arguments="other").count() == 7
    assert staged_arguments(spark, path) == "other"
    assert built == [3, 5, 2, 7]
    assert any(p.name.endswith(".zstd.parquet") for p in (tmp_path / "stage").iterdir())
