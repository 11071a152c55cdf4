import pytest
from pyspark.sql import functions as F

from haplospark import schemas as S
from haplospark.functions.keys import (
    file_name,
    with_defline_key,
    with_file_key,
    without_defline_key,
    without_file_key,
)
from haplospark.functions.numeric import joined_digits, jukes_cantor, tolerant_int
from haplospark.operators.depths import defline_depth


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def paths(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "path string")


@pytest.mark.parametrize(
    ("path", "name"),
    [
        ("file:/a/b.tsv", "b.tsv"),
        ("file:/a%20b/c%20d.tsv", "c d.tsv"),
        ("file:/a/S+1_x.tsv", "S+1_x.tsv"),
        ("file:/a/100%25.tsv", "100%.tsv"),
    ],
)
def test_file_name(spark, path, name):
    assert one(spark, file_name(F.lit(path))) == name


@pytest.mark.parametrize(
    ("name", "key"),
    [
        ("S1_QIA_42_haplotype-1_ivar.tsv", ("QIA_42", "S1", "haplotype-1")),
        ("007_A_h_ivar.tsv", ("A", "007", "h")),
        # The sample's text is removed wherever it occurs.
        ("12_QIA_112_haplotype-3_ivar.tsv", ("QIA_1", "12", "haplotype-3")),
        ("S_A_B_C_D_h1_ivar.tsv", ("A_B_C_D", "S", "h1")),
        # Only one separator goes at each edge.
        ("S__A__h_ivar.tsv", ("_A_", "S", "h")),
        ("S__h_ivar.tsv", ("", "S", "h")),
        ("only_ivar.tsv", ("", "only", "only")),
    ],
)
def test_file_key(spark, name, key):
    found = with_file_key(paths(spark, f"file:/r/{name}")).first()
    assert (found[S.AMPLICON], found[S.SAMPLE], found[S.CONTIG]) == key
    assert found[S.CONTIG_ID] == "-".join(key)


def test_file_without_key(spark):
    files = paths(spark, "file:/r/S1_h_ivar.tsv", "file:/r/S1_A_h_ivar.tsv")
    assert [r.path for r in without_file_key(files).collect()] == ["file:/r/S1_h_ivar.tsv"]
    assert with_file_key(files).count() == 1


def test_file_key_with_other_layout(spark):
    found = with_file_key(
        paths(spark, "file:/r/h1.QIA.4.S1.tsv"),
        suffix=".tsv",
        separator=".",
        sample_index=-1,
        contig_index=0,
    ).first()
    assert found[S.CONTIG_ID] == "QIA.4-S1-h1"
    far = with_file_key(paths(spark, "file:/r/a_b_c_ivar.tsv"), contig_index=9)
    assert far.count() == 0
    with pytest.raises(ValueError):
        with_file_key(paths(spark, "x"), separator="")


DEFLINES = [
    (">S1_QIAseq_42_haplotype-1 size=120", "QIAseq_42-S1-haplotype-1"),
    (">S1_haplotype-1_QIA_4 size=1", "_QIA_4-S1-haplotype-1"),
    (">S1_QIA_haplotype_haplotype x", None),
    (">S1_QIA_contig-1 size=3", None),
    (">S1_haplotype-1 size=3", None),
    (">haplotype-1", None),
    (">S1__haplotype-1 q", "-S1-haplotype-1"),
    (">>S1_A_haplotype>-1 a_b", "A-S1-haplotype-1"),
    (">S1_A_haplotypehaplotype", "A-S1-haplotypehaplotype"),
]


def test_defline_key(spark):
    lines = spark.createDataFrame([(line,) for line, _ in DEFLINES], "line string")
    found = {r["line"]: r[S.CONTIG_ID] for r in with_defline_key(lines).collect()}
    assert found == {line: key for line, key in DEFLINES if key is not None}
    rejected = {r["line"] for r in without_defline_key(lines).collect()}
    assert rejected == {line for line, key in DEFLINES if key is None}


SAMPLES = ["S1", "007", "A+b"]
AMPLICONS = ["QIA_42", "x", "p.q_r_s", "_lead", "trail_"]
CONTIGS = ["haplotype-1", "xhaplotype", "haplotype=3"]


def test_defline_keys_known_by_construction(spark):
    """Headers put together from known parts, wherever the contig stands among them."""
    expected = {}
    for sample in SAMPLES:
        for amplicon in AMPLICONS:
            for contig in CONTIGS:
                key = f"{amplicon}-{sample}-{contig}"
                expected[f">{sample}_{amplicon}_{contig} size=1 b_c"] = key
        expected[f">{sample}_left_haplotype-2_right"] = f"left__right-{sample}-haplotype-2"
    df = spark.createDataFrame([(line,) for line in expected], "line string")
    assert {r["line"]: r[S.CONTIG_ID] for r in with_defline_key(df).collect()} == expected
    assert without_defline_key(df).count() == 0


@pytest.mark.parametrize(
    ("text", "number"),
    [
        ("12", 12),
        (" 12\n", 12),
        ("+7", 7),
        ("-7", -7),
        ("1_000", 1000),
        ("1__0", None),
        ("_1", None),
        ("12.0", None),
        ("", None),
        ("a1", None),
        (None, None),
    ],
)
def test_tolerant_int(spark, text, number):
    assert one(spark, tolerant_int(F.lit(text).cast("string"))) == number


@pytest.mark.parametrize(
    ("text", "number"),
    [("p.Asp614Gly", 614), ("p.Lys3_Asp5del", 35), ("p.?", None), ("", None)],
)
def test_joined_digits(spark, text, number):
    assert one(spark, joined_digits(F.lit(text))) == number


@pytest.mark.parametrize(
    ("line", "separator", "index", "depth"),
    [
        (">a size=120", "=", -1, 120),
        (">a size=x", "=", -1, None),
        (">a 5 |7|9", "|", 1, 7),
        (">a 5 |7|9", "|", 8, None),
        (">a", "=", -1, None),
    ],
)
def test_defline_depth(spark, line, separator, index, depth):
    assert one(spark, defline_depth(F.lit(line), separator, index)) == depth


def test_jukes_cantor(spark):
    assert one(spark, jukes_cantor(F.lit(0.75))) is None
    assert one(spark, jukes_cantor(F.lit(2.0))) is None
    assert one(spark, jukes_cantor(F.lit(0.0))) == 0
    assert one(spark, jukes_cantor(F.lit(0.3))) == pytest.approx(0.38312, abs=1e-5)
