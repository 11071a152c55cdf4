import math
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

import haplospark as hs
from haplospark import schemas as S
from haplospark import scratch
from haplospark.operators import mutations
from haplospark.operators.mutations import BAND_WIDTH as BAND
from haplospark.operators.mutations import attach_codons, attach_spans, label_variants
from haplospark.scratch import broadcast_if_bounded, materialize, scratch_folder, settle
from haplospark.sources.stage import with_signal

VARIANTS = (
    "REGION string, POS bigint, REF string, ALT string, REF_AA string, ALT_AA string, "
    "Amplicon string, `Sample ID` string, Contig string, `Amplicon-Sample-Contig` string"
)
SPANS = "Gene string, Amplicon string, `Start Position` bigint, `Stop Position` bigint"
CODONS = "NUC_SUB string, CODON bigint"


def variant(pos, ref, alt, ref_aa, alt_aa, contig="h1", amplicon="A", sample="S1"):
    key = f"{amplicon}-{sample}-{contig}"
    return ("r", pos, ref, alt, ref_aa, alt_aa, amplicon, sample, contig, key)


def bed(spark, *primers):
    rows = [("r", a, b, "n", name, "1", gene) for name, a, b, gene in primers]
    return spark.createDataFrame(rows, S.PRIMER_BED)


def test_spans(spark, rows):
    df = bed(
        spark,
        ("A_LEFT", 1, 21, "S"),
        ("A_RIGHT", 61, 81, "S"),
        ("B_LEFT", 100, 120, "S"),
        ("B_LEFT", 100, 120, "N"),
        ("B_RIGHT", 160, 180, "N"),
        ("C_LEFT", 1, 2, "S"),
        ("C_LEFT", 3, 4, "S"),
        ("C_RIGHT", 8, 9, "S"),
        ("D_LEFT", 5, 6, None),
        ("E", 7, 8, "S"),
        ("F_LEFT_LEFT", 7, 8, "S"),
        ("G_RIGHT_RIGHT_LEFT", 7, 8, "S"),
    )
    assert rows(hs.amplicon_spans(df), "Amplicon", "Gene", S.START, S.STOP) == [
        ("A", "S", 1, 81),
        ("B", "N", 100, 180),
        ("B", "S", 100, 180),
        ("C", "S", 1, 9),
        ("C", "S", 3, 9),
        ("D", None, 5, None),
        ("E", "S", None, None),
        ("F_LEFT", "S", 7, None),
        ("G_RIGHT", "S", 7, 8),
    ]


def test_classes_and_labels(spark, rows):
    variants = spark.createDataFrame(
        [
            variant(1, "A", "C", "K", "N"),
            variant(1, "A", "C", "K", "N"),
            variant(2, "A", "G", "K", "K"),
            variant(3, "A", "G", None, None),
            variant(4, "A", "G", "K", None),
            variant(5, "A", "G", "NA", "NA"),
            variant(None, None, None, None, None, contig="h2"),
            variant(6, "A", "T", "K", "N", amplicon="Z"),
        ],
        VARIANTS,
    )
    spans = spark.createDataFrame([("S", "A", 1, 81)], SPANS)
    codons = spark.createDataFrame([("A-1-C", 7), ("A-1-C", 9)], CODONS)
    long = hs.classify_mutations(variants, spans, codons)
    assert long.columns == [*S.LONG_COLUMNS, "POS", S.BAND]
    flags = ["Noncoding", "Synonymous", "Nonsynonymous"]
    assert rows(long, "Contig", "NUC_SUB", "Gene", "AA_SUB", *flags) == sorted(
        [
            ("h1", "A-1-C", "S", "S: K-7-N", False, False, True),
            ("h1", "A-1-C", "S", "S: K-9-N", False, False, True),
            ("h1", "A-2-G", "S", "S: K -> K at nuc. position 2", False, True, False),
            ("h1", "A-3-G", "S", None, True, False, False),
            ("h1", "A-4-G", "S", None, False, None, None),
            ("h1", "A-5-G", "S", "S: NA -> NA at nuc. position 5", False, True, False),
            ("h1", "A-6-T", None, None, False, False, True),
            ("h2", None, "S", None, True, False, False),
        ],
        key=repr,
    )


def test_summary(spark, rows):
    variants = spark.createDataFrame(
        [
            variant(10, "A", "C", "K", "N"),
            variant(9, "A", "C", "K", "K"),
            variant(BAND * 3, "A", "C", "K", "K"),
            variant(BAND * 20, "A", "C", "K", "N"),
            variant(BAND * 20, "A", "AC", "K", "N"),
            variant(None, None, None, None, None, contig="h2"),
        ],
        VARIANTS,
    )
    spans = spark.createDataFrame([("S", "A", 1, 81), (None, "A", 1, 81)], SPANS)
    codons = spark.createDataFrame([], CODONS)
    long = hs.classify_mutations(variants, spans.limit(1), codons)
    found = {r["Contig"] if "Contig" in r else r[S.CONTIG_ID]: r for r in hs.mutation_lists(long).collect()}
    first, second = found["A-S1-h1"], found["A-S1-h2"]
    far, farther = BAND * 3, BAND * 20
    assert first[S.NUC_LIST] == f"A-9-C, A-10-C, A-{far}-C, A-{farther}-AC, A-{farther}-C"
    assert first[S.NUC_COUNT] == 5
    at = "S: K -> {} at nuc. position {}".format
    assert first[S.SYN_LIST] == f"{at('K', 9)}, {at('K', far)}"
    assert first[S.SYN_COUNT] == 2
    assert first[S.NONSYN_LIST] == ", ".join([at("N", 10), at("N", farther), at("N", farther)])
    assert first[S.NONSYN_COUNT] == 3
    assert second[S.NUC_LIST] is None and second[S.NUC_COUNT] == 0
    assert second[S.SYN_COUNT] is None and second[S.NONSYN_LIST] is None

    # A gene more: every mutation is counted once per gene, and each contig has a row per gene.
    wide = hs.summarize_contigs(hs.classify_mutations(variants, spans, codons), spans)
    assert wide.columns == S.SHORT_COLUMNS
    assert rows(wide, S.CONTIG_ID, "Gene", S.NUC_COUNT, S.SYN_COUNT, S.NONSYN_COUNT) == [
        ("A-S1-h1", "S", 10, 4, 6),
        ("A-S1-h1", None, 10, 4, 6),
        ("A-S1-h2", "S", 0, None, None),
        ("A-S1-h2", None, 0, None, None),
    ]


def test_contigs_that_share_a_key(spark, rows):
    """Two contigs whose parts join to the same key both get the key's mutations."""
    shared = [
        ("r", 1, "A", "C", None, None, "a-b", "c", "h", "a-b-c-h"),
        ("r", 2, "A", "C", None, None, "a", "b-c", "h", "a-b-c-h"),
    ]
    variants = spark.createDataFrame(shared, VARIANTS)
    long = hs.classify_mutations(
        variants, spark.createDataFrame([], SPANS), spark.createDataFrame([], CODONS)
    )
    assert rows(hs.mutation_lists(long), S.AMPLICON, S.SAMPLE, S.NUC_LIST, S.NUC_COUNT) == [
        ("a", "b-c", "A-1-C, A-2-C", 2),
        ("a-b", "c", "A-1-C, A-2-C", 2),
    ]
    assert hs.contig_ids(long).count() == 2


def test_summary_against_plain_python(spark):
    """One contig with a third of all rows among many small ones."""
    rng = random.Random(7)
    data = set()
    for i in range(6000):
        contig = "hot" if i % 3 == 0 else f"h{rng.randrange(300)}"
        pos = rng.randrange(1, BAND * 6)
        residues = rng.choice([("K", "K"), ("K", "N"), (None, None), ("K", None)])
        data.add(variant(pos, rng.choice("ACGT"), rng.choice("ACGT"), *residues, contig=contig))
    variants = spark.createDataFrame(list(data), VARIANTS)
    spans = spark.createDataFrame([("S", "A", 1, 81)], SPANS)
    long = hs.classify_mutations(variants, spans, spark.createDataFrame([], CODONS))
    expected = {}
    for row in data:
        expected.setdefault(row[9], []).append(row)
    found = {r[S.CONTIG_ID]: r for r in hs.mutation_lists(long).collect()}
    assert found.keys() == expected.keys()
    for key, contig_rows in expected.items():
        nuc = sorted((r[1], f"{r[2]}-{r[1]}-{r[3]}") for r in contig_rows)
        syn = sorted(
            (r[1], f"S: K -> K at nuc. position {r[1]}") for r in contig_rows if r[4] and r[4] == r[5]
        )
        assert found[key][S.NUC_LIST] == ", ".join(x for _, x in nuc)
        assert found[key][S.NUC_COUNT] == len(nuc)
        assert found[key][S.SYN_LIST] == (", ".join(x for _, x in syn) or None)
        assert found[key][S.SYN_COUNT] == (len(syn) or None)


@pytest.mark.parametrize(
    ("nonsyn", "syn", "start", "stop"),
    [(2, 1, 0, 80), (1, 2, 0, 80), (1, 1, 0, 80), (3, 1, 0, 2), (None, 1, 0, 80), (1, None, 0, 80),
     (2, 2, 0, 1), (1, 1, None, 80), (7, 9, 0, 4)],
)
def test_ratio(spark, nonsyn, syn, start, stop):
    short = spark.createDataFrame(
        [(nonsyn, syn, start, stop)],
        "`Nonsyn count` bigint, `Syn count` bigint, `Start Position` bigint, `Stop Position` bigint",
    )
    found = hs.crude_dnds(short).first()[S.RATIO]

    def distance(p):
        return -0.75 * math.log(1 - 4 * p / 3) if p < 0.75 else None

    expected = None
    if None not in (nonsyn, syn, start, stop):
        sites = 2 * (stop - start)
        if sites != syn and sites != nonsyn:
            dn, ds = distance(nonsyn / (sites - syn)), distance(syn / (sites - nonsyn))
            expected = dn / ds if dn is not None and ds else None
    assert found == (pytest.approx(expected) if expected is not None else None)


def test_signal(spark, rows):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (None,)], "`Crude dN/dS Ratio` double")
    assert rows(with_signal(df), S.RATIO, S.SIGNAL) == [
        (0.5, "purifying"),
        (1.0, "neutral"),
        (2.0, "positive"),
        (None, None),
    ]


def ranked_input(spark, n, seed):
    """A third of the rows in one group, and a third of those with the same value."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        group = "hot" if i % 3 == 0 else rng.choice([None, *map(str, range(40))])
        value = 1 if rng.random() < 0.33 else rng.randrange(1000)
        data.append((group, value, i))
    return spark.createDataFrame(data, "g string, v bigint, id bigint")


def test_numbering_equals_a_window(spark, rows):
    df = ranked_input(spark, 20000, 3)
    order = [F.col("v").desc(), F.col("id").asc()]
    expected = df.withColumn("n", F.row_number().over(Window.partitionBy("g").orderBy(*order)))
    found = hs.number_in_groups(df, ["g"], order, "n")
    assert found.columns == ["g", "v", "id", "n"]
    assert rows(found) == rows(expected.withColumn("n", F.col("n").cast("bigint")))


def test_numbering_cuts_a_hot_group(spark):
    """No slice holds much more than its share, though one group has a third of the rows."""
    df = ranked_input(spark, 20000, 5)
    order = [F.col("v").desc(), F.col("id").asc()]
    sizes = [
        r["count"]
        for r in df.repartitionByRange(8, "g", *order)
        .groupBy(F.spark_partition_id())
        .count()
        .collect()
    ]
    assert len(sizes) == 8 and max(sizes) < 20000 / 8 * 2


def test_numbering_of_nothing(spark):
    df = spark.createDataFrame([], "g string, v bigint")
    assert hs.number_in_groups(df, ["g"], [F.col("v")], "n").count() == 0


def test_names(spark, rows):
    fields = (
        "Amplicon string, `Sample ID` string, `Amplicon-Sample-Contig` string, Gene string, "
        "`Start Position` bigint, `Stop Position` bigint, `Depth of Coverage` bigint"
    )
    df = spark.createDataFrame(
        [
            ("A", "S1", "A-S1-h1", "S", 1, 2, 10),
            ("A", "S1", "A-S1-h2", "S", 1, 2, 30),
            ("A", "S1", "A-S1-h3", "S", 1, 2, 10),
            ("A", "S1", "A-S1-h3", None, 1, 2, 10),
            ("A", "S2", "A-S2-h1", "S", 1, 2, 5),
        ],
        fields,
    )
    assert rows(hs.name_haplotypes(df), S.HAPLOTYPE, S.CONTIG_ID, "Gene") == [
        ("A Haplotype 1", "A-S1-h2", "S"),
        ("A Haplotype 1", "A-S2-h1", "S"),
        ("A Haplotype 2", "A-S1-h1", "S"),
        ("A Haplotype 3", "A-S1-h3", None),
        ("A Haplotype 4", "A-S1-h3", "S"),
    ]


def test_scratch(spark):
    folder = scratch_folder(spark)
    assert folder == spark.conf.get("spark.checkpoint.dir")
    df = spark.range(10).withColumn("a b/c", F.lit("x"))
    again = materialize(df, "t")
    assert again.columns == df.columns and again.count() == 10
    assert again.inputFiles()[0].startswith("file:") and folder in again.inputFiles()[0]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
}


def test_lookups_too_large_to_broadcast_are_joined_in_parts(spark, rows):
    """A third of the rows on one amplicon, a third without a label: hot keys are split."""
    rng = random.Random(11)
    data = []
    for i in range(12000):
        amplicon = "hot" if i % 3 == 0 else f"a{rng.randrange(500)}"
        if i % 3 == 1:
            data.append(variant(None, None, None, None, None, contig=f"h{i}", amplicon=amplicon))
        else:
            data.append(variant(i, "A", "C", "K", "N", contig=f"h{i}", amplicon=amplicon))
    variants = spark.createDataFrame(data, VARIANTS)
    spans = spark.createDataFrame([("S", f"a{k}", k, k + 80) for k in range(500)] + [("N", "hot", 1, 81)], SPANS)
    codons = spark.createDataFrame([(f"A-{i}-C", i) for i in range(0, 12000, 2)], CODONS)
    expected = rows(hs.classify_mutations(variants, F.broadcast(spans), F.broadcast(codons)), *S.LONG_COLUMNS)
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    try:
        labelled = label_variants(variants)
        by_amplicon, by_label = attach_spans(labelled, spans), attach_codons(labelled, codons)
        for df in (by_amplicon, by_label):
            df.collect()
            assert "SortMergeJoin" in plan_of(df)
        assert "skew=true" in plan_of(by_amplicon)
        keys = labelled.select(F.coalesce("NUC_SUB", F.concat(F.lit("\0"), S.CONTIG_ID)).alias("k"))
        assert keys.groupBy("k").count().where("count > 1").count() == 0
        assert rows(hs.classify_mutations(variants, spans, codons), *S.LONG_COLUMNS) == expected
    finally:
        for key in SKEW:
            spark.conf.unset(key)


def test_broadcast_only_within_the_bound(spark):
    left = spark.range(1000).withColumn("k", F.col("id") % 10)
    right = spark.range(10).select(F.col("id").alias("k"), F.lit("x" * 50).alias("t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # Ten rows of 1 + 50 bytes and an allowance of 16 for each value.
        small = left.join(settle(right, "r", max_bytes=830), "k", "left")
        big = left.join(settle(right, "r", max_bytes=829), "k", "left")
        none = left.join(settle(right.limit(0), "r", max_bytes=0), "k", "left")
        assert "BroadcastHashJoin" in plan_of(small) and "BroadcastHashJoin" in plan_of(none)
        assert "BroadcastHashJoin" not in plan_of(big) and "SortMergeJoin" in plan_of(big)
        written = materialize(right, "r")
        assert "BroadcastHash" in plan_of(left.join(broadcast_if_bounded(written, 830), "k"))
        assert "BroadcastHash" not in plan_of(left.join(broadcast_if_bounded(written, 829), "k"))
        assert small.count() == big.count() == none.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_packed_variants_come_back(spark, rows):
    """Also with null names and cells, keys that are not made of their parts, and texts with what separates."""
    names = [("A-b", "S", "c-1"), ("é", "", "日"), (None, "S", "c"), ("A", None, None), ("\x01", "\x02", "-")]
    cells = [("r", "A", "C", "K", "N"), (None,) * 5, ("", "\x01", "é", "\x02", "-"), ("\x02", "", "x\x02", "", "")]
    found = [(r, 7 if r else None, *some, *n, i) for n in names for r, *some in cells for i in ("-".join(x or "" for x in n), "other", None)]
    schema = ", ".join(f"`{c}` {'bigint' if c == 'POS' else 'string'}" for c in S.VARIANT_COLUMNS)
    table = spark.createDataFrame(found, schema)
    odd = table.where("POS = 7").limit(3).withColumn("ALT", F.expr("cast(X'41ff' as string)"))
    table = table.union(odd.select(*table.columns))
    whole = lambda df: rows(df.select([F.hex(F.col(f"`{c}`").cast("string")) for c in S.VARIANT_COLUMNS]))
    small = mutations.packed(table)
    assert 0 < small.where("_cells IS NULL").count() < small.count()
    assert whole(mutations.unpacked(small)) == whole(table)


def test_steps_hold_one_shuffle_at_a_time(spark, rows, tmp_path, monkeypatch):
    """With large lookups rows are written between joins, the last ones only, and the results are the same."""
    variants = [("r", k % 5, "A", "C", "K", "N", f"A{k % 3}", "S", f"c{k % 7}", f"A{k % 3}-S-c{k % 7}") for k in range(60)]
    schema = ", ".join(f"`{c}` {'bigint' if c == 'POS' else 'string'}" for c in S.VARIANT_COLUMNS)
    table = spark.createDataFrame(variants, schema)
    spans = spark.createDataFrame([("S", "A0", 1, 9), ("N", "A0", 1, 9), (None, "A1", 2, None)], "Gene string, Amplicon string, `Start Position` bigint, `Stop Position` bigint")
    codons = spark.createDataFrame([("A-1-C", 4), ("A-1-C", 5)], "NUC_SUB string, CODON bigint")
    monkeypatch.setattr(scratch, "scratch_folder", lambda spark: str(tmp_path))
    step = scratch.steps(False)
    long = mutations.classify_mutations(table, spans.hint("merge"), codons.hint("merge"), step)
    short = hs.summarize_contigs(long, spans, step)
    plain = hs.summarize_contigs(mutations.classify_mutations(table, spans, codons), spans)
    assert rows(short) == rows(plain) and len(rows(plain)) > 7
    assert len(list((tmp_path / "haplospark").iterdir())) == 1
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    kept = spark.conf.get(key)
    with scratch.shuffles_freed(spark):
        assert spark.conf.get(key) == "true"
    assert spark.conf.get(key) == kept
