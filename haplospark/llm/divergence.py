"""How the term frequencies of the sources of a language differ.

Equal texts of a language are one text with a number of copies per source, and are tokenized
once. Texts that occur once, which is most of them, are told by a hash and never shuffled;
the others are grouped by their whole bytes, per source first, so that a text that is
everywhere is counted before it meets. A text's list of copies has an entry per source at
most, and the result has a row for every two sources of a language.

A worker counts the terms of many texts before it hands them on: occurrences and documents
per language, source and term. Terms in at least ``LEAST_DOCUMENTS`` documents of their
language are kept. Frequencies are whole numbers: ``1 + floor(1e9 (c + 5) / (N + 5 V))``, c
the term's occurrences in a group, N those of all V kept terms.

Pairs are evaluated sparsely. Where neither group has a term, both have their floor
frequency; where one has it, only the count matters, so a histogram of counts per group is
met with the floors of the other groups; only terms that both have are joined, and correct
what the histograms assumed. Work grows with occurring (group, term) rows, not with V for
every pair.

Defined cases: a null text, language or source is ''; an empty or null text has no terms,
but its group occurs; equal rows count as often as they occur; equal values rank by the bytes
of the item; columns other than text, lang and source are not looked at; no rows give none.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haplospark.llm.common import map_partitions, short_batches
from haplospark.scratch import materialize, settle

LEAST_DOCUMENTS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
TOP_TERMS = 50
#: Entries that a task counts before it hands them on.
HELD = 200_000
#: ASCII letters in lower case, bytes of other characters as they are, blanks for the rest.
_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def terms(raw: bytes) -> list[bytes]:
    """The terms of a text in UTF-8: runs of ASCII letters and of characters beyond ASCII."""
    return raw.translate(_LETTERS).split()


def collapse(documents: DataFrame) -> DataFrame:
    """``lang``, ``text`` (bytes) and ``copies``, an array of (source, n), a row per text."""

    def plain(name: str) -> Column:
        return F.coalesce(documents[name].cast("string"), F.lit(""))

    rows = documents.select(
        plain("lang").alias("lang"), plain("source").alias("source"), plain("text").cast("binary").alias("text")
    ).withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64("lang", F.lit(1), "text")})
    repeated = settle(
        rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "repeated"
    )
    marked = rows.join(repeated, ["h1", "h2"], "left").select("lang", "source", "text", "times")
    one = F.array(F.struct("source", F.lit(1).cast("bigint").alias("n")))
    alone = marked.where("times IS NULL").select("lang", "text", one.alias("copies"))
    grouped = (
        marked.where("times IS NOT NULL")
        .groupBy("lang", "source", "text")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("lang", "text")
        .agg(F.collect_list(F.struct("source", "n")).alias("copies"))
    )
    return alone.unionByName(grouped)


_COUNTS = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _handed_on(found: dict[tuple[str, str], Counter], docs: dict[tuple[str, str], Counter]) -> Iterator[pa.RecordBatch]:
    for (lang, source), counts in found.items():
        held = docs[lang, source]
        yield pa.RecordBatch.from_arrays(
            [
                pa.repeat(lang, len(counts)),
                pa.repeat(source, len(counts)),
                pa.array(list(counts), pa.binary()).cast(pa.string()),
                pa.array(list(counts.values()), pa.int64()),
                pa.array([held[t] for t in counts], pa.int64()),
            ],
            schema=_COUNTS,
        )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences and documents of the terms of each language and source, added up in parts."""
    found, docs, entries = defaultdict(Counter), defaultdict(Counter), 0
    for batch in batches:
        for lang, text, copies in zip(*batch.columns, strict=True):
            lang, own = lang.as_py(), Counter(terms(text.as_py()))
            entries += len(own)
            for copy in copies.as_py():
                group, n = (lang, copy["source"]), copy["n"]
                if n == 1:
                    found[group].update(own)
                    docs[group].update(own.keys())
                else:
                    found[group].update({t: k * n for t, k in own.items()})
                    docs[group].update(dict.fromkeys(own, n))
            if entries > HELD:
                yield from _handed_on(found, docs)
                found, docs, entries = defaultdict(Counter), defaultdict(Counter), 0
    yield from _handed_on(found, docs)


def term_counts(texts: DataFrame) -> DataFrame:
    """Per ``lang``, ``source`` and ``term`` of collapsed texts: occurrences ``n``, documents ``docs``."""
    short_batches(texts.sparkSession)
    parts = map_partitions(
        texts.select("lang", "text", "copies"), _counted, "lang string, source string, term string, n bigint, docs bigint"
    )
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def frequency(count: Column, total: Column, kept: Column) -> Column:
    """The smoothed frequency; the product of the numerator is beyond 64 bits at large counts."""
    wide = ((count + SMOOTHING).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(11,0)")).cast("decimal(38,0)")
    whole = F.call_function("div", wide, (total + SMOOTHING * kept).cast("decimal(20,0)"))
    return whole + 1


def source_divergence(documents: DataFrame) -> DataFrame:
    """Every two sources of a language compared, and the terms that set a source apart.

    Columns ``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``. In part ``pair``
    the item is another source of the language, the value the sum of absolute differences of
    frequencies over all kept terms. In part ``term`` the item is a term more frequent in the
    source than in its language, the value by how much, for the first ``TOP_TERMS``.
    """
    named = [F.coalesce(documents[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]
    groups = settle(documents.select(*named).distinct(), "groups")
    counts = materialize(term_counts(collapse(documents)), "counts")
    of_lang = counts.groupBy("lang", "term").agg(F.sum("n").alias("all"), F.sum("docs").alias("docs"))
    kept = settle(of_lang.where(F.col("docs") >= LEAST_DOCUMENTS).drop("docs"), "kept")
    own = materialize(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "all"), "own")
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("all").alias("lang_total"))
    totals = own.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("terms"))
    zero = F.lit(0).cast("bigint")
    sized = (
        groups.join(langs, "lang", "left")
        .join(totals, ["lang", "source"], "left")
        .select(
            "lang",
            "source",
            *[F.coalesce(c, zero).alias(c) for c in ("v", "lang_total", "total", "terms")],
        )
    )
    floor = F.when(F.col("v") > 0, frequency(zero, F.col("total"), F.col("v"))).otherwise(zero)
    sized = settle(sized.withColumn("floor", floor), "sized")

    mine = own.join(sized.select("lang", "source", "v", "total", "lang_total", "floor"), ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        "n",
        frequency(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        frequency(F.col("all"), F.col("lang_total"), F.col("v")).alias("q"),
        "floor",
    )
    mine = materialize(mine, "frequencies")

    # what each group's own terms differ by, were they all missing in the other
    shapes = mine.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    other = sized.select("lang", F.col("source").alias("item"), F.col("floor").alias("other_floor"))
    apart = (
        shapes.join(other, "lang")
        .where(F.col("source") != F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(F.sum(F.col("m") * F.abs(F.col("p") - F.col("other_floor"))).alias("apart"))
    )
    # terms of both
    right = mine.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("o"), F.col("floor").alias("other_floor"))
    both = (
        mine.select("lang", "term", "source", "p", "floor")
        .join(right, ["lang", "term"])
        .where(F.col("source") < F.col("item"))
        .groupBy("lang", "source", "item")
        .agg(
            F.sum(
                F.abs(F.col("p") - F.col("o")) - F.abs(F.col("p") - F.col("other_floor")) - F.abs(F.col("o") - F.col("floor"))
            ).alias("both"),
            F.count(F.lit(1)).alias("shared"),
        )
    )
    turned = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "both", "shared")
    back = apart.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("apart").alias("back"))
    keys = ["lang", "source", "item"]
    pairs = (
        sized.select("lang", "source", "v", "terms", "floor")
        .join(other.join(sized.select("lang", F.col("source").alias("item"), F.col("terms").alias("other_terms")), ["lang", "item"]), "lang")
        .where(F.col("source") != F.col("item"))
        .join(apart, keys, "left")
        .join(back, keys, "left")
        .join(both.unionByName(turned), keys, "left")
    )
    shared = F.coalesce("shared", zero)
    neither = F.col("v") - F.col("terms") - F.col("other_terms") + shared
    value = (
        F.coalesce("apart", zero)
        + F.coalesce("back", zero)
        + F.coalesce("both", zero)
        + neither * F.abs(F.col("floor") - F.col("other_floor"))
    )
    ranked = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item").asc())
    pair_rows = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value")).withColumn(
        "rank", F.row_number().over(ranked)
    )
    # ranks up to a constant: Spark keeps the first rows of every partition before it shuffles
    term_rows = (
        mine.where("p > q")
        .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
        .withColumn("rank", F.row_number().over(ranked))
        .where(F.col("rank") <= TOP_TERMS)
    )
    return pair_rows.unionByName(term_rows)


#: The same in DuckDB, from all pairs of kept terms and groups.
DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
grp AS (SELECT DISTINCT lang, source FROM docs),
df AS (SELECT lang, term FROM (SELECT lang, unnest(list_distinct(terms)) AS term FROM docs)
  GROUP BY ALL HAVING count(*) >= 30),
tf AS (SELECT lang, source, term, count(*) AS n FROM (SELECT lang, source, unnest(terms) AS term FROM docs) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, d.term, coalesce(t.n, 0)::HUGEINT AS n FROM grp g JOIN df d USING (lang)
  LEFT JOIN tf t ON t.lang = g.lang AND t.source = g.source AND t.term = d.term),
p AS (SELECT lang, source, term, n,
    1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER (PARTITION BY lang, source) + 5 * count(*) OVER (PARTITION BY lang, source)) AS p
  FROM cells),
whole AS (SELECT lang, term, sum(n) AS n FROM cells GROUP BY ALL),
q AS (SELECT lang, term,
    1 + 1000000000::HUGEINT * (n + 5) // (sum(n) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)) AS q
  FROM whole),
far AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
top AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, p.p - q.q AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM top))
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked
WHERE part = 'pair' OR rank <= 50
"""
