"""What the pipeline leaves of copies, and its whole run by the rules of its own stages."""

import random

import public_tokenizers
import tiktoken
from test_line_chunks import line
from test_line_chunks import plain as plain_lines
from test_near_copies import plain_kept

import corpus_pipeline
from haplospark.llm import byte_bpe, decontaminate, fertility

SF = "/root/testdata/sf0.01"


def test_copies_leave_no_fragment(spark):
    """Copies of texts with short lines, few words or one line, also with blank lines around."""
    draw, rows = random.Random(8), []
    for k in range(60):
        lines = [line(draw, draw.choice([1, 3, 12, 60])) for _ in range(draw.randint(1, 14))]
        text = "\n".join(lines)
        rows += [(10 * k, text), (10 * k + 1, text), (10 * k + 2, text)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    for stage in (corpus_pipeline.line_dedup, corpus_pipeline.near_dedup):
        docs = stage(spark, docs, SF)
    found = {r["doc_id"]: r["text"] for r in docs.collect() if r["text"]}
    assert found == {i: t for i, t in rows if i % 10 == 0}


def test_whole_run(spark):
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()]
    items = [decontaminate.normalize(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    good = [(i, t) for i, t, lang in docs if fertility.judge(t.encode(), lang).kept]
    cut = [(i, t) for i, (t, _) in plain_lines(good).items()]
    kept = plain_kept(cut)
    clean = [
        (i, t) for i, t in cut if i in kept and not any(item in decontaminate.normalize(t) for item in items)
    ]
    assert len(docs) > len(good) > len(kept) > len(clean) > 500
    found = corpus_pipeline.run(spark, SF)
    assert {r["doc_id"]: r["ids"] for r in found.collect()} == {i: library.encode_ordinary(t) for i, t in clean}
