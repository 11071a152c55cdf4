"""Encoding against the tiktoken library, and exact round trips."""

import gc
import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from haplospark.llm import byte_bpe
from haplospark.llm.common import Remembered

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
SCHEMA = "doc_id bigint, text string, ids int, n_tokens string, _text string"
ODD = [
    None, "", " ", "\n", "  two  blanks ", "a\n\nb", "tab\tand nbsp", "it's don't 'll", " 'sfoo", "x" * 3000,
    "ab" * 5000, "日本語のテキスト", "é́ combining", "\x1c sep \x85 nel", "12345 678 ½²", "!!!??? ... ###",
    "<|endoftext|> in text", "emoji 👩‍👩‍👧 end", "trailing space ", "line\r\nwindows\r\n", " lead", "a b\nc d\n",
]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(PATH), special_tokens={}
    )


def test_odd_texts(library):
    codec = byte_bpe.codec(PATH)
    for text in ODD:
        ids = codec.encode(text or "").tolist()
        assert ids == library.encode_ordinary(text or ""), text
        assert codec.decode(ids) == (text or "").encode()


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60), st.text(alphabet="abeh inort'\n ", max_size=80))
def test_any_text(library, a, b):
    codec = byte_bpe.codec(PATH)
    for text in (a, b):
        assert codec.encode(text).tolist() == library.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.binary(min_size=1, max_size=40))
def test_any_bytes(piece):
    bpe = byte_bpe.codec(PATH).bpe
    assert bpe.encode_piece(piece) == bpe.merged(piece)


def test_caches_that_overflow_change_nothing(library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "WORD_BYTES", 3000)
    monkeypatch.setattr(byte_bpe, "PIECE_BYTES", 1000)
    monkeypatch.setattr(byte_bpe, "PAIRS", 3)
    codec = byte_bpe.TextCodec(byte_bpe.read_ranks(PATH))
    text = "some words that come and go and come and go again"
    assert codec.encode(text).tolist() == codec.encode(text).tolist() == library.encode_ordinary(text)


def test_query_on_whole_small_table(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = {r["doc_id"]: r for r in byte_bpe.bpe_digests(docs).collect()}
    for doc_id, text in docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(text)
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert tuple(found[doc_id]) == (doc_id, len(ids), digest, hashlib.sha256(text.encode()).hexdigest())
    assert len(found) == docs.count()


def test_documents_and_back(spark):
    rows = [(k if k % 5 else None, t, 1, "x", "y") for k, t in enumerate(ODD)] + [(1, "again", 1, "x", "y")] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    tokens = byte_bpe.encode_documents(docs, "doc_id", docs["_text"].alias("other"))
    back = byte_bpe.decode_ids(tokens, "doc_id", "n_tokens").collect()
    expected = sorted(((r[0], (r[1] or "").encode()) for r in rows), key=repr)
    assert sorted(((r["doc_id"], bytes(r["bytes"])) for r in back), key=repr) == expected
    digests = byte_bpe.bpe_digests(docs).collect()
    assert len(digests) == len(rows) and np.sum([r["n_tokens"] for r in digests]) == sum(r["n_tokens"] for r in back)


def test_memory_stays_within_its_bound():
    """Two million words, and what is really held of them."""
    bound, made = 20 << 20, []
    gc.collect()
    tracemalloc.start()
    words = Remembered(lambda w: made.append(1) or f"{w}{w}".encode(), bound)
    for k in range(2_000_000):
        words[f"word number {k}"]
        if k % 400_000 == 399_999:
            made.clear()
            assert tracemalloc.get_traced_memory()[0] < 1.05 * bound
    assert tracemalloc.get_traced_memory()[1] < 1.6 * bound  # also while the older ones are replaced
    tracemalloc.stop()
    made.clear()
    assert words["word number 1999999"] and words["word number 1950000"] and not made
    assert words["x" * 100] and "x" * 100 not in words


def test_columns_may_have_any_name(spark):
    rows = [(1, "some text", 7, "a", "b", 2.5), (2, None, 8, None, "c", 0.5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens int, ids string, `a.b` string, _text double")
    keep = [docs[f"`{c}`"] for c in docs.columns if c != "text"]
    tokens = byte_bpe.encode_documents(docs, *keep)
    assert tokens.columns == ["doc_id", "n_tokens", "ids", "a.b", "_text", "n_tokens", "ids"]
    found = [tuple(r) for r in tokens.collect()]
    assert [r[:5] for r in sorted(found)] == [(1, 7, "a", "b", 2.5), (2, 8, None, "c", 0.5)]
    plain = byte_bpe.encode_documents(docs, "doc_id", docs["`a.b`"])
    assert [r[:2] for r in sorted(map(tuple, plain.collect()))] == [(1, "b"), (2, "c")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.bpe_digests(empty).count() == 0
    assert byte_bpe.encode_documents(empty, "doc_id").count() == 0


def test_pairs_are_told_without_merging(monkeypatch):
    bpe = byte_bpe.ByteBpe(byte_bpe.read_ranks(PATH))
    rng = random.Random(5)
    ids = sorted(bpe.ranks.values())
    some = [k for k in ids if bpe.vocabulary[k].isalpha()]
    pairs = [(rng.choice(k), rng.choice(k)) for k in (ids, some, ids[:2000]) for _ in range(3000)]
    pairs += [(k, k) for k in ids[:5000]]
    expected = [bpe.merged(bpe.vocabulary[a] + bpe.vocabulary[b]) == [a, b] for a, b in pairs]
    assert 0 < sum(expected) < len(pairs)
    monkeypatch.setattr(bpe, "merged", None)
    assert [bpe._follows(a, b) for a, b in pairs] == expected


def test_tokens_made_from_later_ones():
    ranks = {bytes([k]): k for k in range(256)} | {b"abc": 256, b"bc": 257}
    bpe = byte_bpe.ByteBpe(ranks)
    for a in (ord("a"), ord("d"), 256, 257):
        for b in (ord("b"), ord("c"), 256, 257):
            assert bpe._follows(a, b) == (bpe.merged(bpe.vocabulary[a] + bpe.vocabulary[b]) == [a, b])
    assert bpe.encode_piece(b"dabcbc") == bpe.merged(b"dabcbc") == [ord("d"), 256, 257]
