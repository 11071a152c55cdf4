"""Quality figures against plain definitions."""

import math
import re
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece

from haplospark.llm import fertility

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, _bytes int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_base(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    inside = {j for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for j in range(k, k + 5)}
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    dup = sum(x in lines[:k] for k, x in enumerate(lines))
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, dup, len(inside), failed


@pytest.fixture(scope="module")
def model():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def plain_figures(text, model):
    ids = [i for w in WORDS.findall(text or "") for i in model.encode(w)]
    chars = sum(map(len, WORDS.findall(text or "")))
    if not ids:
        return 0, 0.0, 0.0, 0.0
    same = sum(n * (n - 1) for n in Counter(ids).values())
    pairs = len(ids) * (len(ids) - 1)
    entropy = math.log2(pairs / same) if same else math.log2(max(pairs, 1)) + 1
    return len(ids), chars / len(ids), sum(map(model.is_byte, ids)) / len(ids), entropy


def test_query_on_whole_small_table(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r["doc_id"]: r for r in fertility.quality_figures(docs, "doc_id").collect()}
    kept = set()
    for doc in docs.collect():
        r = rows[doc["doc_id"]]
        base, figures = plain_base(doc["text"]), plain_figures(doc["text"], model)
        assert tuple(r)[1:7] == base
        assert tuple(r)[8:12] == pytest.approx(figures)
        reason = fertility.rejection(fertility.LANGUAGE_BANDS[doc["lang"]], *figures)
        assert (r["kept"], r["rejected_by"]) == (not base[-1] and reason is None, reason)
        kept |= {doc["doc_id"]} if r["kept"] else set()
    assert len(rows) == docs.count()
    assert {r["doc_id"] for r in fertility.keep_good(docs).collect()} == kept


def test_verdict_follows_the_labels(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    judged = fertility.quality_figures(docs, "doc_id").join(labels, "doc_id").where("not base_failed")
    found = {(r[0], r[1]): r[2] for r in judged.groupBy("quality", "kept").count().collect()}
    assert found[1, True] / (found[1, True] + found.get((1, False), 0)) > 0.99
    assert found[0, False] / (found[0, False] + found.get((0, True), 0)) > 0.9


def test_words_alone_have_the_pieces_of_the_text(model):
    text = "Some plain words, and été; 日本語 end."
    assert [i for w in text.split() for i in model.encode(w)] == model.encode(text)


def test_repeated_words():
    words = [b"a", b"b", b"c", b"d", b"e"]
    assert fertility.repeated_words(words) == 0
    assert fertility.repeated_words(words * 2) == 10
    assert fertility.repeated_words([*words, b"x", *words]) == 10
    assert fertility.repeated_words([b"a"] * 6) == 6


def test_odd_rows(spark):
    text = "Un texte " * 3 + " ".join(f"mot{k}" for k in range(300))
    texts = [None, "", " \n\t ", "word", text, "привет мир " + " ".join(f"слово{k}" for k in range(99)), "語" * 90, "x" * 200000]
    rows = [(k if k != 2 else None, t, ["fr", None, "xx"][k % 3], None, None, "k", 1) for k, t in enumerate(texts)]
    rows += [rows[4]] * 2
    docs = spark.createDataFrame(rows, SCHEMA)
    found = fertility.quality_figures(docs, "doc_id", docs["kept"].alias("extra")).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is not None:
            assert tuple(r)[2:8] == plain_base(texts[r["doc_id"]])
    kept = fertility.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in found if r[8])


def test_bands():
    band = fertility.LANGUAGE_BANDS["en"]
    assert fertility.band_of("en", []) is band
    assert fertility.band_of("ru", ["привет".encode()]) is fertility.SCRIPT_BANDS["CYRILLIC"]
    assert fertility.band_of(None, [b"123"]) is fertility.OTHER_BAND
    assert fertility.rejection(band, 1000, 1.2, 0.0, 6.2) == "chars_per_token"
    assert fertility.rejection(band, 1000, 2.2, 0.2, 6.2) == "fallback_share"
    assert fertility.rejection(band, 1000, 2.2, 0.0, 5.0) == "token_entropy"
    assert fertility.rejection(band, 1000, 2.2, 0.0, 6.2) is None


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert fertility.quality_figures(empty, "doc_id").count() == 0
    assert fertility.keep_good(empty).count() == 0
