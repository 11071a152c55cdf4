"""Repeated strings against every window of a small table, and the sorted order by itself."""

import hashlib
import random
from collections import Counter

import pytest

from haplospark.llm import queries
from haplospark.llm import suffixes as S

SCHEMA = "doc_id bigint, text string, key string, known boolean"


def plain(rows, n=S.LENGTH):
    """(doc_id, n_bytes, n_removed, n_spans, hash) of rows (doc_id, text)."""
    raws = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(hash(r[k : k + n]) for _, r in raws for k in range(len(r) - n + 1))
    out = []
    for i, r in raws:
        covered, until = bytearray(len(r)), 0
        for k in range(len(r) - n + 1):
            if times[hash(r[k : k + n])] > 1:
                start = max(k, until)
                covered[start : k + n] = b"\1" * (k + n - start)
                until = k + n
        kept = bytes(b for b, c in zip(r, covered, strict=True) if not c)
        spans = sum(1 for x in bytes(covered).split(b"\0") if x)
        out.append((i, len(r), sum(covered), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def text(draw, words):
    return " ".join(draw.choice(["ab", "über", "x"]) + str(draw.randint(0, 9999)) for _ in range(words))


def odd_rows():
    draw = random.Random(6)
    passages = [text(draw, n) for n in (45, 55, 60, 120, 400)]
    rows = []
    for k in range(150):
        parts = [text(draw, draw.randint(0, 90)) for _ in range(3)]
        if k % 2:
            parts.insert(1, passages[k % 5])
        if k % 7 == 0:  # a piece of a passage, cut anywhere
            whole = passages[4].encode()
            at = draw.randint(0, len(whole) - 500)
            parts.append(whole[at : at + draw.randint(380, 700)].decode(errors="ignore"))
        rows.append((k, " ".join(parts)))
    rows += [(200 + k, rows[3][1]) for k in range(5)] + [(3, rows[3][1])]
    rows += [(300, "=" * 5000), (301, "=" * 399), (302, "=" * 400), (303, "ab" * 700), (304, "x" + "ab" * 300)]
    rows += [(310, None), (311, ""), (None, passages[0]), (None, passages[0]), (None, text(draw, 100))]
    rows += [(320, passages[3][:399]), (321, passages[3][:400]), (322, passages[3][-400:]), (323, "日本" * 500)]
    rows += [(330, text(draw, 20000)), (331, rows[0][1] + rows[0][1])]
    return rows


@pytest.mark.parametrize("group_rows, chunk", [(S.GROUP_ROWS, S.CHUNK_BYTES), (2, 100), (0, 1)])
def test_every_window(spark, monkeypatch, group_rows, chunk):
    """By sorting, by names where a group is large, and by names alone."""
    monkeypatch.setattr(S, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(S, "CHUNK_BYTES", chunk)
    rows = odd_rows()
    docs = spark.createDataFrame([(*r, "k", True) for r in rows], SCHEMA).repartition(6)
    assert found(S.repeated_string_report(docs)) == plain(rows)


def test_spans_and_bytes(spark):
    passage = "p" + text(random.Random(1), 100)
    docs = spark.createDataFrame([(1, "a " + passage + " b"), (2, passage)], "doc_id bigint, text string")
    one, two = sorted(S.without_repeated_strings(docs).collect(), key=lambda r: r["doc_id"])
    assert bytes(one["kept"]) == b"a  b" and [tuple(s) for s in one["spans"]] == [(2, 2 + len(passage.encode()))]
    assert bytes(two["kept"]) == b"" and two["n_bytes"] == len(passage.encode())


def test_corpus_order():
    """Windows of blocks with a common first trigger, some equal, some equal but for the last byte."""
    draw = random.Random(9)
    for _ in range(20):
        base = bytes(draw.choice(b"abcdefgh ") for _ in range(3000))
        at = [k for k in S.triggers_of([base])[0].tolist() if 200 < k < 2000][3]
        before = max(k for k in S.triggers_of([base])[0].tolist() if k < at) + 1
        texts, cuts, counts = [], [], []
        for _ in range(30):
            start = draw.randint(before, at)
            count = draw.randint(1, at - start + 1)
            raw = bytearray(base[start : start + count - 1 + S.LENGTH])
            if draw.random() < 0.7:  # behind the first trigger's own bytes
                raw[draw.randint(at - start + 2 * S.GRAM, len(raw) - 1)] ^= 1
            if S.triggers_of([bytes(raw)])[0][0] == at - start:
                texts.append(bytes(raw))
                cuts.append(at - start)
                counts.append(count)
        windows = [t[k : k + S.LENGTH] for t, n in zip(texts, counts, strict=True) for k in range(n)]
        times = Counter(windows)
        assert S.corpus_order(texts, cuts, counts).tolist() == [times[w] > 1 for w in windows]


def test_suffix_ranks():
    texts = [b"banana", b"ananas", b"", b"na", b"n\0a"]
    ranks, starts = S.suffix_ranks(texts)
    suffixes = [(t[k:], int(ranks[s + k])) for t, s in zip(texts, starts.tolist(), strict=True) for k in range(len(t))]
    for a, x in suffixes:
        for b, y in suffixes:
            assert (a == b) == (x == y) and (a < b) == (x < y)


def test_triggers_do_not_cross_texts_or_depend_on_blocks(monkeypatch):
    draw = random.Random(2)
    texts = [bytes(draw.randrange(97, 123) for _ in range(n)) for n in (5000, 0, 10, 700)]
    whole = [t.tolist() for t in S.triggers_of(texts)]
    assert whole == [S.triggers_of([t])[0].tolist() for t in texts] and len(whole[0]) > 50
    monkeypatch.setattr(S, "_STEP", 64)
    assert [t.tolist() for t in S.triggers_of(texts)] == whole


def test_query_on_whole_small_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()]
    assert found(queries.op13_suffix_array_dedup(spark, "/root/testdata/sf0.001")) == plain(rows)


def test_empty_table(spark):
    assert S.repeated_string_report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
