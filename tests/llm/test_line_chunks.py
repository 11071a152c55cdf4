"""Line dedup against a plain pass over all documents, and recall at random places."""

import random

import pytest

from haplospark.llm import line_chunks as L
from haplospark.llm import queries

SCHEMA = "doc_id bigint, text string, lang string, n_chars bigint, place int, _key string, _gone string, `a.b` int"


def plain(rows):
    """Texts after removal and lines that went, by doc_id; the lines themselves are compared."""
    kept_rows = sorted((r for r in rows if r[1] is not None), key=lambda r: (r[0] is None, r[0] or 0))
    lines = {r[0]: L.Lines(r[1].encode()) for r in kept_rows}
    first = {}
    for doc_id, own in lines.items():
        for start, stop in own.chunks():
            first.setdefault(tuple(own.full[start:stop]), (doc_id, start))
    out = {r[0]: (None, 0) for r in rows}
    for doc_id, own in lines.items():
        marks = set()
        for start, stop in own.chunks():
            other, place = first[tuple(own.full[start:stop])]
            if (other, place) == (doc_id, start):
                continue
            there = lines[other].full
            low = high = 0
            while low < 8 and min(start, place) > low and own.full[start - low - 1] == there[place - low - 1]:
                low += 1
            end = place + stop - start
            while high < 8 and stop + high < len(own.full) and end + high < len(there) and own.full[stop + high] == there[end + high]:
                high += 1
            if low + stop - start + high > 1 or len(own.full[start].split()) > 50:
                marks.update(range(start - low, stop + high))
        gone, k = set(), 0
        while k < len(own.full):
            end = k
            while end in marks:
                end += 1
            if sum(len(line.split()) for line in own.full[k:end]) >= 10:
                gone.update(range(own.places[k], own.places[end - 1] + 1))
            k = max(end, k + 1)
        kept = [line for k, line in enumerate(own.all) if k not in gone]
        if gone and not any(line.split() for line in kept):
            kept = []
        out[doc_id] = (b"\n".join(kept).decode(), len(own.all) - len(kept))
    return out


def line(draw, n):
    return " ".join(str(draw.randint(0, 99999)) for _ in range(n))


def odd_rows():
    draw = random.Random(2)
    passage, long_line = [line(draw, 8) for _ in range(30)], line(draw, 60)
    rows = []
    for k in range(120):
        lines = [line(draw, draw.randint(0, 12)) for _ in range(draw.randint(0, 12))]
        if k % 3 == 0:
            lines[len(lines) // 2 : len(lines) // 2] = passage
        if k % 4 == 0:
            lines.append(long_line)
        if k % 5 == 0:
            lines += ["common short line", "and its neighbour"]
        rows.append((k, "\n".join(lines)))
    rows += [(500, None), (501, ""), (502, "\n\n"), (503, "ü" * 90000), (504, rows[3][1]), (505, "\n\n" + rows[9][1] + "\n")]
    rows += [(506, "\n".join(["same row of seven words once more"] * 7)), (507, "\n".join(["a b c d e f", "g h i j"] * 4))]
    rows += [(508, "\n\n".join(passage[:6])), (None, "\n".join(passage))]
    return rows, passage, long_line


@pytest.mark.parametrize("broadcast", [True, False])
def test_removal(spark, monkeypatch, broadcast):
    """With small tables broadcast and with all joined by a shuffle."""
    if not broadcast:
        whole = L.settle
        monkeypatch.setattr(L, "settle", lambda df, label, most=0: whole(df, label, -1))
    rows, passage, long_line = odd_rows()
    docs = spark.createDataFrame([(*r, "en", 1, 1, "k", "mine", 7) for r in rows], SCHEMA).repartition(5)
    found = {r["doc_id"]: r["text"] for r in L.dedup_lines(docs).collect()}
    assert found == {i: t for i, (t, _) in plain(rows).items()}
    assert sum(long_line in (t or "") for t in found.values()) == 1
    assert all(sum(p in (t or "") for t in found.values()) == 1 for p in passage)
    assert found[504] == found[505] == found[508] == found[None] == ""


def test_columns_stay(spark):
    rows, *_ = odd_rows()
    docs = spark.createDataFrame([(*r, "en", 1, 1, "k", "mine", 7) for r in rows[:20]], SCHEMA)
    cut = L.dedup_lines(docs)
    assert cut.schema.simpleString() == docs.schema.simpleString()
    found = cut.collect()
    assert all(r["n_chars"] == len(r["text"]) for r in found if r["text"] is not None)
    assert all((r["_gone"], r["a.b"], r["_key"], r["place"]) == ("mine", 7, "k", 1) for r in found)


def test_query_on_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in queries.op10_line_dedup(spark, "/root/testdata/sf0.01").collect()}
    assert found == plain(rows) and sum(gone for _, gone in found.values()) > 0


def test_recall_of_short_passages_at_random_places(spark):
    """Passages of 2 to 10 lines within two otherwise different texts are removed to the line."""
    draw, rows, expected = random.Random(5), [], {}
    for k in range(300):
        passage = [line(draw, draw.randint(5, 20)) for _ in range(2 + k % 9)]
        for doc_id in (2 * k, 2 * k + 1):
            before, after = ([line(draw, draw.randint(1, 20)) for _ in range(draw.randint(0, 15))] for _ in "ab")
            rows.append((doc_id, "\n".join([*before, *passage, *after])))
            expected[doc_id] = ("\n".join([*before, *(passage if doc_id % 2 == 0 else []), *after]), len(passage) * (doc_id % 2))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r["doc_id"]: (r["text"], r["lines_removed"]) for r in L.line_dedup_report(docs).collect()}
    assert all(found[k] == expected[k] for k in range(0, 600, 2))
    right = sum(found[k] == expected[k] for k in range(1, 600, 2))
    assert right >= 0.95 * 300 and all(found[k][1] == 0 for k in range(1, 600, 2) if found[k] != expected[k])


def test_boundaries_resist_shifts():
    draw = random.Random(1)
    lines = ["%x" % draw.getrandbits(64) + " w" * 5 for _ in range(400)]

    def ends(some):
        own = L.Lines("\n".join(some).encode())
        return {own.full[stop - 1] for stop in own.ends}

    whole, shifted = ends(lines), ends(["new first line", *lines])
    assert len(whole ^ shifted) <= 2 and 300 < len(whole) < 390


def test_repeated_rows_are_treated_alike(spark):
    rows, *_ = odd_rows()
    docs = spark.createDataFrame([rows[0], rows[0], rows[9], rows[9]], "doc_id bigint, text string")
    found = {}
    for r in L.line_dedup_report(docs).collect():
        found.setdefault(r["doc_id"], set()).add((r["text"], r["lines_removed"]))
    assert {k: v.pop() for k, v in found.items() if len(v) == 1} == plain([rows[0], rows[9]])


def test_empty_table(spark):
    assert L.line_dedup_report(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
