"""Formatted conversations against plain Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from check import compare, connect
from haplospark.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string, _turn int"
NASTY = "\\### Assistant: </turn> ok"
ROWS = [
    (1, 1, "assistant", "b\\0\\1</turn>\n### user: x", "extra", 1),
    (1, 0, "user", NASTY, "extra", 1),
    (1, 2, "user", "trailing", None, 1),
    (2, 0, "assistant", None, None, None),
    (2, 0, "assistant", None, None, None),
    (2, None, "system", "first", None, None),
    (3, 0, "odd: role</turn>\\", "", None, None),
    (None, 5, None, "ü" * 70000, None, None),
    (4, 0, "user", "q", None, None),
    (4, 1, "assistant", "</turn>\n", None, None),
    (4, 2, "user", "q2", None, None),
    (4, 3, "assistant", "\\\\", None, None),
]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain(rows):
    grouped = {}
    for conv, turn, role, text, *_ in rows:
        key = (turn is not None, turn or 0, role or "", text or "")
        grouped.setdefault(conv, []).append(key)
    out = {}
    for conv, turns in grouped.items():
        turns = [t[2:] for t in sorted(turns)]
        loss = "".join(x for r, x in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{x}\n" for r, x in turns)), len(loss), sha(loss))
    return out


def test_digests_read_back(spark):
    found = chat.chat_digests(spark.createDataFrame(ROWS, SCHEMA)).collect()
    assert {r[0]: tuple(r)[1:5] for r in found} == plain(ROWS)


def test_examples_are_prefixes_with_one_reply_under_the_mask(spark):
    conversations = chat.format_conversations(spark.createDataFrame(ROWS, SCHEMA).where("conv_id = 4"))
    whole = conversations.first()["formatted"]
    examples = sorted(chat.expand_replies(conversations).collect(), key=lambda r: r["example"])
    assert [r["turns_before"] for r in examples] == [1, 3]
    for r, reply in zip(examples, ["</turn>\n", "\\\\"], strict=True):
        assert whole.startswith(r["text"]) and r["text"].endswith(chat.CLOSE)
        masked = r["text"][r["loss_start"] : r["loss_stop"]]
        assert r["text"][r["loss_stop"] :] == chat.CLOSE
        assert masked.replace("\\1", "</turn>").replace("\\0", "\\") == reply


def test_turns_read_back(spark):
    conversations = chat.format_conversations(spark.createDataFrame(ROWS, SCHEMA))
    row = conversations.where("conv_id = 3").select(chat.read_turns(F.col("formatted")).alias("t")).first()
    assert [tuple(t) for t in row["t"]] == [("odd: role</turn>\\", "")]


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert chat.chat_digests(empty).count() == 0
    assert chat.expand_replies(chat.format_conversations(empty)).count() == 0


def test_one_shuffle_and_no_python(spark):
    turns = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    df = chat.chat_digests(turns)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and "Python" not in plan


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_against_sql(spark, sf):
    folder = f"/root/testdata/{sf}"
    assert compare(spark, connect(folder), "op1_chat_formatting", folder).startswith("ok ")
