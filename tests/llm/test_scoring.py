"""Scores against plain sums, the gradient against differences, held-out likelihood."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from haplospark.llm import recurrent, scoring

SCHEMA = "doc_id bigint, text string, ids string, word int, n string"


def plain_base(rows):
    lowered = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = [[*re.findall(r"[^\x20\x09-\x0D]+", lowered(t)), "\n"] for _, t in rows]
    out = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(w for t, o in zip(tokens, out, strict=True) if not o for w in t)
    n, v = sum(counts.values()), len(counts)
    score = lambda t: sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in t)
    return [
        (o, len(t), sum(counts[w] > 0 for w in t), n, score(t)) for t, o in zip(tokens, out, strict=True)
    ]


@pytest.mark.parametrize("hot", [scoring.HOT, 500])
def test_query_on_whole_small_table(spark, hot):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    rows = sorted(map(tuple, docs.collect()))
    found = sorted(scoring.score_documents(docs, hot).collect())
    base = plain_base(rows)
    for r, expected in zip(found, base, strict=True):
        assert tuple(r)[1:6] == (*expected[:4], pytest.approx(expected[4]))
    unseen = [r for r in found if r["held_out"]]
    gain = sum(r["score"] - r["base_score"] for r in unseen) / sum(r["n_tokens"] for r in unseen)
    assert gain > 0.15


def tiny(dtype=np.float64):
    draw = np.random.default_rng(0)
    model = recurrent.Model.start(np.full(2 * recurrent.WIDTH + 3, 5.0), 2)
    vector = model.vector.astype(dtype) + draw.normal(0, 0.2, model.vector.shape).astype(dtype)
    return recurrent.Model(2, 3, vector), draw


def test_gradient():
    model, draw = tiny()
    size = model.words + model.alone
    inputs, targets = draw.integers(0, size, (2, 5, 4))
    fresh, state = draw.random((5, 4)) < 0.2, draw.normal(0, 0.5, (4, model.hidden))

    def loss(vector):
        other, s, total = recurrent.Model(2, 3, vector), state, 0.0
        for t in range(5):
            s = other.step(s * ~fresh[t][:, None], other.driven()[inputs[t]])[0]
            total -= other.log_probabilities(s, targets[t]).sum()
        return total / inputs.size

    _, gradient = recurrent.window_gradient(model, state, inputs, targets, fresh)
    for k in draw.choice(np.flatnonzero(np.abs(gradient.vector) > 1e-4), 80):
        up, down = model.vector.copy(), model.vector.copy()
        up[k] += 1e-5
        down[k] -= 1e-5
        assert gradient.vector[k] == pytest.approx((loss(up) - loss(down)) / 2e-5, rel=1e-4, abs=1e-7)


def test_probabilities_add_up():
    model, draw = tiny()
    states = draw.normal(0, 0.5, (3, model.hidden))
    every = np.arange(model.words + model.alone)
    for state in states:
        total = np.exp(model.log_probabilities(np.repeat(state[None], len(every), 0), every)).sum()
        assert total == pytest.approx(1)


def test_lanes_carry_the_state_through_whole_texts():
    model, draw = tiny(np.float32)
    texts = [draw.integers(0, 60, n) for n in (1, 700, 3, 2, 290, 1, 33)]
    for lanes, steps in ((2, 16), (512, 7)):
        found = recurrent.score_texts(model, texts, 0, lanes, steps)
        for text, total in zip(texts, found, strict=True):
            state, before, expected = np.zeros((1, model.hidden), np.float32), 0, 0.0
            for token in text:
                state = model.step(state, model.driven()[[before]])[0]
                expected += model.log_probabilities(state, np.array([token]))[0]
                before = token
            assert total == pytest.approx(expected, rel=1e-4)


def test_training_lowers_the_loss():
    texts = [np.array([k % 5 + 1 for k in range(s, s + 40)] + [0]) for s in range(400)]
    counts = np.bincount(np.concatenate(texts), minlength=2 * recurrent.WIDTH + 1).astype(float)
    model = recurrent.Model.start(counts, 2)
    before = recurrent.score_texts(model, texts, 0).sum()
    trainer = recurrent.Trainer(model, 0, 16, 10)
    for _ in range(5):
        for text in texts:
            trainer.add(text)
    trainer.flush()
    assert recurrent.score_texts(model, texts, 0).sum() > before / 2
    assert trainer.tokens == 5 * sum(map(len, texts))


def test_many_models_are_averaged_in_groups(spark, monkeypatch):
    monkeypatch.setattr(scoring, "FAN_IN", 2)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(7)
    found = scoring.score_documents(docs).collect()
    assert len(found) == docs.count() and all(math.isfinite(r["score"]) for r in found)


def test_odd_rows(spark):
    texts = [None, "", " ", "A a Ａ", "word " * 30000, "same", "same", "é\tü\x0bx"]
    rows = [(k if k != 5 else None, t) for k, t in enumerate(texts)] + [(6, "same")]
    found = scoring.score_documents(spark.createDataFrame([(*r, "i", 1, "n") for r in rows], SCHEMA)).collect()
    expected = sorted(
        ((r[0], *b[:4], round(b[4], 6)) for r, b in zip(rows, plain_base(rows), strict=True)), key=repr
    )
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in found), key=repr) == expected
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert scoring.score_documents(empty).count() == 0
    out = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 7 == 2)
    only = scoring.score_documents(spark.createDataFrame([(out, "a b", "i", 1, "n")], SCHEMA)).first()
    assert tuple(only)[:6] == (out, True, 3, 0, 0, 0.0) and math.isfinite(only["score"])


def test_words_of_one_count_have_outputs_of_their_own(spark):
    """No band of counts fits: the first words by count have ids still, the others their counts by a join."""
    words = [(f"w{k:03d}", 5) for k in range(400)] + [("\n", 3)]
    counts = spark.createDataFrame(words, "word string, n bigint")
    lexicon, rest = scoring.make_lexicon(counts, 100)
    own = scoring.CLASSES * scoring.WIDTH
    assert sum(0 < k < own for k in lexicon.ids) == own - 1
    left = {r["word"] for r in rest.collect()}
    assert left | {w.decode() for w in lexicon.words} == {w for w, _ in words} and not left & {w.decode() for w in lexicon.words}
    assert lexicon.totals.sum() == sum(n for _, n in words) and lexicon.totals[own:].sum() == 5 * (400 - own + 1)
