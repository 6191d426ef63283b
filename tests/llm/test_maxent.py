import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import maxent

DOCS = "doc_id long, text string, code long, n long, known long"


def _rows(n=300):
    rnd = random.Random(4)
    left = ["".join(rnd.choice("abc") for _ in range(5)) + "ing" for _ in range(40)]
    right = ["".join(rnd.choice("xyz") for _ in range(5)) + "tion" for _ in range(40)]
    rows = []
    for i in range(n):
        words = []
        for _ in range(rnd.randint(0, 60)):  # the two kinds take turns
            words += [rnd.choice(left), rnd.choice(right)]
        rows.append((i, " ".join(words).title() + rnd.choice(["", "\n", " Éa"]), 1, 2, 3))
    return rows + [(n, None, 0, 0, 0), (n + 1, "", 0, 0, 0), (n + 2, " \t", 0, 0, 0), (n + 3, "a" * 300, 0, 0, 0)]


def _tokens(text):
    return (text or "").encode().lower().split() + [None]


@pytest.mark.parametrize("frequent", [262_144, 40, 0])
def test_base_score_against_counts(spark, monkeypatch, frequent):
    monkeypatch.setattr(maxent, "FREQUENT", frequent)
    rows = _rows()
    got = {r.doc_id: r for r in maxent.scored(spark.createDataFrame(rows, DOCS)).collect()}
    held = lambda d: zlib.crc32(str(d).encode()) % 10 == 0
    c = Counter(t for d, x, *_ in rows if not held(d) for t in _tokens(x))
    total = sum(c.values())
    norm = math.log10(total + 0.1 * (len(c) + 1))
    for d, x, *_ in rows:
        t, r = _tokens(x), got[d]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(d), len(t), sum(c[w] > 0 for w in t), total)
        assert r.base_score == pytest.approx(sum(math.log10(c[w] + 0.1) - norm for w in t), abs=1e-8)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > 0.97 * sum(r.base_score for r in out)  # both are below zero: the model knows the turns


def test_probabilities_sum_to_one():
    rows = _rows(60)
    t = maxent.Tokens.of([r[1] for r in rows])
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(sum(maxent.ROWS), maxent.CLASSES)).astype(np.float32)
    z = maxent._log_softmax(weights, np.zeros(maxent.CLASSES, np.float32), t.rows())
    assert np.allclose(np.exp(z).sum(axis=1), 1, atol=1e-5)


def test_a_step_follows_the_gradient():
    t = maxent.Tokens.of([r[1] for r in _rows(200)])
    classes = np.arange(maxent.SHAPES) % maxent.CLASSES
    weights, bias = np.zeros((sum(maxent.ROWS), maxent.CLASSES), np.float32), np.zeros(maxent.CLASSES, np.float32)
    loss = lambda: -maxent._log_softmax(weights, bias, t.rows())[np.arange(len(t.code)), classes[t.shape]].mean()
    before = loss()
    for _ in range(3):
        maxent.descend(weights, bias, np.zeros(len(weights), np.int64), np.full(len(weights), 1e-2, np.float32), t, classes)
    assert loss() < 0.5 * before


def test_empty_tables(spark):
    df = spark.createDataFrame(_rows(20), DOCS)
    assert maxent.scored(df.limit(0)).count() == 0
    only_held = spark.createDataFrame([(d, "a b", 0, 0, 0) for d in range(200) if zlib.crc32(str(d).encode()) % 10 == 0], DOCS)
    assert all(r.n_known == 0 and math.isfinite(r.score) for r in maxent.scored(only_held).collect())
