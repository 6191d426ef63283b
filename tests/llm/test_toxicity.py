import random
import zlib

import numpy as np
import pytest

from ledgerloom.llm import toxicity

DOCS = "doc_id long, text string, code long, positive int, score double"
LABELS = "doc_id long, toxic int, quality int, code string"


def _case(n=1500):
    rnd = random.Random(2)
    plain = ["".join(rnd.choice("abcdefgh") for _ in range(6)) for _ in range(2000)]
    slurs = ["zzbad", "qqugly", "vvnasty"]
    rows, labels = [], []
    for i in range(n):
        toxic = rnd.random() < 0.15
        words = [rnd.choice(plain) for _ in range(rnd.randint(10, 150))]
        if toxic:
            for _ in range(rnd.randint(2, 6)):
                words[rnd.randrange(len(words))] = rnd.choice(slurs) + rnd.choice(["", "s", "er", "ly"])
        rows.append((i, " ".join(words), 0, 0, 0.0))
        if rnd.random() < 0.5:
            labels.append((i, int(toxic), 1, "x"))
    truth = [any(s in r[1] for s in slurs) for r in rows]
    return rows, labels, truth


def test_held_out_accuracy(spark):
    rows, labels, truth = _case()
    got = toxicity.scored(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert sorted(r.doc_id for r in got) == list(range(len(rows)))
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    held = [(truth[r.doc_id], r.predicted) for r in got if r.held_out]
    assert np.mean([p for t, p in held if t]) > 0.85 and np.mean([p for t, p in held if not t]) < 0.02


def test_labels_of_the_held_out_fold_and_other_columns_are_no_inputs(spark):
    rows, labels, _ = _case(400)
    held = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    a = toxicity.scored(spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, LABELS))
    turned = [(i, 1 - t if held(i) else t, q, c) for i, t, q, c in labels]
    b = toxicity.scored(spark.createDataFrame([(*r[:2], 7, 1, 9.0) for r in rows], DOCS), spark.createDataFrame(turned, LABELS))
    assert {r.doc_id: r.score for r in a.collect()} == {r.doc_id: r.score for r in b.collect()}


def test_edge_cases(spark):
    rows = [(1, None, 0, 0, 0.0), (2, "", 0, 0, 0.0), (None, "zzbad", 0, 0, 0.0), (2, "", 0, 0, 0.0), (3, "a " * 50_000, 0, 0, 0.0)]
    docs = spark.createDataFrame(rows, DOCS)
    none = spark.createDataFrame([], LABELS)
    got = toxicity.scored(docs, none).collect()
    assert len(got) == 5 and len({r.score for r in got}) == 1 and not any(r.predicted for r in got)
    odd = spark.createDataFrame([(1, None, 1, "x"), (None, 1, 1, "x"), (2, 1, 1, "x"), (2, 0, 1, "x")], LABELS)
    left = toxicity.without_toxic(docs, odd)
    assert left.columns == docs.columns
    assert toxicity.scored(docs.limit(0), none).count() == 0


@pytest.mark.parametrize("sign", [1, -1])
def test_the_risk_never_pays_for_overfitting(sign):
    # Equal texts on both sides: nothing tells them apart, so no weight may grow.
    texts = [f"word{i % 7} other{i % 5}" for i in range(300)]
    weights, bias = toxicity.train(texts, texts[::sign], 0.2)
    assert not weights.any()
