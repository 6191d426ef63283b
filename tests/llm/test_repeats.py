import hashlib
import random

import numpy as np
import pytest

from brute import repeated_bytes
from ledgerloom.llm import repeats

DOCS = "doc_id long, text string, begin int, bits string"


def _texts():
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice("abcdeéè") for _ in range(rnd.randint(2, 9)))
    make = lambda n: " ".join(word() for _ in range(n))
    shared, other = make(60), make(45)
    out = [make(80) + " " + shared + " " + make(70), shared + make(5), make(3) + shared[20:] + make(9), other + make(4) + other]
    out += [make(150), make(40) + shared[:150], "x" * 700, "x" * 250, "", None, "short", out[0]]
    for _ in range(9):  # one passage, other text around it
        out.append(make(rnd.randint(3, 60)) + " " + other + " " + make(rnd.randint(3, 60)))
    base = make(120)
    for _ in range(6):  # near copies
        words = base.split(" ")
        words[rnd.randrange(len(words))] = word()
        out.append(" ".join(words))
    return out


def test_psv_and_lpf_against_plain_versions():
    rnd = np.random.default_rng(0)
    for n in (0, 1, 2, 50, 400):
        v = rnd.permutation(n)
        want = [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(n)]
        assert repeats.previous_smaller(v).tolist() == want
    strings = rnd.integers(97, 99, (120, 9)).astype(np.uint8)
    place = rnd.permutation(120)
    got = repeats.longest_previous_factor(strings, place)

    def lcp(a, b):
        return next((k for k in range(9) if a[k] != b[k]), 9)

    want = [max((lcp(strings[i], strings[j]) for j in range(120) if place[j] < place[i]), default=0) for i in range(120)]
    assert got.tolist() == want


@pytest.mark.parametrize("keep,crowded,frequent", [
    ("none", 20_000, 10), ("first", 20_000, 10), ("none", 20_000, 3), ("first", 20_000, 3), ("none", 2, 3), ("first", 2, 3), ("none", 1, 2), ("first", 1, 2),
])
def test_digest_against_all_strings(spark, monkeypatch, keep, crowded, frequent):
    monkeypatch.setattr(repeats, "CROWDED", crowded)
    monkeypatch.setattr(repeats, "HOT_IN_SAMPLE", frequent)
    monkeypatch.setattr(repeats, "SAMPLE_ROWS", 50)
    rows = [(i, t, 1, "x") for i, t in enumerate(_texts())]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.digest(spark.createDataFrame(rows, DOCS), keep=keep).collect()}
    for d, n, kept, spans in repeated_bytes([r[:2] for r in rows], keep=keep):
        assert got[d] == (n, n - len(kept), spans, hashlib.sha256(kept).hexdigest()), d


def test_repeated_rows_nulls_and_other_columns(spark):
    text = _texts()[0]
    rows = [(1, text, 0, None), (1, text, 0, None), (None, "a", None, None), (2, None, 5, "y")]
    df = spark.createDataFrame(rows, DOCS)
    assert all(r.n_removed == r.n_bytes for r in repeats.digest(df).collect() if r.doc_id == 1)
    left = repeats.dedup(df)
    assert left.columns == df.columns
    assert sorted(len(r.text) for r in left.collect() if r.doc_id == 1) == [0, len(text)]
    assert sorted((r.text or "-") for r in left.collect() if r.doc_id != 1) == ["-", "a"]
    assert repeats.digest(df.limit(0)).count() == 0


def test_text_ids_keep_the_first(spark):
    passage = " ".join(f"w{i}" for i in range(100))
    rows = [("c", "x " + passage, 0, "y"), ("a", passage, 0, "y"), ("b", passage + " z", 0, "y"), (None, passage, 0, "y")]
    left = {r.doc_id: r.text for r in repeats.dedup(spark.createDataFrame(rows, DOCS.replace("doc_id long", "doc_id string"))).collect()}
    assert left == {"a": passage, "b": " z", "c": "x ", None: ""}
