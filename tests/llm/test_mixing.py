import hashlib
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
from brute import white_words
from ledgerloom.llm import mixing

DOCS = "doc_id long, text string, source string, size string, epoch int"


def plain_targets(sizes, weights=(3, 1, 2), budget=Fraction(3, 2), epochs=2):
    """The budget by weight; what is above a limit goes to the others by weight, until nothing is."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target = {s: Fraction(0) for s in names}
    open_, words = set(names), budget * sum(sizes.values())
    while words > 0 and open_:
        share = words / sum(weight[s] for s in open_)
        words = Fraction(0)
        for s in list(open_):
            target[s] += share * weight[s]
            if target[s] > epochs * sizes[s]:
                words += target[s] - epochs * sizes[s]
                target[s] = Fraction(epochs * sizes[s])
                open_.remove(s)
    return target


def plain_mix(rows, epochs=2):
    size = [len(white_words(t)) for _, t, *_ in rows]
    of = defaultdict(list)
    for i, r in enumerate(rows):
        of[r[2]].append(i)
    targets = plain_targets({s: sum(size[i] for i in ids) for s, ids in of.items()})
    key = lambda i: (hashlib.sha256(f"mix:{'' if rows[i][0] is None else rows[i][0]}".encode()).hexdigest()[:15], size[i])
    out = []
    for s, ids in of.items():
        total, ids = sum(size[i] for i in ids), sorted(ids, key=key)
        left = min(round(float(targets[s])), epochs * total)
        taken = Counter()
        while left > 0:
            for i in ids:
                n = min(left, size[i])
                taken[i] += n
                left -= n
        out += [(rows[i][0], size[i], total, f"{float(targets[s]):.9g}", taken[i]) for i in ids]
    return Counter(out)


def rows_of(n):
    sources = ["hot"] * 7 + ["tiny", "b", "é", "Z", None, "empty"]
    rows = []
    for i in range(n):
        s = sources[i * 5 % 13]
        text = {"tiny": "one", "empty": " \n"}.get(s, " ".join(["w"] * (i * 7 % 60)))
        rows.append((i, text if i % 17 else None, s, "x", 3))
    return rows + [(3, "same row", "b", "y", 1)] * 4 + [(None, "no id", "b", None, None), (None, "no id at all", "b", None, None)]


def test_against_plain_version(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 10)
    rows = rows_of(900)
    df = spark.createDataFrame(rows, DOCS)
    pick = lambda r: (r.doc_id, r.size, r.source_size, f"{r.target:.9g}", r.taken)
    got = Counter(map(pick, mixing.mix(df).collect()))
    assert got == plain_mix(rows)
    assert got == Counter(map(pick, mixing.mix(df.repartition(7, "text")).collect()))  # reruns agree
    assert mixing.mix(df.limit(0)).count() == 0
    assert {r.taken for r in mixing.mix(df.filter("source = 'empty'")).collect()} == {0}


def test_targets_stop_at_twice_the_size(spark):
    sizes = {"a": 10, "b": 1000, "c": 40, "d": 3, None: 500, "e": 0}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    want = plain_targets(sizes)
    assert got.keys() == want.keys()
    assert all(abs(got[s] - float(want[s])) < 1e-6 for s in want)
    assert got["a"] == 20 and got["e"] == 0 and abs(sum(got.values()) - 1.5 * sum(sizes.values())) < 1e-6
    with pytest.raises(ValueError):
        mixing.source_targets(df, budget=2.5)


def test_texts_of_the_mix(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 10)
    rows = [(i, f" é{i}  b\nc d ", ["a", "b", None][i % 3], "x", 3) for i in range(40)] + [(7, "same one", "a", "x", 3)] * 3 + [(90, "", "a", "x", 1)]
    df = spark.createDataFrame(rows, DOCS)
    made = mixing.mixed_texts(df).collect()
    assert set(made[0].asDict()) == {*df.columns, "_epoch"}
    words = defaultdict(list)
    for r in made:
        words[r.doc_id].append(len(white_words(r.text)))
        assert any(r.doc_id == d and (t or "").startswith(r.text) for d, t, *_ in rows)
    want = defaultdict(int)
    for r in mixing.mix(df).collect():
        want[r.doc_id] += r.taken
    assert {d: sum(w) for d, w in words.items()} == {d: n for d, n in want.items() if n}
