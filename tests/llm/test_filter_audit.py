import random
import re
from collections import Counter
from itertools import permutations

from brute import white_words
from ledgerloom.llm import filter_audit

DOCS = "doc_id long, text string, source string, part string, number long"


def failures(rows):
    """Set of filters that each row fails, by the plain definitions."""
    least = {}
    for d, t, *_ in rows:
        if d is not None:
            least[t or ""] = min(d, least.get(t or "", d))
    out = []
    for d, t, *_ in rows:
        t = t or ""
        w = white_words(t)
        out.append({f for f, bad in {
            "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)), "E": d is not None and d > least[t],
        }.items() if bad})
    return out


def plain_audit(rows, labels):
    fails = failures(rows)
    good, toxic = ({d for d, q, t in labels if d is not None and x(q, t)} for x in (lambda q, t: q == 1, lambda q, t: t == 1))
    out, shapley = {}, Counter()
    for part in {r[2] or "" for r in rows}:
        own = [(f, r[0]) for f, r in zip(fails, rows) if (r[2] or "") == part]
        for order in permutations("ABCDE"):
            left = own
            for i, f in enumerate(order):
                gone = [x for x in left if f in x[0]]
                left = [x for x in left if f not in x[0]]
                failed = sum(f in x[0] for x in own)
                out[part, "".join(order), i + 1] = [
                    len(left), len(gone), failed - len(gone), sum(x[0] == {f} for x in own),
                    sum(x[1] in good for x in gone), sum(x[1] in toxic for x in gone),
                ]
                shapley[part, f] += len(gone)
    return {k: tuple(v + [shapley[k[0], k[1][k[2] - 1]]]) for k, v in out.items()}


def test_against_plain_version(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "HOT_SHARE", 20)  # texts on both sides of the bound
    rnd = random.Random(3)
    words = [f"w{i}" for i in range(200)] + ["Xy", "ABC", "#", "a&b", "é", "ÄÖ"]
    texts = [None, "", " \n", "A", "same text", "long " * 9000]
    texts += [" ".join(rnd.choices(words[:rnd.choice([20, 206])], k=rnd.choice([10, 49, 50, 51, 80]))) for _ in range(60)]
    texts += [" ".join(f"u{i}" for i in range(60)), " ".join(f"u{i}" for i in range(60)) + " $"]
    rows = [(i, rnd.choice(texts), rnd.choice(["hot", "hot", "b", None, ""]), "x", 7) for i in range(400)]
    rows += [(5, "again", "b", "x", 1)] * 3 + [(None, "same text", "b", None, None)] * 2 + [(1000 + i, "", "hot", "x", 0) for i in range(150)]
    rows += [(-1, "alone", "only here", "x", 1)]
    labels = [(rnd.randrange(450), rnd.choice([0, 1, None]), rnd.choice([0, 1])) for _ in range(300)] + [(None, 1, 1)]
    docs = spark.createDataFrame(rows, DOCS)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = filter_audit.audit(docs, known).collect()
    made = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in got}
    assert len(made) == len(got)
    assert made == plain_audit(rows, labels)
    assert filter_audit.audit(docs.limit(0), known).count() == 0
    assert filter_audit.audit(docs, known.limit(0)).agg({"good_lost": "sum"}).first()[0] == 0


def test_removal_relation_holds_each_set_once(spark):
    rows = [(i, t, "s", None, None) for i, t in enumerate(["A#", "a", " ".join(f"u{i}" for i in range(60)), "A#"])]
    _, failing = filter_audit.failing_ids(spark.createDataFrame(rows, DOCS))
    assert {f: sorted(r.doc_id for r in t.collect()) for f, t in failing.items()} == {"A": [0, 1, 3], "B": [], "C": [0, 3], "D": [0, 3], "E": [3]}
    got = Counter((r["filter"], r.before) for r in filter_audit.removals(failing).collect())
    assert got["A", ""] == 3 and got["A", "BE"] == 2 and got["A", "D"] == 1 and ("D", "C") not in got and got["D", "BE"] == 1
