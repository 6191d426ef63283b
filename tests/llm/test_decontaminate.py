import hashlib
import random

import pytest

from brute import contamination
from ledgerloom.llm import decontaminate as dc

DOCS = "doc_id long, text string, at int, code string, words long"
ITEMS = "item_id long, text string, at int"


def _case():
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice("abcé") for _ in range(3))
    items = [" ".join(word() for _ in range(n)) for n in (13, 20, 40, 40, 5, 1)]
    items[3] = items[2]
    rows = []
    for k in range(30):
        body = [word() for _ in range(rnd.randint(0, 120))]
        for _ in range(rnd.randint(0, 3)):
            part = rnd.choice(items).split(" ")
            a = rnd.randint(0, max(0, len(part) - 13))
            body[rnd.randint(0, len(body)):0] = part[a:a + rnd.randint(12, 30)]
        rows.append(rnd.choice([" ", ", ", "\n"]).join(body).upper().replace("É", "é"))
    rows += ["", None, "...", items[1], items[1] * 2, "ÉA " + items[0]]
    return [(i, t, 1, "c", 2) for i, t in enumerate(rows)] + [(0, rows[0], 1, "c", 2), (None, items[2], 0, None, None)], [
        (i, t, 0) for i, t in enumerate(items + ["", None, "!?"])
    ]


@pytest.mark.parametrize("bound", [10_000, 0])
def test_report_against_sets(spark, bound):
    rows, items = _case()
    got = dc.report(spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS), broadcast_windows=bound).collect()
    want = contamination([r[:2] for r in rows], [r[:2] for r in items])
    made = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got)
    assert made == sorted(
        (str(d), n, h, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), h > 0 and 20 * h >= n) for d, n, h, ids in want
    )


def test_removal_keeps_columns_and_clean_documents(spark):
    rows, items = _case()
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items[:4], ITEMS)
    bad = {d for d, n, h, _ in contamination([r[:2] for r in rows], [r[:2] for r in items[:4]]) if h and 20 * h >= n}
    left = dc.decontaminate(docs, bench)
    assert left.columns == docs.columns
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(r[0]) for r in rows if r[0] not in bad)
    cleaned = dc.decontaminate(docs, bench, remove="spans")
    assert cleaned.columns == docs.columns and cleaned.count() == len(rows)
    text = {r[0]: r[1] for r in rows}
    for r in cleaned.collect():
        n, h = contamination([(r.doc_id, text[r.doc_id])], [x[:2] for x in items[:4]])[0][1:3]
        assert (r.text == text[r.doc_id]) if not h else contamination([(0, r.text)], [])[0][1] == n - h


def test_empty_tables(spark):
    rows, items = _case()
    docs, bench = spark.createDataFrame(rows, DOCS), spark.createDataFrame(items, ITEMS)
    assert dc.report(docs.limit(0), bench).count() == 0
    assert {r.n_hit for r in dc.report(docs, bench.limit(0)).collect()} == {0}
