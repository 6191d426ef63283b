import random

import numpy as np
import pytest

from brute import jaccard_components
from ledgerloom.llm import jaccard_join as jj

DOCS = "doc_id long, text string, key string, set long, comp long, row long"


def _rows():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdef") for _ in range(4))
    out = []
    for size in (3, 6, 7, 9, 30, 80, 81, 200, 400):
        base = [word() for _ in range(size)]
        for edits in (0, 0, 1, 2, 3, 5, 8):
            words = list(base)
            for _ in range(edits):
                words[rnd.randrange(size)] = word()
            out.append(" ".join(words))
    passage = [word() for _ in range(60)]
    for _ in range(60):  # one passage in many texts that aren't near copies
        out.append(" ".join([word() for _ in range(rnd.randint(10, 60))] + passage + [word() for _ in range(rnd.randint(10, 60))]))
    base = [word() for _ in range(90)]
    for _ in range(80):  # a large group of near copies
        words = list(base)
        for _ in range(rnd.randint(0, 3)):
            words[rnd.randrange(90)] = word()
        out.append(" ".join(words).upper() if rnd.random() < 0.2 else " ".join(words))
    out += ["", None, " \n ", "a", "A", "a b c", "a b  c"]
    return [(i, t, None, 1, 2, 3) for i, t in enumerate(out)]


@pytest.mark.parametrize("shingle,percent", [(4, 85), (5, 80)])
def test_components_against_all_pairs(spark, shingle, percent):
    rows = _rows()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jj.components(spark.createDataFrame(rows, DOCS), shingle, percent).collect()}
    for d, n, c in jaccard_components([r[:2] for r in rows], shingle, percent):
        assert got[d] == (n, c), d


def test_one_of_each(spark):
    text = "one two three four five six seven"
    df = spark.createDataFrame([(3, text, "a", 1, 1, 1), (2, text, "b", 1, 1, 1), (2, text, "b", 1, 1, 1), (None, text, "c", 1, 1, 1),
                                (5, None, "d", 1, 1, 1), (5, "", "e", 1, 1, 1), (5, "", "e", 1, 1, 1)], DOCS)
    left = jj.one_of_each(df)
    assert left.columns == df.columns
    assert sorted((r.doc_id, r.key) for r in left.collect()) == [(2, "b"), (5, "d"), (5, "e"), (5, "e")]
    assert jj.components(df.limit(0)).count() == 0


def test_a_link_shares_a_list_and_never_fails_the_sketch():
    rng = np.random.default_rng(1)
    link = jj.Link(85)
    bounds = link.classes(5000)
    for n in (6, 7, 12, 13, 19, 20, 33, 100, 700, 3000):
        for _ in range(40):
            base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            gone = rng.integers(0, max(1, int(0.15 * n)) + 1)
            new = rng.integers(0, max(1, int(0.1 * n)) + 1)
            other = np.unique(np.concatenate((rng.permutation(base)[gone:], rng.integers(0, 2**63, new, dtype=np.uint64))))
            common = len(np.intersect1d(base, other))
            total = len(base) + len(other)
            apart = jj.distances(jj.sketch(base), [jj.sketch(other)])[0]
            assert apart <= total - 2 * common
            if 100 * common >= 85 * (total - common) and total > 2 * common:
                a, b = (np.concatenate(jj.index_keys(x, link, bounds)) for x in (base, other))
                assert len(np.intersect1d(a, b)), (n, gone, new)


def test_lists_over_batches_are_like_one_batch():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    rows = sorted(set(zip(rng.integers(0, 30, 400).tolist(), rng.integers(0, 50, 400).tolist())))
    made = lambda part: pa.RecordBatch.from_pydict({"key": pa.array([k for k, _ in part], pa.int64()), "set": pa.array([s for _, s in part], pa.int64())})

    def run(size):
        out = [b.to_pylist() for b in jj._lists(iter([made(rows[i:i + size]) for i in range(0, len(rows), size)]))]
        flat = [(r["key"], r["a"], r["b"]) for b in out for r in b]
        return {x[:2] for x in flat if x[1] == x[2]}, {x[1:] for x in flat if x[1] != x[2]}

    members, pairs = run(1000)
    by_key = {}
    for k, s in rows:
        by_key.setdefault(k, []).append(s)
    several = {(k, s) for k, v in by_key.items() if len(v) > 1 for s in v}
    stars = {(v[0], s) for v in by_key.values() for s in v[1:]}
    assert several <= members and stars <= pairs
    for size in (1, 2, 7, 50):
        m, p = run(size)
        assert several <= m and stars <= p


def test_keys_of_the_pipelines_bar_are_few_and_link_nothing_by_empty_blocks():
    """At 0.8 unlike sets that share a line meet in few lists, and linked sets of all sizes still meet."""
    rng = np.random.default_rng(4)
    link = jj.Link(80)
    bounds = link.classes(5000)
    line = rng.integers(0, 2**63, 10, dtype=np.uint64) * np.uint64(2)
    meet = []
    for n in (40, 90, 300, 1000, 2500):
        sets = [np.unique(np.concatenate((line, rng.integers(0, 2**64, n, dtype=np.uint64)))) for _ in range(60)]
        keys = [np.unique(np.concatenate(jj.index_keys(s, link, bounds))) for s in sets]
        shared = np.unique(np.concatenate(keys), return_counts=True)[1]
        meet.append(int((shared * (shared - 1) // 2).sum()) / (60 * 59 / 2))
        for k in range(40):
            larger = np.unique(np.concatenate((sets[k], rng.integers(0, 2**64, n * (k % 26) // 100, dtype=np.uint64))))
            common, total = len(sets[k]), len(sets[k]) + len(larger)
            if 100 * common >= 80 * (total - common) and len(larger) > common:
                assert len(np.intersect1d(keys[k], np.concatenate(jj.index_keys(larger, link, bounds)))), (n, k)
    assert max(meet) < 0.5, meet  # lists that an unlike pair meets in


def test_the_pipelines_near_copies_are_five_words_and_80():
    import corpus_pipeline

    assert (corpus_pipeline.SHINGLE, corpus_pipeline.PERCENT) == (5, 80)
