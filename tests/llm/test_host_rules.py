from brute import text_rules
from ledgerloom.llm import host_rules

DOCS = "doc_id long, text string, source string, host string, words int"


def test_counts_against_plain_version(spark):
    texts = ["", None, " \n\t ", "a", "a b", "a b c", "a b c a b c", "x\nx\n\nx \n  \ny", "# * $ é%&|<> ünï " * 5, "one two three four " * 40,
             "\x0b\x0ca\x1cb c", "w " * 300, " ".join(f"w{i % 97}" for i in range(5000))]
    rows = [(i, t, "h", "other", 1) for i, t in enumerate(texts)]
    for r in host_rules.document_rules(spark.createDataFrame(rows, DOCS)).collect():
        n, chars, symbols, dup, rep = text_rules(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep), r.doc_id
        assert r.base_failed == (n < 50 or 100 * rep > 50 * n)


def test_host_verdicts_shrink_small_hosts(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(i, "bad" if i % 10 else good, "spam", None, 0) for i in range(200)]
    rows += [(1000 + 40 * k + i, good, f"good{k}", None, 0) for k in range(12) for i in range(40)]
    rows += [(5000, "bad", "small", None, 0), (5001, good, "small", None, 0), (5002, good, None, None, 0), (5003, "bad", None, None, 0)]
    df = spark.createDataFrame(rows, DOCS)
    kept = {r.doc_id: r.kept for r in host_rules.judge(df).collect()}
    assert len(kept) == len(rows)
    assert not any(kept[i] for i in range(200))  # nine of ten failed: the host is rejected
    assert kept[5001] and kept[5002] and not kept[5003] and not kept[5000]
    assert all(kept[r[0]] for r in rows if str(r[2]).startswith("good"))
    assert host_rules.judge(df.limit(0)).count() == 0
