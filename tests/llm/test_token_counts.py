import random

from pyspark.sql import functions as F

from ledgerloom.llm import token_counts as tc

DOCS = "doc_id long, text string, n_tokens long, chars string"


def _texts():
    rnd = random.Random(6)
    words = ["the", "Quick", "naïve", "12", "don't", "...", "<x>", "a@b.example", "555-123-4567", "日本語"]
    return [rnd.choice([" ", "  ", "\n"]).join(rnd.choice(words) for _ in range(n)) for n in (0, 1, 5, 63, 64, 65, 400, 3000)] + ["", " \n\n ", "x" * 4000]


def test_random_edits_against_encoding_the_whole_text():
    rnd = random.Random(8)
    c = tc.counter(tc.vocabulary_path())
    bits = ["", "x", " ", "\n\n", "the quick", " 12 345'll", "  ", "é" * 5, "...\n"]
    for text in _texts():
        tree, now = tc.CountTree(text, c), text
        for _ in range(40):
            a = rnd.randint(0, len(now))
            b = min(len(now), a + rnd.choice([0, 0, 1, 2, 5, 40, 600]))
            new = rnd.choice(bits)
            now = now[:a] + new + now[b:]
            tree.edit(a, b, new)
            assert tree.text == now and tree.n_tokens == len(c.encoding.encode_ordinary(now))


def test_an_edit_encodes_little_of_a_long_text():
    c = tc.counter(tc.vocabulary_path())
    text = "some words of a long text " * 20_000
    tree = tc.CountTree(text, c)
    tree.edit(250_000, 250_004, "new")
    assert tree.reencoded < 10 * tc.LEAF < tree.n_tokens / 100


def test_query_and_kept_trees_agree(spark):
    rows = [(i, t, 0, "c") for i, t in enumerate(_texts())] + [(50, None, 0, "c"), (1, "a", 0, "c"), (None, "b@c.example x", 0, "c")]
    df = spark.createDataFrame(rows, DOCS).withColumn("edits", tc.masking_edits())
    c = tc.counter(tc.vocabulary_path())
    fresh = {(r.doc_id, r.n_tokens): r for r in tc.edited(df).collect()}
    assert len(fresh) == len({(r[0], len(c.encoding.encode_ordinary(r[1] or ""))) for r in rows})
    assert any(r.n_edits > 10 and 0 < r.n_reencoded for r in fresh.values())
    unique = df.filter("doc_id is not null and chars = 'c' and text != 'a'")
    kept = unique.join(tc.trees(unique).drop("n_tokens"), "doc_id")
    for r in tc.edited(kept).collect():
        assert r == fresh[r.doc_id, r.n_tokens]
    for r in tc.edited(df.withColumn("edits", F.lit(None).cast("array<struct<start:int,stop:int,text:string>>"))).collect():
        assert (r.n_edits, r.n_reencoded, r.n_tokens_after) == (0, 0, r.n_tokens)
    assert tc.edited(df.limit(0)).count() == 0


def test_masked_counts(spark):
    rows = [(i, t, 0, "c") for i, t in enumerate(_texts())]
    df = spark.createDataFrame(rows, DOCS).withColumn("edits", tc.masking_edits())
    c = tc.counter(tc.vocabulary_path())
    edits = {r.doc_id: r.edits for r in df.collect()}
    for r in tc.edited(df).collect():
        text = rows[r.doc_id][1]
        for e in sorted(edits[r.doc_id], key=lambda e: -e.start):
            text = text[:e.start] + e.text + text[e.stop:]
        assert r.n_tokens_after == len(c.encoding.encode_ordinary(text))
        assert "a@b" not in text
