import random

import pytest

import corpus_pipeline
from brute import contamination, jaccard_components, repeated_bytes
from ledgerloom.session import cut


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefg") for _ in range(5))
    make = lambda n: [word() for _ in range(n)]
    items = [" ".join(make(25)) for _ in range(5)]
    passage = " ".join(make(70))
    texts = []
    for i in range(160):
        body = make(rnd.randint(40, 160))
        if i % 8 == 0:
            for _ in range(4):
                body[rnd.randrange(len(body))] = rnd.choice(["zzbad", "qqugly"])
        if i % 11 == 3:
            body[5:5] = passage.split(" ")
        if i % 13 == 5:
            body = body[:60] + rnd.choice(items).split(" ")
        texts.append(" ".join(body))
    for i in range(20):  # near copies
        words = texts[20 + i].split(" ")
        words[len(words) // 2] = word()
        texts.append(" ".join(words))
    texts += [texts[1], texts[1], "", None]
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    d = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    labels = [(i, 1, int("zzbad" in (t or "") or "qqugly" in (t or ""))) for i, t in enumerate(texts)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return str(d)


def test_each_stage_on_its_own_input(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = cut(stage(spark, docs, sf_dir), f"test-{name}")
        if name != "packing":
            assert docs.columns == columns
            after = {r.doc_id: r.text for r in docs.collect()}
            assert all(r.n_chars == len(r.text or "") for r in docs.collect())
        rows = sorted(before.items())
        if name == "toxicity":
            toxic = {d for d, t in rows if "zzbad" in (t or "") or "qqugly" in (t or "")}
            gone = set(before) - set(after)
            assert not gone - toxic and len(gone) > 0.8 * len(toxic)
            assert all(after[d] == before[d] for d in after)
        elif name == "jaccard_join":
            assert set(after) == {d for d, n, c in jaccard_components(rows, 5, 80) if c == d}
        elif name == "suffix_repeats":
            assert {d: (t or "").encode() for d, t in after.items()} == {d: k for d, _, k, _ in repeated_bytes(rows, keep="first")}
        elif name == "decontamination":
            assert set(after) == {d for d, n, h, _ in contamination(rows, items) if not (h and 20 * h >= n)}
        else:
            assert {r.doc_id for r in docs.collect()} == set(before)


def test_run_and_empty_table(spark, sf_dir, tmp_path):
    packed = corpus_pipeline.run(spark, sf_dir)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"empty-{name}")
        assert docs.count() == 0
