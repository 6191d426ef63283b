import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from ledgerloom.llm import packing, tokens

DOCS = "doc_id long, text string, number int, rank int, length string"


def _ids(text):
    t = Tokenizer.from_file(tokens.tokenizer_path())
    return t.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def test_words_encode_like_whole_texts():
    texts = ["Hello, World! it's 12ab\n\n x", "ΑΣ ΣΑΣ ab́ ́x \x1cy I'LL", "İstanbul ǅ ß ﬁ", "<|endoftext|> a<|startoftext|>b", "a." * 70, "é" * 90, "", " \t\r\n"]
    enc = tokens.WordEncoder(tokens.tokenizer_path())
    for _ in range(2):  # without and with the cache
        for t, got in zip(texts, enc.ids_bytes(texts)):
            assert np.frombuffer(got, "<u4").tolist() == _ids(t)[:-1], t


def test_plan_holds_every_piece_once_and_is_near_the_bound():
    rnd = np.random.default_rng(0)
    cases = [rnd.integers(1, 4097, 3000), rnd.lognormal(5.5, 1.2, 20000).astype(int).clip(1, 4096), np.full(5000, 1), np.full(700, 2049),
             np.concatenate((np.full(30000, 3), rnd.integers(1, 4097, 50))), np.array([4096]), np.array([], int)]
    for lengths in cases:
        h = np.bincount(lengths, minlength=4097)
        classes = packing.plan(h)
        held = np.zeros(4097, np.int64)
        for b in classes:
            assert b.count > 0 and sum(x * k for x, k in b.runs) == 4096 - b.free
            for x, k in b.runs:
                held[x] += k * b.count
        assert (held == h).all()
        used, bound = sum(b.count for b in classes), packing.lower_bound(h)
        assert used <= max(bound * 1.03 + 2, (lengths > 2048).sum() + 1)


def test_fit_lowers_the_error():
    h = np.zeros(101, np.int64)
    h[[60, 40, 50, 30, 20]] = 70, 70, 40, 10, 20
    made = packing.patterns(h, 100)
    def error(x):
        used = np.zeros(101)
        for p, n in zip(made, x):
            for k in p:
                used[k] += n
        return ((used - h) ** 2).sum()
    assert error(packing.fit(h, made)) < 0.2 * error(np.zeros(len(made)))


def test_pack_round_trip(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["alpha", "Beta.", "ünder", "x1", "'s"]) for _ in range(rnd.choice([0, 1, 5, 30, 90]))), 1, 2, "l") for i in range(60)]
    rows += [(100, None, 0, 0, None), (101, "", 0, 0, None), (3, rows[3][1], 0, 0, None), (102, "long word " * 150, 0, 0, None)]
    df = spark.createDataFrame(rows, DOCS)
    capacity = 64
    got = packing.pack(df, capacity, with_ids=True).collect()
    pieces = defaultdict(list)
    places = defaultdict(list)
    for r in got:
        assert len(r.ids) == 4 * r.length and zlib.crc32(bytes(r.ids)) == r.ids_crc32
        pieces[r.doc_id].append((r.piece, r.start, r.length, bytes(r.ids)))
        places[r.sequence_id].append((r.offset, r.length))
    for p in places.values():  # gapless and never over capacity
        p.sort()
        assert [o for o, _ in p] == np.cumsum([0] + [n for _, n in p])[:-1].tolist() and sum(n for _, n in p) <= capacity
    for d, t, *_ in rows:
        ids = np.array(_ids(t), "<u4").tobytes()
        want = [(k, k * capacity, len(ids[a:a + 4 * capacity]) // 4, ids[a:a + 4 * capacity]) for k, a in enumerate(range(0, len(ids), 4 * capacity))]
        times = sum(r[0] == d for r in rows)
        assert sorted(pieces[d]) == sorted(want * times)
    assert packing.pack(df.limit(0), capacity).count() == 0
