import hashlib

import numpy as np
import pytest

from ledgerloom.llm import fill_middle

DOCS = "doc_id long, text string, n string, form int, _first string"


def plain_version(doc_id, text):
    """(n, form, prefix chars, middle chars, output)."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    n = len(text)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


TEXTS = [None, "", "a", "ab", "é", "日本語テキスト", "a<P>b", "<M>", "< P>", "x<", "P>y", "<<<<", "S>", "🙂<S", "\n \t", "<p><P", "same", "same",
         "w " * 3000, "😀é漢a" * 700_000]


def test_against_plain_version_and_round_trip(spark, monkeypatch):
    rows = [(i, t, "x", 1, "y") for i, t in enumerate(TEXTS * 12)] + [(None, "no id", None, None, None)] * 3
    rows = [r for i, r in enumerate(rows) if r[1] is None or len(r[1]) < 9000 or i < 2 * len(TEXTS)]
    df = spark.createDataFrame(rows, DOCS)
    made = fill_middle.cut_texts(df)
    assert made.columns == ["doc_id", "text", "n", "form", "_first", "_n", "_form", "prefix_chars", "middle_chars"]
    forms = set()
    out = made.collect()
    assert len(out) == len(rows)
    texts = {r[0]: r[1] for r in rows}
    for r in out:
        want = plain_version(r.doc_id, texts[r.doc_id])
        assert (r["_n"], r["_form"], r.prefix_chars, r.middle_chars, r.text) == want, r.doc_id
        assert r.n == ("x" if r.doc_id is not None else None)
        forms.add(r["_form"])
    assert forms == {"plain", "psm", "spm"}
    for r in fill_middle.restore(made, form_col="_form").collect():
        assert r.text == (texts[r.doc_id] or "")
    sums = fill_middle.digest(df.filter("length(text) < 9000 or text is null"))
    for r in sums.collect():
        text = texts[r.doc_id] or ""
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.output_sha256 == hashlib.sha256(plain_version(r.doc_id, text)[4].encode()).hexdigest()
    assert fill_middle.digest(df.limit(0)).count() == 0


def test_shifts_in_small_pieces(monkeypatch):
    monkeypatch.setattr(fill_middle, "BYTES_AT_ONCE", 3)
    rnd = np.random.default_rng(5)
    marks = fill_middle.Rule().marks()
    for _ in range(200):
        texts = ["".join(rnd.choice(list("a<PSM>é漢"), rnd.integers(0, 9))) for _ in range(rnd.integers(0, 8))]
        texts = [t for t in texts if not any(m in t for m in ("<P>", "<S>", "<M>"))]
        each = [t.encode() for t in texts]
        data, edges = np.frombuffer(b"".join(each), np.uint8), np.cumsum([0] + [len(e) for e in each])
        form = rnd.integers(0, 3, len(texts))
        cuts = np.sort([[rnd.integers(0, len(t) + 1) for t in texts] for _ in range(2)], axis=0).astype(np.int64).reshape(2, -1)
        p, q = (fill_middle.byte_of_point(data, edges, c) for c in cuts)
        made, out = fill_middle.scatter(data, edges, p, q, form, marks)
        for t, f, (a, b), x, y in zip(texts, form, cuts.T, out[:-1], out[1:]):
            want = [t, f"<P>{t[:a]}<S>{t[b:]}<M>{t[a:b]}", f"<S>{t[b:]}<P>{t[:a]}<M>{t[a:b]}"][f]
            assert made[x:y].tobytes().decode() == want
        back, begin = fill_middle.gather(made, out, form, marks)
        assert back.tobytes() == data.tobytes() and (begin == edges).all()


def test_a_broken_output_and_bad_marks_raise(spark):
    df = spark.createDataFrame([(1, "<P>a<S>b", "psm")], "doc_id long, text string, form string")
    with pytest.raises(Exception, match="not a cut text"):
        fill_middle.restore(df).collect()
    with pytest.raises(ValueError):
        fill_middle.Rule(prefix="<S>").marks()
