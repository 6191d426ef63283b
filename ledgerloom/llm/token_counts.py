"""Edit-aware token counts: a segment tree of pre-token blocks per document.

A document's text is cut into pre-tokens, and blocks of ``LEAF`` pre-tokens are the leaves of a
segment tree of token and character sums. An edit finds its leaves by descending the character
sums, and only those leaves with a little context on both sides are encoded again: to the left
as far as a pre-token boundary could depend on edited characters, to the right until old and new
boundaries meet at the end of a leaf. The leaves' new sums then go up their paths.

The tree of a document is two arrays (characters and tokens per leaf) and can be kept as table
columns; ``edited`` takes them up again.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import query, table, texts
from .shingles import slices

LEAF = 64
CONTEXT = 3  # unedited characters that fix the boundary before them
CACHE_TOKENS = 500_000
_loaded: dict[str, "Counter"] = {}


def vocabulary_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Counter:
    """Numbers of tokens by pre-token, with a bounded cache."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.cache: dict[str, int] = {}

    def split(self, text: str) -> list[str]:
        return self.pattern.findall(text)

    def counts(self, tokens: list[str]) -> list[int]:
        cache = self.cache
        if len(cache) > CACHE_TOKENS:
            cache.clear()
        out = [cache.get(t) for t in tokens]
        if None in out:
            for i, (t, n) in enumerate(zip(tokens, out)):
                if n is None:
                    n = cache.get(t)
                    if n is None:
                        n = cache[t] = len(self.encoding.encode_ordinary(t))
                    out[i] = n
        return out


def counter(path: str) -> Counter:
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


class CountTree:
    """Token counts of one text under edits. Sums are kept in heap order: node k has children 2k and 2k+1."""

    def __init__(self, text: str, counter: Counter, chars: list[int] | None = None, tokens: list[int] | None = None):
        self.counter = counter
        if chars is None or tokens is None:
            parts = counter.split(text)
            counts = counter.counts(parts)
            starts = range(0, max(len(parts), 1), LEAF)
            self.leaves = ["".join(parts[a:a + LEAF]) for a in starts]
            tokens = [sum(counts[a:a + LEAF]) for a in starts]
        else:
            edges = np.cumsum([0, *chars]).tolist()
            self.leaves = [text[a:b] for a, b in zip(edges, edges[1:])]
        self.size = 1 << (len(self.leaves) - 1).bit_length()
        self.sums = np.zeros((2 * self.size, 2), np.int64)  # characters, tokens
        self.sums[self.size:self.size + len(self.leaves)] = list(zip(map(len, self.leaves), tokens))
        for k in range(self.size - 1, 0, -1):
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]
        self.reencoded = 0

    @property
    def n_tokens(self) -> int:
        return int(self.sums[1, 1])

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def leaf_sums(self) -> tuple[list[int], list[int]]:
        own = self.sums[self.size:self.size + len(self.leaves)]
        return own[:, 0].tolist(), own[:, 1].tolist()

    def _leaf(self, at: int) -> tuple[int, int]:
        """The leaf of a character, and the character's place in it; the end belongs to the last leaf."""
        k = 1
        while k < self.size:
            k *= 2
            if at >= self.sums[k, 0] and self.sums[k + 1, 0]:
                at -= int(self.sums[k, 0])
                k += 1
        return min(k - self.size, len(self.leaves) - 1), at

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.leaves[leaf] = text
        k = self.size + leaf
        self.sums[k] = len(text), tokens
        while k > 1:
            k //= 2
            self.sums[k] = self.sums[2 * k] + self.sums[2 * k + 1]

    def edit(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in place of the characters [start, stop) of the present text."""
        total = int(self.sums[1, 0])
        start = min(max(start, 0), total)
        stop = min(max(stop, start), total)
        first, offset = self._leaf(start)
        last, _ = self._leaf(max(stop - 1, start)) if stop > start else (first, 0)
        while first > 0 and offset < CONTEXT:
            first -= 1
            offset += len(self.leaves[first])
        body = "".join(self.leaves[first:last + 1])
        body = body[:offset] + new + body[offset + stop - start:]
        while True:
            # Two more leaves at least stand behind as context, or the text's end.
            ahead, k = "", last + 1
            while k < len(self.leaves) and len(ahead) < CONTEXT:
                ahead += self.leaves[k]
                k += 1
            parts, at = [], 0
            for part in self.counter.split(body + ahead):
                if at >= len(body):
                    break
                parts.append(part)
                at += len(part)
            if at == len(body):
                break
            body, last = body + "".join(self.leaves[last + 1:k]), k - 1
        counts = self.counter.counts(parts)
        self.reencoded += sum(counts)
        n = last - first + 1
        edges = [len(parts) * i // n for i in range(n + 1)]
        for i in range(n):
            a, b = edges[i], edges[i + 1]
            self._set(first + i, "".join(parts[a:b]), sum(counts[a:b]))


# --- tasks -----------------------------------------------------------------------------------

_EDITS = "array<struct<start:int,stop:int,text:string>>"
_TREE = "leaf_chars array<int>, leaf_tokens array<int>"


def _build(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for whole in batches:
            for batch in slices(whole):
                trees = [CountTree(t or "", c) for t in batch.column("text").to_pylist()]
                sums = [t.leaf_sums() for t in trees]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "n_tokens": pa.array([t.n_tokens for t in trees], pa.int64()),
                    "leaf_chars": pa.array([s[0] for s in sums], pa.list_(pa.int32())),
                    "leaf_tokens": pa.array([s[1] for s in sums], pa.list_(pa.int32())),
                })

    return run


def _edit(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(path)
        for whole in batches:
            for batch in slices(whole):
                out: dict[str, list] = {k: [] for k in ("n_tokens", "n_edits", "n_tokens_after", "n_reencoded", "leaf_chars", "leaf_tokens")}
                columns = [batch.column(k).to_pylist() for k in ("text", "edits", "leaf_chars", "leaf_tokens")]
                for text, edits, chars, tokens in zip(*columns):
                    tree = CountTree(text or "", c, chars, tokens)
                    before = tree.n_tokens
                    done = sorted((e for e in edits or [] if e), key=lambda e: (e["start"], e["stop"]), reverse=True)
                    for e in done:  # from the end, so that places before an edit stay valid
                        tree.edit(e["start"], e["stop"], e["text"] or "")
                    for values, v in zip(out.values(), (before, len(done), tree.n_tokens, tree.reencoded, *tree.leaf_sums())):
                        values.append(v)
                kinds = (pa.int64(),) * 4 + (pa.list_(pa.int32()),) * 2
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id")} | {k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)}
                )

    return run


# --- operator --------------------------------------------------------------------------------


def trees(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, leaf_chars, leaf_tokens: the tree of every row. Null texts count as empty."""
    rows = texts(docs, id_col, text_col)
    return rows.mapInArrow(_build(path or vocabulary_path()), f"doc_id {rows.dtypes[0][1]}, n_tokens long, {_TREE}")


def edited(docs: DataFrame, edits_col: str = "edits", path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, n_edits, n_tokens_after, n_reencoded, leaf_chars, leaf_tokens.

    ``edits_col`` holds array<struct<start, stop, text>> in characters of the row's text; edits
    don't overlap, and their order doesn't matter. Columns leaf_chars and leaf_tokens, if there
    are any, are the row's tree; else it is built. Places beyond the text count as its end, null
    edits are none, null replacements empty. Repeated rows stay; an empty table gives no rows.
    """
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"), F.col(f"`{edits_col}`").cast(_EDITS).alias("edits"),
        *[(F.col(c) if c in docs.columns else F.lit(None)).cast("array<int>").alias(c) for c in ("leaf_chars", "leaf_tokens")],
    )
    schema = f"doc_id {rows.dtypes[0][1]}, n_tokens long, n_edits long, n_tokens_after long, n_reencoded long, {_TREE}"
    return rows.mapInArrow(_edit(path or vocabulary_path()), schema)


MASKS = ((r"[\w.+-]+@[\w-]+\.[\w.-]+", "<EMAIL>"), (r"\d(?:[ -]?\d){6,}", "<NUMBER>"))


def masking_edits(text_col: str = "text"):
    """Column of the edits that mask e-mail addresses and long numbers."""
    masks = [(re.compile(p), new) for p, new in MASKS]

    @F.pandas_udf(_EDITS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for t in batch:
                found: list[dict] = []
                for p, new in masks:
                    for m in p.finditer(t or ""):
                        if all(m.end() <= e["start"] or m.start() >= e["stop"] for e in found):
                            found.append({"start": m.start(), "stop": m.end(), "text": new})
                out.append(found)
            yield pd.Series(out)

    return find(F.col(f"`{text_col}`"))


@query("op3_edit_counts")
def op3_edit_counts(spark, sf):
    docs = texts(table(spark, sf, "documents"))
    return edited(docs.withColumn("edits", masking_edits())).drop("leaf_chars", "leaf_tokens")
