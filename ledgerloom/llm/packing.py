"""Best-fit packing of tokenized documents by patterns fitted with non-negative least squares.

Only the histogram of piece lengths (at most ``capacity`` numbers) reaches the driver. Patterns of
two to four lengths that fill a sequence are enumerated, their repeat counts fitted to the
histogram by non-negative least squares, rounded down, and the residual pieces are packed by
best fit, longest first, also on counts. The plan says which ranks of which length go where;
each piece then finds its place from its rank among the pieces of its length.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import query, ranked, table, texts
from .shingles import slices
from .tokens import encoder, tokenizer_path

CAPACITY = 4096
END_ID = 1
RANK_BITS = 48  # a length and a rank below 2**48 share one sorted number
STEPS = 300
BYTES_PER_CALL = 4_000_000

# --- pieces ----------------------------------------------------------------------------------


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, id_col: str = "doc_id",
           text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the token ids of each document, then ``END_ID``, cut at ``capacity``."""
    file = path or tokenizer_path()
    end = np.array([END_ID], dtype="<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(file).ids_bytes
        for whole in batches:
            for batch in slices(whole, "text", BYTES_PER_CALL):
                out: dict[str, list] = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")}
                id_type, given = batch.column("doc_id").type, [t or "" for t in batch.column("text").to_pylist()]
                for i, ids in zip(batch.column("doc_id").to_pylist(), encode(given)):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), step)):
                        part = ids[at:at + step]
                        for name, value in zip(out, (i, k, at // 4, len(part) // 4, zlib.crc32(part), part)):
                            out[name].append(value)
                arrays = {k: pa.array(v, t) for (k, v), t in zip(out.items(), (id_type, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))}
                if not with_ids:
                    del arrays["ids"]
                yield pa.RecordBatch.from_pydict(arrays)

    rows = texts(docs, id_col, text_col)
    schema = f"doc_id {rows.dtypes[0][1]}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return rows.mapInArrow(run, schema)


# --- plan ------------------------------------------------------------------------------------


@dataclass
class Bins:
    """``count`` sequences that hold the same (length, repeats) runs."""

    count: int
    free: int
    runs: list[tuple[int, int]] = field(default_factory=list)


def patterns(histogram: np.ndarray, capacity: int) -> list[tuple[int, ...]]:
    """Patterns of up to four present lengths; for each longest length, fillings that leave the least room."""
    present = [int(x) for x in np.flatnonzero(histogram) if x < capacity]
    found = set()

    def largest(limit: int) -> int:
        k = bisect.bisect_right(present, limit)
        return present[k - 1] if k else 0

    for a in present:
        rest = capacity - a
        if b := largest(rest):
            found.add((a, b))
        for share in (0.5, 0.35, 0.7):
            b = largest(int(rest * share))
            c = largest(rest - b) if b else 0
            if c:
                found.add((a, b, c))
                d_rest = rest - b - largest(int((rest - b) * 0.5))
                c2, d = largest(int((rest - b) * 0.5)), largest(d_rest)
                if c2 and d:
                    found.add((a, b, c2, d))
    made = {tuple(sorted(p, reverse=True)) for p in found}
    return sorted((p for p in made if sum(p) <= capacity), key=lambda p: (-sum(p), p))


def fit(histogram: np.ndarray, made: list[tuple[int, ...]], steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - histogram|^2 (A: pieces of a length in a pattern), by multiplicative updates."""
    which = np.repeat(np.arange(len(made)), [len(p) for p in made])
    length = np.array([x for p in made for x in p], dtype=np.int64)
    wanted = histogram.astype(float)
    up = np.bincount(which, weights=wanted[length], minlength=len(made))
    x = np.ones(len(made)) * wanted.sum() / max(1, len(length))
    for _ in range(steps):
        used = np.bincount(length, weights=x[which], minlength=len(wanted))
        down = np.bincount(which, weights=used[length], minlength=len(made))
        x *= up / np.maximum(down, 1e-12)
    return x


def _best_fit(histogram: np.ndarray, capacity: int, open_bins: list[Bins]) -> list[Bins]:
    """Longest pieces first, each into the fullest sequence that takes it, whole classes of equal sequences at a time."""
    by_free: dict[int, list[Bins]] = {}
    for b in open_bins:
        by_free.setdefault(b.free, []).append(b)
    frees = sorted(by_free)
    done: list[Bins] = []

    def put(b: Bins) -> None:
        if not b.count:
            return
        if not b.free:
            done.append(b)
            return
        if b.free not in by_free:
            by_free[b.free] = []
            bisect.insort(frees, b.free)
        by_free[b.free].append(b)

    for length in range(capacity, 0, -1):
        left = int(histogram[length])
        while left:
            k = bisect.bisect_left(frees, length)
            if k < len(frees):
                free = frees[k]
                b = by_free[free].pop()
                if not by_free[free]:
                    del by_free[free]
                    frees.pop(k)
            else:
                b = Bins(-(-left // (capacity // length)), capacity)
            each = b.free // length
            full = min(b.count, left // each)
            put(Bins(full, b.free - each * length, [*b.runs, (length, each)]))
            left -= full * each
            rest = b.count - full
            if rest and left:  # fewer than ``each`` are left: they go into one sequence
                put(Bins(1, b.free - left * length, [*b.runs, (length, left)]))
                rest, left = rest - 1, 0
            put(Bins(rest, b.free, b.runs))
    return done + [b for bs in by_free.values() for b in bs if b.runs]


def plan(histogram: np.ndarray, capacity: int = CAPACITY) -> list[Bins]:
    """Classes of equal sequences that hold every piece once; histogram[n]: pieces of length n."""
    left = histogram.astype(np.int64).copy()
    made = patterns(left, capacity)
    chosen: list[Bins] = []
    if made:
        for p, n in zip(made, np.floor(fit(left, made) + 1e-9).astype(np.int64)):
            need = {x: p.count(x) for x in p}
            n = min(int(n), *(int(left[x]) // k for x, k in need.items()))
            if n > 0 and sum(p) == capacity:  # sequences that aren't full would only fix waste early
                for x, k in need.items():
                    left[x] -= n * k
                chosen.append(Bins(n, 0, sorted(need.items(), reverse=True)))
    return chosen + _best_fit(left, capacity, [])


def lower_bound(histogram: np.ndarray, capacity: int = CAPACITY) -> int:
    return -(-int((np.arange(len(histogram)) * histogram).sum()) // capacity)


@dataclass
class Places:
    """The plan as arrays sorted by (length, first rank): one entry per run of a class."""

    key: np.ndarray
    repeats: np.ndarray
    base: np.ndarray
    offset: np.ndarray

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        k = np.searchsorted(self.key, (length << RANK_BITS) + rank, side="right") - 1
        r = rank - (self.key[k] - (length << RANK_BITS))
        return self.base[k] + r // self.repeats[k], self.offset[k] + (r % self.repeats[k]) * length


def places(classes: list[Bins]) -> Places:
    given: dict[int, int] = {}
    rows, base = [], 0
    for b in classes:
        offset = 0
        for length, repeats in b.runs:
            first = given.get(length, 0)
            rows.append(((length << RANK_BITS) + first, repeats, base, offset))
            given[length] = first + repeats * b.count
            offset += repeats * length
        base += b.count
    rows.sort()
    columns = np.array(rows, dtype=np.int64).reshape(-1, 4).T
    return Places(*columns)


# --- operator --------------------------------------------------------------------------------


def pack(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, id_col: str = "doc_id",
         text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset.

    * Null and empty texts are one piece: the end id alone.
    * Only documents longer than ``capacity`` are cut, into pieces of ``capacity``; the last may be shorter.
    * Repeated rows are packed each; an empty table gives no rows; other columns are not read.
    * Pieces of one length are interchangeable; their order follows the row numbers written once.
    """
    made = pieces(docs, capacity, path, id_col, text_col, with_ids)
    written = cut(made.withColumn("number", F.monotonically_increasing_id()), "pieces")
    histogram = np.zeros(capacity + 1, dtype=np.int64)
    for row in written.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most ``capacity`` rows
        histogram[row.length] = row.n
    found = places(plan(histogram, capacity))

    @F.pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = found.find(length.to_numpy(np.int64), rank.to_numpy(np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    rows = ranked(written, "length", "number", int(histogram.sum()), [], "rank").withColumn("p", place("length", "rank"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else [])
    return rows.select(*columns, "p.sequence_id", "p.offset")


@query("op6_pattern_packing")
def op6_pattern_packing(spark, sf):
    return pack(table(spark, sf, "documents"))
