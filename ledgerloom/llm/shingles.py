"""Word and shingle codes of texts in numpy, a few megabytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 2_000_000  # bytes hashed at once; a longer single word is hashed whole
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit codes that spreads every bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd step and of its inverse modulo 2**64."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SEGMENT + 1)
        inverse = np.uint64(pow(int(_STEP), -1, 2**64))
        for name, base in (("up", _STEP), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=np.uint64)
    return _powers["up"], _powers["down"]


def _segment_codes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    word = ~_SPACE[data]
    edge = np.diff(np.concatenate(([0], word.view(np.int8), [0])))
    first, past = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(first):
        return np.empty(0, np.uint64), first, past
    up, down = _power(len(data) + 1)
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * up[:len(data)], dtype=np.uint64)))
    sums = (total[past] - total[first]) * down[first]
    return mix(sums + (past - first).astype(np.uint64)), first, past


def word_codes(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of the white-space words of folded bytes, and the bytes where each begins and ends."""
    codes, starts, ends, at = [], [], [], 0
    while at < len(data):
        end = min(len(data), at + SEGMENT)
        if end < len(data):
            cut = max(data.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut <= at:  # no separator inside: take the whole word
                nexts = [p for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c") if (p := data.find(c, end)) >= 0]
                cut = min(nexts, default=len(data))
            end = cut
        c, first, past = _segment_codes(np.frombuffer(data, np.uint8, end - at, at))
        codes.append(c)
        starts.append(first + at)
        ends.append(past + at)
        at = max(end, at + 1)
    if not codes:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(codes), np.concatenate(starts), np.concatenate(ends)


def combine(words: np.ndarray, n: int) -> np.ndarray:
    """Codes of all runs of ``n`` words."""
    m = len(words) - n + 1
    out = np.full(max(m, 0), n, dtype=np.uint64)
    for k in range(n):
        out = mix(out + words[k:k + len(out)] * _BYTE[k])
    return out


def shingle_sets(texts: list[str | None], n: int) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct codes of its ``n``-word shingles (A-Z folded).

    A text of fewer words is one shingle of all its words; one without words has none.
    """
    folded = [(t or "").encode().lower() for t in texts]
    codes, starts, _ = word_codes(b"\n".join(folded))
    edges = np.cumsum([0] + [len(f) + 1 for f in folded])
    words = np.searchsorted(starts, edges)
    runs = combine(codes, n)
    for a, b in zip(words[:-1], words[1:]):
        if b - a >= n:
            yield np.unique(runs[a:b - n + 1])
        elif b > a:
            yield combine(codes[a:b], b - a)
        else:
            yield np.empty(0, np.uint64)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes in ``column`` each, and a row at least."""
    import pyarrow.compute as pc

    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    group = np.cumsum(sizes) // limit
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        yield batch.slice(a, b - a)
