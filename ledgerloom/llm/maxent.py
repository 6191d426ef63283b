"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

The probability of a token is that of its class given the words before, times that of the token
within its class. Classes are clusters of word shapes (last bytes and length) by what follows
them. The class model is a softmax over hashed features: the word before, the word before that
(skip), and both together. Its weights are trained by gradient steps inside each task; the tasks'
changes are averaged by feature row in a shuffle, and the next round starts from there. Within a
class a token's share is its training count, smoothed as in the base score.

All training documents are counted and trained on. Tokens are told apart by 64-bit codes. Counts
of the most frequent ``FREQUENT`` tokens (16 bytes each) are broadcast; the other tokens of each
document are joined with the counts in a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut
from .common import query, table, texts
from .shingles import mix, slices, word_codes

FOLDS, HELD_OUT = 10, 0
SHAPES = 2048
FOLLOWERS = 32  # cells in which the shapes that follow a shape are counted
CLASSES = 32
ROWS = (4096, 2048, 2048)  # hashed rows of the features: word before, skip, both
ROUNDS = 2
BATCH = 8192
RATE = 0.3
FREQUENT = 262_144
SMOOTH = 0.1
FLUSH = 4_000_000  # tokens counted at once in a task

END = np.uint64(0x51ED270B5E29A1C7)  # code of the end token; no word is empty
START = np.uint64(0x2545F4914F6CDD1D)  # what stands before the first token


@dataclass
class Tokens:
    """Tokens of several texts in turn, each text closed by the end token."""

    code: np.ndarray
    shape: np.ndarray
    first: np.ndarray  # where each text begins

    @staticmethod
    def of(given: list[str | None]) -> "Tokens":
        folded = [(t or "").encode().lower() for t in given]
        data = b"\n".join(folded)
        codes, starts, ends = word_codes(data)
        edges = np.cumsum([0] + [len(f) + 1 for f in folded])
        words = np.searchsorted(starts, edges)  # first word of each text
        n = len(folded)
        first = words[:-1] + np.arange(n)
        last = words[1:] + np.arange(n)
        code = np.empty(len(codes) + n, np.uint64)
        shape = np.zeros(len(code), np.int64)
        is_word = np.ones(len(code), bool)
        is_word[last] = False
        code[is_word], code[last] = codes, END
        raw = np.frombuffer(data, np.uint8) if data else np.zeros(1, np.uint8)
        one, two = raw[ends - 1].astype(np.uint64), raw[np.maximum(ends - 2, starts)].astype(np.uint64)
        key = one | (two << np.uint64(8)) | (np.minimum(ends - starts, 7).astype(np.uint64) << np.uint64(16))
        shape[is_word] = 1 + (mix(key) % np.uint64(SHAPES - 1)).astype(np.int64)
        return Tokens(code, shape, first)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hashed feature rows of each token: by the word before, the word before that, and both."""
        before, skip = np.empty_like(self.code), np.empty_like(self.code)
        before[1:] = self.code[:-1]
        before[self.first] = START
        skip[1:] = before[:-1]
        skip[self.first] = START
        a, b, c = ROWS
        both = mix(before + mix(skip))
        return (
            (before % np.uint64(a)).astype(np.int16),
            (a + (skip % np.uint64(b)).astype(np.int64)).astype(np.int16),
            (a + b + (both % np.uint64(c)).astype(np.int64)).astype(np.int16),
        )


# --- counts ----------------------------------------------------------------------------------


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, code, shape, n): tokens (kind 0), and cells of shapes and the shapes after them (kind 1)."""
    held: list[Tokens] = []
    size = 0
    cells = np.zeros(SHAPES * FOLLOWERS, np.int64)

    def flush() -> pa.RecordBatch:
        code, at, n = np.unique(np.concatenate([t.code for t in held]), return_index=True, return_counts=True)
        shape = np.concatenate([t.shape for t in held])[at]
        return _rows(np.zeros(len(code), np.int32), code.view(np.int64), shape, n)

    def _rows(kind, code, shape, n) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "kind": pa.array(kind, pa.int32()), "code": pa.array(code, pa.int64()),
            "shape": pa.array(shape, pa.int64()), "n": pa.array(n, pa.int64()),
        })

    for whole in batches:
        for batch in slices(whole):
            t = Tokens.of(batch.column("text").to_pylist())
            inner = np.ones(len(t.code) - 1, bool)
            inner[t.first[1:] - 1] = False  # the end token before the next text
            cell = t.shape[:-1][inner] * FOLLOWERS + t.shape[1:][inner] % FOLLOWERS
            cells += np.bincount(cell, minlength=len(cells))
            held.append(t)
            size += len(t.code)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()
    used = np.flatnonzero(cells)
    if len(used):
        yield _rows(np.ones(len(used), np.int32), used, np.zeros(len(used), np.int64), cells[used])


def shape_classes(cells: np.ndarray, classes: int = CLASSES, rounds: int = 20) -> np.ndarray:
    """Class of each shape by k-means on the square roots of what follows it, weighted by count; class 0 is the end alone."""
    total = cells.sum(axis=1)
    points = np.sqrt(cells / np.maximum(total, 1)[:, None])
    heavy = np.argsort(-total, kind="stable")
    centres = points[heavy[:1]]
    for _ in range(classes - 2):  # the next centre: the shape that weighs most by distance
        far = ((points[:, None] - centres[None]) ** 2).sum(axis=2).min(axis=1) * total
        centres = np.concatenate((centres, points[[int(far.argmax())]]))
    for _ in range(rounds):
        near = ((points[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        for k in range(len(centres)):
            mine = near == k
            if total[mine].sum():
                centres[k] = (points[mine] * total[mine, None]).sum(axis=0) / total[mine].sum()
    out = near + 1
    out[0] = 0
    return out


# --- class model -----------------------------------------------------------------------------


def _log_softmax(weights: np.ndarray, bias: np.ndarray, rows: tuple[np.ndarray, ...]) -> np.ndarray:
    z = weights[rows[0]] + weights[rows[1]]
    z += weights[rows[2]]
    z += bias
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def descend(weights: np.ndarray, bias: np.ndarray, used: np.ndarray, squares: np.ndarray, tokens: Tokens, classes: np.ndarray) -> None:
    """Gradient steps over the tokens, in place; ``used`` counts how often each row was."""
    target = classes[tokens.shape]
    rows = tokens.rows()
    for a in range(0, len(target), BATCH):
        part = tuple(r[a:a + BATCH] for r in rows)
        y = target[a:a + BATCH]
        slope = np.exp(_log_softmax(weights, bias, part))
        slope[np.arange(len(y)), y] -= 1
        for r in part:
            order = np.argsort(r, kind="stable")
            sorted_rows = r[order]
            start = np.flatnonzero(np.concatenate(([True], sorted_rows[1:] != sorted_rows[:-1])))
            total = np.add.reduceat(slope[order], start, axis=0)
            which = sorted_rows[start]
            squares[which] += (total * total).mean(axis=1)
            weights[which] -= RATE * total / np.sqrt(squares[which])[:, None]
            used[which] += np.diff(np.append(start, len(r)))


def _train(weights: np.ndarray, bias: np.ndarray, classes: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, used, squares = weights.copy(), np.zeros(len(weights), np.int64), np.full(len(weights), 1e-2, np.float32)
        for whole in batches:
            for batch in slices(whole):
                descend(own, bias, used, squares, Tokens.of(batch.column("text").to_pylist()), classes)
        moved = np.flatnonzero(used)
        change = (own[moved] - weights[moved]) * used[moved, None]
        columns = {"row": pa.array(moved, pa.int64()), "n": pa.array(used[moved], pa.int64())}
        yield pa.RecordBatch.from_pydict(columns | {f"w{k}": pa.array(change[:, k], pa.float32()) for k in range(change.shape[1])})

    return run


# --- operator --------------------------------------------------------------------------------


@dataclass
class Model:
    weights: np.ndarray  # feature rows x classes
    bias: np.ndarray
    classes: np.ndarray  # of shapes
    inside: np.ndarray  # log10 of each class's smoothed token count
    frequent: np.ndarray  # sorted codes
    counts: np.ndarray
    train_tokens: int
    distinct: int


def fold(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def _frequent(vocabulary: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of the most frequent tokens, at most ``FREQUENT``, in code order."""
    level = F.floor(F.log2("n") * 16)
    sizes = sorted((r.level, r.n) for r in vocabulary.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect())  # under 1,000 levels
    total, least = 0, None
    for at, n in reversed(sizes):
        total += n
        if total > FREQUENT:
            break
        least = at
    if least is None:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    rows = vocabulary.filter(level >= least).select("code", "n").toArrow()
    code, n = rows.column("code").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    order = np.argsort(code)
    return code[order], n[order]


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model, and the vocabulary (code, n) of the training documents."""
    rows = texts(docs, id_col, text_col).filter(fold() != HELD_OUT)
    counted = rows.select("text").mapInArrow(_count, "kind int, code long, shape long, n long")
    counted = cut(counted.groupBy("kind", "code").agg(F.sum("n").alias("n"), F.max("shape").alias("shape")), "counts")
    vocabulary = counted.filter("kind = 0").select("code", "n", "shape")
    cells = np.zeros((SHAPES, FOLLOWERS))
    pairs = counted.filter("kind = 1").select("code", "n").toArrow()  # SHAPES * FOLLOWERS rows at most
    cells.ravel()[pairs.column("code").to_numpy()] = pairs.column("n").to_numpy()
    classes = shape_classes(cells)
    tokens, kinds = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in vocabulary.groupBy("shape").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect():  # SHAPES rows at most
        tokens[r["shape"]], kinds[r["shape"]] = r.n, r.kinds
    in_class = np.bincount(classes, weights=tokens, minlength=CLASSES)
    kinds_in_class = np.bincount(classes, weights=kinds, minlength=CLASSES)
    share = (in_class + 1) / (in_class + 1).sum()
    weights, bias = np.zeros((sum(ROWS), CLASSES), np.float32), np.log(share).astype(np.float32)
    for r in range(rounds):
        part = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit(r"round")), F.lit(rounds)) == r).select("text")
        schema = "row long, n long, " + ", ".join(f"w{k} float" for k in range(CLASSES))
        sums = part.mapInArrow(_train(weights, bias, classes), schema).groupBy("row").agg(
            F.sum("n").alias("n"), *[F.sum(f"w{k}").alias(f"w{k}") for k in range(CLASSES)]
        ).toArrow()  # sum(ROWS) rows at most
        if sums.num_rows:
            change = np.stack([sums.column(f"w{k}").to_numpy() for k in range(CLASSES)], axis=1)
            weights[sums.column("row").to_numpy()] += (change / sums.column("n").to_numpy()[:, None]).astype(np.float32)
    code, n = _frequent(vocabulary)
    model = Model(weights, bias, classes, np.log10(in_class + SMOOTH * (kinds_in_class + 1)), code, n, int(tokens.sum()), int(kinds.sum()))
    return model, vocabulary.select("code", "n")


def _score(m: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                t = Tokens.of(batch.column("text").to_pylist())
                target, rows = m.classes[t.shape], t.rows()
                log_class = np.empty(len(target))
                for a in range(0, len(target), BATCH):
                    z = _log_softmax(m.weights, m.bias, tuple(r[a:a + BATCH] for r in rows))
                    log_class[a:a + BATCH] = z[np.arange(len(z)), target[a:a + BATCH]]
                at = np.searchsorted(m.frequent, t.code)
                at[at == len(m.frequent)] = 0
                known = (m.frequent[at] == t.code) if len(m.frequent) else np.zeros(len(t.code), bool)
                weight = np.where(known, np.log10((m.counts[at] if len(m.counts) else 0) + SMOOTH), 0)
                each = lambda x: np.add.reduceat(x, t.first)
                rest = np.flatnonzero(~known)
                owner = np.searchsorted(t.first, rest, side="right") - 1
                edges = np.searchsorted(owner, np.arange(len(t.first) + 1))
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"),
                    "n_tokens": pa.array(np.diff(np.append(t.first, len(t.code))), pa.int64()),
                    "known": pa.array(each(known.astype(np.int64)), pa.int64()),
                    "counted": pa.array(each(weight), pa.float64()),
                    "classed": pa.array(each(log_class / np.log(10) - m.inside[target]), pa.float64()),
                    "rest": pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(t.code[rest].view(np.int64), pa.int64())),
                })

    return run


def scored(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Null and empty texts are the end token alone. Repeated rows stay and count each. With no
    training document every token is unseen and the score is still finite. An empty table gives
    no rows. Other columns are not read.
    """
    model, vocabulary = fit(docs, id_col, text_col)
    rows = texts(docs, id_col, text_col).withColumn("held_out", fold() == HELD_OUT)
    schema = f"doc_id {rows.dtypes[0][1]}, held_out boolean, n_tokens long, known long, counted double, classed double, rest array<long>"
    done = cut(rows.mapInArrow(_score(model), schema).withColumn("number", F.monotonically_increasing_id()), "scored")
    rare = done.select("number", F.explode("rest").alias("code")).groupBy("number", "code").agg(F.count("*").alias("times"))
    found = rare.join(vocabulary, "code", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    more = found.groupBy("number").agg(
        F.sum(F.col("times") * F.log10(F.col("n") + SMOOTH)).alias("more"),
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("more_known"),
    )
    counted = F.col("counted") + F.coalesce("more", F.lit(0.0))
    norm = float(np.log10(model.train_tokens + SMOOTH * (model.distinct + 1)))
    return done.join(more, "number", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(model.train_tokens).cast("long").alias("train_tokens"),
        (counted - F.col("n_tokens") * norm).alias("base_score"), (counted + F.col("classed")).alias("score"),
    )


@query("op9_maxent_scores")
def op9_maxent_scores(spark, sf):
    return scored(table(spark, sf, "documents"))
