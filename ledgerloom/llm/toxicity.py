"""Toxicity by non-negative positive-unlabelled learning.

Learnt from documents confirmed as toxic and from unlabelled ones, of which a share (the class
prior) is toxic too. The risk of a classifier f with loss l is estimated as

    prior * mean_P l(f) + max(0, mean_U l(-f) - prior * mean_P l(-f)),

and where the second part falls below zero, which only overfitting can cause, its gradient is
followed upwards instead. ``BAGS`` linear classifiers over hashed word features are trained in
numpy, one task each, and their weights averaged. A word's features are itself and its
beginnings of four and five letters, so inflected words share what is learnt.

Training takes a bounded sample: about ``POSITIVES`` toxic and ``UNLABELLED`` other documents,
drawn by row code over the whole table. The prior counts all labels. All texts are scored whole.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import query, row_code, table, texts

BITS = 18
BAGS = 4
PER_BAG = 400  # toxic documents that a classifier of its own needs
POSITIVES = 6_000
UNLABELLED = 12_000
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2
EPOCHS, BATCH = 15, 256
RATE, DECAY, UPWARD = 0.01, 1e-4, 0.5
FEATURES, MIN_Z = (50, 500), 4.0  # chosen per classifier: at least and at most, and how clear they must be
COST = 10  # of a wrongly caught document, in missed toxic ones
CACHE_WORDS = 400_000
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features(word: str) -> tuple[int, int, int]:
    mask = (1 << BITS) - 1
    return tuple(zlib.crc32(f"{k}:{w}".encode()) & mask for k, w in (("w", word), ("4", word[:4]), ("5", word[:5])))


def presence(texts_: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, feature) of every feature that a text has, each once, in order."""
    known: dict[str, tuple] = {}
    owner, found = [], []
    for i, t in enumerate(texts_):
        mine = set()
        for w in words(t):
            f = known.get(w)
            if f is None:
                f = known[w] = features(w)
            mine.update(f)
        found.extend(sorted(mine))
        owner.extend([i] * len(mine))
    return np.array(owner, np.int64), np.array(found, np.int64)


def chosen_features(positive: np.ndarray, n_positive: int, unlabelled: np.ndarray, n_unlabelled: int) -> np.ndarray:
    """Features that toxic documents have clearly more often than others, the clearest first."""
    size = 1 << BITS
    seen = np.bincount(positive, minlength=size)
    share = seen / n_positive
    usual = (np.bincount(unlabelled, minlength=size) + 0.5) / (n_unlabelled + 1)
    z = (share - usual) / np.sqrt(usual * (1 - usual) / n_positive + 1 / n_positive**2)
    z[seen < 3] = 0
    best = np.argsort(-z, kind="stable")[:int(np.clip(n_positive // 3, *FEATURES))]
    return best[z[best] >= MIN_Z]


@dataclass
class Matrix:
    """Rows of feature numbers, one after another."""

    x: np.ndarray
    edges: np.ndarray

    @staticmethod
    def of(owner: np.ndarray, found: np.ndarray, chosen: np.ndarray, rows: int) -> "Matrix":
        number = np.full(1 << BITS, -1)
        number[chosen] = np.arange(len(chosen))
        keep = number[found] >= 0
        return Matrix(number[found[keep]], np.searchsorted(owner[keep], np.arange(rows + 1)))

    def take(self, rows: np.ndarray) -> "Matrix":
        sizes = self.edges[rows + 1] - self.edges[rows]
        new = np.concatenate(([0], np.cumsum(sizes)))
        return Matrix(self.x[np.repeat(self.edges[rows] - new[:-1], sizes) + np.arange(new[-1])], new)

    def logits(self, weights: np.ndarray, bias: float) -> np.ndarray:
        total = np.concatenate(([0.0], np.cumsum(weights[self.x])))
        return bias + total[self.edges[1:]] - total[self.edges[:-1]]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def best_edge(toxic: np.ndarray, unlabelled: np.ndarray, prior: float) -> float:
    """The logit that parts best: caught toxic documents less ``COST`` times the share of others caught.

    That share is what is caught of the unlabelled ones beyond the prior's part in it.
    """
    edges = np.unique(toxic)
    caught = 1 - np.searchsorted(np.sort(toxic), edges) / len(toxic)
    of_all = 1 - np.searchsorted(np.sort(unlabelled), edges) / len(unlabelled)
    wrong = np.maximum(0, (of_all - prior * caught) / (1 - prior))
    return float(edges[np.argmax(caught - COST * wrong)])


def train(positive: list[str], unlabelled: list[str], prior: float, seed: int = 0, epochs: int = EPOCHS) -> tuple[np.ndarray, float]:
    """Weights (none below zero) and bias that lower the non-negative risk, by Adam on mixed batches.

    At last the bias is moved so that ``THRESHOLD`` lies at the best edge. Without texts of either
    kind the prior alone is left.
    """
    out, bias = np.zeros(1 << BITS, np.float32), float(np.log(prior / (1 - prior)))
    if not positive or not unlabelled:
        return out, bias
    p_owner, p_found = presence(positive)
    u_owner, u_found = presence(unlabelled)
    chosen = chosen_features(p_found, len(positive), u_found, len(unlabelled))
    p_rows, u_rows = Matrix.of(p_owner, p_found, chosen, len(positive)), Matrix.of(u_owner, u_found, chosen, len(unlabelled))
    weights = np.zeros(len(chosen))
    rng = np.random.default_rng(seed)
    first, second, step = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1), 0
    parts = max(1, len(unlabelled) // BATCH)
    for _ in range(epochs):
        u_parts = np.array_split(rng.permutation(len(unlabelled)), parts)
        p_parts = np.array_split(np.resize(rng.permutation(len(positive)), max(len(positive), parts * 32)), parts)
        for pi, ui in zip(p_parts, u_parts):
            p, u = p_rows.take(pi), u_rows.take(ui)
            fp, fu = p.logits(weights, bias), u.logits(weights, bias)
            rest = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
            plus = -prior * _sigmoid(-fp) / len(fp)  # gradient of prior * mean_P l(f)
            minus, other = -prior * _sigmoid(fp) / len(fp), _sigmoid(fu) / len(fu)  # of the rest
            gp, gu = (plus + minus, other) if rest >= 0 else (-UPWARD * minus, -UPWARD * other)
            each = np.repeat(np.concatenate((gp, gu)), np.concatenate((np.diff(p.edges), np.diff(u.edges))))
            grad = np.bincount(np.concatenate((p.x, u.x)), weights=each, minlength=len(weights)) + DECAY * weights
            grad = np.append(grad, gp.sum() + gu.sum())
            step += 1
            first += 0.1 * (grad - first)
            second += 0.01 * (grad * grad - second)
            move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
            weights = np.maximum(weights - move[:-1], 0)
            bias -= float(move[-1])
    edge = best_edge(p_rows.logits(weights, bias), u_rows.logits(weights, bias), prior)
    if edge > bias + 1e-9:  # else the edge has no feature at all, and the bias is right as it is
        bias += float(np.log(THRESHOLD / (1 - THRESHOLD)) - edge + 1e-3)
    out[chosen] = weights
    return out, bias


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def score(self, text: Column) -> Column:
        """Column of scores in (0, 1); null and empty texts score by the bias alone."""
        weights = {int(i): float(self.weights[i]) for i in np.flatnonzero(self.weights)}
        bias = self.bias

        @F.pandas_udf("double")
        def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            known: dict[str, tuple] = {}
            for batch in batches:
                out = []
                for t in batch:
                    if len(known) > CACHE_WORDS:
                        known.clear()
                    mine: set[int] = set()
                    for w in words(t):
                        f = known.get(w)
                        if f is None:
                            f = known[w] = tuple(i for i in features(w) if i in weights)
                        if f:
                            mine.update(f)
                    out.append(bias + sum(weights[i] for i in sorted(mine)))
                yield pd.Series(_sigmoid(np.array(out, dtype=float)))

        return run(text)


def fold(doc_id: str = "doc_id", folds: int = FOLDS) -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % folds


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """Train on rows outside the held-out fold. A document is confirmed toxic if any of its labels says so."""
    rows = texts(docs, id_col, text_col).filter(fold() != HELD_OUT).withColumn("code", row_code())
    known = (
        labels.select("doc_id", "toxic").filter("doc_id is not null and toxic is not null")
        .filter(fold() != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    total = rows.count()
    prior = min(max(toxic / n if n else 0.0, 0.001), 0.9)

    def drawn(code: Column, wanted: int, of: int) -> Column:
        """About ``wanted`` of ``of`` rows, by their code."""
        return F.pmod(code, F.lit(1_000_003)) < int(1_000_003 * min(1.0, wanted / max(1, of)))

    # Bounded by the sample's size, whatever the number of labels.
    chosen = known.filter("toxic = 1").filter(drawn(F.xxhash64("doc_id"), positives, toxic)).select("doc_id")
    sample = rows.join(F.broadcast(chosen), "doc_id", "left_semi").select("text", "code", F.lit(1).alias("positive"))
    sample = sample.unionByName(
        rows.filter(drawn(F.xxhash64("code"), unlabelled, total)).select("text", "code", F.lit(0).alias("positive"))
    )
    bagged = sample.withColumn("bag", F.pmod(F.xxhash64("code", F.lit(7)), F.lit(max(1, min(BAGS, toxic // PER_BAG)))).cast("int"))

    def run(key: tuple, t: pa.Table) -> pa.Table:
        t = t.sort_by("code")
        flags = t.column("positive").to_pylist()
        given = t.column("text").to_pylist()
        weights, bias = train([x for x, p in zip(given, flags) if p], [x for x, p in zip(given, flags) if not p],
                              prior, seed=key[0].as_py())
        return pa.table({"bag": pa.array([key[0].as_py()], pa.int32()), "bias": [bias], "weights": [weights.tobytes()]})

    done = bagged.groupBy("bag").applyInArrow(run, "bag int, bias double, weights binary").orderBy("bag").collect()
    if not done:
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(prior / (1 - prior))))
    mean = np.mean([np.frombuffer(r.weights, np.float32) for r in done], axis=0).astype(np.float32)
    return Model(mean, float(np.mean([r.bias for r in done])))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted.

    Null and empty texts score by the bias. Repeated label rows of a document count once, null
    labels not at all; without any toxic label every score is the prior. Ids, languages, sources
    and labels are never inputs of a score. An empty table gives no rows.
    """
    model = fit(docs, labels, id_col, text_col)
    out = texts(docs, id_col, text_col).select("doc_id", (fold() == HELD_OUT).alias("held_out"), model.score(F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that score ``THRESHOLD`` or more; columns stay."""
    model = fit(docs, labels, id_col, text_col)
    return docs.filter(model.score(F.col(f"`{text_col}`")) < THRESHOLD)


@query("op2_toxicity")
def op2_toxicity(spark, sf):
    return scored(table(spark, sf, "documents"), table(spark, sf, "labels"))
