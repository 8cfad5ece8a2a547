"""Toxicity by non-negative positive-unlabelled learning in numpy (operator 10).

Confirmed toxic documents are the positives; all other text is unlabelled, a mixture with a known
share of toxic documents. The risk of calling unlabelled text toxic is corrected by that share,
and where the corrected risk of clean text falls below zero, which only overfitting can do, its
gradient is turned round (the non-negative estimator).

A document is the set of its words; a word has three hashed features: itself and its first four
and five letters. The score is a logistic function of the words' summed weights over the square
root of their number, so long and short texts are on one scale.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

DIMENSIONS = 1 << 18
POSITIVES = 2_000  # documents to fit on, about
UNLABELLED = 6_000
FIT_WORDS = 2_048  # words of a document to fit on: those with the least hashes
STEPS = 100
LEAST_DOCUMENTS = 3  # positives that must have a feature
DECAY = 5e-4
RIDGE = 5e-2  # of the calibration
WORDS = 500_000  # words whose weight a Python worker remembers
THRESHOLD = 0.3
WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> tuple[int, int, int]:
    return tuple(
        zlib.crc32(part.encode("utf-8", "surrogatepass")) % DIMENSIONS
        for part in ("w" + word, "4" + word[:4], "5" + word[:5])
    )


class Model:
    def __init__(self):
        self.weights = np.zeros(DIMENSIONS, dtype=np.float32)
        self.bias = 0.0

    def fit(
        self,
        words: list[np.ndarray],
        positive: np.ndarray,
        prior: float,
        steps: int = STEPS,
        least: int = LEAST_DOCUMENTS,
        decay: float = DECAY,
    ) -> None:
        """Full-batch Adam on the non-negative risk with the logistic loss.

        words: for each document an array (words, 3) of features. prior: share of toxic ones.
        """
        sizes = np.array([len(w) for w in words])
        if not positive.any() or positive.all():
            self.bias = float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
            return
        flat = np.concatenate(words).astype(np.int64)
        owner = np.repeat(np.arange(len(words)), sizes)
        # A feature counts if enough positives have it: others would only tell documents apart.
        mine = positive[owner]
        pairs = np.unique(np.stack([owner[mine].repeat(3), flat[mine].reshape(-1)]), axis=1)
        kept = np.bincount(pairs[1], minlength=DIMENSIONS + 1) >= least
        flat[~kept[flat]] = DIMENSIONS
        scale = 1 / np.sqrt(np.maximum(sizes, 1))
        used, slot = np.unique(flat, return_inverse=True)
        slot = slot.reshape(flat.shape)
        weights, bias = np.zeros(len(used)), float(np.log(prior / (1 - prior)))
        mean, square = np.zeros(len(used) + 1), np.zeros(len(used) + 1)
        n_pos, n_unl = positive.sum(), (~positive).sum()
        for step in range(1, steps + 1):
            score = bias + scale * np.bincount(owner, weights[slot].sum(axis=1), minlength=len(words))
            up = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
            # derivative of log(1 + exp(-z)) is up - 1, of log(1 + exp(z)) is up
            clean_risk = np.logaddexp(0, score[~positive]).mean() - prior * np.logaddexp(0, score[positive]).mean()
            clean = np.where(positive, -prior * up / n_pos, up / n_unl)
            toxic = np.where(positive, prior * (up - 1) / n_pos, 0.0)
            slope = toxic + clean if clean_risk >= 0 else -clean
            per_word = (slope * scale)[owner]
            grad = np.empty(len(used) + 1)
            grad[:-1] = sum(np.bincount(slot[:, k], per_word, minlength=len(used)) for k in range(3)) + decay * weights
            grad[:-1][used == DIMENSIONS] = 0
            grad[-1] = slope.sum()
            mean = 0.9 * mean + 0.1 * grad
            square = 0.999 * square + 0.001 * grad * grad
            move = 0.1 * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
            weights -= move[:-1]
            bias -= move[-1]
        score = scale * np.bincount(owner, weights[slot].sum(axis=1), minlength=len(words))
        slope, bias = _calibrate(score, bias, positive, prior)
        self.weights[used[used < DIMENSIONS]] = slope * weights[used < DIMENSIONS]
        self.bias = float(bias)

    def score(self, text: str | None, memo: dict[str, float]) -> float:
        found = set(WORD.findall((text or "").lower()))
        new = found.difference(memo)
        if new:
            if len(memo) + len(new) > WORDS:
                memo.clear()
                new = found
            for word in new:
                a, b, c = features(word)
                memo[word] = float(self.weights[a]) + float(self.weights[b]) + float(self.weights[c])
        # fsum: the same whatever the order of the set
        from math import fsum

        total = self.bias + fsum(map(memo.__getitem__, found)) / max(1, len(found)) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(total, -500, 500))))


def _calibrate(score: np.ndarray, bias: float, positive: np.ndarray, prior: float, steps: int = 50):
    """Slope and intercept that undo the shrinking by the decay: Newton steps on the corrected
    risk, which is convex in them for the logistic loss (its two sides differ by the score)."""
    x = np.stack([score, np.ones_like(score)], axis=1)
    pull, unlabelled = prior * x[positive].mean(axis=0), x[~positive]
    best = np.array([1.0, bias])
    for _ in range(steps):
        up = 1 / (1 + np.exp(-np.clip(unlabelled @ best, -30, 30)))
        grad = unlabelled.T @ up / len(up) - pull + RIDGE * (best - [1.0, bias])
        curve = (unlabelled * (up * (1 - up))[:, None]).T @ unlabelled / len(up) + RIDGE * np.eye(2)
        move = np.linalg.solve(curve, grad)
        best = best - move / max(1.0, np.abs(move).max() / 2)
    return (best[0], best[1]) if best[0] > 0 else (1.0, bias)


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    """A model from documents (doc_id, text) and the confirmed labels (doc_id, toxic) given.

    The class prior is the share of toxic ones among the labels. About `positives` toxic
    documents and `unlabelled` ones of all, by the hash of doc_id, are brought to the driver,
    as hashed words, at most FIT_WORDS of each. Without a toxic label every score is the prior.
    """
    marks = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    marks = marks.where(F.col("doc_id").isNotNull())
    toxic, known = marks.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.count("*")).first()
    model = Model()
    prior = min(max(toxic / known, 1e-4), 0.999) if known else 1e-4
    unit = 1 << 30
    hashed = F.pmod(F.xxhash64("doc_id"), F.lit(unit))
    total = docs.count()
    few = docs.where(hashed < int(unit * min(1.0, unlabelled / max(total, 1))))
    # the chosen label rows are at most twice the number asked for: small enough to send about
    chosen = marks.where("toxic = 1").where(hashed < int(unit * min(1.0, positives / max(toxic, 1)))).select("doc_id").limit(2 * positives)

    def hashed_words(batches):
        for batch in batches:
            lists = []
            for text in batch.column(1).to_pylist():
                found = sorted(set(WORD.findall((text or "").lower())), key=lambda w: zlib.crc32(w.encode()))
                lists.append([f for w in found[:FIT_WORDS] for f in features(w)])
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(lists, type=pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "words"],
            )

    # The unlabelled sample is of all text, confirmed or not: its share of toxic ones is the prior.
    sample = (
        docs.join(F.broadcast(chosen), "doc_id")
        .select("doc_id", "text", F.lit(1).alias("toxic"))
        .union(few.select("doc_id", "text", F.lit(0).alias("toxic")))
    )
    rows = sample.mapInArrow(hashed_words, "doc_id long, toxic int, words array<int>").toArrow()
    rows = rows.sort_by([("toxic", "descending"), ("doc_id", "ascending")])
    words = [np.asarray(w.values, dtype=np.int32).reshape(-1, 3) for w in rows.column("words").combine_chunks()] if rows.num_rows else []
    positive = np.array(rows.column("toxic").to_pylist(), dtype=bool)
    model.fit(words, positive, prior)
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """`docs` with score (0 to 1, higher: likelier toxic) over every whole text.

    A null or empty text, or one without letters, has the score of no words: the logistic of the
    bias. Rows are scored one by one by their text alone; a column score is replaced.
    """
    kept = docs.drop("score")

    @F.pandas_udf("double")
    def judge(texts):
        import pandas as pd

        memo = _memos.setdefault(key, {})
        return pd.Series([model.score(t, memo) for t in texts], dtype="float64")

    key = f"{model.bias!r}-{zlib.crc32(model.weights.tobytes())}"
    return kept.withColumn("score", judge("text"))


_memos: dict[str, dict[str, float]] = {}
