"""Language identification by a byte convolutional network, trained here in numpy (operator 7).

A text in lower case is cut into windows of a fixed number of bytes, all of it, the last padded.
Bytes are embedded, convolved with filters of several widths, each filter's maximum over the
window is kept, and a softmax gives the languages. A text's probabilities are the means over its
windows, weighted by their bytes.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
PER_LANGUAGE = 1500  # training windows of each language, about
MAX_LANGUAGES = 200
STEPS = 900  # of 64 windows each
BATCH = 512
UNKNOWN = "und"
MAYBE = re.compile(r"[^\W\d_]")  # letters, and numbers such as one half


class ByteNetwork:
    """Embedding, multi-width convolution, maximum, softmax. Byte 0 pads and has no embedding."""

    def __init__(self, languages: list[str], seed: int = 7):
        draw = np.random.default_rng(seed)
        self.languages = languages
        self.weights = {"embed": draw.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32)}
        for w in WIDTHS:
            scale = 1 / np.sqrt(w * EMBEDDING)
            self.weights[f"conv{w}"] = draw.normal(0, scale, (w * EMBEDDING, FILTERS)).astype(np.float32)
            self.weights[f"bias{w}"] = np.zeros(FILTERS, np.float32)
        self.weights["out"] = draw.normal(
            0, 0.1, (len(WIDTHS) * FILTERS, len(languages))
        ).astype(np.float32)
        self.weights["prior"] = np.zeros(len(languages), np.float32)

    def _forward(self, windows: np.ndarray):
        """Probabilities, pooled features, and for each width where the maximum was."""
        p = self.weights
        table = p["embed"].copy()
        table[0] = 0
        embedded = table[windows]
        pooled, places = [], []
        for w in WIDTHS:
            runs = np.lib.stride_tricks.sliding_window_view(embedded, (w, EMBEDDING), axis=(1, 2))
            flat = runs.reshape(len(windows), -1, w * EMBEDDING)
            values = flat @ p[f"conv{w}"]
            place = values.argmax(axis=1)
            places.append(place)
            pooled.append(np.take_along_axis(values, place[:, None], axis=1)[:, 0] + p[f"bias{w}"])
        features = np.maximum(np.concatenate(pooled, axis=1), 0)
        scores = features @ p["out"] + p["prior"]
        scores = np.exp(scores - scores.max(axis=1, keepdims=True))
        return scores / scores.sum(axis=1, keepdims=True), features, places, embedded

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        return np.concatenate(
            [self._forward(windows[i : i + BATCH])[0] for i in range(0, len(windows), BATCH)]
            or [np.zeros((0, len(self.languages)), np.float32)]
        )

    def _gradients(self, windows, labels):
        p = self.weights
        found, features, places, embedded = self._forward(windows)
        delta = found
        delta[np.arange(len(labels)), labels] -= 1
        delta /= len(labels)
        grads = {"out": features.T @ delta, "prior": delta.sum(axis=0)}
        back = (delta @ p["out"].T) * (features > 0)
        embed = np.zeros_like(p["embed"])
        rows = np.arange(len(windows))[:, None, None]
        for i, w in enumerate(WIDTHS):
            mine = back[:, i * FILTERS : (i + 1) * FILTERS]
            grads[f"bias{w}"] = mine.sum(axis=0)
            at = places[i][:, :, None] + np.arange(w)
            taken = embedded[rows, at].reshape(len(windows), FILTERS, -1)
            grads[f"conv{w}"] = np.einsum("nf,nfk->kf", mine, taken)
            spread = mine[:, :, None] * p[f"conv{w}"].T[None]
            np.add.at(
                embed, windows[rows, at].reshape(-1), spread.reshape(-1, EMBEDDING)
            )
        grads["embed"] = embed
        return grads

    def fit(self, windows: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = 7) -> None:
        """Adam on the cross entropy."""
        draw = np.random.default_rng(seed)
        mean = {k: np.zeros_like(v) for k, v in self.weights.items()}
        square = {k: np.zeros_like(v) for k, v in self.weights.items()}
        order = np.zeros(0, dtype=np.int64)
        for step in range(1, steps + 1):
            if len(order) < 64:
                order = np.concatenate([order, draw.permutation(len(windows))])
            picked, order = order[:64], order[64:]
            for k, g in self._gradients(windows[picked], labels[picked]).items():
                mean[k] = 0.9 * mean[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                rate = 0.004 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                self.weights[k] -= (rate * mean[k] / (np.sqrt(square[k]) + 1e-8)).astype(np.float32)


def has_letter(text: str | None) -> bool:
    """Is any character a letter (general category L)? Signs for numbers are none."""
    return any(m[0].isalpha() for m in MAYBE.finditer(text or ""))


def windows_of(text: str) -> np.ndarray:
    """All bytes of the text in lower case, in rows of WINDOW, zeros at the end."""
    data = text.lower().encode("utf-8", "surrogatepass")
    rows = max(1, -(-len(data) // WINDOW))
    return np.frombuffer(data.ljust(rows * WINDOW, b"\0"), dtype=np.uint8).reshape(rows, WINDOW)


def train(
    docs: DataFrame, per_language: int = PER_LANGUAGE, seed: int = 7, most_languages: int = MAX_LANGUAGES
) -> ByteNetwork:
    """A network for the non-null values of `lang` in `docs` (doc_id, text, lang).

    About `per_language` documents of each language, those with the least hashes of doc_id and
    text, give one window each, at a place chosen by the hash: that is all the driver gets, and
    copies of a row give one. Only the `most_languages` most frequent values are learned. Two
    languages at least are needed for a choice; with one or none the network names that one or
    nothing.
    """
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = {
        r["lang"]: r["n"]
        for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most_languages).collect()
    }
    languages = sorted(counts)
    network = ByteNetwork(languages or [UNKNOWN], seed)
    if not languages:
        return network
    unit = 1 << 30
    least = F.element_at(
        F.create_map(*[x for k, n in counts.items() for x in (F.lit(k), F.lit(int(unit * min(1.0, per_language / n))))]),
        F.col("lang"),
    )
    hashed = F.pmod(F.xxhash64("doc_id", "text"), F.lit(unit))
    start = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.greatest(F.length("text") - WINDOW // 2, F.lit(1)))
    chosen = (
        labelled.where(F.col("lang").isin(languages))
        .where(hashed < least)
        .select("lang", F.col("text").substr((start + 1).cast("int"), F.lit(WINDOW)).alias("part"), hashed.alias("h"))
        .distinct()
        .limit(2 * per_language * len(languages))
        .collect()
    )
    chosen.sort(key=lambda r: (r["h"], r["lang"], r["part"]))
    if chosen:
        parts = np.concatenate([windows_of(r["part"])[:1] for r in chosen])
        network.fit(parts, np.array([languages.index(r["lang"]) for r in chosen]), seed=seed)
    return network


def identify(docs: DataFrame, network: ByteNetwork) -> DataFrame:
    """`docs` with lang_pred and score (the mean probability of that language).

    Every whole text is read. `und` with score 1 stands for a null or empty text or one without
    a letter. Rows are judged one by one by their text alone; repeated rows, nulls in other
    columns and an empty table need no care; columns lang_pred and score are replaced.
    """
    weights, languages = network.weights, network.languages
    kept = docs.drop("lang_pred", "score")

    @F.pandas_udf("lang_pred string, score double")
    def judge(text):
        import pandas as pd

        model = ByteNetwork(languages)
        model.weights = weights
        names, scores = [UNKNOWN] * len(text), np.ones(len(text))
        pending, held = [], 0

        def flush():
            if not pending:
                return
            found = model.probabilities(np.concatenate([w for _, w, _ in pending]))
            at = 0
            for row, w, size in pending:
                share = np.full(len(w), WINDOW, dtype=np.float64)
                share[-1] = size - WINDOW * (len(w) - 1)
                mean = (share @ found[at : at + len(w)]) / share.sum()
                names[row], scores[row] = languages[int(mean.argmax())], min(1.0, float(mean.max()))
                at += len(w)
            pending.clear()

        for row, t in enumerate(text):
            if not has_letter(t):
                continue
            w = windows_of(t)
            size = len(t.lower().encode("utf-8", "surrogatepass"))
            pending.append((row, w, size))
            held += len(w)
            if held >= BATCH:
                flush()
                held = 0
        flush()
        return pd.DataFrame({"lang_pred": names, "score": scores})

    return kept.withColumn("_judged", judge("text")).select(
        *kept.columns, "_judged.lang_pred", "_judged.score"
    )
