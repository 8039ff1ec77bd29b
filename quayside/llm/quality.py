"""Quality classifier: a byte-level convolutional network in numpy.

A document is cut into overlapping chunks of bytes that cover all of it. Learned filters run over the embedded bytes of
each chunk, the strongest response of each filter in a chunk is kept, and a small network combines the mean and the
maximum of these over the chunks into one probability.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import remainder
from quayside.llm.sampling import labelled_texts

CHUNK, STEP = 256, 224          # bytes of a chunk, bytes from one chunk to the next
WIDTH, STRIDE = 8, 2            # bytes under a filter, bytes from one position to the next
EMBEDDING, FILTERS, HIDDEN = 8, 32, 24
PER_CLASS = 2_500               # the fit uses at most so many different texts of either label, each whole
STEPS, BATCH, RATE = 700, 48, 4e-3
THRESHOLD, FOLDS = 0.3, 5

_POSITIONS = (CHUNK - WIDTH) // STRIDE + 1
_TAKE = np.arange(_POSITIONS)[:, None] * STRIDE + np.arange(WIDTH)
_AT_ONCE = 256                  # chunks whose positions are laid out in memory together


def chunks(text: str | None) -> np.ndarray:
    """All chunks of a text, the last one padded with zero bytes; an empty or null text is one chunk of padding."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    n = 1 + max(0, -(-(len(data) - CHUNK) // STEP))
    padded = np.zeros((n - 1) * STEP + CHUNK, np.uint8)
    padded[:len(data)] = data
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::STEP]


@dataclass
class ByteNet:
    weights: dict[str, np.ndarray]
    prior: float = 0.0

    @staticmethod
    def fresh(seed: int) -> ByteNet:
        rng = np.random.default_rng(seed)

        def normal(*shape: int) -> np.ndarray:
            return (rng.standard_normal(shape) * np.sqrt(2 / shape[0])).astype(np.float32)

        zeros = np.zeros
        return ByteNet({
            "embed": (rng.standard_normal((256, EMBEDDING)) * 0.5).astype(np.float32),
            "conv": normal(WIDTH * EMBEDDING, FILTERS), "conv_bias": zeros(FILTERS, np.float32),
            "dense": normal(2 * FILTERS, HIDDEN), "dense_bias": zeros(HIDDEN, np.float32),
            "out": normal(HIDDEN, 1)[:, 0], "out_bias": zeros(1, np.float32),
        })

    def pooled(self, data: np.ndarray, positions: bool = False):
        """The strongest response of each filter in each chunk (and, if asked, the position it came from)."""
        w = self.weights
        values, places = [], []
        for k in range(0, len(data), _AT_ONCE):
            part = data[k:k + _AT_ONCE]
            laid = w["embed"][part[:, _TAKE]].reshape(len(part) * _POSITIONS, WIDTH * EMBEDDING)
            response = (laid @ w["conv"]).reshape(len(part), _POSITIONS, FILTERS)
            values.append(response.max(1) + w["conv_bias"])
            if positions:
                places.append(response.argmax(1))
        best = np.maximum(np.concatenate(values), 0)
        return (best, np.concatenate(places)) if positions else best

    def combine(self, best: np.ndarray, first: np.ndarray):
        """Logits of documents from the pooled responses of their chunks; ``first`` is each document's first chunk."""
        w = self.weights
        count = np.diff([*first, len(best)])[:, None]
        both = np.concatenate([np.add.reduceat(best, first) / count, np.maximum.reduceat(best, first)], 1)
        hidden = np.maximum(both @ w["dense"] + w["dense_bias"], 0)
        return both, hidden, hidden @ w["out"] + w["out_bias"][0]

    def scores(self, texts) -> np.ndarray:
        """The probability of label 1 for each whole text."""
        out = []
        group: list[np.ndarray] = []

        def flush() -> None:
            if group:
                first = np.cumsum([0, *map(len, group[:-1])])
                logit = self.combine(self.pooled(np.concatenate(group)), first)[2] + self.prior
                out.append(1 / (1 + np.exp(-np.clip(logit, -30, 30))))
                group.clear()

        for text in texts:
            group.append(chunks(text))
            if sum(map(len, group)) >= _AT_ONCE:
                flush()
        flush()
        return np.concatenate(out).astype(float) if out else np.zeros(0)


def fit(samples: list[np.ndarray], labels: np.ndarray, prior: float, seed: int = 11) -> ByteNet:
    """Adam on the logistic loss over batches with as many documents of either label; ``prior`` is the log odds of the
    labels, which such batches take away."""
    net, rng = ByteNet.fresh(seed), np.random.default_rng(seed)
    w = net.weights
    moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in w.items()}
    either = [np.flatnonzero(labels == q) for q in (0, 1)]
    for step in range(1, STEPS + 1):
        rate = RATE * (1 - step / STEPS) + 1e-4
        chosen = np.concatenate([rng.choice(e, BATCH // 2) for e in either])
        data = np.concatenate([samples[i] for i in chosen])
        sizes = np.array([len(samples[i]) for i in chosen])
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        best, places = net.pooled(data, True)
        both, hidden, logit = net.combine(best, first)
        error = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - labels[chosen]) / len(chosen)
        error = error.astype(np.float32)
        grad = {"out": hidden.T @ error, "out_bias": error.sum(keepdims=True)}
        back = error[:, None] * w["out"] * (hidden > 0)
        grad |= {"dense": both.T @ back, "dense_bias": back.sum(0)}
        back = back @ w["dense"].T
        owner = np.repeat(np.arange(len(chosen)), sizes)
        top = best == np.repeat(both[:, FILTERS:], sizes, 0)
        grads = (back[owner, :FILTERS] / sizes[owner, None] + back[owner, FILTERS:] * top) * (best > 0)
        grad["conv_bias"] = grads.sum(0)
        # Only the position with the strongest response passes the gradient on.
        window = data[np.arange(len(data))[:, None, None], _TAKE[places]]
        seen = w["embed"][window].reshape(len(data), FILTERS, WIDTH * EMBEDDING)
        grad["conv"] = np.einsum("cf,cfe->ef", grads, seen, optimize=True)
        spread = (grads[:, :, None] * w["conv"].T).reshape(-1, EMBEDDING)
        grad["embed"] = np.stack([np.bincount(window.ravel(), spread[:, j], 256) for j in range(EMBEDDING)], 1)
        for name, g in grad.items():
            g = g.astype(np.float32) + 1e-4 * w[name]
            m, v = moment[name]
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            w[name] -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    net.prior = prior
    return net


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> ByteNet | None:
    """Learn from labelled documents outside the held-out fold; None without both labels.

    The bound: of either label at most ``per_class`` different texts, drawn by ``sampling.labelled_texts``, with all of
    their chunks. Copies of a text count once, so they move neither the sample nor the share of the labels.
    """
    counts, sample = labelled_texts(docs, labels, "quality", remainder(F.col("doc_id"), FOLDS) != 0, per_class)
    if sample is None:
        return None

    def cut(frames):
        for frame in frames:
            yield pd.DataFrame({"content": frame["content"], "label": frame["label"],
                                "data": [chunks(text).tobytes() for text in frame["text"]]})

    taken = sorted(sample.mapInPandas(cut, "content string, label int, data binary").collect(), key=lambda r: r.content)
    return fit([np.frombuffer(r.data, np.uint8).reshape(-1, CHUNK) for r in taken],
               np.array([r.label for r in taken], float), float(np.log(counts[1] / counts[0])))


def _score(net: ByteNet | None):
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(net.scores(texts) if net else np.full(len(texts), 0.5))
    return score


def classify(docs: DataFrame, labels: DataFrame, net: ByteNet | None = None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` (probability of label 1, from the text alone) and ``predicted``.

    One row per row of the input, repeated rows and null ids included (a null id is not held out). A null text scores
    as the empty one. Labels other than 0 and 1 are ignored; without both labels every score is one half. Other columns
    are ignored.
    """
    net = net or train(docs, labels)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _score(net)("text").alias("score"))
    return scored.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id"), FOLDS) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, net: ByteNet | None = None) -> DataFrame:
    """The documents that the classifier does not reject, with their columns. Null and empty texts are judged as empty
    ones, repeated rows alike; an empty table, or one without both labels, is returned as it is."""
    net = net or train(docs, labels)
    return docs.filter(_score(net)("text") >= THRESHOLD)
