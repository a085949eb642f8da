"""Quality scores by learning from positives and unlabelled text.

Trusted positives and unlabelled texts are described by frequencies of byte values and of pairs of character classes,
and by a few counts (length, word length, repeated words and lines). The share of positives among
unlabelled texts is estimated from a first classifier that tells the two samples apart: for scores above a
cut, the unlabelled sample holds at least prior times the positives' share, so the smallest ratio of the two
tails (with an allowance for small tails) bounds the prior. The model is linear and minimises the
non-negative unbiased risk: prior * R(positives as positive) + max(0, R(unlabelled as negative) - prior *
R(positives as negative)).

Fitting takes at most `sample` positives and `sample` unlabelled texts, those with the smallest hash of their id;
only their features reach the driver. Every text is scored whole, in batches.

Defined cases: null text counts as empty, and empty texts get the model's score for no characters at all;
without positives every score is 0.5; rows of labels whose quality is null are not trusted; a document with
several labels is trusted if one of them is 1; repeated rows get equal results; an empty table gives an empty
result; columns of any other name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.base import filled, held_out, smallest

SAMPLE = 6000
STEPS = 400
RATE = 0.02
DECAY = 1e-4
# Character classes, by the bytes that belong to them.
CLASSES = [
    b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n", b"\t\r", b".", b",", b"!?",
    b"\"'`", b"()[]{}<>", b":;", b"|/\\", b"-_=~", b"#$%&*@^+",
]
_CLASS_OF = np.full(256, len(CLASSES), np.uint8)
for _number, _members in enumerate(CLASSES):
    _CLASS_OF[np.frombuffer(_members, np.uint8)] = _number
_N = len(CLASSES) + 1
N_FEATURES = 256 + _N * _N + 6


def features(text: str) -> np.ndarray:
    data = np.frombuffer(text.encode(), np.uint8)
    out = np.zeros(N_FEATURES, np.float32)
    if not len(data):
        return out
    kinds = _CLASS_OF[data].astype(np.int64)
    out[:256] = np.sqrt(np.bincount(data, minlength=256) / len(data))
    if len(data) > 1:
        out[256 : 256 + _N * _N] = np.sqrt(np.bincount(kinds[:-1] * _N + kinds[1:], minlength=_N * _N) / (len(data) - 1))
    words, lines = text.split(), text.split("\n")
    n = max(len(words), 1)
    out[-6:] = (
        np.log1p(len(data)), np.log1p(len(words)), len(data) / n / 10, len(set(words)) / n,
        len(set(lines)) / len(lines), np.log1p(len(data) / len(lines)),
    )
    return out


@dataclass
class Model:
    centre: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        return _sigmoid(np.clip((rows - self.centre) / self.spread, -8, 8) @ self.weights + self.bias)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _descend(gradient, size: int, steps: int = STEPS) -> np.ndarray:
    """Adam from zero."""
    at, first, second = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        slope = gradient(at)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        at = at - RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return at


def estimated_prior(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of positives among the unlabelled, from scores that tell the two samples apart."""
    cuts = np.quantile(positives, np.linspace(0, 0.9, 91))
    above = lambda scores: 1 - np.searchsorted(np.sort(scores), cuts, side="left") / len(scores)
    allowance = np.sqrt(np.log(20) / 2) * (len(positives) ** -0.5 + len(unlabelled) ** -0.5)
    tail = np.maximum(above(positives), 1e-9)
    best = np.argmin((above(unlabelled) + allowance) / tail)
    return float(np.clip(above(unlabelled)[best] / tail[best], 0.05, 0.95))


def train(positives: np.ndarray, unlabelled: np.ndarray) -> Model:
    """The model of two samples of feature rows."""
    centre, spread = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-3
    p = np.clip((positives - centre) / spread, -8, 8).astype(np.float64)
    u = np.clip((unlabelled - centre) / spread, -8, 8).astype(np.float64)
    p, u = np.c_[p, np.ones(len(p))], np.c_[u, np.ones(len(u))]

    def apart(at: np.ndarray) -> np.ndarray:
        return (p.T @ (_sigmoid(p @ at) - 1)) / len(p) + (u.T @ _sigmoid(u @ at)) / len(u) + DECAY * at

    half_p, half_u = slice(0, None, 2), slice(1, None, 2)
    both = (p, u)
    p, u = both[0][half_p], both[1][half_p]
    first = _descend(apart, p.shape[1])
    p, u = both
    prior = estimated_prior(p[half_u] @ first, u[half_u] @ first) if len(p) > 1 and len(u) > 1 else 0.5

    def risk(at: np.ndarray) -> np.ndarray:
        sp, su = _sigmoid(p @ at), _sigmoid(u @ at)
        # logistic loss: as positive -log s, as negative -log(1 - s)
        as_negative = -np.log1p(-np.minimum(su, 1 - 1e-9)).mean() + prior * np.log1p(-np.minimum(sp, 1 - 1e-9)).mean()
        negative = (u.T @ su) / len(u) - prior * (p.T @ sp) / len(p)
        if as_negative < 0:
            return -negative  # step back from a risk that cannot be: it fits the unlabelled positives
        return prior * (p.T @ (sp - 1)) / len(p) + negative + DECAY * at

    at = _descend(risk, p.shape[1])
    return Model(centre, spread, at[:-1], float(at[-1]), prior)


def _sample(rows: DataFrame, size: int, among: DataFrame | None = None) -> np.ndarray:
    some = smallest(rows.select("doc_id", filled(F.col("text")).alias("text")), size, among=among)

    def describe(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"row": [features(text).tobytes() for text in part["text"]]})

    found = some.select("text").mapInPandas(describe, "row binary").toPandas()["row"]
    return np.stack([np.frombuffer(row, np.float32) for row in found]) if len(found) else np.zeros((0, N_FEATURES), np.float32)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model | None:
    """Learn from rows that are not held out; None without a positive."""
    learnt = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text")
    trusted = labels.where("quality = 1").select("doc_id").distinct()
    positives = _sample(learnt, sample, among=trusted)
    return train(positives, _sample(learnt, sample)) if len(positives) else None


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every text."""
    doc_id, text = F.col("doc_id"), filled(F.col("text"))
    rows = docs.select(doc_id.cast("bigint").alias("doc_id"), held_out(doc_id).alias("held_out"), text.alias("text"))
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.5).alias("score"), F.lit(1).alias("predicted"))

    def score(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            described = np.stack([features(text) for text in part["text"]]) if len(part) else np.zeros((0, N_FEATURES))
            scores = model.score(described).astype(float)
            ids, predicted = part["doc_id"].astype("Int64"), (scores >= 0.5).astype("int32")
            yield pd.DataFrame({"doc_id": ids, "held_out": part["held_out"], "score": scores, "predicted": predicted})

    return rows.mapInPandas(score, "doc_id bigint, held_out boolean, score double, predicted int")


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, fit(docs, labels))
