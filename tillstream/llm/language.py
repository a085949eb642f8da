"""Language identification with a string kernel.

A text is the set of its byte n-grams of orders 1 to 4 (text in lower case), hashed per order: the blended
spectrum. The kernel of two texts is the weighted number of n-grams both have, divided by the norms.
Landmark texts span a Nyström approximation, in which one-versus-rest ridge regression is solved. Scoring a
batch is two matrix products: presence by landmarks, then by the regression's weights.

Fitting takes at most `per_language` labelled texts of each of the `most_languages` languages with the most texts, and `landmarks`
of them as landmarks (those with the smallest hash of their id); only their packed presence bits reach the driver, 2.6 KB
a text. Every text is scored whole, in batches.

Defined cases: a text that is null or has no letter is `und` with score 0; with nothing to learn from, all
texts are; rows without a language are not learnt from; repeated rows get equal results; an empty table gives
an empty result; columns of any other name are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tillstream.llm.base import filled, held_out, smallest

ORDER_BITS = (8, 12, 13, 13)
WEIGHTS = (1.0, 1.0, 1.0, 1.0)
PER_LANGUAGE = 400
LANDMARKS = 16
MOST_LANGUAGES = 64
RIDGE = 1e-2
SHARPNESS = 4.0
LEAST_SCORE = 0.3
UNKNOWN = "und"
_STARTS = np.cumsum([0, *(1 << bits for bits in ORDER_BITS)])
SIZE = int(_STARTS[-1])
_ROWS = 64


def presence(text: str) -> np.ndarray:
    """Which hashed n-grams a text has."""
    data = np.frombuffer(text.lower().encode(), np.uint8).astype(np.uint32)
    found, code = np.zeros(SIZE, bool), np.zeros(len(data), np.uint32)
    for order, bits in enumerate(ORDER_BITS):
        if len(data) <= order:
            break
        code = (code[: len(data) - order] << np.uint32(8)) | data[order:]
        place = code if order == 0 else (code * np.uint32(2654435761)) >> np.uint32(32 - bits)
        found[_STARTS[order] + place.astype(np.int64)] = True
    return found


_SCALE = np.repeat(np.sqrt(np.array(WEIGHTS, np.float32)), [1 << bits for bits in ORDER_BITS])


def _scaled(found: np.ndarray) -> np.ndarray:
    """Rows of unit length, so that a product of two is the kernel."""
    rows = found.astype(np.float32) * _SCALE
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass
class Model:
    languages: list[str]
    landmarks: np.ndarray  # packed presence bits
    weights: np.ndarray  # landmarks by languages

    def scorer(self):
        """A function from presence rows to probabilities."""
        spanned = _scaled(np.unpackbits(self.landmarks, axis=1, count=SIZE)).T.copy()

        def score(found: np.ndarray) -> np.ndarray:
            power = np.exp(SHARPNESS * (_scaled(found) @ spanned @ self.weights))
            return power / power.sum(axis=1, keepdims=True)

        return score


def fit(
    labelled: DataFrame, per_language: int = PER_LANGUAGE, landmarks: int = LANDMARKS, most_languages: int = MOST_LANGUAGES
) -> Model | None:
    """Learn from columns doc_id, text and lang; None without labelled texts that have a letter."""
    learnt = labelled.where("lang IS NOT NULL AND text IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    some = smallest(learnt.select("doc_id", "lang", "text"), per_language, within="lang", most=most_languages)

    def pack(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            bits = [np.packbits(presence(text)).tobytes() for text in part["text"]]
            yield pd.DataFrame({"lang": part["lang"], "nr": part["nr"], "bits": bits})

    rows = some.select("lang", "nr", "text").mapInPandas(pack, "lang string, nr int, bits binary").toPandas()
    if rows.empty:
        return None
    rows = rows.sort_values(["lang", "nr"]).reset_index(drop=True)
    packed = np.stack([np.frombuffer(bits, np.uint8) for bits in rows["bits"]])
    languages = sorted(rows["lang"].unique())
    chosen = packed[(rows["nr"] <= landmarks).to_numpy()]
    spanned = _scaled(np.unpackbits(chosen, axis=1, count=SIZE))
    values, vectors = np.linalg.eigh((spanned @ spanned.T).astype(np.float64))
    used = values > 1e-8 * values.max()
    whiten = vectors[:, used] / np.sqrt(values[used])
    kernel = np.concatenate([
        _scaled(np.unpackbits(packed[at : at + _ROWS], axis=1, count=SIZE)) @ spanned.T for at in range(0, len(packed), _ROWS)
    ])
    features = kernel @ whiten
    codes = np.searchsorted(languages, rows["lang"].to_numpy().astype(str))
    target = np.where(np.arange(len(languages)) == codes[:, None], 1.0, -1.0)
    each = 1.0 / np.bincount(codes, minlength=len(languages))[codes]  # languages count alike
    gram = features.T @ (features * each[:, None]) + RIDGE * np.eye(features.shape[1])
    weights = whiten @ np.linalg.solve(gram, features.T @ (target * each[:, None]))
    return Model(languages, chosen, weights.astype(np.float32))


def predictor(docs: DataFrame, model: Model):
    """A column function from text to struct<lang_pred, score>; its argument is empty for texts without a letter."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # landmarks times languages rows of a few KB
    kind = StructType([StructField("lang_pred", StringType()), StructField("score", DoubleType())])

    @F.pandas_udf(kind)
    def score(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = shared.value
        scorer, names = model.scorer(), np.array(model.languages, dtype=object)
        for part in parts:
            texts, known = list(part), (part != "").to_numpy()
            scores = [scorer(np.stack([presence(text) for text in texts[at : at + _ROWS]])) for at in range(0, len(texts), _ROWS)]
            scores = np.concatenate(scores) if scores else np.zeros((0, len(names)))
            yield pd.DataFrame(
                {
                    "lang_pred": np.where(known, names[scores.argmax(axis=1)], UNKNOWN),
                    "score": np.where(known, scores.max(axis=1, initial=0), 0.0).astype(float),
                }
            )

    return score


def _lettered(text: Column) -> Column:
    text = filled(text)
    return F.when(text.rlike(r"\p{L}"), text).otherwise("")


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every text."""
    ids = [F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out")]
    if model is None:
        return docs.select(*ids, F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    found = docs.select(*ids, predictor(docs, model)(_lettered(F.col("text"))).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


def learnt_from(docs: DataFrame) -> Model | None:
    """The model of the rows that are not held out."""
    return fit(docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang"))


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out and predict all."""
    return predict(docs, learnt_from(docs))


def accepted(docs: DataFrame, model: Model | None, least_score: float = LEAST_SCORE) -> DataFrame:
    """The documents in a known language: those with a letter and a score above chance; all columns as they were."""
    if model is None:
        return docs.where(F.lit(False))
    found = docs.select(F.struct("*").alias("doc"), predictor(docs, model)(_lettered(F.col("text"))).alias("found"))
    return found.where(F.col("found.lang_pred") != UNKNOWN).where(F.col("found.score") >= least_score).select("doc.*")
