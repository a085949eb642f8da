"""Line deduplication: passages that an earlier place has already are removed, in units of lines or of their sentences.

A text is cut into units: sentences inside lines, whole lines, or paragraphs. Every unit is compared, whatever its length.
It is normalised (A-Z lower, white space to single spaces) and hashed. Per digest the earliest occurrence in the order (doc_id, text
hash, position) is the one that stays; all others are later ones. Later units that follow each other in a text are a run; runs of
at least `least_run` words are removed, with their original offsets reported, shorter ones stay: a few sentences alone are equal by
chance or are quoted. Units without words neither belong to a run nor end one.

Digests are counted in each task before the shuffle, so a line that a third of the documents hold sends one row per task; the
join back to occurrences splits it (skew join). Runs are made of a text's own later units only.

Defined cases: null text counts as empty, which has no units; rows that repeat an id and its text are one document and get the
same result each; a unit repeated inside a document is a later one there too; null ids come first; an empty table gives an empty
result; columns of any other name are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.base import filled, written

LEAST_RUN = 25  # words: half of a passage of fifty, whose first and last sentence often belong to the text around it
_BREAK = {
    "sentence": re.compile(r"\n|(?<=[.!?])[ \t]+"),
    "line": re.compile(r"\n"),
    "paragraph": re.compile(r"\n[ \t\r]*\n"),
}
_UNIT = "doc_id bigint, text_key bigint, at int, start int, length int, words int, digest binary"


def _units(text: str, unit: str) -> Iterator[tuple[int, int]]:
    """(start, end) of each unit with the break after it, in characters; together they are the text."""
    start = 0
    for found in _BREAK[unit].finditer(text):
        yield start, found.end()
        start = found.end()
    if start < len(text):
        yield start, len(text)


def units(docs: DataFrame, unit: str = "sentence") -> DataFrame:
    """The units that have words, numbered in each text, with offset, words and digest."""
    columns = [field.split()[0] for field in _UNIT.split(", ")]

    def cut(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            found = []
            for doc_id, key, text in zip(part["doc_id"], part["text_key"], part["text"]):
                at = 0
                for start, end in _units(text, unit):
                    words = text[start:end].encode().lower().split()  # bytes: only A-Z and ASCII white space
                    if words:
                        digest = xxhash.xxh3_128_digest(b" ".join(words))
                        found.append((doc_id, key, at, start, end - start, len(words), digest))
                        at += 1
            yield pd.DataFrame(found, columns=columns).astype({"doc_id": "Int64"})

    return _keyed(docs).mapInPandas(cut, _UNIT)


def _keyed(docs: DataFrame) -> DataFrame:
    text = filled(F.col("text"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def later_units(found: DataFrame) -> DataFrame:
    """Units that an earlier place has, one row per place."""
    where = F.struct("doc_id", "text_key", "at")
    first = found.groupBy("digest").agg(F.min(where).alias("first"), F.count(F.lit(1)).alias("n"))
    # written, so that the join reads two plain shuffles, whose heavy digests Spark splits
    repeated = written(first.where("n > 1").select("digest", "first"), "repeated-units")
    later = found.join(repeated, "digest").where(where != F.col("first"))
    once = [F.min(name).alias(name) for name in ("start", "length", "words")]
    return later.groupBy("doc_id", "text_key", "at").agg(*once)


def removed_units(later: DataFrame, least_run: int = LEAST_RUN) -> DataFrame:
    """Per text the start and length of its later units that lie in runs of enough words."""
    text = ["doc_id", "text_key"]
    run = F.col("at") - F.row_number().over(Window.partitionBy(*text).orderBy("at"))
    together = later.withColumn("run", run).withColumn("run_words", F.sum("words").over(Window.partitionBy(*text, "run")))
    spans = F.array_sort(F.collect_list(F.struct("start", "length")))
    return together.where(F.col("run_words") >= least_run).groupBy(*text).agg(spans.alias("removed"))


def without_repeats(docs: DataFrame, unit: str = "sentence", least_run: int = LEAST_RUN) -> DataFrame:
    """One row per document: doc_id, text without the removed units, n_removed, removed (start and length of each)."""
    removed = removed_units(later_units(units(docs, unit)), least_run)
    rows, removed = _keyed(docs).alias("d"), removed.alias("r")
    same = F.col("d.doc_id").eqNullSafe(F.col("r.doc_id")) & (F.col("d.text_key") == F.col("r.text_key"))
    spans = F.coalesce(F.col("r.removed"), F.array().cast("array<struct<start: int, length: int>>"))
    return rows.join(removed, same, "left").select(
        F.col("d.doc_id"), _without(F.col("d.text"), F.col("r.removed")).alias("text"),
        F.size(spans).alias("n_removed"), spans.alias("removed"),
    )


def _without(text: Column, removed: Column) -> Column:
    """The text between the removed spans."""

    def between(i: Column) -> Column:
        last = F.get(removed, i - 1)
        begin = F.coalesce(last["start"] + last["length"], F.lit(0))
        end = F.coalesce(F.get(removed, i)["start"], F.char_length(text))
        return text.substr(begin + 1, end - begin)

    pieces = F.transform(F.sequence(F.lit(0), F.size(removed)), between)
    return F.when(removed.isNull(), text).otherwise(F.array_join(pieces, ""))
