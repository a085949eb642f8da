"""Importance resampling: documents drawn so that their hashed n-grams follow a target's.

Features are the runs of one to three words, hashed by the crc32 of their bytes into buckets. Words are looked up by
an Aho-Corasick automaton over distinct words, each bounded by a delimiter on either side, so that a scan emits whole words only:
of each its crc32, the crc32 with a space after it, and its length. The crc32 of a run is composed of its words' payloads
(crc32 is linear: the first part is shifted by the length of the second, by table), so no n-gram is ever put together as text.

Every task has its own dictionary, of the words that it has met: words that a scan doesn't find are hashed where they stand and
go into the automaton when it is next built. It holds at most `DICTIONARY_WORDS`; words beyond are hashed each time they
occur, with the same result. Counts are summed per task, so the shuffle carries one row per bucket and task whatever the words are,
and the table of gains has one number per bucket. Scored rows are written, ranked by ranges of the score (totals per
range are added up, nothing is sorted in one task) and read from there.

Defined cases: null text has no words, no feature and weight 0; words are counted with repeats; rows that repeat an id are
documents of their own, also in N; of equal scores the smaller id comes first, a null id, hashed as an empty one, before all; without
target every count of it is 0; with no document of `least_words` words nothing is drawn; an empty table gives an empty result; columns of any
other name are ignored.
"""

from __future__ import annotations

import functools
import itertools
import math
import re
import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.base import LOWER, UPPER, counted, filled, written

BUCKETS = 10_000
ORDER = 3
DICTIONARY_WORDS = 200_000
REBUILT_FROM = 2_000  # new words that are worth a new automaton
WORD_BYTES = 64  # longer words are not put into the dictionary
CHUNK = 1 << 20
_POLYNOMIAL = 0xEDB88320

_WORD = re.compile(rb" *[^ ]+")

# Upper case to lower case, everything that is in no word to the delimiter.
_IN_WORD = {*b"0123456789", *UPPER.encode(), *LOWER.encode(), *range(0x80, 0x100)}
_NORMAL = bytes(ord(chr(b).lower()) if b < 0x80 and b in _IN_WORD else b if b in _IN_WORD else 0x20 for b in range(256))


@functools.cache
def _byte_steps() -> np.ndarray:
    """What one zero byte makes of each value of a crc32's low byte."""
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = np.where(steps & 1, (steps >> 1) ^ np.uint32(_POLYNOMIAL), steps >> 1)
    return steps


@functools.cache
def _shift_tables() -> np.ndarray:
    """Tables by number of zero bytes (0 to 255), byte of the value and its value: the shifted value is the xor of four."""
    tables = np.zeros((256, 4, 256), np.uint32)
    for byte in range(4):
        tables[0, byte] = np.arange(256, dtype=np.uint32) << np.uint32(8 * byte)
    for count in range(1, 256):
        before = tables[count - 1]
        tables[count] = (before >> np.uint32(8)) ^ _byte_steps()[before & 0xFF]
    return tables


def _shifted_short(crcs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    tables = _shift_tables()
    result = tables[counts, 0, crcs & 0xFF]
    for byte in range(1, 4):
        result ^= tables[counts, byte, (crcs >> np.uint32(8 * byte)) & 0xFF]
    return result


@functools.cache
def _power_tables(bits: int) -> np.ndarray:
    """The four tables that shift by 2^bits zero bytes."""
    if bits < 8:
        return _shift_tables()[1 << bits]
    half = _power_tables(bits - 1)
    return _through(half, _through(half, _shift_tables()[0].reshape(-1))).reshape(4, 256)


def _through(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    parts = (tables[byte][(crcs >> np.uint32(8 * byte)) & 0xFF] for byte in range(4))
    return functools.reduce(np.bitwise_xor, parts)


def shifted(crcs: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """crc32 values after so many further zero bytes, without the value's first and last inversion: a crc32 of AB is
    `shifted(crc32(A), len(B)) ^ crc32(B)`."""
    result = _shifted_short(crcs, counts & 0xFF)
    rest, bits = counts >> 8, 8
    while rest.any():
        rows = (rest & 1).astype(bool)
        result[rows] = _through(_power_tables(bits), result[rows])
        rest, bits = rest >> 1, bits + 1
    return result


class Dictionary:
    """Payloads of the words met so far, and the automaton that finds them in a text."""

    def __init__(self, most: int = DICTIONARY_WORDS, rebuilt_from: int = REBUILT_FROM) -> None:
        self.most, self.rebuilt_from = most, rebuilt_from
        self.known: set[bytes] = set()
        self.new: set[bytes] = set()
        self.automaton = None
        self.crcs, self.spaced, self.sizes = (np.zeros(0, kind) for kind in (np.uint32, np.uint32, np.int64))

    def _rebuild(self) -> None:
        self.known |= set(itertools.islice(self.new, self.most - len(self.known)))
        self.new = set()
        words = list(self.known)
        self.automaton = ahocorasick.Automaton()
        for nr, word in enumerate(words):
            self.automaton.add_word(f" {word.decode('latin-1')} ", nr)
        self.automaton.make_automaton()
        self.crcs = np.array([zlib.crc32(word) for word in words], np.uint32)
        self.spaced = np.array([zlib.crc32(word + b" ") for word in words], np.uint32)
        self.sizes = np.array([len(word) for word in words], np.int64)

    def payloads(self, text: bytes) -> tuple[np.ndarray, ...]:
        """Of each word of a normalised text that begins and ends with a delimiter: start, crc32, crc32 with a space, length."""
        edges = np.diff((np.frombuffer(text, np.uint8) != 0x20).astype(np.int8))
        starts, ends = np.flatnonzero(edges == 1) + 1, np.flatnonzero(edges == -1) + 1
        crcs, spaced = np.zeros(len(starts), np.uint32), np.zeros(len(starts), np.uint32)
        if len(self.new) >= max(self.rebuilt_from, len(self.known) // 4) and len(self.known) < self.most:
            self._rebuild()
        missing = np.ones(len(starts), bool)
        if self.automaton is not None:
            emitted = self.automaton.iter(text.decode("latin-1"))
            found = np.fromiter(itertools.chain.from_iterable(emitted), np.int64).reshape(-1, 2)
            places = np.searchsorted(ends, found[:, 0])
            crcs[places], spaced[places] = self.crcs[found[:, 1]], self.spaced[found[:, 1]]
            missing[places] = False
        for at in np.flatnonzero(missing).tolist():
            word = text[starts[at] : ends[at]]
            crcs[at], spaced[at] = zlib.crc32(word), zlib.crc32(word + b" ")
            if len(word) <= WORD_BYTES:
                self.new.add(word)
        if len(self.known) >= self.most:
            self.new.clear()
        return starts, crcs, spaced, ends - starts


def _segments(texts: list[bytes], order: int, size: int = CHUNK) -> Iterator[list[tuple[int, bytes, int]]]:
    """Groups of about `size` bytes of normalised (document number, segment, length of its own part).

    A segment of a long text goes on for the words that runs beginning in its own part reach.
    """
    some, total = [], 0
    for nr, text in enumerate(texts):
        body, at = text.translate(_NORMAL), 0
        while at < len(body):
            end = body.find(b" ", at + size)
            end = reach = len(body) if end < 0 else end
            for _ in range(order - 1):
                further = _WORD.match(body, reach)
                reach = further.end() if further else reach
            if some and total + reach - at > size:
                yield some
                some, total = [], 0
            some.append((nr, body[at:reach], end - at))
            total += reach - at
            at = end
    if some:
        yield some


def _features(
    segments: list[tuple[int, bytes, int]], words: Dictionary, buckets: int, order: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place of the segment, bucket) of all features that begin in the segments' own parts, in order; for each length of run."""
    whole = b" " + b" ".join([body for _, body, _ in segments]) + b" "
    firsts = np.cumsum([1] + [len(body) + 1 for _, body, _ in segments])
    starts, crcs, spaced, sizes = words.payloads(whole)
    owner = np.searchsorted(firsts, starts, side="right") - 1
    own = starts - firsts[owner] < np.array([length for _, _, length in segments], np.int64)[owner]
    run, length = crcs, sizes
    yield owner[own], run[own] % np.uint32(buckets)
    for count in range(2, order + 1):  # the run that begins at a word: the word with a space, then the run at the next word
        head = max(len(starts) - count + 1, 0)
        run = shifted(spaced[:head], length[1 : head + 1]) ^ run[1 : head + 1]
        length = sizes[:head] + 1 + length[1 : head + 1]
        inside = own[:head] & (owner[:head] == owner[count - 1 :][:head])
        yield owner[:head][inside], run[inside] % np.uint32(buckets)


@functools.cache
def dictionary() -> Dictionary:
    """One for all tasks of a Python worker."""
    return Dictionary()


def _texts(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select(*columns, filled(F.col("text")).cast("binary").alias("text"))


def feature_counts(rows: DataFrame, buckets: int = BUCKETS, order: int = ORDER) -> np.ndarray:
    """How many features of all texts fall into each bucket. One row per bucket comes to the driver."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        totals, words = np.zeros(buckets, np.int64), dictionary()
        for part in parts:
            for some in _segments(part["text"].tolist(), order):
                for _, bucket in _features(some, words, buckets, order):
                    totals += np.bincount(bucket, minlength=buckets)
        yield pd.DataFrame({"bucket": np.flatnonzero(totals), "n": totals[totals > 0]})

    found = _texts(rows).mapInPandas(count, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(buckets, np.int64)
    for row in found:
        counts[row["bucket"]] = row["n"]
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """1000 times the logarithm of how much likelier each bucket is in the target, smoothed by one feature a bucket, rounded down."""
    more_source, more_target = float(source.sum() + len(source)), float(target.sum() + len(target))
    ratios = ((t + 1.0) * more_source / ((s + 1.0) * more_target) for s, t in zip(source.tolist(), target.tolist()))
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def weighed(docs: DataFrame, gain: np.ndarray, order: int = ORDER) -> DataFrame:
    """doc_id, n_words, n_features and weight, the sum of the gains of its features, of each document."""
    buckets = len(gain)

    def weigh(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = dictionary()
        for part in parts:
            n_words, n_features, weight = (np.zeros(len(part), np.int64) for _ in range(3))
            for some in _segments(part["text"].tolist(), order):
                documents = np.array([nr for nr, _, _ in some])
                for count, (place, bucket) in enumerate(_features(some, words, buckets, order), 1):
                    per_segment = np.bincount(place, minlength=len(some))
                    sums = np.concatenate([[0], np.cumsum(gain[bucket])])  # places come in order
                    until = np.cumsum(per_segment)
                    np.add.at(n_features, documents, per_segment)
                    np.add.at(weight, documents, sums[until] - sums[until - per_segment])
                    if count == 1:
                        np.add.at(n_words, documents, per_segment)
            yield pd.DataFrame(
                {"doc_id": part["doc_id"], "n_words": n_words, "n_features": n_features, "weight": weight}
            ).astype({"doc_id": "Int64"})

    rows = _texts(docs, F.col("doc_id").cast("bigint").alias("doc_id"))
    return rows.mapInPandas(weigh, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def resampled(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS, order: int = ORDER
) -> DataFrame:
    """Every document with n_words, n_features, weight, score and rank; rank is null where a document isn't drawn.

    The score is the weight plus Gumbel noise from the id's sha256, so that the highest scores are a sample without
    replacement by weight. Of the documents with `least_words` words the best `percent` are drawn.
    """
    gain = gains(feature_counts(docs, buckets, order), feature_counts(target, buckets, order))
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    share = (F.conv(F.substring(F.sha2(key.cast("binary"), 256), 1, 8), 16, 10).cast("bigint") + 0.5) / 4294967296.0
    noise = F.floor(-1000 * F.log(-F.log(share))).cast("bigint")
    scored = weighed(docs, gain, order).withColumn("score", F.col("weight") + noise)
    scored, (_, n) = counted(scored, "scored", F.sum((F.col("n_words") >= least_words).cast("bigint")))
    drawn = percent * (n or 0) // 100
    # the rows that can't be drawn come last; the number tells equal rows apart, so that no range must hold them all
    order_by = [F.col("out"), F.col("score").desc(), F.col("doc_id"), F.col("row")]
    rows = scored.withColumns({"out": F.col("n_words") < least_words, "row": F.monotonically_increasing_id()})
    ranged = written(rows.repartitionByRange(*order_by).withColumn("range", F.spark_partition_id()), "ranked")
    totals = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))  # one row per range
    starts = totals.select("range", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("range").orderBy(*order_by)) + F.col("before")
    wanted = F.when(~F.col("out") & (F.col("rank") <= drawn), F.col("rank").cast("bigint"))
    ranked = ranged.join(starts, "range").withColumn("rank", rank)
    return ranked.select("doc_id", "n_words", "n_features", "weight", "score", wanted.alias("rank"))
