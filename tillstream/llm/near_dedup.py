"""Near-duplicate groups by b-bit MinHash.

A document is its set of distinct five-word shingles, as 64-bit hashes. From 128 minima, bands of four give
the buckets that fetch candidate pairs, and the low four bits of each minimum are kept, packed as bit planes.
For a candidate pair the bit counts of the planes give the share of equal low bits, corrected for chance
equality (1 in 16); pairs whose estimate is six standard deviations below the threshold are dropped and the
rest are confirmed on their full sets. A pair at the threshold shares no band with a chance of 6e-6
((1 - 0.75^4)^32), and is dropped by its estimate with a chance of about 1e-9.

Equal sets become one class first. A bucket never gives all its pairs: in each round the first few unused
members of a bucket are its hubs, every later member of another component is paired with them, and links found join
components before the next round; a bucket whose unused members lie in one component is done. Bands have two rounds,
with 1 and with 4 hubs. What is left are members of large buckets of unlike texts, such as texts that quote one passage.
Their pairs are found without bands and without loss: of the left texts, those as similar as asked share one of the
rarest quarter of their shingles (prefix filter), and what comes after the first shared one bounds how many they can share
(positional filter). Buckets by such shingles go through rounds of 1, 16, 256, ... hubs until all are done. Component ids are
thus those of all links.

The full sets of all members of buckets are written once, before the first round, with a bitmap of fixed size in front, so that
other texts are not shuffled; rounds read those of the ids they need. Where copies are removed, only texts that go are shuffled.

Defined cases: null or empty texts have no words, are their own component and linked with nothing; rows
that repeat an id are judged row by row; null ids rank last in a component and stay if it has no other; an
empty table gives an empty result; columns of any other name are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstream.llm.base import asked, counted, filled, small_batches, written
from tillstream.llm.components import components

WORDS = 5
PERCENT = 75
HASHES = 128
BAND_ROWS = 4
BITS = 4
DEVIATIONS = 6
BAND_HUBS = (1, 4)
_CHUNK = 2048  # shingles hashed at once
_MIX_A, _MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SIGNATURE = "doc_id bigint, text_key bigint, n_shingles bigint, digest binary, bands array<bigint>, planes array<bigint>"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _MIX_A
    x = (x ^ (x >> np.uint64(29))) * _MIX_B
    return x ^ (x >> np.uint64(32))


def shingles(text: str, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of `size` words; of the whole text if it has fewer."""
    words = text.encode().lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    run = min(size, len(words))
    last = len(words) - run + 1
    found = _mixed(hashed[:last] + np.uint64(run))
    for at in range(1, run):
        found = _mixed(found * _MIX_B + hashed[at : at + last])
    return np.unique(found)


def _multipliers() -> tuple[np.ndarray, np.ndarray]:
    numbers = np.random.Generator(np.random.PCG64(20240607)).integers(0, 2**63, (2, HASHES, 1), dtype=np.uint64)
    return numbers[0] * np.uint64(2) + np.uint64(1), numbers[1]


def minima(values: np.ndarray, factors: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The upper half of the smallest value under each hash function."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for first in range(0, len(values), _CHUNK):
        hashed = values[first : first + _CHUNK] * factors[0] + factors[1]
        np.minimum(least, hashed.min(axis=1), out=least)
    return least >> np.uint64(32)


def _bands(least: np.ndarray) -> np.ndarray:
    """A key per band; the band's number is part of it."""
    rows = least.reshape(len(least), -1, BAND_ROWS)
    key = np.broadcast_to(np.arange(rows.shape[1], dtype=np.uint64), rows.shape[:2]).copy()
    for at in range(BAND_ROWS):
        key = _mixed(key * _MIX_B + rows[:, :, at])
    return key.view(np.int64)


def _planes(least: np.ndarray) -> np.ndarray:
    """Low bits, one plane of HASHES bits after the other, 64 to a number."""
    bits = [(least >> np.uint64(at) & np.uint64(1)).astype(np.uint8) for at in range(BITS)]
    return np.packbits(np.concatenate(bits, axis=1), axis=1).view(np.int64)


def signatures(docs: DataFrame) -> DataFrame:
    """Set size, digest of the set, band keys and packed low bits of every document."""

    def sign(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        factors = _multipliers()
        for part in parts:
            sets = [shingles(text) for text in part["text"]]
            if not sets:
                continue
            least = np.stack([minima(one, factors) for one in sets])
            yield pd.DataFrame(
                {
                    "doc_id": part["doc_id"].astype("Int64"), "text_key": part["text_key"],
                    "n_shingles": [len(one) for one in sets],
                    "digest": [xxhash.xxh3_128_digest(one.tobytes()) for one in sets],
                    "bands": list(_bands(least)), "planes": list(_planes(least)),
                }
            )

    return _keyed(docs).mapInPandas(sign, _SIGNATURE)


def _keyed(docs: DataFrame) -> DataFrame:
    text = filled(F.col("text"))
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("text_key"), text.alias("text"))


def estimate(one: Column, other: Column) -> Column:
    """Similarity by the planes' bit counts, corrected for low bits that are equal by chance."""
    words = HASHES // 64
    differing = None
    for word in range(words):
        unlike = None
        for plane in range(BITS):
            at = plane * words + word
            bits = one[at].bitwiseXOR(other[at])
            unlike = bits if unlike is None else unlike.bitwiseOR(bits)
        differing = F.bit_count(unlike) if differing is None else differing + F.bit_count(unlike)
    chance = 2.0**-BITS
    return (1 - differing / HASHES - chance) / (1 - chance)


def least_estimate(percent: int = PERCENT) -> float:
    """The threshold less DEVIATIONS standard deviations of the estimate."""
    similarity, chance = percent / 100, 2.0**-BITS
    equal = similarity + (1 - similarity) * chance
    return similarity - DEVIATIONS * math.sqrt(equal * (1 - equal) / HASHES) / (1 - chance)


def _classes(signed: DataFrame) -> DataFrame:
    """One row per distinct set, numbered as it is written."""
    grouped = signed.where("n_shingles > 0").groupBy("digest").agg(
        F.min("doc_id").alias("first_id"), F.min(F.struct("doc_id", "text_key")).alias("text_of"),
        F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("planes").alias("planes"),
    )
    return written(grouped.withColumn("id", F.monotonically_increasing_id()), "near-classes")


def _row_key() -> Column:
    """The id and the hash of the text in one value that is never null."""
    return F.concat_ws(":", "doc_id", "text_key")


def _sets(docs: DataFrame, classes: DataFrame, ids: DataFrame) -> DataFrame:
    """The full sets of the classes with these ids, one row each, written once."""
    wanted = classes.join(ids, "id").select("id", "text_of.*").select("id", _row_key().alias("row_key"))
    wanted = written(wanted, "near-wanted")
    texts = _keyed(docs).select(_row_key().alias("row_key"), "text")
    texts = asked(texts, wanted, "row_key").where("asked").groupBy("row_key").agg(F.first("text").alias("text"))

    def make(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            yield pd.DataFrame({"id": part["id"], "members": [shingles(text).view(np.int64) for text in part["text"]]})

    found = wanted.join(texts, "row_key").select("id", "text").mapInPandas(make, "id bigint, members array<bigint>")
    with small_batches(docs.sparkSession):
        return written(found, "near-sets")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets are similar enough."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    some = written(sets.join(ids, "id", "left_semi"), "near-met-sets")
    one = some.select(F.col("id").alias("a"), F.col("members").alias("of_a"))
    other = some.select(F.col("id").alias("b"), F.col("members").alias("of_b"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", F.size("of_a").alias("na"), F.size("of_b").alias("nb"),
                                                        F.size(F.array_intersect("of_a", "of_b")).alias("shared"))
    return both.where(F.col("shared") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("shared"))).select("a", "b")


def _shared_only(members: DataFrame) -> DataFrame:
    """Members of buckets that have more than one."""
    shared = members.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
    return members.join(shared, "key", "left_semi")


def _prefixes(sets: DataFrame, ids: DataFrame, percent: int) -> DataFrame:
    """Rare shingles of these classes: key, id, number of the class's rarer ones (at) and of all of them (n).

    Two classes that are similar enough share one of these; the order is by the number of classes here that have a shingle.
    """
    left = written(sets.join(ids, "id", "left_semi"), "near-left-sets")
    tokens = left.select("id", F.size("members").alias("n"), F.explode("members").alias("key"))
    found = tokens.groupBy("key").agg(F.count("*").alias("classes")).where("classes > 1")
    ordered = tokens.join(found, "key").groupBy("id", "n").agg(F.array_sort(F.collect_list(F.struct("classes", "key"))).alias("all"))
    placed = ordered.select("id", "n", F.size("all").alias("shared"), F.posexplode("all").alias("nr", "one"))
    placed = placed.select(F.col("one.key").alias("key"), "id", (F.col("n") - F.col("shared") + F.col("nr")).alias("at"), "n")
    return placed.where(F.col("at") * 100 <= F.col("n") * (100 - percent))


def _placed(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Members with their component."""
    if labels is None:
        return members.withColumn("component", F.col("id"))
    found = members.join(labels, F.col("id") == F.col("node"), "left")
    return found.select(*members.columns, F.coalesce("component", "id").alias("component"))


def _undone(placed: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component."""
    open_keys = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return placed.join(open_keys.where("low <> high").select("key"), "key", "left_semi")


def _meet(
    members: DataFrame, labels: DataFrame | None, narrow: DataFrame, hubs_each: int, percent: int
) -> tuple[DataFrame | None, DataFrame | None]:
    """Pairs of a bucket's first members with its later ones that could be linked, and the members not used; None for none."""
    still, n = counted(_undone(_placed(members, labels)), "near-undone")
    if not n[0]:
        return None, None
    order = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    hubs = still.withColumn("nr", order).where(F.col("nr") <= hubs_each).drop("nr")
    hubs = written(hubs.select("key", *[F.col(c).alias(f"{c}_hub") for c in hubs.columns if c != "key"]), "near-hubs")
    met = still.join(hubs, "key").where("id > id_hub AND component <> component_hub")
    if "at" in members.columns:
        most = F.least(F.col("n") - F.col("at"), F.col("n_hub") - F.col("at_hub"))
        met = met.where((100 + percent) * most >= percent * (F.col("n") + F.col("n_hub")))
    met = met.select(F.col("id_hub").alias("a"), F.col("id").alias("b")).distinct()
    a, b = (narrow.select(*[F.col(c).alias(f"{c}_{side}") for c in narrow.columns]) for side in "ab")
    near = met.join(a, F.col("a") == F.col("id_a")).join(b, F.col("b") == F.col("id_b"))
    near = near.where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    near = near.where(estimate(F.col("planes_a"), F.col("planes_b")) >= least_estimate(percent)).select("a", "b")
    last = hubs.groupBy("key").agg(F.max("id_hub").alias("last"))
    rest = still.drop("component").join(last, "key").where("id > last").select(*members.columns)
    near, n = counted(near, "near-pairs")
    return near if n[0] else None, rest


def _joined(sets: DataFrame, near: DataFrame | None, labels: DataFrame | None, percent: int) -> DataFrame | None:
    """Labels after the pairs that are links on their full sets."""
    if near is None:
        return labels
    links = _confirmed(near, sets, percent)
    if labels is None:
        return components(links)
    ends = links.join(labels.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left").join(
        labels.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left"
    )
    joined = components(ends.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")))
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("moved"))
    labels = labels.join(moved, "component", "left").select("node", F.coalesce("moved", "component").alias("component"))
    return written(labels.unionByName(joined), "near-labels")


def _linked(docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame | None:
    """(node, component) of the classes that are linked to one with a smaller id; None where no pair came near."""
    narrow, labels = classes.select("id", "n", "planes"), None
    members, n = counted(_shared_only(classes.select(F.explode("bands").alias("key"), "id")), "near-members")
    if not n[0]:
        return None
    sets = _sets(docs, classes, members.select("id").distinct())
    for hubs_each in BAND_HUBS:
        near, members = _meet(members, labels, narrow, hubs_each, percent)
        labels = _joined(sets, near, labels, percent)
        if members is None:
            return labels
    ids, n = counted(_undone(_placed(members, labels)).select("id").distinct(), "near-left")
    members, hubs_each = _shared_only(_prefixes(sets, ids, percent)) if n[0] else None, 1
    while members is not None:
        near, members = _meet(members, labels, narrow, hubs_each, percent)
        labels = _joined(sets, near, labels, percent)
        hubs_each *= 16
    return labels


def near_groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, class_id (equal sets have equal ones), text_key."""
    with small_batches(docs.sparkSession):
        signed = written(signatures(docs), "near-signatures")
    classes = _classes(signed)
    labels = _linked(docs, classes, percent)
    placed = _placed(classes.select("digest", "id", "first_id"), labels)
    lowest = placed.groupBy("component").agg(F.min("first_id").alias("component_id"))
    of_digest = placed.join(lowest, "component").select(
        F.col("digest").alias("of_digest"), F.col("id").alias("class_id"), "component_id"
    )
    rows = signed.select("doc_id", "text_key", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
    rows = rows.join(of_digest, F.col("digest") == F.col("of_digest"), "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"), "class_id",
        "text_key",
    )


def without_near_copies(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The document of each component that stays, with all its columns."""
    gone = near_groups(docs, percent).where("NOT kept").select(_row_key().alias("row_key"))
    gone = written(gone.distinct(), "near-gone")
    rows = docs.select(
        F.struct("*").alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(filled(F.col("text"))).alias("text_key")
    ).select("doc", _row_key().alias("row_key"))
    rows = asked(rows, gone, "row_key")
    left = rows.where("asked").join(gone, "row_key", "left_anti")
    return rows.where("NOT asked").select("doc").union(left.select("doc")).select("doc.*")
