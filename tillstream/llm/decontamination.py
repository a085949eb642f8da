"""Benchmark decontamination by winnowing.

A text's fingerprints are the smallest hash of its k-grams in every run of `w = span - k + 1` of them, so any
two texts that share `span` consecutive words share the fingerprint chosen there. Document fingerprints are
joined to those of the benchmark, and each hit is extended to the windows of `span` words that can have it; their
words are then compared. Items of fewer words are one window of their own length, fingerprinted as a whole.

Only fingerprints (position and hash) are joined, not texts. The texts of documents with a hit come back in one join; others stay
where they are, by a bitmap of `FILTER_BITS` bits, of fixed size whatever the input. A hit is joined to each window once,
however many items have it: items belong to sets of items, one per window, and meet documents as sets. What is gathered per
document are its own windows, and its items, which the result names. The index of the benchmark is written first, so Spark
knows its size and chooses the joins by it.

Defined cases: null text has no words; an item without words has no window; rows that repeat an id and its
text are one document and get the same result each; a repeated item id counts once; null item ids count as
items named by the empty string; empty tables give no hits or no rows; columns of any other name are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.base import ascii_lower, asked, written

SPAN = 10
GRAM = 6
_KEYS = ("doc_id", "text_key")
POSITION_BITS = 30  # a text has fewer words than that; the bits above hold the hash
_HASH = ~((1 << POSITION_BITS) - 1)
_NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(text), _NOT_WORD), "")


def _grams(words: Column, size: int) -> Column:
    """Hash and position (from 1) of each run of `size` words, in one number."""
    last = F.size(words) - size + 1
    hashed = F.transform(
        F.sequence(F.lit(1), last),
        lambda i: F.xxhash64(F.slice(words, i, size), F.lit(size)).bitwiseAND(F.lit(_HASH)).bitwiseOR(i.cast("bigint")),
    )
    return F.when(last >= 1, hashed).otherwise(F.array().cast("array<bigint>"))


def _least(grams: Column, run: int) -> Column:
    """The smallest gram of every run."""
    last = F.size(grams) - run + 1
    chosen = F.transform(F.sequence(F.lit(1), last), lambda i: F.array_min(F.slice(grams, i, run)))
    return F.when(last >= 1, F.array_distinct(chosen)).otherwise(F.array().cast("array<bigint>"))


def fingerprints(rows: DataFrame, keys: list[str], shorter: list[int], span: int, gram: int) -> DataFrame:
    """(keys, hash, at) of winnowed grams, and of every run as long as one of the shorter items. Needs `words`."""
    grams = rows.select(*keys, "words", _grams(F.col("words"), gram).alias("grams"))
    chosen = _least(F.col("grams"), span - gram + 1)
    for length in shorter:
        chosen = F.concat(chosen, _grams(F.col("words"), length))
    exploded = grams.select(*keys, F.explode(chosen).alias("code"))
    at = F.col("code").bitwiseAND(F.lit(~_HASH)).cast("int")
    return exploded.select(*keys, F.col("code").bitwiseAND(F.lit(_HASH)).alias("hash"), at.alias("at"))


def benchmark_index(items: DataFrame, span: int = SPAN, gram: int = GRAM) -> tuple[DataFrame, DataFrame, DataFrame, list[int]]:
    """What documents are joined to, and the lengths below `span` that occur (fewer than `span`).

    `index` (hash, ahead, span): a fingerprint, how many words its window begins before it, and the window's length.
    `windows` (window, set_id): the words of each window, and the set of the items that have it.
    `members` (set_id, item_id). A set is known by its size and two sums of 64 bits over its items.
    """
    words = items.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), words_of(F.col("text")).alias("words")
    ).where(F.size("words") > 0)
    words = written(words, "benchmark-words")
    sizes = words.where(F.size("words") < span).select(F.size("words").alias("n")).distinct()
    shorter = sorted(row["n"] for row in sizes.collect())
    parts = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("words") - span + 1, F.lit(1))), lambda i: F.slice("words", i, span)
    )
    owned = words.select("item_id", F.explode(parts).alias("words")).distinct()
    owned = written(owned.select("item_id", "words", F.array_join("words", " ").alias("window")), "benchmark-windows")
    sums = [F.count(F.lit(1)), F.bit_xor(F.xxhash64("item_id")), F.bit_xor(F.xxhash64(F.lit(1), "item_id"))]
    windows = written(owned.groupBy("window").agg(F.concat_ws("_", *sums).alias("set_id")), "benchmark-sets")
    example = windows.groupBy("set_id").agg(F.min("window").alias("window"))
    members = written(owned.join(example, "window").select("set_id", "item_id"), "benchmark-members")

    whole = F.size("words") == span
    code = F.when(whole, F.array_min(_grams(F.col("words"), gram)))
    for length in shorter:
        code = code.when(F.size("words") == length, F.get(_grams(F.col("words"), length), F.lit(0)))
    index = owned.select(code.alias("code"), F.size("words").alias("span"))
    ahead = (F.col("code").bitwiseAND(F.lit(~_HASH)) - 1).cast("int").alias("ahead")
    index = index.select(F.col("code").bitwiseAND(F.lit(_HASH)).alias("hash"), ahead, "span").distinct()
    return written(index, "benchmark-index"), windows, members, shorter


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents as structs, with the id and the hash of the text that they are known by here."""
    texts = docs.select(
        F.struct("*").alias("doc"), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")
    )
    return texts.withColumn("text_key", F.xxhash64("text"))


def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))


def _hits(texts: DataFrame, items: DataFrame, span: int, gram: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_key, start word, span, set_id) of the windows that documents have, and the sets' members."""
    index, windows, members, shorter = benchmark_index(items, span, gram)
    worded = texts.select("doc_id", "text_key", words_of(F.col("text")).alias("words"))
    prints = fingerprints(worded, ["doc_id", "text_key"], shorter, span, gram)
    start = (F.col("at") - F.col("ahead")).alias("start")
    places = prints.join(index, "hash").select("doc_id", "text_key", start, "span").where("start >= 1")
    places = places.groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("start", "span")).alias("places"))
    places = written(places, "document-places")

    wanted = asked(texts, places, *_KEYS).where("asked").alias("d").join(places.alias("p"), _same("d", "p"))
    wanted = wanted.select("d.doc_id", "d.text_key", words_of(F.col("d.text")).alias("words"), "p.places")
    inside = F.filter("places", lambda p: p["start"] + p["span"] - 1 <= F.size("words"))
    cut = lambda p: F.struct(
        p["start"].alias("start"), p["span"].alias("span"),
        F.array_join(F.slice("words", p["start"], p["span"]), " ").alias("window"),
    )
    seen = wanted.select("doc_id", "text_key", F.inline(F.transform(inside, cut)))
    hits = seen.join(windows, "window").select("doc_id", "text_key", "start", "span", "set_id")
    return written(hits, "document-hits"), members


def without_contaminated(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """The documents without a hit, with all their columns."""
    texts = _keyed(docs)
    hits, _ = _hits(texts, items, span, gram)
    bad = hits.select("doc_id", "text_key").distinct()
    rows = asked(texts, bad, *_KEYS)
    left = rows.where("asked").alias("d").join(bad.alias("b"), _same("d", "b"), "left_anti")
    return rows.where("NOT asked").select("doc.*").unionByName(left.select("doc.*"))


def _n_covered(spans: Column) -> Column:
    """How many words lie in some of the spans."""

    def add(seen: Column, span: Column) -> Column:
        last = span["start"] + span["span"] - 1
        more = F.greatest(last - F.greatest(seen["last"], span["start"] - 1), F.lit(0))
        return F.struct(F.greatest(seen["last"], last).alias("last"), (seen["n"] + more).alias("n"))

    none = F.struct(F.lit(0).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(F.array_sort(spans), none, add, lambda seen: seen["n"].cast("bigint"))


def contamination(docs: DataFrame, items: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, items, hits (start word, span)."""
    texts = _keyed(docs.select("doc_id", "text"))
    hits, members = _hits(texts, items, span, gram)
    keys = ["doc_id", "text_key"]
    spans = hits.groupBy(*keys).agg(F.collect_set(F.struct("start", "span")).alias("hits"))
    named = hits.select(*keys, "set_id").distinct().join(members, "set_id")
    named = named.groupBy(*keys).agg(F.array_sort(F.collect_set("item_id")).alias("items"))
    found = spans.alias("s").join(named.alias("i"), _same("s", "i")).select("s.*", "i.items")
    counted = texts.select(
        F.col("doc.doc_id").alias("own_id"), *keys, F.size(words_of(F.col("text"))).cast("bigint").alias("n_words")
    )
    rows = counted.alias("d").join(found.alias("f"), _same("d", "f"), "left").select(
        F.col("d.own_id").alias("doc_id"), "d.n_words",
        F.coalesce("f.items", F.array().cast("array<string>")).alias("items"),
        F.coalesce("f.hits", F.array().cast("array<struct<start: int, span: int>>")).alias("hits"),
    )
    return rows.select(
        "doc_id", "n_words", _n_covered(F.col("hits")).alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"), "items", "hits",
    )
