"""Exact deduplication by a stream with keyed state on disk.

Rows become (digest, id, content locator). A stream keeps, for each digest ever seen, the largest id, the
locator of its row and the number of rows; the state lies in a disk-backed store in the shared folder and
never expires. Rows are joined to the state by digest. Digests with more than one row are hits: their
full bytes are compared, and where texts differ in spite of an equal digest, the rows of that digest are
grouped by their whole text instead. Only the texts of hits are shuffled for that: a bitmap of `FILTER_BITS` bits, of
fixed size whatever the input, lets through all rows of hits and few others.

State is summed in each task before the shuffle, so a text that a third of all rows hold sends one row per
task. The join back splits a heavy digest (skew join), as the state has one row for it.

Defined cases: null text counts as empty, and empty texts equal each other; case differs only by A-Z; of
rows that share the largest id, the one with the last locator stays; null ids are lower than all others;
an empty table gives an empty result; columns of any other name are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from tillstream.llm.base import ascii_lower, written
from tillstream.session import workspace

STATE_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: without this each sets megabytes of disk aside that it does not need
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


FILTER_BITS = 1 << 26  # eight megabytes at most, sent to every executor


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def in_files(docs: DataFrame) -> DataFrame:
    """The rows, read from files, so that each has a place that stays: written first, if they are not."""
    try:
        docs.select("_metadata.file_path", "_metadata.row_index")
        return docs
    except AnalysisException:
        return written(docs, "exact-rows")


def located() -> Column:
    """Where a row's content lies: file and row."""
    return F.concat_ws("#", "_metadata.file_path", F.format_string("%015d", "_metadata.row_index"))


def _bit(digest: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(bits)) + 1


def hits_only(rows: DataFrame, hits: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """All rows whose digest is among the hits, and a few others, without a shuffle of the rows."""
    places = hits.select(_bit("digest", bits).alias("id"))
    places = places.select(F.bitmap_bucket_number("id").alias("bucket"), F.bitmap_bit_position("id").alias("bit"))
    marks = F.broadcast(places.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("marks")))
    at = F.bitmap_bit_position("id")
    byte = F.conv(F.hex(F.substring("marks", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.getbit(byte, (at % 8).cast("int")) == 1
    placed = rows.withColumn("id", _bit("digest", bits)).withColumn("bucket", F.bitmap_bucket_number("id"))
    return placed.join(marks, "bucket").where(marked).select(*rows.columns)


def keep_state(rows: DataFrame, checkpoint: str, changes: str, drain: bool = True) -> StreamingQuery:
    """Run a stream of (digest, doc_id, locator) into keyed state; changed keys go to one folder per batch.

    A repeated batch overwrites its own folder. The state's later values are never lower than earlier ones,
    so the largest value of a digest is the last one.
    """
    state = rows.groupBy("digest").agg(
        F.max(F.struct("doc_id", "locator")).alias("keep"), F.count("*").alias("group_size")
    )

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{changes}/batch_id={number}")

    spark, before = rows.sparkSession, {}
    for key, value in STATE_ON_DISK.items():
        before[key] = spark.conf.get(key, None)
        spark.conf.set(key, value)
    try:
        writer = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(write)
        return (writer.trigger(availableNow=True) if drain else writer).start()
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)


def current_state(spark: SparkSession, changes: str) -> DataFrame:
    """Digest, kept row and number of rows, after all batches so far."""
    schema = "digest string, keep struct<doc_id: bigint, locator: string>, group_size bigint"
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(changes)
    return rows.groupBy("digest").agg(F.max("keep").alias("keep"), F.max("group_size").alias("group_size"))


def exact_groups(
    docs: DataFrame, digest: Callable[[Column], Column] = sha256, batches: int = 3, text: str = "text"
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, locator.

    `batches`: the number of micro-batches that a table's rows are dealt into. `digest`: any digest; what a
    weak one confuses is told apart by the whole text.
    """
    spark, docs = docs.sparkSession, in_files(docs)
    root = workspace(spark, "exact-dedup")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), ascii_lower(F.col(text)).alias("body"), located().alias("locator")
    ).withColumn("digest", digest(F.col("body")))
    narrow = rows.select("doc_id", "locator", "digest", sha256(F.col("body")).alias("text_sha256"))
    narrow.write.parquet(f"{root}/rows")
    narrow = spark.read.schema(narrow.schema).parquet(f"{root}/rows")
    per_batch = max(1, math.ceil(len(narrow.inputFiles()) / batches))
    stream = spark.readStream.schema(narrow.schema).option("maxFilesPerTrigger", per_batch).parquet(f"{root}/rows")
    keep_state(stream.select("digest", "doc_id", "locator"), f"{root}/state", f"{root}/changes").awaitTermination()
    # written, so that both sides of the join below are plain shuffles, which a skew join can split
    state = written(current_state(spark, f"{root}/changes"), "exact-state")

    # the digests of hits are taken from the state that is written; their texts alone meet
    texts = hits_only(rows, state.where("group_size > 1").select("digest")).groupBy("digest").agg(F.count("*").alias("n"), F.min("body").alias("least"), F.max("body").alias("most"))
    confused = texts.where((F.col("n") > 1) & (F.col("least") != F.col("most"))).select("digest")
    confused.write.parquet(f"{root}/confused")
    confused = spark.read.schema(confused.schema).parquet(f"{root}/confused")
    decided = narrow.join(state, "digest")
    if not confused.isEmpty():
        by_text = rows.join(confused, "digest", "left_semi")
        kept = by_text.groupBy("digest", "body").agg(
            F.max(F.struct("doc_id", "locator")).alias("keep"), F.count("*").alias("group_size")
        )
        apart = by_text.join(kept, ["digest", "body"]).select(
            "digest", "doc_id", "locator", sha256(F.col("body")).alias("text_sha256"), "keep", "group_size"
        )
        decided = decided.join(confused, "digest", "left_anti").unionByName(apart)
    return decided.select(
        "doc_id", F.col("keep.doc_id").alias("keep_id"), "group_size",
        (F.col("locator") == F.col("keep.locator")).alias("kept"), "text_sha256", "locator",
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows that stay, with all their columns."""
    docs = in_files(docs)
    kept = exact_groups(docs).where("kept").select("locator")
    rows = docs.select(F.struct("*").alias("doc"), located().alias("locator"))
    return rows.join(kept, "locator", "left_semi").select("doc.*")
