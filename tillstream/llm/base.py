"""What the operators share: reading tables, ASCII lower case, tables written between steps."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tillstream.session import workspace

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
FILTER_BITS = 1 << 26  # eight megabytes at most, sent to every executor


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def filled(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, everything else unchanged. `lower` does just that where every character is ASCII."""
    text = filled(text)
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def written(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there: later plans start at these files."""
    spark = rows.sparkSession
    folder = workspace(spark, purpose)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


def counted(rows: DataFrame, purpose: str, *more: Column) -> tuple[DataFrame, tuple]:
    """The rows, written as by `written`, with their number and further totals taken as they are written."""
    totals = Observation()
    watched = rows.observe(totals, F.count(F.lit(1)).alias("t0"), *[total.alias(f"t{i}") for i, total in enumerate(more, 1)])
    stored = written(watched, purpose)
    found = totals.get
    return stored, tuple(found[f"t{i}"] for i in range(len(more) + 1))


@contextmanager
def small_batches(spark: SparkSession, rows: int = 512) -> Iterator[None]:
    """Few rows to an Arrow batch in the jobs inside, whose rows hold whole texts or sets."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def asked(rows: DataFrame, wanted: DataFrame, *keys: str, bits: int = FILTER_BITS) -> DataFrame:
    """The rows with `asked`: true for all whose keys are wanted and for few others, without a shuffle of rows."""
    place = F.pmod(F.xxhash64(*keys), F.lit(bits))
    places = wanted.select(place.alias("place"))
    marks = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("marks")
    )
    at = F.bitmap_bit_position(place)
    byte = F.conv(F.hex(F.substring("marks", (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    placed = rows.withColumn("bucket", F.bitmap_bucket_number(place)).join(F.broadcast(marks), "bucket", "left")
    return placed.withColumn("asked", F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))).drop("bucket", "marks")


def held_out(doc_id: Column) -> Column:
    """Rows a model must not learn from: crc32 of the id as text leaves remainder 1 when divided by 3."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "UTF-8")) % 3 == 1


def _lowest(ids: DataFrame, size: int, most: int | None = None) -> DataFrame:
    """Of (doc_id, of) about twice `size` ids for each `of`, among them the `size` with the smallest hash; all of a small group."""
    hashed = F.xxhash64("doc_id")
    groups = ids.groupBy("of").agg(F.count("*").alias("n"))
    groups = groups if most is None else groups.orderBy(F.desc("n"), "of").limit(most)
    groups = written(groups.withColumn("top", F.lit(-(2.0**63)) + F.lit(2.0**65 * size) / F.col("n")), "sample-groups")
    below = ids.join(groups, "of").where(hashed.cast("double") <= F.col("top")).groupBy("of").agg(F.count("*").alias("found"))
    found = F.coalesce("found", F.lit(0))
    top = F.when(found < F.least(F.col("n"), F.lit(size)), F.lit(2.0**63)).otherwise(F.col("top"))
    groups = written(groups.join(below, "of", "left").select("of", top.alias("top")), "sample-tops")
    return ids.join(groups, "of").where(hashed.cast("double") <= F.col("top")).select("doc_id", "of")


def smallest(
    rows: DataFrame, size: int, within: str | None = None, among: DataFrame | None = None, most: int | None = None
) -> DataFrame:
    """The rows of the `size` ids with the smallest hash, in all or of each value of a column; one row per id.

    `among` gives the ids to choose from, where not all count; `most` bounds the values, those with the most ids first.

    Ids are counted first, so that only those below the hash that twice `size` of them are expected to reach are ranked; a value for
    which fewer than `size` do has all its ids ranked. The ids are chosen from narrow rows and written, so that Spark knows how
    few they are when it joins the texts.
    """
    ids = rows.select("doc_id", (F.col(within) if within else F.lit("")).alias("of")).where("doc_id IS NOT NULL")
    ids = (ids if among is None else ids.join(among, "doc_id", "left_semi")).distinct()
    nr = F.row_number().over(Window.partitionBy("of").orderBy(F.xxhash64("doc_id"), "doc_id"))
    ranked = _lowest(written(ids, "sample-ids"), size, most).withColumn("nr", nr).where(F.col("nr") <= size)
    ids = written(ranked.groupBy("doc_id").agg(F.min("nr").alias("nr")), "sample")
    others = [F.min(name).alias(name) for name in rows.columns if name != "doc_id"]
    return rows.join(ids, "doc_id").groupBy("doc_id", "nr").agg(*others)
