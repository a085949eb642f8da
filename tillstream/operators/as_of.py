"""Rows with the version of a keyed record that was valid at their time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tillstream.functions.money import integer_div


def as_of_join(
    rows: DataFrame, versions: DataFrame, key: str, time: str, since: str, columns: list[str], seconds: int
) -> DataFrame:
    """Add `columns` of the newest version of `key` that began (`since`) at or before the row's `time`; null where none did.

    Versions of a key begin at different times. Rows and versions are put together and each row takes the last version
    before it. That is done within (key, time bucket of `seconds`), so a key with very many rows is spread along time; what was valid
    when a bucket began is found from the last versions of the buckets, one row per (key, bucket), and joined to it. No row is compared
    with every version. The result depends on times alone: the same rows give the same result whenever they are worked on.
    """
    micros = lambda name: F.unix_micros(F.col(name).cast("timestamp"))
    bucket = lambda name: integer_div(micros(name) - F.pmod(micros(name), width), width).alias("__bucket")
    width = F.lit(seconds * 1_000_000).cast("bigint")
    version = F.struct(*[F.col(name) for name in columns]).alias("__version")
    left = rows.select(F.col(key).alias("__key"), micros(time).alias("__at"), bucket(time), F.lit(1).alias("__turn"), F.struct(*rows.columns).alias("__row"))
    right = versions.where(F.col(key).isNotNull() & F.col(since).isNotNull()).select(
        F.col(key).alias("__key"), micros(since).alias("__at"), bucket(since), F.lit(0).alias("__turn"), version
    )
    both = left.unionByName(right, allowMissingColumns=True)
    inside = Window.partitionBy("__key", "__bucket").orderBy("__at", "__turn").rowsBetween(Window.unboundedPreceding, 0)
    last = both.withColumn("__inside", F.last("__version", ignorenulls=True).over(inside)).where("__turn = 1")
    ends = right.groupBy("__key", "__bucket").agg(F.max_by("__version", "__at").alias("__version"))
    places = left.select("__key", "__bucket").distinct().join(ends, ["__key", "__bucket"], "full")
    earlier = Window.partitionBy("__key").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = places.withColumn("__before", F.last("__version", ignorenulls=True).over(earlier)).drop("__version")
    before = before.where("__before IS NOT NULL").select(
        F.col("__key").alias("__of"), F.col("__bucket").alias("__in"), "__before"
    )
    same = (F.col("__key") == F.col("__of")) & (F.col("__bucket") == F.col("__in"))
    found = last.join(before, same, "left").select("__row", F.coalesce("__inside", "__before").alias("__version"))
    return found.select("__row.*", *[F.col(f"__version.{name}").alias(name) for name in columns])
