"""Distinct counts that can be put together: one exact bitmap per day and range of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def daily_bitmaps(events: DataFrame, day: str, device: str) -> DataFrame:
    """Bitmaps (`day`, `bucket`, `bits`) of the devices of each day. Devices are integers from 0; others are left out.

    Each task sets its bits before the shuffle, so a device with very many events costs one bit per task.
    """
    ids = events.where(F.col(device) >= 0).select(F.col(day).alias("day"), (F.col(device).cast("bigint") + 1).alias("__id"))
    placed = ids.select("day", F.bitmap_bucket_number("__id").alias("bucket"), F.bitmap_bit_position("__id").alias("__bit"))
    return placed.groupBy("day", "bucket").agg(F.bitmap_construct_agg("__bit").alias("bits"))


def merged(*bitmaps: DataFrame) -> DataFrame:
    """One bitmap per day and bucket out of several tables of them."""
    together = bitmaps[0]
    for more in bitmaps[1:]:
        together = together.unionByName(more)
    return together.groupBy("day", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def devices_within(bitmaps: DataFrame, days: list[int]) -> DataFrame:
    """Distinct devices (`day`, `days`, `devices`) of the `days` days that end with each day that has any.

    A day's bitmap is sent to the days it counts for; events are not read again.
    """
    reach = F.explode(F.array(*[F.lit(n) for n in days])).alias("days")
    counted = bitmaps.select(F.col("day").cast("date").alias("__of"), "bucket", "bits", reach)
    ahead = F.sequence(F.lit(0), F.col("days") - 1)
    sent = counted.select(F.explode(F.transform(ahead, lambda n: F.date_add("__of", n))).alias("__day"), "days", "bucket", "bits")
    present = bitmaps.select(F.col("day").cast("date").alias("__present")).distinct()
    sent = sent.join(present, F.col("__day") == F.col("__present"), "left_semi")
    whole = sent.groupBy("__day", "days", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n"))
    return whole.groupBy(F.date_format("__day", "yyyy-MM-dd").alias("day"), "days").agg(F.sum("n").alias("devices"))
