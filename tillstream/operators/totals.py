"""Keyed sums and counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.money import cents, from_cents
from tillstream.functions.times import now_text


def brand_totals(wide: DataFrame, stat_time: Column | None = None) -> DataFrame:
    """Paid amount per brand of one batch, stamped with the processing time. Summed in cents."""
    return (
        wide.groupBy("tm_id", "tm_name")
        .agg(F.sum(cents(F.col("final_detail_amount"))).cast("bigint").alias("__cents"))
        .select(
            (stat_time if stat_time is not None else now_text()).alias("stat_time"),
            F.col("tm_id").alias("trademark_id"),
            F.col("tm_name").alias("trademark_name"),
            from_cents(F.col("__cents")).alias("amount"),
        )
    )


def active_devices(first_events: DataFrame, *keys: str) -> DataFrame:
    """Number of first events per key."""
    return first_events.groupBy(*keys).agg(F.count("*").alias("devices"))


def sliding_sums(rows: DataFrame, time: str, value: str, length: int, slide: int, keys: list[str]) -> DataFrame:
    """Sum per sliding window (seconds): rows are summed once per slide, then each slide joins its windows."""
    pane = F.window(F.col(time).cast("timestamp"), f"{slide} seconds")
    panes = rows.groupBy(pane.alias("__pane"), *keys).agg(F.sum(value).alias("__sum"), F.count("*").alias("__rows"))
    start = F.unix_seconds(F.col("__pane.start"))
    starts = F.sequence(start - (length - slide), start, F.lit(slide).cast("bigint"))
    return (
        panes.withColumn("__start", F.explode(starts))
        .groupBy("__start", *keys)
        .agg(F.sum("__sum").cast("bigint").alias("total"), F.sum("__rows").cast("bigint").alias("n_rows"))
        .select(
            F.timestamp_seconds("__start").alias("window_start"),
            F.timestamp_seconds(F.col("__start") + length).alias("window_end"),
            *keys,
            "total",
            "n_rows",
        )
    )
