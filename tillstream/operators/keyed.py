"""One row per key: first and latest.

The row-number filters become a per-partition limit before the shuffle, so a key with very many
copies sends one row per input partition, not all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(rows: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """The first row of every key; `order` must be total for a repeatable result.

    Best called before any step that partitions by the same key: after one there is no shuffle left to
    limit the rows for.
    """
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col("__rank") == 1).drop("__rank")


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of every key."""
    return first_per_key(rows, keys, [F.col(name).desc_nulls_last() for name in order])
