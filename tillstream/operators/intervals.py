"""Joins within a time bound of both rows, spread by (key, time bucket)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.functions.money import integer_div


def _micros(column: str):
    return F.unix_micros(F.col(column).cast("timestamp"))


def _bucketed(left: DataFrame, right: DataFrame, left_time: str, right_time: str, seconds: int):
    bound = F.lit(seconds * 1_000_000).cast("bigint")
    width = F.lit(2 * seconds * 1_000_000).cast("bigint")
    # floor division also before 1970
    bucket = lambda micros: integer_div(micros - F.pmod(micros, width), width)
    placed = left.withColumns({"__bucket": bucket(_micros(left_time)), "__left_at": _micros(left_time)})
    reach = F.sequence(bucket(_micros(right_time) - bound), bucket(_micros(right_time) + bound))
    spread = right.withColumn("__right_at", _micros(right_time)).withColumn("__bucket", F.explode(reach))
    return placed, spread, bound


def _match(placed: DataFrame, spread: DataFrame, keys: dict[str, str], bound):
    close = F.abs(placed["__left_at"] - spread["__right_at"]) <= bound
    same = placed["__bucket"] == spread["__bucket"]
    for left_key, right_key in keys.items():
        same = same & (placed[left_key] == spread[right_key])
    return same & close


def interval_join(
    left: DataFrame, right: DataFrame, keys: dict[str, str], left_time: str, right_time: str, seconds: int
) -> DataFrame:
    """Inner join on the keys of rows at most `seconds` apart.

    A right row is copied into the one or two buckets (twice the bound wide) it can match in, so each
    pair meets once and a key with very many rows is split along time.
    """
    placed, spread, bound = _bucketed(left, right, left_time, right_time, seconds)
    return placed.join(spread, _match(placed, spread, keys, bound)).select(
        *[placed[c] for c in left.columns], *[spread[c] for c in right.columns]
    )


def without_partner(
    left: DataFrame, right: DataFrame, keys: dict[str, str], left_time: str, right_time: str, seconds: int
) -> DataFrame:
    """Left rows for which the join above has no pair: what the time bound loses."""
    placed, spread, bound = _bucketed(left, right, left_time, right_time, seconds)
    return placed.join(spread, _match(placed, spread, keys, bound), "left_anti").select(*left.columns)
