"""Small text builders for topics, state keys and key lists."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def source_topic(table: Column) -> Column:
    """Topic of a routed table."""
    return F.concat(F.lit("ods_"), table)


def prefixed(prefix: str, key: Column) -> Column:
    """`prefix:key`"""
    return F.concat(F.lit(prefix + ":"), key.cast("string"))


def joined(items: Column, separator: str = ",") -> Column:
    """Elements of an array column as one text."""
    return F.array_join(items, separator)


def as_id(text: Column) -> Column:
    """Dimension id text as the fact's integer id; null when it is not a number."""
    return text.try_cast("bigint")
