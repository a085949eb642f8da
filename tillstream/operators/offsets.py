"""Topic positions: ranges of a batch, a ledger of them, and where to resume."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F


def offset_ranges(messages: DataFrame) -> DataFrame:
    """First offset and the one after the last, per topic partition."""
    return messages.groupBy("topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def ledger_rows(ranges: DataFrame, group_id: str) -> DataFrame:
    """Ledger rows of one batch."""
    return ranges.select(
        F.lit(group_id).alias("group_id"),
        "topic",
        F.col("partition").cast("int").alias("partition_id"),
        F.col("until_offset").alias("topic_offset"),
    )


def saved_offsets(ledger: DataFrame, topic: str, group_id: str) -> DataFrame:
    """Last written offset of every partition of a topic, for one group; by batch where the ledger names batches."""
    last = F.max_by("topic_offset", "batch_id") if "batch_id" in ledger.columns else F.max("topic_offset")
    return (
        ledger.filter((F.col("topic") == topic) & (F.col("group_id") == group_id))
        .groupBy("topic", "partition_id")
        .agg(last.alias("topic_offset"))
    )


EARLIEST = -2  # a source's mark for the first offset it has


def start_position(ledger: DataFrame, topic: str, group_id: str, partitions: int = 0) -> str:
    """Start option of a topic source: saved offsets as JSON, or `latest` when there are none.

    The source wants all partitions named: those of the first `partitions` that the ledger lacks start at their
    earliest offset. One row per partition of the topic comes to the driver, as the source option is a text.
    """
    rows = saved_offsets(ledger, topic, group_id).collect()
    if not rows:
        return "latest"
    saved = {r.partition_id: r.topic_offset for r in rows}
    named = sorted({*range(partitions), *saved})
    return json.dumps({topic: {str(number): saved.get(number, EARLIEST) for number in named}})
