"""Sessions: rows of a key that follow each other within a gap; a longer pause starts anew.

Rows are first summed per (key, slot), a slot being as long as the gap, so two rows of one slot are always of one session.
That sum is partial before the shuffle: a key with very many rows sends one row per task and slot. What is put in order per
key are slots, as many as gaps fit into the time the key spans, however many rows they stand for.

Rows without a time are in no session. Null keys are one key. Rows exactly a gap apart are of one session.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from tillstream.operators.running import running_sums

SLOT = "__slot"


def slot_sums(rows: DataFrame, key: str, time: str, value: str, gap: int) -> DataFrame:
    """(key, slot, first, last, total, n_rows); on a stream with a watermark each slot comes once, when it is over."""
    slot = F.window(F.col(time), f"{gap} seconds").alias(SLOT)
    # rows without a time have no window
    return rows.where(F.col(time).isNotNull()).groupBy(key, slot).agg(
        F.min(time).alias("first"), F.max(time).alias("last"), F.sum(value).alias("total"), F.count(F.lit(1)).alias("n_rows")
    )


def _numbered(slots: DataFrame, key: str, gap: int) -> DataFrame:
    """Slots with the start of their session as `session_start`."""
    in_time = Window.partitionBy(key).orderBy("first")
    pause = F.unix_micros("first") - F.unix_micros(F.lag("last").over(in_time))
    started = slots.withColumn("__start", F.when(pause.isNull() | (pause > gap * 1_000_000), F.col("first")))
    return started.withColumn("session_start", F.last("__start", ignorenulls=True).over(in_time)).drop("__start")


def sessions(rows: DataFrame, key: str, time: str, value: str, gap: int) -> DataFrame:
    """One row per session: key, session_start, session_end (its last row), total, n_rows."""
    numbered = _numbered(slot_sums(rows, key, time, value, gap), key, gap)
    return numbered.groupBy(key, "session_start").agg(
        F.max("last").alias("session_end"), F.sum("total").alias("total"), F.sum("n_rows").alias("n_rows")
    )


def session_running_sums(
    rows: DataFrame,
    key: str,
    time: str,
    order: list[str],
    sums: dict[str, str],
    gap: int,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows with their session's start and, by name, the sums of columns over its rows up to and with this one.

    `order` must be total within a key and go by time first. A session of any size is summed in ranges (`running_sums`).
    """
    slot = F.window(F.col(time), f"{gap} seconds")
    one = rows.select(key, time, F.lit(1).alias("__one"))
    numbered = _numbered(slot_sums(one, key, time, "__one", gap), key, gap)
    starts = numbered.select(F.col(key).alias("__key"), F.col(SLOT).alias("__of"), "session_start")
    placed = rows.where(F.col(time).isNotNull()).withColumn(SLOT, slot)
    same = F.col(key).eqNullSafe(F.col("__key")) & (F.col(SLOT) == F.col("__of"))
    of = F.struct(key, "session_start")
    joined = placed.join(starts, same).select(*rows.columns, "session_start", of.alias("__session"))
    return running_sums(joined, "__session", order, sums, stage).drop("__session")
