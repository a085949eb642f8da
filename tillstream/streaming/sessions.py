"""Sessions of a stream: windows whose end moves with every row, kept and merged by Spark's own state.

State holds the open sessions of a key, with their sums. A task merges its rows to sessions before the shuffle (`early_merge`), so a
heavy key sends one row per task and session.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.streaming.runs import during

_EARLY_MERGE = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}


@contextmanager
def early_merge(spark: SparkSession):
    """Sessions merged in each task before the shuffle, for the queries started within."""
    with during(spark, _EARLY_MERGE):
        yield


def session_stream(rows: DataFrame, key: str, time: str, value: str, gap: int) -> DataFrame:
    """One row per session, once it is over, of a stream with a watermark on `time`; columns as of `operators.sessions.sessions`.

    `value` is a whole number; a session without any has total 0. `start` it within `early_merge`.
    """
    session = F.session_window(F.col(time), f"{gap} seconds").alias("__session")
    # rows without a time have no window
    summed = rows.where(F.col(time).isNotNull()).groupBy(key, session).agg(
        F.min(time).alias("session_start"),
        F.max(time).alias("session_end"),
        F.coalesce(F.sum(value), F.lit(0)).cast("bigint").alias("total"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return summed.drop("__session")
