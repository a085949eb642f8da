"""Starting queries: trigger, checkpoint, per-batch hook."""

from __future__ import annotations

import time
from collections.abc import Callable
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.readwriter import DataStreamWriter

from tillstream.session import SHUFFLE_PARTITIONS, state_settings
from tillstream.sinks.batches import path_exists

BATCH_INTERVAL = "5 seconds"
ADAPTIVE = "spark.sql.adaptive.enabled"
STATE_PARTITIONS_PER_CORE = 2


def start(writer: DataStreamWriter, checkpoint: str, drain: bool = False) -> StreamingQuery:
    """Every five seconds, or once over what is there (`drain`). The checkpoint is written after the sinks."""
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if drain else writer.trigger(processingTime=BATCH_INTERVAL)
    return writer.start()


def first_number(spark: SparkSession, checkpoint: str) -> int:
    """The number of a checkpoint's first batch, fixed when it is first asked for.

    Spark counts the batches of every checkpoint from 0. Sinks keep batches by number, so a run with a new checkpoint
    must not meet the numbers of the run before: its numbers start at the time, in milliseconds, of its first batch.
    """
    place = f"{checkpoint}/first_number"
    if not path_exists(spark, f"{place}/_SUCCESS"):
        now = spark.createDataFrame([(int(time.time() * 1000),)], "number bigint")
        now.coalesce(1).write.mode("overwrite").parquet(place)
    return spark.read.schema("number bigint").parquet(place).first()["number"]


def each_batch(
    stream: DataFrame,
    work: Callable[[DataFrame, int], None],
    checkpoint: str,
    drain: bool = False,
    hold: bool = False,
    mode: str = "append",
    whole: bool = False,
) -> StreamingQuery:
    """Run `work` on every batch that has rows, with a number that grows from run to run.

    `hold` keeps the batch for the time of `work`, so that stateful operators above it run once although
    the batch is read more than once. With `whole`, `work` gets every batch, also an empty one, and reads all
    of it once, as by writing it, so that nothing need be kept. The work itself is planned adaptively, with the session's number of shuffle
    partitions; a stream's own plan is not, and its state lies in `state_partitions`.
    """
    session = stream.sparkSession
    settings = {ADAPTIVE: "true", SHUFFLE_PARTITIONS: session.conf.get(SHUFFLE_PARTITIONS)}

    def guarded(batch: DataFrame, batch_id: int) -> None:
        number = lambda: first_number(batch.sparkSession, checkpoint) + batch_id
        with during(batch.sparkSession, settings):
            if whole:
                work(batch, number())
            elif hold:
                with kept(batch) as rows:
                    if not rows.isEmpty():
                        work(rows, number())
            elif not batch.isEmpty():
                work(batch, number())

    with during(session, state_settings(session) | {SHUFFLE_PARTITIONS: state_partitions(session)}):
        return start(stream.writeStream.outputMode(mode).foreachBatch(guarded), checkpoint, drain)


def state_partitions(session: SparkSession) -> str:
    """Into how many partitions a new checkpoint divides its state: a few per core, no more than the session's shuffles have.

    Every batch opens, reads and commits each operator's stores in each of them, also those with few rows, and unlike a batch
    query's shuffle they cannot be joined as the query runs. The number is fixed by the checkpoint's first batch.
    """
    few = STATE_PARTITIONS_PER_CORE * session.sparkContext.defaultParallelism
    return str(min(few, int(session.conf.get(SHUFFLE_PARTITIONS))))


@contextmanager
def during(session: SparkSession, settings: dict[str, str]):
    """Settings that hold inside: adaptive planning, which a stream's session has off, for the batch queries of a micro-batch."""
    before = {name: session.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        session.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                session.conf.unset(name)
            else:
                session.conf.set(name, value)


@contextmanager
def kept(rows: DataFrame):
    """Rows held for several writes of one batch; lost blocks are computed again."""
    held = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield held
    finally:
        held.unpersist()
