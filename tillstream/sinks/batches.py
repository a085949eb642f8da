"""Writing one micro-batch so that a repeated batch changes nothing."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from tillstream.operators.offsets import ledger_rows
from tillstream.session import workspace


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _numbers(spark: SparkSession, root: str, mark: str):
    """The N of the `root/mark=N` folders, and their file system. One folder name per batch comes to the driver."""
    target = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [status.getPath().getName() for status in files.listStatus(target)] if files.exists(target) else []
    found = [re.fullmatch(f"{re.escape(mark)}=(-?[0-9]+)", name) for name in names]  # a folder of null has no number
    return sorted(int(match[1]) for match in found if match), files


def complete_numbers(
    spark: SparkSession, root: str, mark: str, above: float = float("-inf"), below: float = float("inf")
) -> list[int]:
    """The N of the completely written `root/mark=N` folders between two bounds."""
    numbers, _ = _numbers(spark, root, mark)
    return [n for n in numbers if above < n < below and path_exists(spark, f"{root}/{mark}={n}/_SUCCESS")]


def forget_numbers(spark: SparkSession, root: str, mark: str, upto: int) -> None:
    """Delete the `root/mark=N` folders with N up to a bound."""
    numbers, files = _numbers(spark, root, mark)
    for n in numbers:
        if n <= upto:
            files.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{mark}={n}"), True)


def staged(rows: DataFrame, purpose: str) -> DataFrame:
    """The rows, written once to the shared folder and read from there."""
    folder = workspace(rows.sparkSession, purpose)
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def write_batch(
    rows: DataFrame,
    root: str,
    batch_id: int,
    partition_by: list[str] | None = None,
    counted: Observation | None = None,
    gathered: bool = True,
    codec: str | None = None,
) -> bool:
    """Write a batch as `root/batch_id=N`. False, and nothing done, when it is complete already.

    `counted` gets the number of `rows`. It is taken above everything else: in a plan that turns out empty as it
    runs, what lies below a rebalancing is left out, and a count there would never come. `gathered=False` leaves the
    rows in the tasks they are in, where the folders are few and large. `codec` names another compression than the session's.
    """
    path = f"{root}/batch_id={batch_id}"
    if path_exists(rows.sparkSession, f"{path}/_SUCCESS"):
        return False
    if partition_by and gathered:
        # rows of one folder in few tasks: each task writes a file to every folder it has rows for
        rows = rows.hint("rebalance", *partition_by)
    if counted is not None:
        rows = rows.observe(counted, F.count(F.lit(1)).alias("rows"))
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if codec:
        writer = writer.option("compression", codec)
    writer.parquet(path)
    return True


def write_results_with_offsets(results: DataFrame, ranges: DataFrame, root: str, group_id: str, batch_id: int) -> None:
    """Results first, then the batch's offsets as its commit mark: readers see both or neither."""
    write_batch(results, f"{root}/results", batch_id)
    write_batch(ledger_rows(ranges, group_id), f"{root}/offsets", batch_id)


def committed_results(spark: SparkSession, root: str) -> DataFrame:
    """Results of the batches whose offsets are written."""
    done = spark.read.parquet(f"{root}/offsets").select("batch_id").distinct()
    return spark.read.parquet(f"{root}/results").join(done, "batch_id", "left_semi")


def offset_ledger(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/offsets")
