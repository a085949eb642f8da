"""Database append and console output."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Write settings of the column store.
APPEND_OPTIONS = {"batchsize": "100", "isolationLevel": "NONE", "numPartitions": "4"}


def append_to_database(rows: DataFrame, url: str, name: str, driver: str | None = None, **options) -> None:
    """Append rows to a database table from the executors."""
    settings = APPEND_OPTIONS | ({"driver": driver} if driver else {}) | options
    rows.write.mode("append").options(**settings).jdbc(url, name)


def show_batches(rows: DataFrame, checkpoint: str, n: int = 1000):
    """Stream writer printing the first rows of each batch."""
    return rows.writeStream.format("console").option("numRows", n).option("checkpointLocation", checkpoint)
