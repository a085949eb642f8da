"""Tables of a folder, as batch or stream, and ad-hoc SQL rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def table_stream(spark: SparkSession, folder: str, name: str, **options) -> DataFrame:
    """The files of a table as a stream. The pattern lets the path be one file or a folder of files."""
    reader = spark.readStream.schema(table(spark, folder, name).schema)
    return reader.options(**options).parquet(f"{folder}/{name}.parque[t]")


def sql_rows(spark: SparkSession, query: str, upper_labels: bool = False, **tables: DataFrame) -> DataFrame:
    """Rows of a SQL query as JSON texts; labels in upper case when the caller's store returns them so."""
    rows = spark.sql(query, **tables)
    if upper_labels:
        rows = rows.toDF(*[name.upper() for name in rows.columns])
    return rows.select(F.to_json(F.struct("*")).alias("row"))


def jdbc_rows(spark: SparkSession, url: str, query: str, **options) -> DataFrame:
    """Rows of a query sent to a database; give partitionColumn, bounds and numPartitions for a large one."""
    return spark.read.format("jdbc").options(url=url, query=query, **options).load()


def snapshot_rows(spark: SparkSession, url: str, name: str, **options) -> DataFrame:
    """A database table; filters and column choices made on it are sent to the database."""
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()
