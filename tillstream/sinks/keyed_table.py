"""A table with keyed upserts, kept as a base and one change folder per batch.

A write costs as much as its batch, not as the table. The base has one row per key already, so a read
sorts only the changes after it and drops their keys from the base: with few changes the base is
scanned without a shuffle. With `buckets`, rows lie in folders by the hash of their first key, and `in_use` reads
only the folders that some given keys can be in. `compact` folds the changes into a new base. A repeated batch changes
nothing, and `read(before=N)` gives the table as batch N found it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from tillstream.functions.documents import parse_records
from tillstream.functions.keys import as_id
from tillstream.operators.keyed import latest_per_key
from tillstream.operators.lookups import rows_in_use
from tillstream.sinks.batches import complete_numbers, forget_numbers, path_exists, write_batch


BUCKET = "__bucket"


@dataclass(frozen=True)
class KeyedTable:
    path: str
    schema: StructType
    keys: list[str]
    order: list[str] = field(default_factory=list)
    partition_by: list[str] = field(default_factory=list)
    buckets: int = 0

    def _bucket(self, key: Column) -> Column:
        """Ids are compared as integers, whether a record has them as text or not."""
        return F.pmod(F.xxhash64(as_id(key.cast("string"))), F.lit(self.buckets)).cast("int").alias(BUCKET)

    @property
    def _folders(self) -> list[str]:
        return [BUCKET] * bool(self.buckets) + self.partition_by

    def _load(self, spark: SparkSession, kind: str, mark: str, numbers: list[int], wanted: DataFrame | None) -> DataFrame:
        """The rows of some `mark=N` folders, of the wanted buckets only."""
        rows = self._stored(spark, kind, mark, numbers)
        if wanted is not None:
            rows = rows.join(F.broadcast(wanted), BUCKET, "left_semi")  # at most `buckets` rows
        return rows.drop(BUCKET)

    def _stored(self, spark: SparkSession, kind: str, mark: str, numbers: list[int]) -> DataFrame:
        own = [StructField("__batch", LongType()), StructField(mark, LongType())]
        stored = StructType([*self.schema.fields, *own, *[StructField(BUCKET, IntegerType())] * bool(self.buckets)])
        root = f"{self.path}/{kind}"
        if not numbers:
            return spark.createDataFrame([], stored).drop(mark)
        paths = [f"{root}/{mark}={n}" for n in numbers]
        return spark.read.schema(stored).option("basePath", root).parquet(*paths).drop(mark)

    def _versions(self, spark: SparkSession, before: int | None) -> tuple[list[int], list[int]]:
        """The newest complete base (or none), and the complete changes after it."""
        end = float("inf") if before is None else before
        bases = complete_numbers(spark, f"{self.path}/base", "upto", below=end)[-1:]
        return bases, complete_numbers(spark, f"{self.path}/changes", "batch_id", *bases, below=end)

    def upsert(self, rows: DataFrame, batch_id: int) -> int:
        """Write a batch of rows, the last per key by `order`; returns the number of rows written."""
        batch = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
        batch = latest_per_key(batch, self.keys, self.order or self.keys)
        counted = Observation()
        batch = self._placed(batch.withColumn("__batch", F.lit(batch_id).cast("bigint")))
        written = write_batch(batch, f"{self.path}/changes", batch_id, self._folders, counted)
        return counted.get["rows"] if written else 0

    def _placed(self, rows: DataFrame) -> DataFrame:
        return rows.select("*", self._bucket(F.col(self.keys[0]))) if self.buckets else rows

    def put(self, spark: SparkSession, document: str | dict, batch_id: int) -> int:
        """Upsert one document, given as JSON text or as a (nested) dict."""
        text = document if isinstance(document, str) else json.dumps(document, ensure_ascii=False)
        return self.upsert(parse_records(spark.createDataFrame([(text,)], "value string"), self.schema), batch_id)

    def in_use(self, spark: SparkSession, rows: DataFrame, key: str, before: int | None = None) -> DataFrame:
        """The table's rows that `rows` refer to by `key`, read from the folders of their buckets alone.

        The buckets are found as the query runs and prune the scans of base and changes (dynamic partition pruning).
        """
        wanted = None
        if self.buckets:
            wanted = rows.select(self._bucket(F.col(key))).distinct().where(F.col(BUCKET) >= 0)
        return rows_in_use(self.read(spark, before, wanted), self.keys[0], rows, key)

    def read(self, spark: SparkSession, before: int | None = None, wanted: DataFrame | None = None) -> DataFrame:
        """Current rows, or those before a batch; of some buckets, if they are given."""
        bases, numbers = self._versions(spark, before)
        base = self._load(spark, "base", "upto", bases, wanted)
        changes = latest_per_key(
            self._load(spark, "changes", "batch_id", numbers, wanted), self.keys, ["__batch", *self.order]
        )
        if bases and numbers:
            changed = changes.select(*[F.col(key).alias(f"__{key}") for key in self.keys])
            same = [base[key].eqNullSafe(changed[f"__{key}"]) for key in self.keys]
            rows = base.join(changed, reduce(and_, same), "left_anti").unionByName(changes)
        else:
            rows = base if bases else changes
        return rows.select(*self.schema.fieldNames())

    def changes_since_base(self, spark: SparkSession) -> int:
        """How many batches were written after the newest base."""
        return len(self._versions(spark, None)[1])

    def compact(self, spark: SparkSession, upto: int, keep=None) -> None:
        """Write the table as of the end of batch `upto` as a base; `keep` drops rows past their time.

        The newest two bases stay, and the changes after the older one, for batches run again.
        """
        path = f"{self.path}/base/upto={upto}"
        if path_exists(spark, f"{path}/_SUCCESS"):
            return
        rows = self.read(spark, before=upto + 1)
        if keep is not None:
            rows = rows.filter(keep)
        rows = self._placed(rows.withColumn("__batch", F.lit(upto).cast("bigint")))
        if self._folders:
            rows = rows.hint("rebalance", *self._folders)
        writer = rows.write.mode("overwrite")
        if self._folders:
            writer = writer.partitionBy(*self._folders)
        writer.parquet(path)
        bases = complete_numbers(spark, f"{self.path}/base", "upto")
        if len(bases) > 1:
            forget_numbers(spark, f"{self.path}/base", "upto", upto=bases[-2] - 1)
            forget_numbers(spark, f"{self.path}/changes", "batch_id", upto=bases[-2])
