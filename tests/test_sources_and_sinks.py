"""Options of the outer systems, and batch writes that may be repeated."""

import json
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tillstream.schemas import record
from tillstream.session import workspace
from tillstream.sinks.batches import complete_numbers, committed_results, offset_ledger, write_batch, write_results_with_offsets
from tillstream.sinks.keyed_table import KeyedTable
from tillstream.sinks.stores import append_to_database, show_batches
from tillstream.sources.tables import sql_rows, table_stream
from tillstream.sources.topics import FileTopics, KafkaTopics


class Recorder:
    """Stands in for a reader or writer and keeps what it was told."""

    def __init__(self):
        self.said = {}

    def _keep(self, **values):
        self.said.update(values)
        return self

    def format(self, name):
        return self._keep(format=name)

    def mode(self, name):
        return self._keep(mode=name)

    def options(self, **values):
        return self._keep(**values)

    def option(self, key, value):
        return self._keep(**{key: value})

    def jdbc(self, url, name):
        return self._keep(url=url, table=name)


def test_kafka_options():
    kafka = KafkaTopics("k1:9092,k2:9092")
    assert kafka.source_options("t") == {
        "kafka.bootstrap.servers": "k1:9092,k2:9092", "subscribe": "t", "startingOffsets": "latest",
    }
    start = json.dumps({"t": {"0": 5}})
    assert kafka.source_options("t", "g", start)["startingOffsets"] == start
    assert kafka.source_options("t", "g")["kafka.group.id"] == "g"
    assert kafka.sink_options()["kafka.enable.idempotence"] == "true"


def test_database_append_options():
    writer = Recorder()
    append_to_database(SimpleNamespace(write=writer), "jdbc:x:y", "order_wide", driver="d.Driver")
    assert writer.said == {
        "mode": "append", "batchsize": "100", "isolationLevel": "NONE", "numPartitions": "4", "driver": "d.Driver",
        "url": "jdbc:x:y", "table": "order_wide",
    }


def test_console_options():
    writer = Recorder()
    show_batches(SimpleNamespace(writeStream=writer), "/c", 100)
    assert writer.said == {"format": "console", "numRows": 100, "checkpointLocation": "/c"}


def test_sql_rows(spark):
    source = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    found = sql_rows(spark, "SELECT id, name FROM {t} ORDER BY id", upper_labels=True, t=source)
    assert [r.row for r in found.collect()] == ['{"ID":1,"NAME":"a"}', '{"ID":2}']


def test_workspace_is_below_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert workspace(spark, "a").startswith(f"{root}/tillstream/a-")
    assert workspace(spark, "a") != workspace(spark, "a")


def test_stream_of_a_file_or_a_folder(spark):
    root = workspace(spark, "tables")
    spark.range(10).coalesce(1).write.parquet(f"{root}/numbers.parquet")
    spark.range(10, 15).coalesce(1).write.mode("append").parquet(f"{root}/numbers.parquet")
    stream = table_stream(spark, root, "numbers", maxFilesPerTrigger=1)
    query = stream.writeStream.format("memory").queryName("numbers").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("numbers").count() == 15
    assert len([p for p in query.recentProgress if p.numInputRows]) == 2


SCHEMA = record("id BIGINT, name STRING, n BIGINT")


def entries(spark, *values):
    return spark.createDataFrame(values, SCHEMA)


def test_keyed_table(spark, rows):
    stored = KeyedTable(workspace(spark, "keyed"), SCHEMA, ["id"], ["n"])
    assert rows(stored.read(spark)) == []
    assert stored.upsert(entries(spark, (1, "a", 1), (1, "b", 2), (2, "c", 1)), 0) == 2
    assert stored.upsert(entries(spark, (1, "d", 0)), 1) == 1
    now = [(1, "d", 0), (2, "c", 1)]
    assert rows(stored.read(spark)) == now
    assert rows(stored.read(spark, before=1)) == [(1, "b", 2), (2, "c", 1)]
    assert rows(stored.read(spark, before=0)) == []
    assert stored.upsert(entries(spark, (9, "again", 0)), 1) == 0, "a repeated batch changes nothing"
    stored.compact(spark, 1)
    stored.compact(spark, 1)
    assert rows(stored.read(spark)) == now
    stored.upsert(entries(spark, (2, "e", 5), (3, "f", 0)), 2)
    assert rows(stored.read(spark)) == [(1, "d", 0), (2, "e", 5), (3, "f", 0)]
    assert rows(stored.read(spark, before=2)) == now
    assert rows(stored.read(spark, before=1)) == [(1, "b", 2), (2, "c", 1)]
    stored.compact(spark, 2, keep=F.col("n") > 0)
    assert complete_numbers(spark, f"{stored.path}/changes", "batch_id") == [2], "changes of the older base are gone"
    assert rows(stored.read(spark)) == [(2, "e", 5)]


def test_keyed_table_with_days_and_nested_documents(spark, rows):
    schema = StructType.fromDDL("id BIGINT, dt STRING, actors ARRAY<STRUCT<id: BIGINT, name: STRING>>")
    stored = KeyedTable(workspace(spark, "films"), schema, ["dt", "id"], partition_by=["dt"])
    one = spark.createDataFrame([(1, "2024-01-01", [(3, "ann")])], schema)
    stored.upsert(one, 0)
    stored.upsert(spark.createDataFrame([(1, "2024-01-02", None)], schema), 1)
    found = stored.read(spark)
    assert rows(found.select("id", "dt")) == [(1, "2024-01-01"), (1, "2024-01-02")]
    assert found.filter("dt = '2024-01-01'").first().actors[0].name == "ann"
    assert "PartitionFilters: [isnotnull(dt" in found.filter("dt = '2024-01-01'")._jdf.queryExecution().executedPlan().toString()


def test_put_one_document(spark, rows):
    schema = StructType.fromDDL("id BIGINT, name STRING, score FLOAT, actors ARRAY<STRUCT<id: BIGINT, name: STRING>>")
    stored = KeyedTable(workspace(spark, "films"), schema, ["id"])
    assert stored.put(spark, '{"id": 200, "name": "river", "score": 8.0, "actors": [{"id": 3, "name": "zhang"}]}', 0) == 1
    stored.put(spark, {"id": 300, "name": "天龙八部", "score": 9.0, "actors": [{"id": 66, "name": "李"}]}, 1)
    stored.put(spark, {"id": 200, "name": "river two"}, 2)
    assert rows(stored.read(spark)) == [(200, "river two", None, None), (300, "天龙八部", 9.0, [(66, "李")])]


def test_repeated_batch_is_skipped(spark):
    root = workspace(spark, "batches")
    assert write_batch(spark.range(3), root, 4)
    assert not write_batch(spark.range(9), root, 4)
    assert spark.read.parquet(root).count() == 3


def test_results_count_only_with_their_offsets(spark, rows):
    root = workspace(spark, "results")
    result = lambda *v: spark.createDataFrame([(x,) for x in v], "amount double")
    ranges = spark.createDataFrame([("t", 0, 0, 10)], "topic string, partition int, from_offset bigint, until_offset bigint")
    write_results_with_offsets(result(1.0), ranges, root, "g", 0)
    write_results_with_offsets(result(5.0), ranges, root, "g", 0)
    write_batch(result(7.0), f"{root}/results", 1)  # stopped before its offsets were written
    assert rows(committed_results(spark, root).select("amount")) == [(1.0,)]
    assert [r.topic_offset for r in offset_ledger(spark, root).collect()] == [10]


def test_file_topics(spark):
    topics = FileTopics(workspace(spark, "topics"))
    sent = spark.createDataFrame([("a", "k", "1"), ("b", None, "2")], "topic string, key string, value string")
    topics.write(sent, "maker", 0)
    topics.write(sent, "maker", 0)
    query = topics.read(spark, "a").writeStream.format("memory").queryName("a").trigger(availableNow=True).start()
    query.awaitTermination()
    assert [(r.key, r.value, r.topic) for r in spark.table("a").collect()] == [("k", "1", "a")]


def test_no_shared_folder_on_a_cluster():
    conf = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        workspace(cluster, "a")
