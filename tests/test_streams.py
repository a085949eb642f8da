"""Streams against their batch form, in several batches, repeated and end to end."""

import datetime as dt
import itertools
import json
import pathlib
from dataclasses import replace
from types import SimpleNamespace

import pytest
from compare import database, differences
from pyspark.sql import functions as F
from tillstream import schemas
from tillstream.functions.documents import parse_records
from tillstream.operators.first_orders import status_updates, with_first_flag
from tillstream.operators.offsets import start_position
from tillstream.plans import inputs, stream_runs
from tillstream.plans.inputs import load
from tillstream.session import SHUFFLE_PARTITIONS, state_settings, workspace
from tillstream.sinks.batches import committed_results, offset_ledger, path_exists
from tillstream.sources.tables import table_stream
from tillstream.sources.topics import FileTopics, KafkaTopics
from tillstream.streaming import launch
from tillstream.streaming.jobs import Warehouse
from tillstream.streaming.runs import STATE_PARTITIONS_PER_CORE, each_batch, first_number
from tillstream.streaming.state import ORDER_COPIES, dedup_within, join_within

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def warehouse(spark):
    root = workspace(spark, "warehouse")
    return Warehouse(spark, FileTopics(f"{root}/topics"), root, drain=True)


def send(warehouse, topic, batch_id, *documents):
    rows = [(topic, None, d if isinstance(d, str) else json.dumps(d, ensure_ascii=False)) for d in documents]
    sent = warehouse.spark.createDataFrame(rows, "topic string, key string, value string").coalesce(1)
    warehouse.topics.write(sent, f"test_{topic}", batch_id)


def folder_of(spark, frame, name, files):
    """A table folder with the rows in several files, in order."""
    root = workspace(spark, name)
    for part in range(files):
        frame.filter(F.col("__part") == part).drop("__part").coalesce(1).write.mode("append").parquet(f"{root}/{name}.parquet")
    return root


def test_daily_active_in_several_batches(spark, rows, warehouse):
    log = inputs.start_log(load(spark, SMALL, "events")).withColumn("n", (F.col("offset") / 500).cast("int"))
    for part in range(2):
        sent = log.filter(F.col("n") == part).select(F.lit("start").alias("topic"), "value")
        warehouse.topics.write(sent.coalesce(1), "log", part)
        warehouse.daily_active("start").awaitTermination()
    kept = warehouse.device_index.read(spark)
    events = load(spark, SMALL, "events")
    pairs = events.select(F.col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).distinct()
    assert rows(kept.select("mid", "dt")) == rows(pairs)
    assert kept.filter("mi <> '00' OR ar <> '110000' OR hr IS NULL").count() == 0


def test_first_flags_in_several_batches(spark, rows, warehouse):
    """The flags of a stream cut by time are those of the whole table."""
    orders = inputs.order_records(load(spark, SMALL, "orders").filter("o_custkey % 10 = 3"))
    cuts = ["1997-01-01", "1999-01-01"]
    part = sum(F.when(F.col("create_time") >= c, 1).otherwise(0) for c in cuts)
    sent = orders.select(F.lit("ods_order_info").alias("topic"), F.to_json(F.struct("*")).alias("value"), part.alias("n"))
    for n in range(3):
        warehouse.topics.write(sent.filter(F.col("n") == n).drop("n"), "orders", n)
        warehouse.orders().awaitTermination()
    flags = warehouse.order_index.read(spark).select("id", "if_first_order")
    assert rows(flags) == rows(with_first_flag(orders).select("id", "if_first_order"))
    assert warehouse.user_status.read(spark).count() == orders.select("user_id").distinct().count()


def test_repeated_batch_keeps_first_flags(spark, rows):
    """A batch run again does not take its own first orders for known users."""
    warehouse = Warehouse(spark, FileTopics(workspace(spark, "t")), workspace(spark, "w"), drain=True)
    batch = spark.createDataFrame([(1, 7, "2024-01-01 10:00:00"), (2, 7, "2024-01-01 11:00:00")], "id bigint, user_id bigint, create_time string")
    results = []
    for _ in range(2):
        flagged = with_first_flag(batch, warehouse.user_status.read(spark, before=0))
        results.append(rows(flagged.select("id", "if_first_order")))
        warehouse.user_status.upsert(status_updates(flagged), 0)
    assert results == [[(1, "1"), (2, "0")]] * 2
    assert rows(warehouse.user_status.read(spark)) == [("7", "1", 1)]


def test_a_later_delivery_keeps_the_first_flag(spark, rows, warehouse):
    """The same order in a second batch, with a new one of the same user and one of no user."""
    order = {"id": 1, "user_id": 7, "create_time": "2024-01-01 10:00:00"}
    for number, more in enumerate(({"id": 3, "user_id": 8}, {"id": 2, "user_id": 7}, {"id": 4})):
        send(warehouse, "ods_order_info", number, order, {"create_time": "2024-01-01 09:00:00", **more})
        warehouse.orders().awaitTermination()
    found = warehouse.order_index.read(spark).select("id", "if_first_order")
    assert rows(found) == [(1, "1"), (2, "0"), (3, "1"), (4, "0")]


def test_an_upsert_without_rows_is_counted(spark, rows, warehouse):
    """Into a table with folders by day, when all rows fall away as the plan runs."""
    device = spark.createDataFrame([("m", "2024-01-01", 1)], "mid string, dt string, ts bigint")
    for name in warehouse.device_index.schema.fieldNames():
        if name not in device.columns:
            device = device.withColumn(name, F.lit(None).cast("string"))
    assert warehouse.device_index.upsert(device, 0) == 1
    known = warehouse.device_index.read(spark).select("dt", "mid")
    assert warehouse.device_index.upsert(device.join(known, ["dt", "mid"], "left_anti"), 1) == 0
    assert rows(warehouse.device_index.read(spark).select("mid", "dt")) == [("m", "2024-01-01")]


def test_a_run_from_the_beginning_counts_twice(spark):
    """What `stream_resume` shows depends on the start position."""
    amounts = lambda from_ledger: stream_runs._brand_sums(spark, stream_runs._resumed(spark, SMALL, from_ledger)).agg(F.sum("amount")).first()[0]
    assert amounts(False) > 1.4 * amounts(True)


def test_start_positions_of_file_topics(spark, rows, warehouse):
    send(warehouse, "t", 0, {"n": 0}, {"n": 1})
    send(warehouse, "t", 1, {"n": 2})
    offsets = {json.loads(r.value)["n"]: r.offset for r in spark.read.parquet(warehouse.topics.root).collect()}
    assert offsets[0] < offsets[1] < offsets[2]

    def seen(start):
        found = []
        stream = warehouse.topics.read(spark, "t", start=start)
        work = lambda batch, n: found.extend(json.loads(r.value)["n"] for r in batch.collect())
        each_batch(stream, work, workspace(spark, "checkpoint"), drain=True).awaitTermination()
        return sorted(found)

    assert seen("earliest") == [0, 1, 2] and seen("latest") == []
    assert seen(json.dumps({"t": {"0": offsets[1]}})) == [1, 2] and seen(json.dumps({"t": {"1": 5, "0": -2}})) == [0, 1, 2]


def test_dedup_within_drops_copies_of_later_batches(spark, rows):
    at = lambda h: dt.datetime(2024, 1, 1, h)
    events = spark.createDataFrame(
        [(1, "a", at(8), 0), (2, "a", at(9), 0), (3, "b", at(9), 1), (4, "a", at(10), 1), (5, "c", at(11), 2)],
        "id bigint, mid string, ts timestamp, __part int",
    )
    root = folder_of(spark, events, "events", 3)
    stream = table_stream(spark, root, "events", maxFilesPerTrigger=1)
    found = []
    work = lambda batch, n: found.extend((r.mid, n) for r in batch.collect())
    once = dedup_within(stream, ["mid"], "ts", "24 hours", ["id"], salts=3)
    each_batch(once, work, f"{root}/checkpoint", drain=True, hold=True).awaitTermination()
    assert sorted(m for m, _ in found) == ["a", "b", "c"]


def test_join_within_bound_and_lost_lines(spark, rows):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    orders = spark.createDataFrame([(1, at(0), 0), (2, at(10), 0), (9, at(900), 1)], "id bigint, at timestamp, __part int")
    details = spark.createDataFrame(
        [(11, 1, at(20), 0), (12, 1, at(21), 0), (21, 2, at(0), 0), (31, 3, at(5), 0), (91, 9, at(900), 1)],
        "id bigint, order_id bigint, at timestamp, __part int",
    )
    left, right = folder_of(spark, orders, "orders", 2), folder_of(spark, details, "details", 2)
    for how, expected in [("inner", {(1, 11), (2, 21), (9, 91)}), ("right_outer", {(1, 11), (2, 21), (9, 91), (None, 12), (None, 31)})]:
        pairs = join_within(
            table_stream(spark, left, "orders", maxFilesPerTrigger=1),
            table_stream(spark, right, "details", maxFilesPerTrigger=1),
            "at", "at", 20, how=how, salts=2,
        )
        named = pairs.select(F.col("o.id").alias("order_id"), F.col("d.id").alias("line_id"))
        found = set()
        work = lambda batch, n: found.update((r.order_id, r.line_id) for r in batch.collect())
        each_batch(named, work, f"{left}/checkpoint_{how}", drain=True, hold=True).awaitTermination()
        assert found == expected


def wide_streams(spark, root_orders, root_lines):
    at = F.current_timestamp().alias("at")

    def filled(frame, schema):
        for item in schema.fields:
            if item.name not in frame.columns:
                frame = frame.withColumn(item.name, F.lit(None).cast(item.dataType))
        return frame

    orders = table_stream(spark, root_orders, "orders").select("*", at)
    lines = table_stream(spark, root_lines, "lines", maxFilesPerTrigger=1)
    lines = lines.select("*", F.lit(0).alias("partition"), F.col("id").alias("offset"), at)
    return filled(orders, schemas.ENRICHED_ORDER_INFO), filled(lines, schemas.ENRICHED_ORDER_DETAIL)


def test_payment_is_allocated_across_batches(spark, warehouse):
    """Lines of an order arriving in three batches, some delivered twice: the parts add up to the payment."""
    orders = spark.createDataFrame(
        [(1, 100.0, 90.0, 0), (2, 9.99, 12.0, 0), (3, 100.0, 90.0, 0)],
        "id bigint, final_total_amount double, original_total_amount double, __part int",
    )
    lines = spark.createDataFrame(
        [
            (1, 1, 30.0, 1, 0), (1, 1, 30.0, 1, 0), (2, 1, 15.0, 2, 1), (1, 1, 30.0, 1, 1), (3, 1, 30.0, 1, 2),
            (4, 2, 12.0, 1, 0), (4, 2, 12.0, 1, 2), (5, 3, 30.0, 1, 1), (6, 3, 30.0, 1, 2),
        ],
        "id bigint, order_id bigint, order_price double, sku_num bigint, __part int",
    )
    order_stream, line_stream = wide_streams(spark, folder_of(spark, orders, "orders", 1), folder_of(spark, lines, "lines", 3))
    warehouse.wide_orders(order=order_stream, detail=line_stream, seconds=600).awaitTermination()
    found = spark.read.parquet(f"{warehouse.root}/order_wide").collect()
    parts = {(r.order_id, r.order_detail_id): r.final_detail_amount for r in found}
    assert len(found) == len(parts) == 6
    assert parts == {(1, 1): 33.33, (1, 2): 33.33, (1, 3): 33.34, (2, 4): 9.99, (3, 5): 33.33, (3, 6): 33.33}
    assert warehouse.allocation_sums.read(spark).filter("order_id = 1").first().line_count == 3


@pytest.mark.parametrize("name", ["stream_wide", "stream_split"])
def test_slow_runs_lose_no_line(spark, monkeypatch, name):
    """With hours between the runs every line still meets its order, and sums of earlier runs count."""
    hours, runs, wide_orders = itertools.count(1), [dt.datetime(2026, 1, 1)], Warehouse.wide_orders

    def later(*given, **named):
        runs.append(runs[0] + dt.timedelta(hours=next(hours)))
        return wide_orders(*given, **named)

    monkeypatch.setattr(Warehouse, "wide_orders", later)
    monkeypatch.setattr(F, "current_timestamp", lambda: F.lit(runs[-1]))
    found = getattr(stream_runs, name)(spark, SMALL).toPandas()
    assert differences(found, database(SMALL).execute(stream_runs.registry.sql[name]).df()) is None


def test_state_of_the_wide_job_stays_flat(spark):
    """Rows in state after each run: what the lifetime covers, though the orders grow from part to part; late lines leave too."""
    held, lines = [], []
    for warehouse, query in stream_runs.wide_runs(spark, SMALL, "flat", late=True):
        held.append([operator["numRowsTotal"] for operator in query.lastProgress["stateOperators"]])
        lines.append(spark.read.parquet(f"{warehouse.root}/late_lines").count())
    joined = [max(operators) for operators in held]
    assert max(joined[:-1]) < 1.6 * joined[0] and joined[-1] < 0.05 * joined[0]
    assert lines == sorted(lines) and lines[-2] > 0 and lines[-1] == len(database(SMALL).execute(stream_runs.registry.sql["stream_late_lines"]).df())


def test_end_to_end(spark, rows, warehouse):
    """Change records in, brand sums out, through every layer; a second run finds nothing new."""
    change = lambda table, data, kind="insert": {"type": kind, "table": table, "data": data}
    send(
        warehouse, "changes", 0,
        change("base_province", {"id": "1", "name": "North", "area_code": "10", "iso_code": "N-1"}, "bootstrap-insert"),
        change("user_info", {"id": "7", "user_level": "2", "birthday": "2010-01-01", "gender": "M"}, "bootstrap-insert"),
        change("base_trademark", {"tm_id": "3", "tm_name": "A_B"}, "bootstrap-insert"),
        change("base_category3", {"id": "4", "name": "cases", "category2_id": "0"}, "bootstrap-insert"),
        change("spu_info", {"id": "2", "spu_name": "covers"}, "bootstrap-insert"),
        change("sku_info", {"id": "5", "spu_id": "2", "price": "30", "sku_name": "case", "tm_id": "3", "category3_id": "4"}, "update"),
        change("order_info", {"id": 1, "province_id": 1, "user_id": 7, "final_total_amount": 100.0, "original_total_amount": 90.0, "create_time": "2024-01-01 10:00:00"}),
        change("order_info", {"id": 2, "province_id": 9, "user_id": 8, "final_total_amount": 5.0, "original_total_amount": 5.0, "create_time": "2024-01-01 11:00:00"}),
        change("order_info", {"id": 3, "user_id": 7, "create_time": "2024-01-01 12:00:00"}, "update"),
        change("order_detail", {"id": 11, "order_id": 1, "sku_id": 5, "order_price": 30.0, "sku_num": 1, "sku_name": "case"}),
        change("order_detail", {"id": 12, "order_id": 1, "sku_id": 5, "order_price": 30.0, "sku_num": 2, "sku_name": "case"}),
        change("order_detail", {"id": 21, "order_id": 2, "sku_id": 6, "order_price": 5.0, "sku_num": 1, "sku_name": "gone"}),
    )

    def run():
        warehouse.route("changes").awaitTermination()
        for name in ["base_province", "user_info", "base_trademark", "base_category3", "spu_info", "sku_info"]:
            warehouse.dimension(name, as_of=F.lit("2024-06-30").cast("date")).awaitTermination()
        warehouse.orders().awaitTermination()
        warehouse.details().awaitTermination()
        warehouse.wide_orders(seconds=600).awaitTermination()
        warehouse.brands().awaitTermination()

    run()
    index = warehouse.order_index.read(spark)
    assert rows(index.select("id", "if_first_order", "province_name", "user_age_group", "user_gender", "create_hour")) == [
        (1, "1", "North", "20岁及以下", "男", "10"), (2, "1", None, None, None, "11"),
    ]
    wide = spark.read.parquet(f"{warehouse.root}/order_wide")
    assert rows(wide.select("order_detail_id", "final_detail_amount", "tm_name", "spu_name", "category3_name", "province_area_code")) == [
        (11, 33.33, "A_B", "covers", "cases", "10"), (12, 66.67, "A_B", "covers", "cases", "10"), (21, 5.0, None, None, None, None),
    ]
    totals = lambda: rows(committed_results(spark, f"{warehouse.root}/brand_totals").select("trademark_id", "trademark_name", "amount"))
    expected = [(0, None, 5.0), (3, "A_B", 100.0)]
    assert totals() == expected
    run()
    assert totals() == expected
    assert offset_ledger(spark, f"{warehouse.root}/brand_totals").select("group_id").distinct().first()[0] == "brand_totals"


def test_array_envelopes_by_stream(spark, rows, warehouse):
    send(warehouse, "changes", 0, {"type": "INSERT", "table": "order_info", "data": [{"id": "1"}, {"id": "2"}]}, {"type": "DELETE", "table": "x", "data": [{}]})
    warehouse.route("changes", envelope="array").awaitTermination()
    routed = spark.read.parquet(f"{warehouse.topics.root}/producer=route_array_changes")
    assert rows(routed.select("topic", "value")) == [("ods_order_info", '{"id":"1"}'), ("ods_order_info", '{"id":"2"}')]


def test_jobs_start_from_the_command_line(spark, rows, warehouse):
    send(warehouse, "ods_spu_info", 0, {"id": "2", "spu_name": "covers"}, {"id": "2", "spu_name": "sleeves"})
    place = ["--topic-folder", warehouse.topics.root, "--root", warehouse.root, "--drain"]
    launch.start(spark, launch.arguments([*place, "dimension", "spu_info"])).awaitTermination()
    assert rows(warehouse.spus.read(spark)) == [("2", "sleeves")]
    send(warehouse, "changes", 0, {"type": "delete", "table": "spu_info", "data": {"id": "2"}})
    launch.start(spark, launch.arguments([*place, "route-single", "changes", "--drop-deletes"])).awaitTermination()
    assert launch.arguments([*place, "wide-orders"]).job == "wide-orders"
    assert not path_exists(spark, f"{warehouse.topics.root}/producer=route_single_changes")


def test_a_day_keeps_its_earliest_event_of_a_batch(spark, rows, warehouse):
    """In offset order or not; a later batch changes nothing."""
    event = lambda ts, ch: {"common": {"mid": "m", "uid": "u", "ar": "1", "ch": ch, "vc": "v"}, "ts": ts}
    send(warehouse, "start", 0, event(7_200_000, "late"), event(3_600_000, "early"), event(10_800_000, "latest"))
    warehouse.daily_active("start").awaitTermination()
    send(warehouse, "start", 1, event(1_000, "next batch"), "no json")
    warehouse.daily_active("start").awaitTermination()
    kept = warehouse.device_index.read(spark)
    assert rows(kept.select("mid", "ch", "hr", "ts")) == [("m", "early", "01", 3_600_000)]


def test_a_run_with_a_new_checkpoint_adds_to_the_results(spark, rows, warehouse):
    line = lambda amount: {"tm_id": 3, "tm_name": "A", "final_detail_amount": amount}
    totals = lambda: sum(r.amount for r in committed_results(spark, f"{warehouse.root}/brand_totals").collect())
    send(warehouse, "dws_order_wide", 0, line(10.0))
    warehouse.brands().awaitTermination()
    warehouse.brands().awaitTermination()
    assert totals() == 10.0
    anew = replace(warehouse, checkpoints="_anew", topics=FileTopics(f"{warehouse.root}/topics2"))
    send(anew, "dws_order_wide", 0, line(25.0))
    anew.brands().awaitTermination()
    assert totals() == 35.0


def test_numbers_of_a_checkpoint_stay(spark):
    place = workspace(spark, "numbers")
    assert first_number(spark, place) == first_number(spark, place)
    assert first_number(spark, place) <= first_number(spark, workspace(spark, "numbers"))


def test_an_order_delivered_twice_is_one_first_order(spark, rows, warehouse):
    order = {"id": "1", "user_id": "7", "final_total_amount": "100.5", "create_time": "2024-01-01 10:00:00"}
    send(warehouse, "ods_order_info", 0, order, order, {**order, "id": 2, "create_time": "2024-01-01 11:00:00"})
    warehouse.orders().awaitTermination()
    found = warehouse.order_index.read(spark).select("id", "user_id", "final_total_amount", "if_first_order")
    assert rows(found) == [(1, 7, 100.5, "1"), (2, 7, 100.5, "0")]


def test_further_sinks_of_wide_lines(spark, monkeypatch, capsys):
    place = ["--brokers", "host:1", "--max-offsets", "500", "--root", "r", "wide-orders"]
    assert launch.further_sink(launch.arguments(place)) is None
    calls = []
    monkeypatch.setattr(launch, "append_to_database", lambda rows, *names: calls.append((rows.count(), *names)))
    sink = launch.further_sink(launch.arguments([*place, "--append-url", "jdbc:x:y", "--append-table", "t", "--show", "2"]))
    sink(spark.range(3), 7)
    assert calls == [(3, "jdbc:x:y", "t", None)]
    assert "only showing top 2 rows" in capsys.readouterr().out


def test_topic_options():
    options = KafkaTopics("host:1", 500, 12).source_options("t", "g", "earliest")
    assert options["maxOffsetsPerTrigger"] == "500" and options["minPartitions"] == "12"
    assert "minPartitions" not in KafkaTopics("host:1").source_options("t")


def test_start_names_all_partitions_at_their_last_written_offsets(spark):
    rows = [("g", "t", 0, 9, 1), ("g", "t", 0, 4, 2), ("g", "t", 2, 7, 1), ("h", "t", 1, 5, 1)]
    ledger = spark.createDataFrame(rows, "group_id string, topic string, partition_id int, topic_offset bigint, batch_id bigint")
    assert json.loads(start_position(ledger, "t", "g", 4)) == {"t": {"0": 4, "1": -2, "2": 7, "3": -2}}


def test_state_lies_in_few_partitions(spark):
    """A stream's state follows the cores, the work on its batches the session's shuffle partitions."""
    cores, before = spark.sparkContext.defaultParallelism, spark.conf.get(SHUFFLE_PARTITIONS)
    events = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), n, 0) for n in range(9)], "mid string, ts timestamp, id bigint, __part int")
    root, seen = folder_of(spark, events, "state", 1), []
    spark.conf.set(SHUFFLE_PARTITIONS, "64")
    try:
        once = dedup_within(table_stream(spark, root, "state"), ["mid"], "ts", "24 hours", ["id"])
        work = lambda batch, n: seen.append((batch.count(), batch.sparkSession.conf.get(SHUFFLE_PARTITIONS)))
        each_batch(once, work, f"{root}/checkpoint", drain=True, hold=True).awaitTermination()
        assert spark.conf.get(SHUFFLE_PARTITIONS) == "64"
    finally:
        spark.conf.set(SHUFFLE_PARTITIONS, before)
    assert seen == [(1, "64")]
    places = [p for p in pathlib.Path(f"{root}/checkpoint/state/0").iterdir() if p.name.isdigit()]
    assert len(places) == STATE_PARTITIONS_PER_CORE * cores < 64


def test_messages_of_one_task_are_spread_over_files(spark, warehouse):
    sent = spark.range(1000).coalesce(1).select(F.lit("t").alias("topic"), F.col("id").cast("string").alias("value"))
    warehouse.topics.write(sent, "sender", 0)
    found = spark.read.parquet(warehouse.topics.root)
    files = [row["count"] for row in found.groupBy(F.input_file_name()).count().collect()]
    assert len(files) == spark.sparkContext.defaultParallelism and max(files) < 2 * min(files)
    assert found.select("offset").distinct().count() == found.select("value").distinct().count() == 1000


def test_a_message_is_parsed_once(spark):
    messages = spark.createDataFrame([('{"id": "1"}',), ("no json",), (None,), ("[1]",)], "value string")
    parsed = parse_records(messages, schemas.record("id BIGINT, name STRING"))
    assert [tuple(row) for row in parsed.collect()] == [(1, None)]
    plan = parsed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(") == 1


@pytest.mark.parametrize("master, outside", [("local", False), ("local[4]", False), ("local-cluster[3,2,1024]", True), ("spark://h:7077", True)])
def test_state_lies_outside_the_heap_of_executors(master, outside):
    """Executors started by a local cluster are as small as others: their state must not lie in their heap."""
    found = state_settings(SimpleNamespace(sparkContext=SimpleNamespace(master=master)))
    assert any("RocksDB" in value for value in found.values()) is outside


def test_the_wide_job_keeps_little(spark, warehouse):
    """An order lies in state a few times, lines once; rows between two steps go when their batch is done."""
    filled = {"create_time": "2024-01-01 10:00:00"}
    send(warehouse, "dwd_order_info", 0, *[{"id": n, "final_total_amount": 9.0, "original_total_amount": 9.0, **filled} for n in range(50)])
    send(warehouse, "dwd_order_detail", 0, *[{"id": n, "order_id": n, "order_price": 9.0, "sku_num": 1, **filled} for n in range(50)])
    query = warehouse.wide_orders(seconds=600, time="create_time", lifetime=600)
    query.awaitTermination()
    assert spark.read.parquet(f"{warehouse.root}/order_wide").where("final_detail_amount = 9").count() == 50
    assert max(o["numRowsTotal"] for o in query.lastProgress["stateOperators"]) == (ORDER_COPIES + 1) * 50 <= 300
    for name in ("_pairs", "_running"):
        assert not list(pathlib.Path(f"{warehouse.root}/{name}").glob("batch_id=*"))


def test_staged_parts_go_when_they_are_sent(spark):
    messages = stream_runs._staged_by_part(spark.createDataFrame([("a", 0), ("b", 1), ("c", None), ("d", 2)], "value string, __part int"))
    stream_runs._sent(messages, 1)
    assert [row.value for row in messages.where("__part = 2").collect()] == ["d"]
    place = pathlib.Path(messages.where("__part = 2").inputFiles()[0].removeprefix("file:")).parent.parent
    assert sorted(folder.name for folder in place.glob("__part=*")) == ["__part=2", "__part=__HIVE_DEFAULT_PARTITION__"]
