"""Starting one job of the warehouse with spark-submit.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:<version> \\
        tillstream/streaming/launch.py --brokers host:9092 --root hdfs:///warehouse orders
"""

from __future__ import annotations

import argparse
import pathlib
import sys

from pyspark.sql import SparkSession

if __package__ in (None, ""):
    sys.path.insert(0, str(pathlib.Path(__file__).resolve().parents[2]))

from tillstream.operators.offsets import start_position  # noqa: E402
from tillstream.session import tune  # noqa: E402
from tillstream.sinks.batches import offset_ledger  # noqa: E402
from tillstream.sinks.stores import append_to_database  # noqa: E402
from tillstream.sources.topics import FileTopics, KafkaTopics  # noqa: E402
from tillstream.streaming.jobs import Warehouse  # noqa: E402

DIMENSIONS = ["base_province", "user_info", "base_trademark", "base_category3", "spu_info", "sku_info"]


def arguments(words: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Run one job of the warehouse.")
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--brokers", help="Kafka brokers")
    where.add_argument("--topic-folder", help="folder of file topics, for replays")
    parser.add_argument("--root", required=True, help="shared folder of tables and checkpoints")
    parser.add_argument("--max-offsets", type=int, help="most messages of one batch")
    parser.add_argument("--min-partitions", type=int, help="least tasks that read a topic")
    parser.add_argument("--drain", action="store_true", help="work through what is there and end")
    jobs = parser.add_subparsers(dest="job", required=True)
    for envelope in ("array", "single"):
        route = jobs.add_parser(f"route-{envelope}", help="change records to one topic per table")
        route.add_argument("topic")
        route.add_argument("--drop-deletes", action="store_true")
    jobs.add_parser("dimension", help="keep a dimension current").add_argument("name", choices=DIMENSIONS)
    jobs.add_parser("daily-active", help="first event per day and device").add_argument("topic")
    for name in ("orders", "details"):
        jobs.add_parser(name)
    wide = jobs.add_parser("wide-orders")
    wide.add_argument("--append-url", help="JDBC address of a database that the wide lines are appended to as well")
    wide.add_argument("--append-table", default="order_wide")
    wide.add_argument("--append-driver", help="JDBC driver class")
    wide.add_argument("--show", type=int, default=0, help="print so many rows of every batch")
    brands = jobs.add_parser("brands", help="paid amount per brand and batch")
    brands.add_argument("--resume", action="store_true", help="a first run starts at the offsets written with the results")
    brands.add_argument("--partitions", type=int, default=0, help="partitions of the topic, for those without a saved offset")
    return parser.parse_args(words)


def start(spark: SparkSession, options: argparse.Namespace):
    """Start the job and return its query."""
    kafka = lambda: KafkaTopics(options.brokers, options.max_offsets, options.min_partitions)
    topics = kafka() if options.brokers else FileTopics(options.topic_folder)
    starts = {}
    if options.job == "brands" and options.resume:
        ledger = offset_ledger(spark, f"{options.root}/brand_totals")
        starts["dws_order_wide"] = start_position(ledger, "dws_order_wide", "brand_totals", options.partitions)
    warehouse = Warehouse(tune(spark), topics, options.root, options.drain, starts=starts)
    if options.job.startswith("route-"):
        return warehouse.route(options.topic, options.job.removeprefix("route-"), options.drop_deletes)
    if options.job == "dimension":
        return warehouse.dimension(options.name)
    if options.job == "daily-active":
        return warehouse.daily_active(options.topic)
    if options.job == "wide-orders":
        return warehouse.wide_orders(also=further_sink(options))
    return getattr(warehouse, options.job.replace("-", "_"))()


def further_sink(options: argparse.Namespace):
    """What is done with each batch of wide lines besides the table and the topic; None for nothing."""
    if not options.append_url and not options.show:
        return None

    def sink(rows, batch_id: int) -> None:
        if options.append_url:
            append_to_database(rows, options.append_url, options.append_table, options.append_driver)
        if options.show:
            rows.show(options.show, truncate=False)

    return sink


if __name__ == "__main__":
    start(SparkSession.builder.appName("tillstream").getOrCreate(), arguments()).awaitTermination()
