"""Versions by time, pruned dimension reads, bitmaps, postings and windows written once."""

import datetime as dt
import random

from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tillstream.operators.as_of import as_of_join
from tillstream.operators.bitmaps import daily_bitmaps, devices_within, merged
from tillstream.operators.postings import hits, tokens, write_postings
from tillstream.plans import stream_runs
from tillstream.session import workspace
from tillstream.sinks.keyed_table import KeyedTable

SMALL = "/root/testdata/sf0.001"
START = dt.datetime(2024, 1, 1)


def plan_of(frame):
    return frame._jdf.queryExecution().toString()


def test_as_of_against_brute_force(spark, rows):
    """A key with most rows, keys without versions, rows before the first version and at the very time of one."""
    some = random.Random(5)
    at = lambda: START + dt.timedelta(seconds=some.randrange(40_000))
    facts = [(i, some.choice([1, 1, 1, 1, 2, 3, 4, None]), at()) for i in range(400)]
    versions = list({(k, t): (k, t, f"v{n}") for n, (k, t) in enumerate((some.choice([1, 2, 3, 5]), at()) for _ in range(60))}.values())
    facts += [(1000 + n, k, t) for n, (k, t, _) in enumerate(versions)]
    left = spark.createDataFrame(facts, "id bigint, k bigint, at timestamp")
    right = spark.createDataFrame([*versions, (None, START, "x"), (1, None, "y")], "k bigint, since timestamp, name string")
    expected = []
    for i, k, t in facts:
        found = max(((since, name) for key, since, name in versions if key == k and since <= t), default=(None, None))
        expected.append((i, k, t, found[1], found[0]))
    for seconds in (1, 977, 10_000_000):
        found = as_of_join(left, right, "k", "at", "since", ["name", "since"], seconds)
        assert found.columns == ["id", "k", "at", "name", "since"] and rows(found) == sorted(expected, key=repr)
    again = right.unionByName(spark.createDataFrame([(1, START + dt.timedelta(days=9), "later")], right.schema))
    assert rows(as_of_join(left, again, "k", "at", "since", ["name", "since"], 977)) == sorted(expected, key=repr)
    assert as_of_join(left, right.limit(0), "k", "at", "since", ["name"], 977).where("name IS NULL").count() == len(facts)


def test_reads_are_pruned_to_the_buckets_of_the_keys(spark, rows):
    stored = KeyedTable(workspace(spark, "pruned"), StructType.fromDDL("id STRING, name STRING"), ["id"], buckets=8)
    stored.upsert(spark.range(1000).select(F.col("id").cast("string"), F.lit("a").alias("name")), 0)
    stored.compact(spark, 0)
    stored.upsert(spark.createDataFrame([("7", "b"), ("8", "b"), ("no number", "c")], "id string, name string"), 1)
    batch = spark.createDataFrame([(7, 1), (7, 2), (5000, 3), (None, 4)], "user_id bigint, n int")
    found = stored.in_use(spark, batch, "user_id")
    assert rows(found) == [("7", "b")]
    plan = plan_of(found)
    assert plan.count("dynamicpruning") >= 2 and "__bucket" in plan  # base and changes
    one = spark.createDataFrame([(7,)], "user_id bigint").select(stored._bucket(F.col("user_id")))
    files = lambda frame: frame.select(F.input_file_name()).distinct().count()
    pruned = stored._load(spark, "base", "upto", [0], one.distinct().where("__bucket >= 0"))
    assert files(pruned) == 1 and files(stored._load(spark, "base", "upto", [0], None)) == 8
    assert stored.read(spark).count() == 1001


def test_bitmaps_of_several_batches(spark, rows):
    some = random.Random(6)
    events = [(f"2024-01-{some.randrange(1, 10):02d}", some.choice([0, 5, 40_000, 5, 5, some.randrange(100_000), None, -3])) for _ in range(800)]
    parts = [daily_bitmaps(spark.createDataFrame(events[n::3], "d string, m bigint"), "d", "m") for n in range(3)]
    found = devices_within(merged(*parts), [1, 3])
    seen = {(d, m) for d, m in events if m is not None and m >= 0}
    expected = []
    for day in {d for d, _ in seen}:
        for n in (1, 3):
            first = dt.date.fromisoformat(day) - dt.timedelta(days=n - 1)
            expected.append((day, n, len({m for d, m in seen if first <= dt.date.fromisoformat(d) <= dt.date.fromisoformat(day)})))
    assert rows(found) == sorted(expected, key=repr)


def test_postings_answer_without_the_texts(spark, rows):
    texts = [(1, "The red-fox, the FOX"), (2, "red 日本 x2"), (3, None), (4, "")]
    docs = spark.createDataFrame(texts, "doc bigint, text string")
    postings = write_postings(docs, "doc", "text", workspace(spark, "postings"), buckets=4)
    asked = spark.createDataFrame([("a", "fox RED"), ("b", "本"), ("c", "none"), ("d", "x2 x2")], "query_id string, q string")
    found = hits(postings, asked.select("query_id", tokens(F.col("q")).alias("tokens")), buckets=4)
    assert rows(found) == [("a", 1, 2), ("a", 2, 1), ("b", 2, 1), ("d", 2, 1)]
    assert postings.count() == 3 + 4 and "text" not in postings.columns


def test_windows_are_written_once_and_late_rows_are_counted(spark):
    dropped = written = 0
    for place, query in stream_runs.window_runs(spark, SMALL):
        dropped += sum(sum(o["numRowsDroppedByWatermark"] for o in p["stateOperators"]) for p in query.recentProgress)
        before, written = written, spark.read.parquet(place).count()
        assert written >= before
    windows = spark.read.parquet(place)
    assert windows.count() == windows.select("window_start", "event_type").distinct().count() > 0
    assert dropped > 0
