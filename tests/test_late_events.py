"""Sessions, days written again and fields of records: edge cases and brute force."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F
from tillstream import schemas
from tillstream.operators.record_fields import declared_fields, field_drift, record_fields
from tillstream.operators.sessions import session_running_sums, sessions
from tillstream.plans import late_events
from tillstream.session import workspace
from tillstream.sinks.batches import write_batch
from tillstream.sinks.day_table import DayTable
from tillstream.sources.tables import table_stream
from tillstream.streaming.runs import each_batch
from tillstream.streaming.sessions import early_merge, session_stream

SMALL = "/root/testdata/sf0.001"
GAP = 600


def events(spark, rows):
    """(id, key, seconds, value) rows with their time."""
    frame = spark.createDataFrame(rows, "id bigint, user bigint, s bigint, value bigint")
    return frame.withColumn("ts", F.timestamp_seconds("s"))


def plain_sessions(rows, gap=GAP):
    found, running = [], {}
    for key in {row[1] for row in rows}:
        own = sorted((row[2], row[0], row[3]) for row in rows if row[1] == key and row[2] is not None)
        start = last = None
        for s, number, value in own:
            if last is None or s - last > gap:
                start, total, count = s, 0, 0
                found.append([key, start, s, 0, 0])
            last, total, count = s, total + value, count + 1
            found[-1][2:] = [s, total, count]
            running[number] = (start, total)
    return sorted(map(tuple, found), key=repr), running


def test_sessions_of_a_heavy_key(spark, rows):
    pick = random.Random(5)
    data = [(n, 1 if n % 3 else pick.randrange(20), pick.randrange(400_000), pick.randrange(100)) for n in range(3000)]
    data += [(9000, 99, None, 5), (9001, None, 100, 1), (9002, None, 100, 2)]  # no time; no key
    data += [(9100, 50, 1_000_000, 1), (9101, 50, 1_000_600, 1), (9102, 50, 1_001_201, 1)]  # a gap apart, and a second more
    expected, running = plain_sessions(data)
    seconds = [F.unix_seconds(name).alias(name) for name in ("session_start", "session_end")]
    found = sessions(events(spark, data), "user", "ts", "value", GAP).select("user", *seconds, "total", "n_rows")
    assert rows(found) == expected
    summed = session_running_sums(events(spark, data), "user", "ts", ["ts", "id"], {"running": "value"}, GAP)
    assert {r["id"]: (int(r["session_start"].timestamp()), r["running"]) for r in summed.collect()} == running


def test_sessions_of_an_empty_table(spark):
    none = events(spark, [])
    assert sessions(none, "user", "ts", "value", GAP).count() == 0
    assert session_running_sums(none, "user", "ts", ["ts", "id"], {"running": "value"}, GAP).count() == 0


def test_open_sessions_leave_the_state(spark):
    """State has open sessions, not all: each run's is far below the sessions given so far."""
    held, given = [], []
    for place, query in late_events.session_runs(spark, SMALL):
        held.append(query.lastProgress["stateOperators"][-1]["numRowsTotal"])
        given.append(spark.read.parquet(place).count())
    assert given[0] > 0 and given == sorted(given)
    # at most an open session and its timer per user
    assert max(held[:-1]) <= 2 * 2 * 15 + 4 and held[-1] <= 2


def test_a_stream_joins_sessions_over_batches(spark, rows):
    """Against plain sessions, in three batches with sessions that go over their cuts; Spark's own operators alone."""
    pick = random.Random(7)
    data = [(n, n % 7 or None, pick.randrange(60_000), pick.randrange(100)) for n in range(900)] + [(900, 3, None, 5)]
    data += [(901, 50, 19_700, 1), (902, 50, 20_300, 2), (903, 50, 20_901, 4)]  # a gap apart over a cut, and a second more
    root = workspace(spark, "session-batches")
    for part in range(3):
        of_part = [row for row in data if (row[2] or 0) // 20_000 == part]
        events(spark, of_part).coalesce(1).write.mode("append").parquet(f"{root}/events.parquet")
    events(spark, [(-1, -1, 900_000, 0)]).coalesce(1).write.mode("append").parquet(f"{root}/events.parquet")
    timed = table_stream(spark, root, "events", maxFilesPerTrigger=1).withWatermark("ts", "1 hour")
    found = session_stream(timed, "user", "ts", "value", GAP)
    assert "Pandas" not in found._jdf.queryExecution().analyzed().toString()
    with early_merge(spark):
        query = each_batch(found, lambda b, n: write_batch(b, f"{root}/found", n), f"{root}/checkpoint", drain=True, hold=True)
    query.awaitTermination()
    given = spark.read.parquet(f"{root}/found").where("user IS NULL OR user >= 0")
    seconds = [F.unix_seconds(name).alias(name) for name in ("session_start", "session_end")]
    assert rows(given.select("user", *seconds, "total", "n_rows")) == plain_sessions(data)[0]


DAYS = schemas.record("dt STRING, mid STRING, ts BIGINT")


@pytest.fixture
def days(spark):
    return DayTable(workspace(spark, "days"), DAYS, "dt", ["mid"], ["ts"])


def files(days):
    return {str(p): p.stat().st_mtime_ns for p in pathlib.Path(f"{days.path}/days").rglob("*.parquet")}


def test_only_changed_days_are_written(spark, rows, days):
    some = lambda *r: spark.createDataFrame(list(r), DAYS)
    assert rows(days.read(spark)) == []
    days.merge(some(("d1", "a", 5), ("d1", "a", 4), ("d2", "a", 7), (None, "a", 1)), 0)
    assert rows(days.read(spark)) == [("d1", "a", 4), ("d2", "a", 7)]
    before = files(days)
    days.merge(some(("d1", "a", 4), ("d2", "a", 9)), 1)  # nothing earlier
    assert files(days) == before
    days.merge(some(("d2", "b", 1), ("d1", "a", 6)), 2)
    after = files(days)
    assert {p: t for p, t in after.items() if "dt=d1" in p} == {p: t for p, t in before.items() if "dt=d1" in p}
    assert rows(days.read(spark)) == [("d1", "a", 4), ("d2", "a", 7), ("d2", "b", 1)]
    days.merge(some(("d1", "z", 0)), 2)  # the number is taken: the same batch again
    assert files(days) == after
    days.merge(some(), 3)
    assert files(days) == after
    assert rows(days.log(spark).select("dt", "batch_id")) == [("d1", 0), ("d2", 0), ("d2", 2)]


def test_a_batch_broken_off_after_staging_goes_on(spark, rows, days):
    batch = spark.createDataFrame([("d1", "a", 4)], DAYS)
    days._stage(batch, 0)
    days.merge(batch, 0)
    assert rows(days.read(spark)) == [("d1", "a", 4)]
    days.merge(batch.withColumn("ts", F.lit(1).cast("bigint")), 1)
    assert rows(days.read(spark)) == [("d1", "a", 1)]


def test_a_run_without_news_writes_no_day(spark):
    seen = []
    for table in late_events.day_runs(spark, SMALL):
        seen.append(files(table))
    assert seen[3] == seen[2] and seen[1] != seen[0]


def test_fields_of_odd_records(spark, rows):
    values = [
        '{"a": 1, "b": null}', '{"a": "x", "c": {"d": 1}}', "[1, 2]", "7", "null", "{", "", None, "{}", '{"a": null, "é.x": 1.50}',
    ]
    messages = spark.createDataFrame([("t", v) for v in values] + [(None, '{"a": 1}')], "source_table string, value string")
    assert rows(record_fields(messages, "source_table")) == sorted(
        [
            ("t", "a", "VARIANT", 3, 2), ("t", "b", None, 1, 0), ("t", "c", "OBJECT", 1, 1), ("t", "é.x", "DECIMAL", 1, 1),
            (None, "a", "BIGINT", 1, 1),
        ],
        key=repr,
    )
    assert record_fields(messages.limit(0), "source_table").count() == 0


def test_drift(spark, rows):
    found = spark.createDataFrame(
        [("t", "id", "STRING", 1, 1), ("t", "name", None, 1, 0), ("t", "extra", "BIGINT", 1, 1), ("t", "price", "BIGINT", 1, 1), ("u", "x", "BIGINT", 1, 1)],
        "source_table string, field string, kind string, n_records bigint, n_filled bigint",
    )
    declared = declared_fields(spark, {"t": schemas.record("id BIGINT, name STRING, price DOUBLE, gone STRING")})
    assert rows(field_drift(found, declared).select("field", "drift")) == [("extra", "new"), ("gone", "missing"), ("id", "changed")]
