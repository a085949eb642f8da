"""Events by session and by day, in any order of arrival: batch and stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions.money import cents
from tillstream.operators.sessions import session_running_sums, sessions
from tillstream.plans.daily_active import FIRST_SQL
from tillstream.plans.inputs import load, start_log
from tillstream.plans.registry import Registry
from tillstream.session import tune, workspace
from tillstream.sinks.batches import write_batch
from tillstream.sinks.day_table import DayTable
from tillstream.sources.topics import FileTopics
from tillstream.streaming.jobs import Warehouse
from tillstream.streaming.runs import each_batch
from tillstream.streaming.sessions import early_merge, session_stream

registry = Registry()

GAP = 2 * 3600

_CENTS = 'CAST(floor("value" * 100 + 0.5) AS BIGINT)'
_NUMBERED = f"""
    SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nr FROM (
        SELECT *, {_CENTS} AS value_cents,
               CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) <= {GAP * 1_000_000}
                    THEN 0 ELSE 1 END AS opens
        FROM events)
"""
_SESSIONS = f"""
    SELECT user_id, epoch_us(min(ts)) AS session_start, epoch_us(max(ts)) AS session_end,
           CAST(sum(value_cents) AS BIGINT) AS total, count(*) AS n_rows
    FROM ({_NUMBERED}) GROUP BY user_id, nr
"""


def _events(spark, folder):
    time = F.col("ts").cast("timestamp").alias("ts")
    return load(spark, folder, "events").select("event_id", "user_id", time, cents(F.col("value")).alias("value_cents"))


def _in_micros(found):
    return found.withColumns({name: F.unix_micros(name) for name in ("session_start", "session_end")})


@registry.query(_SESSIONS)
def event_sessions(spark, folder):
    """Events of a user that follow each other within two hours, summed."""
    return _in_micros(sessions(_events(spark, folder), "user_id", "ts", "value_cents", GAP))


@registry.query(
    f"""
    SELECT event_id, user_id, epoch_us(min(ts) OVER (PARTITION BY user_id, nr)) AS session_start,
           CAST(sum(value_cents) OVER (PARTITION BY user_id, nr ORDER BY ts, event_id) AS BIGINT) AS running
    FROM ({_NUMBERED})
    """
)
def event_session_sums(spark, folder):
    """Each event with the sum since its user's last pause of over two hours."""
    summed = session_running_sums(_events(spark, folder), "user_id", "ts", ["ts", "event_id"], {"running": "value_cents"}, GAP)
    return summed.select("event_id", "user_id", F.unix_micros("session_start").alias("session_start"), "running")


_CUTS = ("2024-01-10", "2024-01-20")


def session_runs(spark, folder):
    """The session job, run after each of three parts of the events by time, and after one event far ahead, which ends all.

    Sessions that go over a cut are put together from two runs. Gives (folder, query) after each run.
    """
    root = workspace(tune(spark), "stream_sessions")
    topics = FileTopics(f"{root}/topics")
    events = _events(spark, folder)
    part = sum(F.when(F.col("ts") >= F.lit(cut).cast("timestamp"), 1).otherwise(0) for cut in _CUTS)
    closing = spark.range(1).select(F.lit(-1).cast("bigint").alias("user_id"), F.lit("2030-01-01").cast("timestamp").alias("ts"))
    events = events.withColumn("nr", part).unionByName(closing.withColumn("nr", F.lit(3)), allowMissingColumns=True)
    value = F.to_json(F.struct("user_id", F.unix_micros("ts").alias("at"), "value_cents"))
    messages = events.select(F.lit("events").alias("topic"), value.alias("value"), "nr")
    for number in range(4):
        topics.write(messages.where(F.col("nr") == number), "sender", number)
        read = topics.read(spark, "events").select(F.from_json("value", "user_id BIGINT, at BIGINT, value_cents BIGINT").alias("e"))
        timed = read.select("e.user_id", F.timestamp_micros("e.at").alias("ts"), "e.value_cents").withWatermark("ts", "1 hour")
        found = session_stream(timed, "user_id", "ts", "value_cents", GAP)
        with early_merge(spark):
            query = each_batch(found, lambda b, n: write_batch(b, f"{root}/sessions", n), f"{root}/checkpoint", drain=True, hold=True)
        query.awaitTermination()
        yield f"{root}/sessions", query


@registry.query(_SESSIONS)
def stream_sessions(spark, folder):
    """Sessions of a stream, each given once, when no event can come to it any more."""
    *_, (place, _) = session_runs(spark, folder)
    return _in_micros(spark.read.parquet(place).drop("batch_id"))


# Events come in parts: each hour of the day is one of three, the latest hours first.
_PART = "CAST(2 - floor(hour(ts) / 8) AS INTEGER)"


def day_runs(spark, folder):
    """The job that keeps each day's first events, with earlier events of the same days coming later; the table after each run.

    The last run has only what was there before.
    """
    root = workspace(tune(spark), "stream_late_days")
    warehouse = Warehouse(spark, FileTopics(f"{root}/topics"), root, drain=True)
    log = start_log(load(spark, folder, "events"))
    at = F.timestamp_millis(F.get_json_object("value", "$.ts").cast("bigint"))
    log = log.withColumn("nr", (2 - F.floor(F.hour(at) / 8)).cast("int"))
    for number in range(4):
        wanted = (F.col("nr") == number) | (F.col("nr") == number - 1)
        warehouse.topics.write(log.where(wanted).select(F.lit("start_log").alias("topic"), "value"), "sender", number)
        warehouse.daily_first("start_log").awaitTermination()
        yield warehouse.day_index


@registry.query(f"SELECT mid, uid, '110000' AS ar, ch, vc, dt, hr, mi, ts FROM ({FIRST_SQL})")
def stream_late_days(spark, folder):
    """First start event per day and device, whatever the order in which events come."""
    *_, days = day_runs(spark, folder)
    return days.read(spark)


@registry.query(
    f"""
    WITH best AS (SELECT CAST(ts AS DATE) AS day, user_id, {_PART} AS part, min(epoch_us(ts) // 1000) AS first FROM events GROUP BY 1, 2, 3),
    steps AS (SELECT *, min(first) OVER (PARTITION BY day, user_id ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
              FROM best)
    SELECT strftime(day, '%Y-%m-%d') AS dt, count(DISTINCT part) AS writes FROM steps WHERE earlier IS NULL OR first < earlier GROUP BY day
    """
)
def stream_day_writes(spark, folder):
    """How often each day's folder was written: by the batches that changed it, by no other."""
    *_, days = day_runs(spark, folder)
    return days.log(spark).groupBy("dt").agg(F.count(F.lit(1)).alias("writes"))
