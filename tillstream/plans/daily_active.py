"""Daily active devices and other event queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions.documents import dynamic, field
from tillstream.functions.money import cents
from tillstream.functions.times import day_of_millis, hour_of_millis
from tillstream.operators.intervals import interval_join, without_partner
from tillstream.operators.keyed import first_per_key
from tillstream.operators.offsets import ledger_rows, offset_ranges, saved_offsets
from tillstream.operators.totals import active_devices, sliding_sums
from tillstream.plans.inputs import load, start_events, start_log
from tillstream.plans.registry import Registry

registry = Registry()

FIRST_SQL = """
    SELECT * FROM (
        SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid, event_type AS ch,
               json_extract_string(props, '$.k') AS vc, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%H') AS hr,
               '00' AS mi, epoch_us(ts) // 1000 AS ts, event_id,
               row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY epoch_us(ts) // 1000, event_id) AS rn
        FROM events) WHERE rn = 1
"""


def first_events(spark, folder):
    events = start_events(load(spark, folder, "events"))
    dated = events.withColumns({"dt": day_of_millis(F.col("ts")), "hr": hour_of_millis(F.col("ts")), "mi": F.lit("00")})
    return first_per_key(dated, ["dt", "mid"], ["ts", "event_id"])


@registry.query(f"SELECT mid, uid, ch, vc, dt, hr, mi, ts FROM ({FIRST_SQL})")
def dau_first_events(spark, folder):
    return first_events(spark, folder).select("mid", "uid", "ch", "vc", "dt", "hr", "mi", "ts")


@registry.query(
    "SELECT strftime(ts, '%Y-%m-%d') AS dt, CAST(count(DISTINCT user_id) AS BIGINT) AS devices FROM events GROUP BY 1"
)
def dau_daily_count(spark, folder):
    events = start_events(load(spark, folder, "events"))
    return events.groupBy(day_of_millis(F.col("ts")).alias("dt")).agg(F.count_distinct("mid").alias("devices"))


@registry.query(f"SELECT dt, hr, CAST(count(*) AS BIGINT) AS devices FROM ({FIRST_SQL}) GROUP BY dt, hr")
def dau_hourly_count(spark, folder):
    return active_devices(first_events(spark, folder), "dt", "hr")


@registry.query(
    """
    SELECT CAST(user_id AS VARCHAR) AS mid, CAST(user_id AS VARCHAR) AS uid, '110000' AS ar, event_type AS ch,
           json_extract_string(props, '$.k') AS vc, epoch_us(ts) // 1000 AS ts, strftime(ts, '%Y-%m-%d') AS dt,
           strftime(ts, '%H') AS hr
    FROM events
    """
)
def app_log_flatten(spark, folder):
    """Start log messages read as schemaless JSON."""
    log = start_log(load(spark, folder, "events")).select(dynamic(F.col("value")).alias("event"))
    event = F.col("event")
    flat = log.select(
        *[field(event, f"common.{name}").alias(name) for name in ("mid", "uid", "ar", "ch", "vc")],
        field(event, "ts", "bigint").alias("ts"),
    )
    return flat.withColumns({"dt": day_of_millis(F.col("ts")), "hr": hour_of_millis(F.col("ts"))})


def _messages(spark, folder):
    """Events as messages of two topics with four partitions each."""
    return load(spark, folder, "events").select(
        F.concat(F.lit("start_"), F.when(F.col("event_type") == "click", "click").otherwise("other")).alias("topic"),
        (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
    )


@registry.query(
    """
    SELECT CASE WHEN event_type = 'click' THEN 'start_click' ELSE 'start_other' END AS topic,
           CAST(event_id % 4 AS INTEGER) AS "partition", min(event_id) AS from_offset, max(event_id) + 1 AS until_offset
    FROM events GROUP BY 1, 2
    """,
    name="offset_ranges",
)
def topic_ranges(spark, folder):
    return offset_ranges(_messages(spark, folder))


@registry.query(
    """
    SELECT 'start_click' AS topic, CAST(event_id % 4 AS INTEGER) AS partition_id, max(event_id) + 1 AS topic_offset
    FROM events WHERE event_type = 'click' GROUP BY 2
    """
)
def offset_resume(spark, folder):
    """Ledger of two groups; the saved offsets of one topic for one group."""
    ranges = offset_ranges(_messages(spark, folder))
    earlier = ranges.withColumn("until_offset", F.col("from_offset"))
    ledger = ledger_rows(ranges, "dau").unionByName(ledger_rows(earlier, "dau"))
    ledger = ledger.unionByName(ledger_rows(earlier, "other"))
    return saved_offsets(ledger, "start_click", "dau")


_SECONDS = 2 * 3600


def _clicks_and_purchases(spark, folder):
    events = load(spark, folder, "events")
    click = events.filter(F.col("event_type") == "click").select(
        F.col("user_id").alias("click_user"), F.col("event_id").alias("click_id"), F.col("ts").alias("click_ts")
    )
    purchase = events.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("user_id"), F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts")
    )
    return click, purchase


@registry.query(
    f"""
    SELECT p.user_id, p.event_id AS purchase_id, c.event_id AS click_id,
           abs(epoch_us(p.ts) - epoch_us(c.ts)) AS apart_us
    FROM events p JOIN events c ON p.user_id = c.user_id
         AND abs(epoch_us(p.ts) - epoch_us(c.ts)) <= {_SECONDS * 1_000_000}
    WHERE p.event_type = 'purchase' AND c.event_type = 'click'
    """,
    name="interval_join",
)
def clicks_near_purchases(spark, folder):
    click, purchase = _clicks_and_purchases(spark, folder)
    pairs = interval_join(purchase, click, {"user_id": "click_user"}, "purchase_ts", "click_ts", _SECONDS)
    micros = lambda name: F.unix_micros(F.col(name).cast("timestamp"))
    apart = F.abs(micros("purchase_ts") - micros("click_ts")).alias("apart_us")
    return pairs.select("user_id", "purchase_id", "click_id", apart)


@registry.query(
    f"""
    SELECT p.user_id, p.event_id AS purchase_id FROM events p
    WHERE p.event_type = 'purchase' AND NOT EXISTS (
        SELECT 1 FROM events c WHERE c.event_type = 'click' AND p.user_id = c.user_id
        AND abs(epoch_us(p.ts) - epoch_us(c.ts)) <= {_SECONDS * 1_000_000})
    """,
    name="interval_join_unmatched",
)
def purchases_without_click(spark, folder):
    click, purchase = _clicks_and_purchases(spark, folder)
    lost = without_partner(purchase, click, {"user_id": "click_user"}, "purchase_ts", "click_ts", _SECONDS)
    return lost.select("user_id", "purchase_id")


@registry.query(
    """
    SELECT make_timestamp(s * 1000000) AS window_start, make_timestamp((s + 1200) * 1000000) AS window_end,
           event_type, CAST(sum(CAST(floor("value" * 100 + 0.5) AS BIGINT)) AS BIGINT) AS total,
           CAST(count(*) AS BIGINT) AS n_rows
    FROM (SELECT event_type, "value", CAST(floor(epoch_us(ts) / 300000000.0) AS BIGINT) * 300 - 300 * k AS s
          FROM events, (VALUES (0), (1), (2), (3)) AS slides(k))
    GROUP BY s, event_type
    """
)
def sliding_window_sum(spark, folder):
    """Value per event type in windows of 20 minutes, every 5 minutes."""
    events = load(spark, folder, "events").select("ts", "event_type", cents(F.col("value")).alias("value_cents"))
    sums = sliding_sums(events, "ts", "value_cents", 1200, 300, ["event_type"])
    return sums.withColumns({name: F.col(name).cast("timestamp_ntz") for name in ("window_start", "window_end")})
