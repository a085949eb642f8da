"""Orders and order lines with their attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream.functions.money import cents, line_amount
from tillstream.functions.times import date_part, hour_part
from tillstream.operators import lookups
from tillstream.operators.first_orders import status_updates, with_first_flag
from tillstream.operators.running import running_sums
from tillstream.plans import inputs
from tillstream.plans.dimensions import SKU_SQL, USER_SQL
from tillstream.plans.inputs import load
from tillstream.plans.registry import Registry

registry = Registry()

# the day the later batch of the two-batch queries begins
CUT_OFF = "1998-01-01 00:00:00"


@registry.query(
    """
    SELECT event_id AS id, strftime(ts, '%Y-%m-%d') AS create_date, strftime(ts, '%H') AS create_hour FROM events
    """
)
def order_date_parts(spark, folder):
    """Date and hour of time texts; events are the table whose times have hours."""
    text = load(spark, folder, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("t"))
    return text.select(
        F.col("event_id").alias("id"), date_part(F.col("t")).alias("create_date"), hour_part(F.col("t")).alias("create_hour")
    )


@registry.query(
    """
    SELECT o_orderkey AS id, o_custkey AS user_id,
           CASE WHEN row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
                THEN '1' ELSE '0' END AS if_first_order
    FROM orders
    """
)
def order_first_flag(spark, folder):
    orders = inputs.order_records(load(spark, folder, "orders"))
    return with_first_flag(orders).select("id", "user_id", "if_first_order")


def _two_batches(spark, folder):
    orders = inputs.order_records(load(spark, folder, "orders")).select("id", "user_id", "create_time")
    earlier = orders.filter(F.col("create_time") < CUT_OFF)
    status = status_updates(with_first_flag(earlier))
    return orders.filter(F.col("create_time") >= CUT_OFF), status


_LATER_SQL = f"""
    SELECT o_orderkey AS id, o_custkey AS user_id,
           CASE WHEN o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{CUT_OFF}')
                 AND row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
                THEN '1' ELSE '0' END AS if_first_order
    FROM orders WHERE o_orderdate >= TIMESTAMP '{CUT_OFF}'
"""


@registry.query(_LATER_SQL)
def order_first_flag_known_users(spark, folder):
    """The later orders, with the users of the earlier ones known."""
    later, status = _two_batches(spark, folder)
    return with_first_flag(later, status).select("id", "user_id", "if_first_order")


@registry.query(
    f"SELECT CAST(user_id AS VARCHAR) AS user_id, '1' AS if_consumed, id AS order_id FROM ({_LATER_SQL}) WHERE if_first_order = '1'"
)
def new_users_in_batch(spark, folder):
    later, status = _two_batches(spark, folder)
    return status_updates(with_first_flag(later, status))


@registry.query(
    """
    SELECT o_orderkey AS id, CAST(c_nationkey AS BIGINT) AS province_id, n_name AS province_name,
           CAST(100000 + n_nationkey * 1000 AS VARCHAR) AS province_area_code,
           'R-' || n_regionkey AS province_iso_code
    FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    """
)
def order_with_province(spark, folder):
    orders = inputs.in_home_province(inputs.order_records(load(spark, folder, "orders")), load(spark, folder, "customer"))
    found = lookups.with_province(orders, inputs.provinces(load(spark, folder, "nation")))
    return found.select("id", "province_id", "province_name", "province_area_code", "province_iso_code")


@registry.query(
    f"""
    SELECT o_orderkey AS id, o_custkey AS user_id, u.age_group AS user_age_group, u.gender_name AS user_gender
    FROM orders LEFT JOIN ({USER_SQL}) u ON CAST(o_custkey AS VARCHAR) = u.id
    """
)
def order_with_user(spark, folder):
    orders = inputs.order_records(load(spark, folder, "orders"))
    found = lookups.with_user(orders, inputs.user_dim(load(spark, folder, "customer")))
    return found.select("id", "user_id", "user_age_group", "user_gender")


@registry.query(
    f"""
    SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS id, l_partkey AS sku_id,
           CAST(s.spu_id AS BIGINT) AS spu_id, CAST(s.tm_id AS BIGINT) AS tm_id,
           CAST(s.category3_id AS BIGINT) AS category3_id, s.spu_name, s.tm_name, s.category3_name
    FROM lineitem LEFT JOIN ({SKU_SQL}) s ON CAST(l_partkey AS VARCHAR) = s.id
    """
)
def detail_with_sku(spark, folder):
    details = inputs.detail_records(load(spark, folder, "lineitem"))
    found = lookups.with_sku(details, inputs.sku_dim(load(spark, folder, "part")))
    return found.drop("order_price", "sku_num")


@registry.query(
    """
    SELECT l_orderkey AS order_id, line_id, amount AS line_cents,
           CAST(sum(amount) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, line_id) AS BIGINT) AS running_cents
    FROM (SELECT *, CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) * CAST(l_quantity AS BIGINT) AS amount,
                 """
    + inputs.UNIQUE_LINE_ID_SQL
    + " AS line_id FROM lineitem)"
)
def order_running_sums(spark, folder):
    """Price times quantity, summed line by line within each order."""
    lines = load(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        "l_linenumber",
        inputs.unique_line_id().alias("line_id"),
        line_amount(cents(F.col("l_extendedprice")), F.col("l_quantity").cast("bigint")).alias("line_cents"),
    )
    return running_sums(lines, "order_id", ["l_linenumber", "line_id"], {"running_cents": "line_cents"}).drop("l_linenumber")
