"""Change records of all tables routed to one topic per table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstream import schemas
from tillstream.functions.documents import parse_records, record_json
from tillstream.operators.changes import route_array_envelope, route_single_envelope
from tillstream.operators.record_fields import declared_fields, field_drift, record_fields
from tillstream.plans.inputs import load, order_records
from tillstream.plans.registry import Registry

registry = Registry()


def array_envelopes(spark, folder):
    """Orders and lines as array envelopes; an order's record has two elements, open orders are updates."""
    orders, lines = load(spark, folder, "orders"), load(spark, folder, "lineitem")
    order = lambda number: F.struct(number.alias("id"), F.col("o_custkey").alias("user_id"))
    kind = F.when(F.col("o_orderstatus") == "O", "UPDATE").when(F.col("o_orderstatus") == "P", "insert")
    changed = orders.select(
        F.to_json(
            F.struct(
                F.array(order(F.col("o_orderkey") * 2), order(F.col("o_orderkey") * 2 + 1)).alias("data"),
                kind.otherwise("INSERT").alias("type"),
                F.lit("order_info").alias("table"),
            )
        ).alias("value")
    )
    line = F.struct(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("sku_id"))
    added = lines.select(
        F.to_json(
            F.struct(F.lit("INSERT").alias("type"), F.lit("order_detail").alias("table"), F.array(line).alias("data"))
        ).alias("value")
    )
    return changed.unionByName(added)


def single_envelopes(spark, folder):
    """Orders, customers and parts as single-row envelopes with mixed types, tables and empty data."""
    orders, customers = load(spark, folder, "orders"), load(spark, folder, "customer")
    parts = load(spark, folder, "part")

    def message(kind, name, data):
        return F.to_json(F.struct(kind.alias("type"), F.lit(name).alias("table"), data.alias("data"))).alias("value")

    status = F.col("o_orderstatus")
    order_kind = F.when(status == "O", "insert").when(status == "F", "bootstrap-insert").otherwise("update")
    user_kind = F.when(F.col("c_custkey") % 3 == 0, "delete").otherwise("bootstrap-insert")
    user_data = F.when(F.col("c_custkey") % 5 != 0, F.struct(F.col("c_custkey").alias("id")))
    other = F.struct(F.col("p_partkey").alias("id"))
    return (
        orders.select(message(order_kind, "order_info", F.struct(F.col("o_orderkey").alias("id"))))
        .unionByName(customers.select(message(user_kind, "user_info", user_data)))
        .unionByName(parts.select(message(F.lit("insert"), "coupon_info", other)))
        .unionByName(parts.select(message(F.lit("insert"), "sku_info", F.create_map().cast("map<string,string>"))))
        .unionByName(parts.select(message(F.lit("update"), "sku_info", other)))
    )


ARRAY_SQL = """
    SELECT 'ods_order_info' AS topic, CAST(to_json({'id': o_orderkey * 2 + n, 'user_id': o_custkey}) AS VARCHAR) AS "value"
    FROM orders, (VALUES (0), (1)) AS copies(n) WHERE o_orderstatus = 'F'
    UNION ALL
    SELECT 'ods_order_detail', CAST(to_json({'order_id': l_orderkey, 'sku_id': l_partkey}) AS VARCHAR) FROM lineitem
"""

SINGLE_SQL = """
    SELECT 'ods_order_info' AS topic, CAST(to_json({'id': o_orderkey}) AS VARCHAR) AS "value"
    FROM orders WHERE o_orderstatus = 'O'
    UNION ALL
    SELECT 'ods_user_info', CAST(to_json({'id': c_custkey}) AS VARCHAR) FROM customer
    WHERE c_custkey % 5 <> 0
    UNION ALL
    SELECT 'ods_sku_info', CAST(to_json({'id': p_partkey}) AS VARCHAR) FROM part
"""


@registry.query(ARRAY_SQL)
def cdc_array_route(spark, folder):
    return route_array_envelope(array_envelopes(spark, folder))


@registry.query(SINGLE_SQL)
def cdc_single_route(spark, folder):
    return route_single_envelope(single_envelopes(spark, folder))


@registry.query(SINGLE_SQL.replace("c_custkey % 5 <> 0", "c_custkey % 5 <> 0 AND c_custkey % 3 <> 0"))
def cdc_single_route_without_deletes(spark, folder):
    return route_single_envelope(single_envelopes(spark, folder), drop_deletes=True)


@registry.query(
    """
    SELECT o_orderkey AS id, o_orderstatus AS order_status, o_custkey AS user_id, o_totalprice AS final_total_amount,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS create_time
    FROM orders
    """
)
def array_orders_parsed(spark, folder):
    """Orders in array envelopes, all values as text, routed and read as order records; broken messages give none."""
    orders = order_records(load(spark, folder, "orders"))
    as_text = F.struct(*[F.col(name).cast("string").alias(name) for name in orders.columns])
    envelope = F.struct(F.lit("INSERT").alias("type"), F.lit("order_info").alias("table"), F.array(as_text).alias("data"))
    routed = route_array_envelope(orders.select(F.to_json(envelope).alias("value"))).select("value")
    broken = orders.where("id % 100 = 0").select(F.substring(record_json("id"), 1, 4).alias("value"))
    records = parse_records(routed.unionByName(broken), schemas.ORDER_INFO)
    return records.select("id", "order_status", "user_id", "final_total_amount", "create_time")


def drifting_records(spark, folder):
    """Order, line and event records whose fields change: ids as text, fields that come late, fields that never have a value."""
    orders, lines = load(spark, folder, "orders"), load(spark, folder, "lineitem")
    events = load(spark, folder, "events")

    def message(name, *fields):
        value = F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})
        return F.lit(name).alias("source_table"), value.alias("value")

    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    id_, user = F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id")
    never = F.lit(None).cast("string").alias("expire_time")
    amount, status = F.col("o_totalprice").alias("final_total_amount"), F.col("o_orderstatus").alias("order_status")
    line = [F.col("l_orderkey").alias("order_id"), F.col("l_extendedprice").alias("order_price")]
    when = F.date_format("l_shipdate", "yyyy-MM-dd").alias("ship_time")
    common = F.struct(F.col("user_id").cast("string").alias("mid")).alias("common")
    return (
        orders.where(~late).select(*message("order_info", id_, user, never, amount))
        .unionByName(orders.where(late).select(*message("order_info", id_, user.cast("string").alias("user_id"), never, amount, status)))
        .unionByName(lines.select(*message("order_detail", *line, when)))
        .unionByName(events.select(*message("start_log", common, F.col("event_id").alias("id"))))
        .unionByName(events.select(F.lit("start_log").alias("source_table"), F.lit('{"id": 1').alias("value")))
    )


_FIELDS_SQL = """
    SELECT 'order_info' AS source_table, f.field AS field,
           CASE f.field WHEN 'id' THEN 'BIGINT' WHEN 'final_total_amount' THEN 'DECIMAL' WHEN 'order_status' THEN 'STRING'
                WHEN 'user_id' THEN CASE WHEN n_late = 0 THEN 'BIGINT' WHEN n_late = n THEN 'STRING' ELSE 'VARIANT' END END AS kind,
           CASE f.field WHEN 'order_status' THEN n_late ELSE n END AS n_records,
           CASE f.field WHEN 'order_status' THEN n_late WHEN 'expire_time' THEN 0 ELSE n END AS n_filled
    FROM (SELECT count(*) AS n, count(*) FILTER (o_orderdate >= TIMESTAMP '1998-01-01') AS n_late FROM orders),
         (VALUES ('id'), ('user_id'), ('expire_time'), ('final_total_amount'), ('order_status')) AS f(field)
    UNION ALL
    SELECT 'order_detail', f.field, f.kind, count(*), count(*)
    FROM lineitem, (VALUES ('order_id', 'BIGINT'), ('order_price', 'DECIMAL'), ('ship_time', 'STRING')) AS f(field, kind) GROUP BY 1, 2, 3
    UNION ALL
    SELECT 'start_log', f.field, f.kind, count(*), count(*)
    FROM events, (VALUES ('common', 'OBJECT'), ('id', 'BIGINT')) AS f(field, kind) GROUP BY 1, 2, 3
"""


@registry.query(_FIELDS_SQL, name="record_fields")
def fields_of_records(spark, folder):
    """Fields and merged types per source table; broken messages have none."""
    return record_fields(drifting_records(spark, folder), "source_table")


_DECLARED = {"order_info": schemas.ORDER_INFO, "order_detail": schemas.ORDER_DETAIL}
_DECLARED_SQL = ", ".join(
    f"('{table}', '{f.name}', '{f.dataType.simpleString()}')" for table, schema in _DECLARED.items() for f in schema.fields
)


@registry.query(
    f"""
    WITH found AS ({_FIELDS_SQL}), declared(source_table, field, type) AS (VALUES {_DECLARED_SQL})
    SELECT source_table, field, type, kind,
           CASE WHEN type IS NULL THEN 'new' WHEN n_records IS NULL THEN 'missing' ELSE 'changed' END AS drift
    FROM (SELECT * FROM found WHERE source_table IN (SELECT source_table FROM declared)) f
         FULL JOIN declared d USING (source_table, field)
    WHERE type IS NULL OR n_records IS NULL OR (kind IS NOT NULL AND NOT (
        (type = 'bigint' AND kind = 'BIGINT') OR (type = 'double' AND kind IN ('BIGINT', 'DECIMAL', 'DOUBLE'))
        OR (type = 'string' AND kind = 'STRING')))
    """,
    name="field_drift",
)
def drift_of_records(spark, folder):
    """Where the records left the schemas that orders and lines are read by."""
    return field_drift(record_fields(drifting_records(spark, folder), "source_table"), declared_fields(spark, _DECLARED))
