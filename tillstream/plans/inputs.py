"""The given tables seen as the records of the shop."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillstream.functions.money import cents
from tillstream.operators.dimensions import sku_records, user_records
from tillstream.session import tune
from tillstream.sources.tables import table

AS_OF = "2024-06-30"


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return table(tune(spark), folder, name)


def start_events(events: DataFrame) -> DataFrame:
    """Start log fields of the events: the device is the user, the channel the event type."""
    return events.select(
        F.col("user_id").cast("string").alias("mid"),
        F.col("user_id").cast("string").alias("uid"),
        F.col("event_type").alias("ch"),
        F.get_json_object("props", "$.k").alias("vc"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("ts"),
        "event_id",
    )


def start_log(events: DataFrame) -> DataFrame:
    """The events as start log messages."""
    common = F.struct("mid", "uid", F.lit("110000").alias("ar"), "ch", "vc").alias("common")
    value = F.to_json(F.struct(common, F.struct(F.lit("icon").alias("entry")).alias("start"), F.col("ts")))
    return start_events(events).select(
        value.alias("value"), (F.col("event_id") % 4).cast("int").alias("partition"), F.col("event_id").alias("offset")
    )


def order_records(orders: DataFrame) -> DataFrame:
    """Orders as order_info, without the province."""
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").alias("final_total_amount"),
        F.lit(0.0).alias("benefit_reduce_amount"),
        F.col("o_totalprice").alias("original_total_amount"),
        F.lit(0.0).alias("feight_fee"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("create_time"),
    )


def in_home_province(records: DataFrame, customers: DataFrame) -> DataFrame:
    """Order records with the customer's nation as province."""
    home = customers.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("bigint").alias("province_id"))
    return records.join(home, "user_id", "left")


def detail_records(lines: DataFrame, line_id=None, *others: str) -> DataFrame:
    """Lines as order_detail: one unit at the extended price."""
    return lines.select(
        (line_id if line_id is not None else F.col("l_linenumber").cast("bigint")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").alias("order_price"),
        F.lit(1).cast("bigint").alias("sku_num"),
        *others,
    )


def unique_line_id():
    """An id for a line of an order: 60 bits of a hash of all that tells lines apart, whatever the size of their keys."""
    parts = F.concat_ws("-", "l_partkey", "l_suppkey", "l_linenumber", F.col("l_quantity").cast("bigint"))
    return F.conv(F.substring(F.md5(parts), 1, 15), 16, 10).cast("bigint")


UNIQUE_LINE_ID_SQL = (
    "CAST('0x' || substr(md5(concat_ws('-', l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS BIGINT))), 1, 15) AS BIGINT)"
)


def provinces(nations: DataFrame) -> DataFrame:
    return nations.select(
        F.col("n_nationkey").cast("string").alias("id"),
        F.col("n_name").alias("name"),
        (F.lit(100000) + F.col("n_nationkey") * 1000).cast("string").alias("area_code"),
        F.concat(F.lit("R-"), F.col("n_regionkey").cast("string")).alias("iso_code"),
    )


def users(customers: DataFrame) -> DataFrame:
    """Customers as user_info, with birthdays spread over 20,000 days."""
    offset = ((F.col("c_custkey") * 97) % 20000).cast("int")
    return customers.select(
        F.col("c_custkey").cast("string").alias("id"),
        F.col("c_mktsegment").alias("user_level"),
        F.date_format(F.date_add(F.lit("1960-01-01").cast("date"), offset), "yyyy-MM-dd").alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
    )


def user_dim(customers: DataFrame) -> DataFrame:
    return user_records(users(customers), F.lit(AS_OF).cast("date"))


def name_id(name: str):
    """Numeric id text of a name."""
    return F.conv(F.substring(F.md5(F.col(name)), 1, 8), 16, 10)


def skus(parts: DataFrame) -> DataFrame:
    """Parts as sku_info: brand, type and name are trademark, category and product family."""
    return parts.select(
        F.col("p_partkey").cast("string").alias("id"),
        name_id("p_name").alias("spu_id"),
        cents(F.col("p_retailprice")).cast("string").alias("price"),
        F.col("p_name").alias("sku_name"),
        name_id("p_brand").alias("tm_id"),
        name_id("p_type").alias("category3_id"),
    )


def sku_dim(parts: DataFrame) -> DataFrame:
    """Products with their names, from dimensions made of the distinct brands, types and names."""
    def names(column: str, label: str) -> DataFrame:
        return parts.select(name_id(column).alias("id"), F.col(column).alias(label)).distinct()

    return sku_records(skus(parts), names("p_type", "name"), names("p_brand", "tm_name"), names("p_name", "spu_name"))


def payment_lines(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """Lines to allocate: payment from the order, original total from the sum of its lines."""
    amounts = lines.select(
        F.col("l_orderkey").alias("order_id"),
        unique_line_id().alias("line_id"),
        F.col("l_partkey").alias("sku_id"),
        cents(F.col("l_extendedprice")).alias("line_cents"),
    )
    totals = amounts.groupBy("order_id").agg(F.sum("line_cents").cast("bigint").alias("total_cents"))
    paid = orders.select(F.col("o_orderkey").alias("order_id"), cents(F.col("o_totalprice")).alias("payment_cents"))
    return amounts.join(paid.join(totals, "order_id"), "order_id")
