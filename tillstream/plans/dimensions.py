"""Dimension tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tillstream.operators.as_of import as_of_join
from tillstream.operators import lookups
from tillstream.operators.keyed import latest_per_key
from tillstream.operators.dimensions import trademark_records
from tillstream.plans import inputs
from tillstream.plans.inputs import AS_OF, load
from tillstream.plans.registry import Registry
from tillstream.session import workspace
from tillstream.sinks.keyed_table import KeyedTable

registry = Registry()

USER_SQL = f"""
    SELECT id, user_level, birthday, gender,
           CASE WHEN age < 20 THEN '20岁及以下' WHEN age > 30 THEN '30岁以上' ELSE '21岁到30岁' END AS age_group,
           CASE WHEN gender = 'M' THEN '男' ELSE '女' END AS gender_name
    FROM (SELECT *, date_diff('day', CAST(birthday AS DATE), DATE '{AS_OF}') // 365 AS age FROM (
        SELECT CAST(c_custkey AS VARCHAR) AS id, c_mktsegment AS user_level,
               strftime(DATE '1960-01-01' + CAST(c_custkey * 97 % 20000 AS INTEGER), '%Y-%m-%d') AS birthday,
               CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender FROM customer))
"""


def name_id_sql(name: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({name}), 1, 8) AS BIGINT) AS VARCHAR)"


SKU_SQL = f"""
    SELECT CAST(p_partkey AS VARCHAR) AS id, {name_id_sql('p_name')} AS spu_id,
           CAST(CAST(floor(p_retailprice * 100 + 0.5) AS BIGINT) AS VARCHAR) AS price, p_name AS sku_name,
           {name_id_sql('p_brand')} AS tm_id, {name_id_sql('p_type')} AS category3_id,
           p_type AS category3_name, p_name AS spu_name, p_brand AS tm_name
    FROM part
"""


@registry.query(USER_SQL)
def user_dim(spark, folder):
    return inputs.user_dim(load(spark, folder, "customer"))


@registry.query(SKU_SQL)
def sku_dim_wide(spark, folder):
    return inputs.sku_dim(load(spark, folder, "part"))


@registry.query(f"SELECT DISTINCT {name_id_sql('p_brand')} AS id, p_brand AS tm_name FROM part")
def trademark_dim(spark, folder):
    brands = load(spark, folder, "part").select(inputs.name_id("p_brand").alias("tm_id"), F.col("p_brand").alias("tm_name"))
    return trademark_records(brands.distinct())


@registry.query(
    """
    SELECT o_custkey AS user_id, o_orderkey AS id, o_orderstatus AS order_status FROM (
        SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn = 1
    """
)
def dim_latest_by_key(spark, folder):
    """Orders as versions of their customer: the last one stays."""
    versions = load(spark, folder, "orders").select(
        F.col("o_custkey").alias("user_id"),
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("changed_at"),
    )
    return latest_per_key(versions, ["user_id"], ["changed_at", "id"]).drop("changed_at")


@registry.query(
    """
    SELECT c_custkey AS id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'moved' ELSE c_mktsegment END AS segment,
           CAST(CASE WHEN c_mktsegment = 'MACHINERY' THEN c_nationkey + 1 ELSE c_nationkey END AS BIGINT) AS nation
    FROM customer
    """
)
def dim_upsert(spark, folder):
    """All customers, then a batch changing one market segment, through a keyed table with a compaction between."""
    customers = load(spark, folder, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment"),
        F.col("c_nationkey").cast("bigint").alias("nation"),
    )
    schema = StructType.fromDDL("id BIGINT, segment STRING, nation BIGINT")
    stored = KeyedTable(workspace(spark, "dim_upsert"), schema, ["id"])
    stored.upsert(customers, 0)
    stored.compact(spark, 0)
    moved = customers.filter(F.col("segment") == "MACHINERY")
    stored.upsert(moved.withColumns({"segment": F.lit("moved"), "nation": F.col("nation") + 1}), 1)
    return stored.read(spark)


@registry.query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_custkey % 3 = 0 THEN 'moved' ELSE c_mktsegment END AS segment
    FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-07-30')
    """
)
def dim_rows_pruned(spark, folder):
    """Customers that the last days' orders refer to, from a table in folders by key, with changes over a base."""
    customers = load(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_mktsegment").alias("segment")
    )
    schema = StructType.fromDDL("id STRING, segment STRING")
    stored = KeyedTable(workspace(spark, "dim_rows_pruned"), schema, ["id"], buckets=64)
    stored.upsert(customers, 0)
    stored.compact(spark, 0)
    moved = customers.where(F.col("id").cast("bigint") % 3 == 0)
    stored.upsert(moved.withColumn("segment", F.lit("moved")), 1)
    orders = load(spark, folder, "orders").where(F.col("o_orderdate") >= F.lit("2001-07-30").cast("timestamp_ntz"))
    return stored.in_use(spark, orders, "o_custkey")


@registry.query(
    """
    WITH versions AS (
        SELECT c_custkey, TIMESTAMP '1990-01-01' AS since, c_mktsegment AS level FROM customer
        UNION ALL SELECT c_custkey, TIMESTAMP '1996-01-01' + INTERVAL 1 DAY * (c_custkey % 400)::INT, 'second' FROM customer WHERE c_custkey % 2 = 0
        UNION ALL SELECT c_custkey, TIMESTAMP '1999-01-01' + INTERVAL 1 DAY * (c_custkey % 700)::INT, 'third' FROM customer WHERE c_custkey % 5 > 0)
    SELECT o_orderkey AS id, o_custkey AS user_id, level AS user_level, since
    FROM orders ASOF LEFT JOIN versions ON o_custkey = c_custkey AND o_orderdate >= since
    """
)
def order_user_as_of(spark, folder):
    """Orders with their user's level as it was at the order's time, over three versions of the users."""
    customers = load(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("user_level"))

    def version(start: str, days: int, level: str):
        since = F.date_add(F.lit(start).cast("date"), (F.col("user_id") % days).cast("int")).cast("timestamp_ntz")
        return customers.select("user_id", F.lit(level).alias("user_level"), since.alias("since"))

    first = customers.withColumn("since", F.lit("1990-01-01").cast("timestamp_ntz"))
    second = version("1996-01-01", 400, "second").where("user_id % 2 = 0")
    third = version("1999-01-01", 700, "third").where("user_id % 5 > 0")
    orders = load(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("user_id"), F.col("o_orderdate").alias("at")
    )
    versions = first.unionByName(second).unionByName(third)
    return as_of_join(orders, versions, "user_id", "at", "since", ["user_level", "since"], seconds=90 * 86_400).drop("at")


@registry.query(
    """
    SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS sku_name FROM part
    WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')
    """
)
def dim_rows_in_use(spark, folder):
    """Products the returned lines refer to."""
    returned = load(spark, folder, "lineitem").filter(F.col("l_returnflag") == "R")
    return lookups.rows_in_use(inputs.skus(load(spark, folder, "part")), "id", returned, "l_partkey").select("id", "sku_name")
