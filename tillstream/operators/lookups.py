"""Attribute lookups. Dimensions are unique by key; rows without a match keep null attributes.

No dimension carries a broadcast hint: Spark broadcasts one whose size is below
`spark.sql.autoBroadcastJoinThreshold` (statistics before, measured size during the run) and
otherwise shuffles, splitting skewed keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.functions.keys import as_id


def lookup(rows: DataFrame, dim: DataFrame, key: str, dim_key: str, attributes: dict[str, str]) -> DataFrame:
    """Left lookup adding `attributes` (dimension column -> new name); both keys are compared as integers."""
    side = dim.select(as_id(F.col(dim_key)).alias("__key"), *[F.col(c).alias(n) for c, n in attributes.items()])
    return rows.join(side, rows[key].cast("bigint") == side["__key"], "left").drop("__key")


def with_province(orders: DataFrame, provinces: DataFrame) -> DataFrame:
    return lookup(
        orders, provinces, "province_id", "id",
        {"name": "province_name", "area_code": "province_area_code", "iso_code": "province_iso_code"},
    )


def with_user(orders: DataFrame, users: DataFrame) -> DataFrame:
    return lookup(orders, users, "user_id", "id", {"age_group": "user_age_group", "gender_name": "user_gender"})


def with_sku(details: DataFrame, skus: DataFrame) -> DataFrame:
    """Product ids (as integers) and names of an order line."""
    found = lookup(
        details, skus, "sku_id", "id",
        {name: name for name in ("spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")},
    )
    return found.withColumns({name: as_id(F.col(name)) for name in ("spu_id", "tm_id", "category3_id")})


def rows_in_use(dim: DataFrame, dim_key: str, rows: DataFrame, key: str) -> DataFrame:
    """The dimension rows the given rows refer to, for a dimension much larger than a batch.

    Spark measures the distinct keys as the query runs and broadcasts them when they are few.
    """
    wanted = rows.select(F.col(key).cast("bigint").alias("__key")).distinct()
    return dim.join(wanted, as_id(dim[dim_key]) == wanted["__key"], "left_semi")
