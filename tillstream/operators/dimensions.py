"""Dimension records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions import people


def user_records(users: DataFrame, as_of: Column) -> DataFrame:
    """Users with age bucket and gender label."""
    age = people.age_years(people.birthday(F.col("birthday")), as_of)
    return users.withColumns({"age_group": people.age_group(age), "gender_name": people.gender_name(F.col("gender"))})


def trademark_records(trademarks: DataFrame) -> DataFrame:
    """Stored under `id`, unlike the record's `tm_id`."""
    return trademarks.select(F.col("tm_id").alias("id"), "tm_name")


def sku_records(skus: DataFrame, categories: DataFrame, trademarks: DataFrame, spus: DataFrame) -> DataFrame:
    """Products with the names of their category, trademark and product family."""
    category = categories.select(F.col("id").alias("category3_id"), F.col("name").alias("category3_name"))
    trademark = trademarks.select(F.col("id").alias("tm_id"), "tm_name")
    family = spus.select(F.col("id").alias("spu_id"), "spu_name")
    return (
        skus.join(category, "category3_id", "left")
        .join(trademark, "tm_id", "left")
        .join(family, "spu_id", "left")
        .select(*skus.columns, "category3_name", "spu_name", "tm_name")
    )
