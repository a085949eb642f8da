"""Which order is a user's first one."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillstream.operators.keyed import first_per_key


def first_orders(orders: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """Earliest order (`user_id`, `id`) of every user without an entry in `status`; ties go to the lower id.

    An order without a user is nobody's first. Where `status` names the order that was a user's first, that order
    is it again, so that a second delivery keeps its flag.
    """
    placed = orders.select("user_id", "create_time", "id").where("user_id IS NOT NULL")
    earliest = first_per_key(placed, ["user_id"], ["create_time", "id"]).select("user_id", "id")
    if status is None:
        return earliest
    user = F.col("user_id").cast("bigint").alias("user_id")
    first = earliest.join(status.select(user), "user_id", "left_anti")
    if "order_id" in status.columns:
        first = first.unionByName(status.where("order_id IS NOT NULL").select(user, F.col("order_id").cast("bigint").alias("id")))
    return first


def with_first_flag(orders: DataFrame, status: DataFrame | None = None) -> DataFrame:
    """Add `if_first_order` ("1" or "0").

    The flag is joined back on the order id, which is unique and spreads evenly, never on the user id.
    """
    first = first_orders(orders, status).select("id", F.lit("1").alias("__flag"))
    flagged = orders.join(first, "id", "left")
    return flagged.withColumn("if_first_order", F.coalesce("__flag", F.lit("0"))).select(
        *[c for c in orders.columns if c != "if_first_order"], "if_first_order"
    )


def status_updates(flagged: DataFrame) -> DataFrame:
    """Status rows (`user_id`, `if_consumed`, `order_id`) of the users whose first order is in the batch."""
    return flagged.filter(F.col("if_first_order") == "1").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.lit("1").alias("if_consumed"),
        F.col("id").cast("bigint").alias("order_id"),
    )
