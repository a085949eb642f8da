"""The paid amount of an order spread over its lines, the rounding remainder on the last line."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

from tillstream.functions.money import share_cents
from tillstream.operators.running import running_sums

STATE_COLUMNS = ["order_id", "origin_sum", "split_sum", "line_count"]


def allocate_payment(
    lines: DataFrame,
    prior: DataFrame | None = None,
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add `allocated_cents` to lines (order_id, line_id, line_cents, payment_cents, total_cents, ...).

    Lines are unique by (order_id, line_id) and taken in line_id order; amounts are not negative.
    A line at which the running sum reaches the order's total takes what is left of the payment,
    every other line its rounded share. `prior` holds the sums of earlier batches (STATE_COLUMNS)
    and counts as a line before all others. `stage` writes the rows that running sums are taken of.
    """
    share = share_cents(F.col("payment_cents"), F.col("line_cents"), F.col("total_cents"))
    rows = lines.withColumns(
        {"__share": share, "__count": F.lit(1).cast("bigint"), "__turn": F.lit(1), "__amount": F.col("line_cents")}
    )
    if prior is not None:
        earlier = prior.join(lines.select("order_id").distinct(), "order_id", "left_semi").select(
            "order_id",
            F.col("split_sum").alias("__share"),
            F.col("line_count").alias("__count"),
            F.lit(0).alias("__turn"),
            F.col("origin_sum").alias("__amount"),
        )
        rows = rows.unionByName(earlier, allowMissingColumns=True)

    summed = running_sums(
        rows,
        group="order_id",
        order=["__turn", "line_id"],
        sums={"__amount_to": "__amount", "__share_to": "__share", "__count_to": "__count"},
        stage=stage,
    )
    # shares of a zero total are null and add nothing, as does the row's own share here
    share_before = F.coalesce(F.col("__share_to"), F.lit(0)) - F.coalesce(F.col("__share"), F.lit(0))
    takes_rest = (F.col("line_cents") > 0) | (F.col("__count_to") == 1)
    allocated = F.when(
        F.col("__amount_to") == F.col("total_cents"),
        F.when(takes_rest, F.col("payment_cents") - share_before).otherwise(F.lit(0)),
    ).otherwise(F.col("__share"))
    return (
        summed.filter(F.col("__turn") == 1)
        .withColumn("allocated_cents", allocated.cast("bigint"))
        .select(*lines.columns, "allocated_cents")
    )


def allocation_state(allocated: DataFrame, prior: DataFrame | None = None) -> DataFrame:
    """Sums per order (STATE_COLUMNS) after a batch of allocated lines, earlier batches included."""
    rows = allocated.select(
        "order_id",
        F.col("line_cents").alias("origin_sum"),
        F.coalesce("allocated_cents", F.lit(0)).alias("split_sum"),
        F.lit(1).cast("bigint").alias("line_count"),
    )
    if prior is not None:
        touched = prior.join(allocated.select("order_id").distinct(), "order_id", "left_semi")
        rows = rows.unionByName(touched.select(*STATE_COLUMNS))
    return rows.groupBy("order_id").agg(*[F.sum(c).cast("bigint").alias(c) for c in STATE_COLUMNS[1:]])
