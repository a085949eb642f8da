"""Running sums within a group of any size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window, functions as F

from tillstream.sinks.batches import staged

PART = "__part"


def running_sums(
    rows: DataFrame,
    group: str,
    order: list[str],
    sums: dict[str, str],
    stage: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add `name`: the sum of the column `sums[name]` over the rows of the group up to and with this one.

    All groups take one way. The rows are cut into ranges of (group, order), each about as large as the
    others, so a group with very many rows lies in many ranges, wherever its order values fall. Rows are summed
    inside their range, ranges are totalled per group (at most one row per range and group), and the total
    before a range is added to its rows. The ranges are written once by `stage`, as two plans that
    cut them anew could disagree.
    """
    stage = stage or (lambda ranged: staged(ranged, "running-sums"))
    ranged = stage(rows.repartitionByRange(group, *order).withColumn(PART, F.spark_partition_id()))
    inside = Window.partitionBy(group, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = ranged.withColumns({n: F.sum(c).over(inside) for n, c in sums.items()})
    totals = ranged.groupBy(group, PART).agg(*[F.sum(c).alias(f"__total_{n}") for n, c in sums.items()])
    before = Window.partitionBy(group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col(group).alias("__group"), F.col(PART).alias("__of"), *[F.sum(f"__total_{n}").over(before).alias(f"__before_{n}") for n in sums]
    )
    same = F.col(group).eqNullSafe(F.col("__group")) & (F.col(PART) == F.col("__of"))
    found = summed.join(offsets, same).withColumns(
        {n: F.coalesce(F.col(n) + F.col(f"__before_{n}"), F.col(n), F.col(f"__before_{n}")) for n in sums}
    )
    return found.select(*rows.columns, *sums)
