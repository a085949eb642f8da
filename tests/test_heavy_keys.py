"""One key with a third of all rows: results stay whole, plans reduce or split it."""

import random

import pytest
from pyspark.sql import Window, functions as F
from tillstream.operators.allocation import allocate_payment
from tillstream.operators.first_orders import with_first_flag
from tillstream.operators.intervals import interval_join
from tillstream.operators.keyed import first_per_key
from tillstream.operators.running import running_sums
from tillstream.plans import daily_active, orders, texts, wide_orders
from tillstream.sinks.batches import staged

SMALL = "/root/testdata/sf0.001"


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """3,000 rows of 400 orders, a third of them in order 7, as (order_id, line_id, amount)."""
    generator = random.Random(5)
    rows = [(7, i, generator.randrange(1, 900)) for i in range(1000)]
    rows += [(generator.randrange(100, 500), 10_000 + i, generator.randrange(1, 900)) for i in range(2000)]
    generator.shuffle(rows)
    return spark.createDataFrame(rows, "order_id bigint, line_id bigint, amount bigint")


def by_range(spark, rows, group, order, parts):
    """The rows as running_sums stages them, in a given number of ranges."""
    cut = rows.repartitionByRange(parts, group, *order).withColumn("__part", F.spark_partition_id())
    return staged(cut, "test-ranges")


@pytest.mark.parametrize("parts", [1, 3, 40])
@pytest.mark.parametrize("apart", [1, 100_000])
def test_running_sums_equal_a_plain_window(spark, skewed, rows, parts, apart):
    """However the ranges fall, and however sparse the ids are."""
    lines = skewed.withColumn("line_id", F.col("line_id") * apart)
    whole = Window.partitionBy("order_id").orderBy("line_id").rowsBetween(Window.unboundedPreceding, 0)
    plain = lines.withColumns({"total": F.sum("amount").over(whole), "n": F.count("*").over(whole)})
    stage = lambda ranged: by_range(spark, ranged.drop("__part"), "order_id", ["line_id"], parts)
    found = running_sums(lines.withColumn("one", F.lit(1)), "order_id", ["line_id"], {"total": "amount", "n": "one"}, stage)
    assert rows(found.drop("one")) == rows(plain)


def test_a_huge_order_of_sparse_ids_lies_in_many_ranges(spark):
    lines = spark.range(20_000).select(F.lit(7).alias("order_id"), (F.col("id") * 99_991).alias("line_id"), F.lit(1).alias("amount"))
    ranged = by_range(spark, lines, "order_id", ["line_id"], 16)
    assert max(r["count"] for r in ranged.groupBy("__part").count().collect()) < 4_000


def test_running_sums_keep_rows_without_a_group(spark, rows):
    lines = spark.createDataFrame([(None, 1, 5), (None, 2, 6), (1, 1, 2)], "order_id bigint, line_id bigint, amount bigint")
    found = running_sums(lines, "order_id", ["line_id"], {"total": "amount"})
    assert rows(found) == [(1, 1, 2, 2), (None, 1, 5, 5), (None, 2, 6, 11)]


def brute_force(lines):
    """Allocation line by line, in plain Python."""
    result, sums = {}, {}
    for order, line, amount, payment, total in sorted(lines):
        origin, split, count = sums.get(order, (0, 0, 0))
        share = (2 * payment * amount + total) // (2 * total)
        part = share
        if origin + amount == total:
            part = payment - split if amount > 0 or count == 0 else 0
        sums[order] = (origin + amount, split + part, count + 1)
        result[order, line] = part
    return result


@pytest.mark.parametrize("scale", [1, 10**9])
def test_allocation_equals_brute_force(spark, scale):
    """Also for amounts of ten thousand million and more."""
    generator = random.Random(11)
    lines = []
    for order, count in [(7, 600)] + [(k, generator.randrange(1, 6)) for k in range(100, 400)]:
        amounts = [generator.choice([0, generator.randrange(1, 5000) * scale]) for _ in range(count)]
        total = max(1, sum(amounts) - generator.choice([0, 0, 0, amounts[-1], 17 * scale, -30 * scale]))
        payment = generator.randrange(0, 2 * total)
        lines += [(order, i, a, payment, total) for i, a in enumerate(amounts)]
    frame = spark.createDataFrame(
        lines, "order_id bigint, line_id bigint, line_cents bigint, payment_cents bigint, total_cents bigint"
    )
    found = allocate_payment(frame)
    assert {(r.order_id, r.line_id): r.allocated_cents for r in found.collect()} == brute_force(lines)


def test_parts_of_complete_orders_add_up(spark):
    paid = wide_orders._allocated(spark, SMALL).groupBy("order_id").agg(
        F.sum("allocated_cents").alias("parts"), F.first("payment_cents").alias("payment")
    )
    assert paid.filter("parts <> payment").count() == 0
    assert paid.count() > 1000


def test_one_first_order_per_user(spark):
    flags = orders.order_first_flag(spark, SMALL).groupBy("user_id").agg(F.count_if(F.col("if_first_order") == "1").alias("n"))
    assert flags.filter("n <> 1").count() == 0


def test_one_event_per_day_and_device(spark):
    assert daily_active.dau_first_events(spark, SMALL).groupBy("dt", "mid").count().filter("count > 1").count() == 0


def test_first_per_key_is_limited_before_the_shuffle(spark, skewed):
    steps = plan(first_per_key(skewed, ["order_id"], ["line_id"])).split("\n")
    shuffle = next(i for i, step in enumerate(steps) if "Exchange" in step)
    assert any("WindowGroupLimit" in step and "Partial" in step for step in steps[shuffle:])


def test_flag_does_not_shuffle_all_orders_by_user(spark):
    """Only the limited rows go to the user's task; the whole rows meet their flag by order id."""
    batch = spark.range(100_000).select(
        "id", (F.col("id") % 3).alias("user_id"), F.lit("t").alias("create_time"), F.col("id").alias("payload")
    )
    steps = plan(with_first_flag(batch)).split("\n")
    by_user = [i for i, step in enumerate(steps) if "Exchange hashpartitioning(user_id" in step]
    assert len(by_user) == 1
    assert "WindowGroupLimit" in steps[by_user[0] + 1] and "Partial" in steps[by_user[0] + 1]
    assert not any("payload" in step for step in steps[by_user[0] :])


def test_interval_join_splits_a_key_along_time(spark):
    left = spark.range(10).select(F.lit(1).alias("k"), F.timestamp_seconds("id").alias("a"))
    right = spark.range(10).select(F.lit(1).alias("r"), F.timestamp_seconds("id").alias("b"))
    steps = plan(interval_join(left, right, {"k": "r"}, "a", "b", 2))
    assert "__bucket" in steps and "CartesianProduct" not in steps and "NestedLoop" not in steps


QUERIES = {**daily_active.registry.queries, **orders.registry.queries, **wide_orders.registry.queries, **texts.registry.queries}


@pytest.mark.parametrize("name", sorted(set(QUERIES)))
def test_no_cross_join_and_no_single_row_group(spark, name):
    steps = plan(QUERIES[name](spark, SMALL))
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "collect_list"):
        assert forbidden not in steps


def test_filters_and_columns_reach_the_scan(spark):
    steps = plan(texts.document_by_id(spark, SMALL))
    assert "EqualTo(doc_id,42)" in steps
    scan = next(s for s in plan(daily_active.dau_daily_count(spark, SMALL)).split("\n") if "FileScan" in s)
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in scan
