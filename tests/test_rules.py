"""The rules of the records, case by case."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from tillstream import schemas
from tillstream.functions import money, people, text, times
from tillstream.functions.documents import dynamic, field, malformed_messages, parse_records, record_json
from tillstream.functions.keys import as_id, joined
from tillstream.operators import lookups
from tillstream.operators.allocation import allocate_payment, allocation_state
from tillstream.operators.changes import route_array_envelope, route_single_envelope
from tillstream.operators.dimensions import sku_records, trademark_records
from tillstream.operators.first_orders import status_updates, with_first_flag
from tillstream.operators.intervals import interval_join, without_partner
from tillstream.operators.keyed import first_per_key, latest_per_key
from tillstream.operators.offsets import ledger_rows, offset_ranges, start_position
from tillstream.operators.search import by_id, search
from tillstream.operators.totals import brand_totals
from tillstream.operators.wide import join_lines, wide_records


def value_of(spark, column, **inputs):
    names = list(inputs) or ["unused"]
    return spark.createDataFrame([tuple(inputs.values()) or (0,)], names).select(column).first()[0]


def messages(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) or v is None else json.dumps(v),) for v in values], "value string")


def test_rounding(spark):
    assert value_of(spark, money.round_half_up(F.col("x")), x=1.005) == 1.0
    assert value_of(spark, money.round_half_up(F.col("x")), x=2.675) == 2.68
    assert value_of(spark, money.round_half_up(F.col("x")), x=-1.5) == -1.5
    assert value_of(spark, money.cents(F.col("x")), x=0.29) == 29


def test_times(spark):
    assert value_of(spark, times.day_of_millis(F.col("t")), t=1704067207179) == "2024-01-01"
    assert value_of(spark, times.hour_of_millis(F.col("t")), t=1704067207179) == "00"
    assert value_of(spark, times.date_part(F.col("t")), t="2020-10-27 14:30:20") == "2020-10-27"
    assert value_of(spark, times.hour_part(F.col("t")), t="2020-10-27 14:30:20") == "14"
    assert value_of(spark, times.hour_part(F.col("t")), t="2020-10-27") is None


@pytest.mark.parametrize("age, label", [(19, "20岁及以下"), (20, "21岁到30岁"), (30, "21岁到30岁"), (31, "30岁以上")])
def test_age_groups(spark, age, label):
    assert value_of(spark, people.age_group(F.col("a")), a=age) == label


def test_age_and_gender(spark):
    born = people.birthday(F.lit("2000-01-01"))
    assert value_of(spark, people.age_years(born, F.lit(dt.date(2019, 12, 27)))) == 20  # 20 * 365 days
    assert value_of(spark, people.age_years(born, F.lit(dt.date(2019, 12, 26)))) == 19
    assert value_of(spark, people.birthday(F.lit("no date"))) is None
    for gender, label in [("M", "男"), ("F", "女"), (None, "女")]:
        assert value_of(spark, people.gender_name(F.lit(gender))) == label


def test_array_envelope(spark, rows):
    two = [{"id": "1"}, {"id": "2"}]
    routed = route_array_envelope(
        messages(
            spark,
            {"type": "INSERT", "table": "anything", "data": two},
            {"type": "UPDATE", "table": "anything", "data": two},
            {"type": "insert", "table": "anything", "data": two},
            {"type": "INSERT", "table": "anything", "data": None},
            "not json",
        )
    )
    assert rows(routed) == [("ods_anything", '{"id":"1"}'), ("ods_anything", '{"id":"2"}')]


def test_single_envelope(spark, rows):
    kinds = [
        ("order_info", "insert", {"id": 1}),
        ("order_info", "bootstrap-insert", {"id": 2}),
        ("order_detail", "update", {"id": 3}),
        ("base_province", "delete", {"id": 4}),
        ("coupon", "insert", {"id": 5}),
        ("user_info", "update", {}),
        ("user_info", "update", None),
        ("spu_info", "bootstrap-insert", {"id": 6, "deep": {"a": [1.50]}}),
    ]
    source = messages(spark, *[{"type": k, "table": t, "data": d} for t, k, d in kinds])
    expected = [
        ("ods_base_province", '{"id": 4}'),
        ("ods_order_info", '{"id": 1}'),
        ("ods_spu_info", '{"id": 6, "deep": {"a": [1.5]}}'),
    ]
    plain = lambda found: [(t, json.loads(v)) for t, v in found]
    assert plain(rows(route_single_envelope(source))) == plain(expected)
    assert plain(rows(route_single_envelope(source, drop_deletes=True))) == plain(expected[1:])


def test_records_ignore_unknown_fields(spark):
    found = parse_records(messages(spark, {"id": "7", "spu_name": "x", "more": 1}, {"id": "8"}, "broken"), schemas.SPU)
    assert {tuple(r) for r in found.collect()} == {("7", "x"), ("8", None)}
    assert [r.value for r in malformed_messages(messages(spark, {"id": "7"}, "broken", "5"), schemas.SPU).collect()] == ["broken", "5"]


def test_numbers_as_text_are_numbers(spark):
    shape = StructType.fromDDL("id BIGINT, amount DOUBLE, name STRING, inner STRUCT<n: INT, all: ARRAY<BIGINT>>")
    found = parse_records(
        messages(spark, {"id": "1", "amount": "100.5", "name": 7, "inner": {"n": "2", "all": ["3", 4, "x"]}}, {"id": "none"}), shape
    )
    assert [r.asDict(True) for r in found.collect()] == [
        {"id": 1, "amount": 100.5, "name": "7", "inner": {"n": 2, "all": [3, 4, None]}},
        {"id": None, "amount": None, "name": None, "inner": None},
    ]


def test_dynamic_fields(spark):
    source = messages(spark, {"common": {"mid": "m1"}, "ts": 5}, "broken").select(dynamic(F.col("value")).alias("d"))
    found = source.select(field(F.col("d"), "common.mid"), field(F.col("d"), "ts", "bigint"), field(F.col("d"), "x")).collect()
    assert [tuple(r) for r in found] == [("m1", 5, None), (None, None, None)]


def test_json_leaves_nulls_out(spark):
    assert spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, struct('x' AS c) AS d").select(record_json()).first()[0] == (
        '{"a":1,"d":{"c":"x"}}'
    )


def test_ids_and_lists(spark):
    assert value_of(spark, as_id(F.lit("12"))) == 12
    assert value_of(spark, as_id(F.lit("x"))) is None
    assert value_of(spark, joined(F.array(F.lit("a"), F.lit("b")), "','")) == "a','b"


def test_first_event_of_a_day(spark, rows):
    events = spark.createDataFrame(
        [("m1", "d1", 8), ("m1", "d1", 9), ("m1", "d2", 0), ("m2", "d1", 8)], "mid string, dt string, ts int"
    )
    assert rows(first_per_key(events, ["dt", "mid"], ["ts"])) == [("m1", "d1", 8), ("m1", "d2", 0), ("m2", "d1", 8)]


def test_latest_version(spark, rows):
    versions = spark.createDataFrame([(1, 1, "old"), (1, 2, "new"), (2, None, "only")], "id int, n int, name string")
    assert rows(latest_per_key(versions, ["id"], ["n"])) == [(1, 2, "new"), (2, None, "only")]


def orders(spark, *values):
    return spark.createDataFrame(values, "id bigint, user_id bigint, create_time string")


def test_first_order_in_batch(spark, rows):
    batch = orders(spark, (1, 7, "10:02"), (2, 7, "10:01"), (5, 8, "10:00"), (4, 8, "10:00"), (6, 9, "10:00"), (7, 9, "11:00"))
    known = spark.createDataFrame([("9", "1")], "user_id string, if_consumed string")
    flagged = with_first_flag(batch, known)
    assert rows(flagged.select("id", "if_first_order")) == [(1, "0"), (2, "1"), (4, "1"), (5, "0"), (6, "0"), (7, "0")]
    assert rows(status_updates(flagged)) == [("7", "1", 2), ("8", "1", 4)]


def test_lookup_without_match_keeps_the_order(spark, rows):
    provinces = spark.createDataFrame([("1", "North", "10", "N-1")], schemas.PROVINCE)
    batch = spark.createDataFrame([(1, 1), (2, 99), (3, None)], "id bigint, province_id bigint")
    assert rows(lookups.with_province(batch, provinces)) == [
        (1, 1, "North", "10", "N-1"), (2, 99, None, None, None), (3, None, None, None, None),
    ]


def test_sku_names_and_ids(spark, rows):
    sku = [("1", "s1", "9.5", "phone", "t1", "c1", None), ("2", "2", "1", "case", "3", "4", None)]
    products = sku_records(
        spark.createDataFrame(sku, schemas.SKU),
        spark.createDataFrame([("4", "cases", "0")], schemas.CATEGORY3),
        trademark_records(spark.createDataFrame([("3", "A_B")], schemas.TRADEMARK)),
        spark.createDataFrame([("2", "covers")], schemas.SPU),
    )
    details = spark.createDataFrame([(1, 1), (2, 2), (3, 5)], "id bigint, sku_id bigint")
    found = lookups.with_sku(details, products).select("id", "spu_id", "tm_id", "category3_id", "spu_name", "tm_name", "category3_name")
    assert rows(found) == [
        (1, None, None, None, None, None, None),  # ids that are no numbers
        (2, 2, 3, 4, "covers", "A_B", "cases"),
        (3, None, None, None, None, None, None),
    ]
    assert {r.id for r in lookups.rows_in_use(products, "id", details, "sku_id").collect()} == {"1", "2"}


def lines(spark, payment, total, amounts, order=1, first=1):
    values = [(order, first + i, a, payment, total) for i, a in enumerate(amounts)]
    return spark.createDataFrame(
        values, "order_id bigint, line_id bigint, line_cents bigint, payment_cents bigint, total_cents bigint"
    )


@pytest.mark.parametrize(
    "payment, total, amounts, parts",
    [
        (10000, 9000, [3000, 3000, 3000], [3333, 3333, 3334]),
        (999, 1200, [1200], [999]),
        (10000, 9000, [3000, 3000], [3333, 3333]),
        (10000, 6000, [3000, 3000, 3000], [5000, 5000, 5000]),  # complete at the second of three lines
        (1000, 3000, [1000, 2000, 0], [333, 667, 0]),
        (1000, 3000, [0, 1000, 2000], [0, 333, 667]),
        (500, 0, [0, 0], [500, 0]),
        (500, 0, [100], [None]),
    ],
)
def test_allocation(spark, payment, total, amounts, parts):
    found = allocate_payment(lines(spark, payment, total, amounts)).orderBy("line_id").collect()
    assert [r.allocated_cents for r in found] == parts


def test_allocation_goes_on_in_the_next_batch(spark):
    first = allocate_payment(lines(spark, 10000, 9000, [3000, 3000]))
    state = allocation_state(first)
    assert [tuple(r) for r in state.collect()] == [(1, 6000, 6666, 2)]
    second = allocate_payment(lines(spark, 10000, 9000, [3000], first=3), state)
    assert [r.allocated_cents for r in second.collect()] == [3334]
    assert [tuple(r) for r in allocation_state(second, state).collect()] == [(1, 9000, 10000, 3)]


def test_wide_record(spark):
    order = spark.createDataFrame([(1, "1001", 7, "2020-01-01", 9.5)], "id bigint, order_status string, user_id bigint, create_date string, final_total_amount double")
    for item in schemas.ENRICHED_ORDER_INFO.fields:
        if item.name not in order.columns:
            order = order.withColumn(item.name, F.lit(None).cast(item.dataType))
    detail = spark.createDataFrame([(5, 1, 3, 2.5, 2)], "id bigint, order_id bigint, sku_id bigint, order_price double, sku_num bigint")
    for item in schemas.ENRICHED_ORDER_DETAIL.fields:
        if item.name not in detail.columns:
            detail = detail.withColumn(item.name, F.lit(None).cast(item.dataType))
    wide = wide_records(join_lines(order, detail))
    assert wide.columns == schemas.ORDER_WIDE.fieldNames() and len(wide.columns) == 26
    found = wide.first()
    assert (found.order_id, found.order_detail_id, found.dt, found.sku_price) == (1, 5, "2020-01-01", 2.5)
    assert (found.tm_id, found.feight_fee, found.final_detail_amount, found.tm_name) == (0, 0.0, 0.0, None)


def test_brand_names_stay_whole(spark, rows):
    wide = spark.createDataFrame([(1, "A_B", 1.1), (1, "A_B", 2.2), (1, "A", 5.0), (2, "", 1.0)], "tm_id bigint, tm_name string, final_detail_amount double")
    totals = brand_totals(wide, F.lit("2024-01-01 00:00:00"))
    assert rows(totals.drop("stat_time")) == [(1, "A", 5.0), (1, "A_B", 3.3), (2, "", 1.0)]


def test_interval_bounds(spark, rows):
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    left = spark.createDataFrame([(1, at(0)), (2, at(100)), (3, at(39))], "o int, o_at timestamp")
    right = spark.createDataFrame([(1, at(20)), (2, at(79)), (3, at(20)), (3, at(58)), (3, at(60))], "d int, d_at timestamp")
    pairs = interval_join(left, right, {"o": "d"}, "o_at", "d_at", 20)
    assert rows(pairs.select("o", "d_at")) == [(1, at(20)), (3, at(20)), (3, at(58))]
    assert rows(without_partner(left, right, {"o": "d"}, "o_at", "d_at", 20).select("o")) == [(2,)]
    assert rows(without_partner(right, left, {"d": "o"}, "d_at", "o_at", 20).select("d", "d_at")) == [(2, at(79)), (3, at(60))]


def test_interval_join_before_1970(spark):
    at = lambda s: dt.datetime(1969, 12, 31, 23, 59, 50) + dt.timedelta(seconds=s)
    left = spark.createDataFrame([(1, at(s)) for s in range(0, 20)], "k int, l_at timestamp")
    right = spark.createDataFrame([(1, at(s)) for s in range(0, 20)], "r int, r_at timestamp")
    expected = sum(1 for a in range(20) for b in range(20) if abs(a - b) <= 3)
    assert interval_join(left, right, {"k": "r"}, "l_at", "r_at", 3).count() == expected


def test_offsets(spark, rows):
    source = spark.createDataFrame([("t", 0, 5), ("t", 0, 7), ("t", 1, 2), ("u", 0, 1)], "topic string, partition int, offset bigint")
    ranges = offset_ranges(source)
    assert rows(ranges) == [("t", 0, 5, 8), ("t", 1, 2, 3), ("u", 0, 1, 2)]
    ledger = ledger_rows(ranges, "g")
    assert json.loads(start_position(ledger, "t", "g")) == {"t": {"0": 8, "1": 3}}
    assert start_position(ledger, "t", "other") == "latest"


def test_tokens():
    assert text.query_tokens("The 天龙 the-X2") == ["the", "天", "龙", "x2"]
    assert text.query_tokens(" - ") == []


@pytest.mark.parametrize(
    "document, query, hit, marked",
    [
        ("The sea, the Sea", "sea", True, "The <em>sea</em>, the <em>Sea</em>"),
        ("overseas", "sea", False, "overseas"),
        ("天龙八部", "天龙", True, "<em>天</em><em>龙</em>八部"),
        ("été chaud", "ÉTÉ", True, "<em>été</em> chaud"),
        ("x天y", "y", True, "x天<em>y</em>"),
        ("anything", "", False, "anything"),
    ],
)
def test_match_and_highlight(spark, document, query, hit, marked):
    assert value_of(spark, text.matches(F.col("t"), query), t=document) is hit
    assert value_of(spark, text.highlight(F.col("t"), query), t=document) == marked


def test_search_page_with_nested_term(spark, rows):
    films = spark.createDataFrame(
        [
            (1, "sea one", 8.0, [(1, "ann")]),
            (2, "sea two", 9.0, [(1, "ann"), (2, "bob")]),
            (3, "land", 9.5, [(1, "ann")]),
            (4, "sea four", 7.0, [(2, "bob")]),
            (5, "sea five", 6.0, None),
        ],
        "id bigint, name string, score double, actors array<struct<id: bigint, name: string>>",
    )
    only = text.has_nested_term(F.col("actors"), "name", "ann")
    found = search(films, "name", "Sea", only, [F.col("score").desc()], 0, 20, "marked")
    assert [(r.id, r.marked) for r in found.collect()] == [(2, "<em>sea</em> two"), (1, "<em>sea</em> one")]
    assert [r.id for r in search(films, "name", "sea", None, [F.col("score")], 1, 2).collect()] == [4, 1]
    assert by_id(films, "id", 3).first().name == "land"
