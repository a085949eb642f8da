"""Change-data-capture envelopes to `topic, value` rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.keys import source_topic

# Tables the single-row envelope lets through, and the change type facts must have.
FACT_TABLES = ["order_info", "order_detail"]
DIMENSION_TABLES = ["base_province", "user_info", "sku_info", "base_trademark", "base_category3", "spu_info"]
FACT_CHANGE = "insert"
ARRAY_CHANGE = "INSERT"


def _change(value: str, data: str) -> Column:
    """The parsed envelope as a one-element array: used inside a generator, a message is parsed once."""
    return F.array(F.from_json(F.col(value).cast("string"), f"type STRING, table STRING, data {data}"))


def route_array_envelope(messages: DataFrame, value: str = "value") -> DataFrame:
    """`{type, table, data: [..]}`: one row per element of `data` for upper-case inserts of any table."""
    inserts = F.filter(_change(value, "ARRAY<STRING>"), lambda c: c["type"] == ARRAY_CHANGE)
    routed = F.transform(
        inserts,
        lambda c: F.transform(
            c["data"], lambda row: F.struct(source_topic(c["table"]).alias("topic"), row.alias("value"))
        ),
    )
    return messages.select(F.inline(F.flatten(routed)))


def route_single_envelope(messages: DataFrame, value: str = "value", drop_deletes: bool = False) -> DataFrame:
    """`{type, table, data: {..}}`: facts on insert, dimensions on any change, nothing else, no empty data."""

    def wanted(change: Column) -> Column:
        kind, table = change["type"], change["table"]
        routed = (table.isin(FACT_TABLES) & (kind == FACT_CHANGE)) | table.isin(DIMENSION_TABLES)
        if drop_deletes:
            routed = routed & (kind != "delete")
        return routed & (F.size(F.json_object_keys(change["data"])) > 0)

    routed = F.transform(
        F.filter(_change(value, "STRING"), wanted),
        lambda c: F.struct(source_topic(c["table"]).alias("topic"), c["data"].alias("value")),
    )
    return messages.select(F.inline(routed))
