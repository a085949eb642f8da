"""What change records are made of: fields and types per source table, and where they left a known schema.

Records are read as schemaless values. Their fields are summed per (table, field) before the shuffle, so what is shuffled are
fields, not records, whatever a table's share of the records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from tillstream.functions.documents import dynamic


def _kind(schema: Column) -> Column:
    """A type without its size: DECIMAL(7,2) is DECIMAL, OBJECT<..> is OBJECT. Text next to numbers is VARIANT."""
    return F.regexp_extract(schema, r"^[A-Z_]+", 0)


def record_fields(messages: DataFrame, table: str, value: str = "value") -> DataFrame:
    """(source_table, field, kind, n_records, n_filled): the merged type of a field, the records that name it, those with a value.

    `kind` is null for a field that never has a value. What is no JSON object has no fields.
    """
    spark = messages.sparkSession
    parsed = messages.select(F.col(table).alias("source_table"), dynamic(F.col(value)).alias("document"))
    parsed = parsed.where(F.schema_of_variant("document").startswith("OBJECT"))
    each = spark.tvf.variant_explode(F.col("document").outer())
    fields = parsed.lateralJoin(each).select("source_table", F.col("key").alias("field"), F.col("value").alias("item"))
    filled = ~F.is_variant_null("item")
    found = fields.groupBy("source_table", "field").agg(
        F.schema_of_variant_agg(F.when(filled, F.col("item"))).alias("schema"),
        F.count(F.lit(1)).alias("n_records"),
        F.count_if(filled).alias("n_filled"),
    )
    kind = F.when(F.col("n_filled") > 0, _kind(F.col("schema")))
    return found.select("source_table", "field", kind.alias("kind"), "n_records", "n_filled")


# The kinds of JSON values that a column's type reads without loss.
READABLE = {
    "bigint": ["BIGINT"],
    "double": ["BIGINT", "DECIMAL", "DOUBLE"],
    "string": ["STRING"],
}


def declared_fields(spark: SparkSession, schemas: dict[str, StructType]) -> DataFrame:
    """(source_table, field, type) of known schemas; as many rows as they have fields."""
    rows = [(table, f.name, f.dataType.simpleString()) for table, schema in schemas.items() for f in schema.fields]
    return spark.createDataFrame(rows, "source_table string, field string, type string")


def field_drift(found: DataFrame, declared: DataFrame) -> DataFrame:
    """(source_table, field, type, kind, drift) of the fields that are `new`, `missing` or `changed`; tables of no schema are left out."""
    readable = F.lit(False)
    for kind, kinds in READABLE.items():
        readable = readable | ((F.col("type") == kind) & F.col("kind").isin(kinds))
    drift = (
        F.when(F.col("type").isNull(), "new")
        .when(F.col("n_records").isNull(), "missing")
        .when(F.col("kind").isNotNull() & ~readable, "changed")
    )
    known = found.join(declared.select("source_table").distinct(), "source_table", "left_semi")
    both = known.join(declared, ["source_table", "field"], "full").withColumn("drift", drift)
    return both.where("drift IS NOT NULL").select("source_table", "field", "type", "kind", "drift")
