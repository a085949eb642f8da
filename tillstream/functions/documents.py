"""JSON text to records and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType

MALFORMED = "__malformed"


def _as_text(kind: DataType) -> DataType:
    """The type with text in the place of every scalar."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_as_text(kind.elementType))
    if isinstance(kind, MapType):
        return MapType(StringType(), _as_text(kind.valueType))
    return StringType()


def _from_text(value: Column, kind: DataType) -> Column:
    """A value read as text, in its own type; scalars that do not fit it are null."""
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*[_from_text(value[f.name], f.dataType).alias(f.name) for f in kind.fields]))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda item: _from_text(item, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda _, item: _from_text(item, kind.valueType))
    return value if isinstance(kind, StringType) else value.try_cast(kind)


def _record(schema: StructType, value: str) -> Column:
    read = StructType([*_as_text(schema).fields, StructField(MALFORMED, StringType())])
    return F.from_json(F.col(value).cast("string"), read, {"columnNameOfCorruptRecord": MALFORMED})


def parse_records(messages: DataFrame, schema: StructType, value: str = "value", keep: tuple[str, ...] = ()) -> DataFrame:
    """One typed record per well-formed message, by field name; unknown fields are ignored, absent ones are null.

    Numbers may come as text ("1" as well as 1). What is no JSON object gives no record: see `malformed_messages`.
    """
    # out of a generator, which the filter stays above: a message is parsed once, not again for every use of its record
    rows = messages.select(*keep, F.explode(F.array(_record(schema, value))).alias("record"))
    rows = rows.where(F.col("record").isNotNull() & F.col(f"record.{MALFORMED}").isNull())
    return rows.select(*keep, *[_from_text(F.col("record")[f.name], f.dataType).alias(f.name) for f in schema.fields])


def malformed_messages(messages: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """The messages that give no record, as they came."""
    record = _record(schema, value)
    return messages.where(record.isNull() | record[MALFORMED].isNotNull())


def dynamic(value: Column) -> Column:
    """JSON text as a schemaless value; null when it is not JSON."""
    return F.try_parse_json(value.cast("string"))


def field(document: Column, path: str, kind: str = "string") -> Column:
    """A (nested) field of a schemaless value; null when absent or of another kind."""
    return F.try_variant_get(document, f"$.{path}", kind)


def record_json(*columns: str) -> Column:
    """The row, or the named columns, as JSON text without its null fields."""
    return F.to_json(F.struct(*(columns or ("*",))))
