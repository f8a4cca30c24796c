"""Declared table shapes and the drift guard every write goes through.

Identifiers default to 32-bit integers. A lake with more than 2^31 orders asks for
``IDS_WIDE``: the same shapes with 64-bit identifiers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

IDS_NARROW = T.IntegerType()
IDS_WIDE = T.LongType()

_INT, _FLOAT, _STR, _DATE = T.IntegerType(), T.FloatType(), T.StringType(), T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


def customer_schema(ids: T.DataType = IDS_NARROW) -> T.StructType:
    return _struct(("id", ids), ("name", _STR), ("country", _STR))


def order_schema(ids: T.DataType = IDS_NARROW) -> T.StructType:
    return _struct(("id", ids), ("id_customer", ids), ("total", _FLOAT), ("date", _STR), ("product_id", ids))


def order_item_schema(ids: T.DataType = IDS_NARROW) -> T.StructType:
    return _struct(("id_order", ids), ("seq", _INT), ("desc_item", _STR), ("qty", _INT), ("total_item", _FLOAT))


def product_schema(ids: T.DataType = IDS_NARROW) -> T.StructType:
    return _struct(
        ("product_id", ids), ("name", _STR), ("unit_price", _FLOAT), ("category_id", _INT), ("category_name", _STR)
    )


def silver_schema(ids: T.DataType = IDS_NARROW) -> T.StructType:
    return _struct(
        ("customer_name", _STR),
        ("country", _STR),
        ("customer_id", ids),
        ("order_id", ids),
        ("order_total", _FLOAT),
        ("order_date", _DATE),
        ("product_id", ids),
        ("product_name", _STR),
        ("product_category_id", _INT),
        ("category_name", _STR),
        ("item_seq", _INT),
        ("item_description", _STR),
        ("item_quantity", _INT),
        ("item_total", _FLOAT),
    )


def gold_schema(ids: T.DataType = IDS_NARROW) -> T.StructType:
    return _struct(
        ("customer_name", _STR),
        ("country", _STR),
        ("order_date", _DATE),
        ("product_id", ids),
        ("product_name", _STR),
        ("product_category_id", _INT),
        ("category_name", _STR),
        ("total_quantity", T.LongType()),
        ("total_value", T.DoubleType()),
        ("total_orders", T.LongType()),
    )


ISSUE = T.ArrayType(
    T.StructType(
        [
            T.StructField("name", _STR),
            T.StructField("message", _STR),
            T.StructField("columns", T.ArrayType(_STR)),
            T.StructField("metadata", T.MapType(_STR, _STR)),
        ]
    )
)


def quarantine_schema(ids: T.DataType = IDS_NARROW) -> T.StructType:
    return T.StructType([*order_schema(ids).fields, T.StructField("_errors", ISSUE), T.StructField("_warnings", ISSUE)])


class SchemaDrift(ValueError):
    """A frame's columns differ from the declared shape of its table."""


def check_schema(df: DataFrame, expected: T.StructType, what: str = "table") -> DataFrame:
    """Return ``df`` in declared column order, or raise when names or types differ.

    Column order and nullability may differ; added, missing, renamed and retyped columns may not.
    Nested types are compared without nullability and metadata.
    """
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    want = {f.name: f.dataType.simpleString() for f in expected.fields}
    problems = [f"unexpected column {c} {have[c]}" for c in have if c not in want]
    problems += [f"missing column {c} {want[c]}" for c in want if c not in have]
    problems += [f"column {c} is {have[c]}, declared {want[c]}" for c in want if c in have and have[c] != want[c]]
    if len(have) != len(df.schema.fields):
        problems.append("duplicate column names")
    if problems:
        raise SchemaDrift(f"{what}: " + "; ".join(problems))
    return df.select(*want)
