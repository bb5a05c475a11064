"""The fixed table schemas and the strict check against them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

# Column names and types of the exchange files.
EVENTS = StructType(
    [
        StructField("PatientOrder", LongType()),
        StructField("NumDays", IntegerType()),
        StructField("WordIndex", IntegerType()),
        StructField("window", IntegerType()),
    ]
)
MATRIX = StructType(
    [
        StructField("i", IntegerType()),
        StructField("j", IntegerType()),
        StructField("count", LongType()),
    ]
)
MAPPING = StructType(
    [
        StructField("WordIndex", LongType()),
        StructField("Source", LongType()),
        StructField("Code", StringType()),
    ]
)
EMBEDDINGS = StructType(
    [
        StructField("i", IntegerType()),
        StructField("features", ArrayType(DoubleType())),
    ]
)


class SchemaError(ValueError):
    """A table does not have the required columns."""


def check_schema(df: DataFrame, expected: StructType, what: str) -> DataFrame:
    """Return ``df`` when names, order and types match; nullability and metadata are ignored."""
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in expected]
    if have != want:
        raise SchemaError(f"{what}: expected columns {want}, found {have}")
    return df
