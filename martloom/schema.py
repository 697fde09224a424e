"""Declared schemas without a running session."""

from __future__ import annotations

from pyspark.sql.types import (
    BinaryType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, StringType, StructType,
    TimestampNTZType, TimestampType,
)

LONG, INT, TEXT, DOUBLE = LongType(), IntegerType(), StringType(), DoubleType()
DATE, TS, TS_NTZ, BYTES = DateType(), TimestampType(), TimestampNTZType(), BinaryType()
AMOUNT = DecimalType(18, 2)


def record(**fields: DataType) -> StructType:
    out = StructType()
    for name, dtype in fields.items():
        out.add(name, dtype)
    return out
