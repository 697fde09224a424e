"""Readers for stored files. Schemas are always declared, never inferred."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from martloom.operators.ranking import latest_per_key
from martloom.operators.rows import with_event


def read_files(spark: SparkSession, path: str, fmt: str, schema: StructType | str,
               **options: str) -> DataFrame:
    """Files in object storage (or any Hadoop path) with a fixed schema."""
    return spark.read.schema(schema).options(**options).format(fmt).load(path)


def read_documents(spark: SparkSession, path: str,
                   schema: StructType | None = None) -> DataFrame:
    """One JSON document per line.

    The untouched text stays in ``payload``. With a schema the known fields land
    in ``doc`` (broken documents have a null ``doc``); without one the whole
    document becomes a VARIANT to be queried by path later.
    """
    lines = spark.read.text(path).withColumnRenamed("value", "payload")
    if schema is None:
        return lines.withColumn("doc", F.try_parse_json("payload"))
    return with_event(lines, schema, "payload").withColumnRenamed("event", "doc")


def lake_window(day: dt.date, depth: int) -> tuple[dt.date, dt.date]:
    """First and last day of a look-back of ``depth`` days that ends at ``day``."""
    if depth < 1:
        raise ValueError("depth counts days and must be at least 1")
    return day - dt.timedelta(days=depth - 1), day


def read_lake(spark: SparkSession, path: str, schema: StructType | str, day: dt.date, depth: int = 1,
              day_col: str = "event_date", undated: bool = False) -> DataFrame:
    """Partitions of ``depth`` days up to ``day``, with ``undated`` also that of rows
    without a day; other folders are not opened."""
    first, last = lake_window(day, depth)
    wanted = F.col(day_col).between(F.lit(first), F.lit(last))
    return spark.read.schema(schema).parquet(path).filter(wanted | F.col(day_col).isNull() if undated else wanted)


def read_lookup(spark: SparkSession, path: str, schema: StructType | str, key: str,
                order_col: str | None = None) -> DataFrame:
    """Key-value snapshot with one row per key.

    With ``order_col`` the newest row of a key wins; without it the snapshot is
    taken to hold equal rows only when it repeats a key.
    """
    snapshot = spark.read.schema(schema).parquet(path)
    if order_col:
        return latest_per_key(snapshot, [key], [order_col])
    return snapshot.dropDuplicates([key])
