"""Row filters, projections and views."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

_BROKEN = "_broken"


def with_statuses(df: DataFrame, col: str, allowed: Iterable[str]) -> DataFrame:
    """Rows whose status is wanted; the filter reaches the file scan."""
    return df.filter(F.col(col).isin(*allowed))


def signed_amount(df: DataFrame, amount: str, is_refund: Column, name: str = "signed_amount") -> DataFrame:
    """Refunds count against revenue."""
    return df.withColumn(name, F.when(is_refund, -F.col(amount)).otherwise(F.col(amount)))


def computed_once(df: DataFrame, name: str, col: Column) -> DataFrame:
    """Add a costly column, such as parsed text, as the output of a generator.

    A plain column would be substituted into every filter and field access on it,
    also into the null filters the optimizer adds, and be computed for each.
    """
    return df.select("*", F.explode(F.array(col)).alias(name))


def with_event(df: DataFrame, schema: StructType, value: str = "value") -> DataFrame:
    """Envelopes with a column ``event``, null where the value does not fit the schema."""
    wider = StructType([*schema.fields, StructField(_BROKEN, StringType())])
    event = F.from_json(
        F.col(value).cast("string"), wider, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BROKEN}
    )
    parsed = computed_once(df, "event", event)
    fits = F.col("event").isNotNull() & F.col(f"event.{_BROKEN}").isNull()
    fields = F.struct(*[F.col(f"event.{name}") for name in schema.names])
    return parsed.select(*df.columns, F.when(fits, fields).alias("event"))


def parse_events(df: DataFrame, schema: StructType, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split envelopes into parsed rows and rows that do not fit the schema.

    The good side has the envelope columns and one column ``event``; the bad side
    is the envelope as received, to be stored and looked at.
    """
    parsed = with_event(df, schema, value)
    return parsed.filter("event IS NOT NULL"), parsed.filter("event IS NULL").select(*df.columns)


def is_active(start: str, end: str, now: Column) -> Column:
    """Live at ``now``: the start belongs to the interval, the end does not."""
    return (F.col(start) <= now) & (now < F.col(end))


def active_at(df: DataFrame, start: str, end: str, now: Column) -> DataFrame:
    return df.filter(is_active(start, end, now))


def create_views(spark: SparkSession, defs: Mapping[str, str | DataFrame]) -> None:
    """Temporary views from SQL texts or frames, in the order given."""
    for name, definition in defs.items():
        if isinstance(definition, DataFrame):
            definition.createOrReplaceTempView(name)
        else:
            spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {definition}")


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Exactly the columns, order and types of the target layer."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def add_with_default(df: DataFrame, col: str, default: object, dtype: str) -> DataFrame:
    """A column added to a running pipeline: history has the default.

    Works both for rows read without the column and for rows read with the new
    schema, where the column of old files is null.
    """
    filler = F.lit(default).cast(dtype)
    if col not in df.columns:
        return df.withColumn(col, filler)
    return df.withColumn(col, F.coalesce(F.col(col).cast(dtype), filler))
