"""Parallel database reads and writes through Spark's JDBC source.

The driver jar comes from the user (``--jars``); nothing here opens a
connection before an action runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, part_col: str, lo: int | str, hi: int | str,
                 n: int, fetch_size: int = 10_000, **extra: str) -> dict[str, str]:
    """Options for ``n`` range queries over ``part_col``.

    The bounds only set the stride. Rows outside them are still read, by the
    first and the last query, so wrong bounds cost balance but never rows.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": part_col,
        "lowerBound": str(lo),
        "upperBound": str(hi),
        "numPartitions": str(n),
        "fetchsize": str(fetch_size),
        **extra,
    }


def read_table(spark: SparkSession, url: str, table: str, part_col: str,
               lo: int | str, hi: int | str, n: int, **extra: str) -> DataFrame:
    return spark.read.format("jdbc").options(
        **jdbc_options(url, table, part_col, lo, hi, n, **extra)
    ).load()


def append_table(df: DataFrame, url: str, table: str, **extra: str) -> None:
    df.write.format("jdbc").options(url=url, dbtable=table, **extra).mode("append").save()
