"""Layouts of stored tables: clustered by key, and compacted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from martloom.session import stored

#: Bytes that a file of a compacted lake should have.
FILE_BYTES = 128 << 20


def cluster(df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Store ``df`` under ``path`` as a table of the catalog, bucketed and sorted by ``keys``.

    Tables of the same number of buckets by the same keys are joined, and each is grouped,
    without a shuffle: the layout is paid for once, when it is written.
    """
    # One task per bucket, or each task would write a file for each of them.
    spread = df.repartition(buckets, *keys)
    (spread.write.mode("overwrite").format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


def file_sizes(spark: SparkSession, path: str, schema: StructType, parts: Sequence[str]) -> DataFrame:
    """(parts, files, bytes) of a lake stored by ``parts``, from the files' metadata."""
    rows = spark.read.schema(schema).parquet(path)
    files = rows.select(*parts, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes")).distinct()
    return files.groupBy(*parts).agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))


def _same(parts: Sequence[str], other: str) -> Column:
    same = F.lit(True)
    for p in parts:
        same = same & F.col(p).eqNullSafe(F.col(f"{other}{p}"))
    return same


def compact(spark: SparkSession, path: str, schema: StructType, parts: Sequence[str], sort: Sequence[str] = (),
            file_bytes: int = FILE_BYTES) -> DataFrame:
    """Rewrite, in place, the folders of a lake that have more files than their bytes need,
    and tell which: (parts, files, bytes) before.

    A folder that needs several files is spread over as many tasks, so a hot folder is not
    one task; rows of a file are sorted by ``sort``. Other folders are not rewritten. New
    files are moved in when all are written: a job that dies before leaves the old ones.
    """
    sizes = file_sizes(spark, path, schema, parts)
    needed = F.ceil(F.col("bytes") / file_bytes)
    crowded = stored(sizes.filter(F.col("files") > needed), "crowded")
    wanted = crowded.select(*[F.col(p).alias(f"_c_{p}") for p in parts], needed.alias("_files"))
    # As many rows as folders; Spark broadcasts them while they are few and prunes by them.
    rows = spark.read.schema(schema).parquet(path).join(wanted, _same(parts, "_c_"))
    piece = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col("_files"))
    tasks = crowded.agg(F.sum(needed).cast("int")).first()[0] or 1
    spread = rows.withColumn("_piece", piece).repartition(tasks, *parts, "_piece").drop("_files", *[f"_c_{p}" for p in parts])
    (spread.sortWithinPartitions(*parts, *sort).drop("_piece").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path))
    return crowded
