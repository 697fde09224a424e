"""Checks on tables: profile, orphans, duplicates, equality as bags."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from martloom.operators.joins import without_known


def profile(df: DataFrame, exact: bool = True) -> DataFrame:
    """One row per column: rows, nulls, distinct values, least and greatest value.

    The exact form counts each value first and profiles the counts: every branch
    reads one column, and repeated values are merged before the shuffle. The
    approximate form is a single pass with one distinct-count sketch per column.
    """
    if exact:
        def one(c: str) -> DataFrame:
            values = df.groupBy(F.col(c).alias("v")).agg(F.count(F.lit(1)).alias("n"))
            return values.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
                F.coalesce(F.sum(F.when(F.col("v").isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
                F.count("v").alias("distinct_values"),
                F.min("v").cast("string").alias("min_value"),
                F.max("v").cast("string").alias("max_value"),
            ).select(F.lit(c).alias("column_name"), "*")

        return reduce(DataFrame.unionByName, [one(c) for c in df.columns])

    wide = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(c).alias(f"{c}#filled") for c in df.columns],
        *[F.approx_count_distinct(c).alias(f"{c}#distinct") for c in df.columns],
        *[F.min(c).cast("string").alias(f"{c}#min") for c in df.columns],
        *[F.max(c).cast("string").alias(f"{c}#max") for c in df.columns],
    )
    entries = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col("rows"),
            (F.col("rows") - F.col(f"`{c}#filled`")).alias("nulls"),
            F.col(f"`{c}#distinct`").alias("distinct_values"),
            F.col(f"`{c}#min`").alias("min_value"),
            F.col(f"`{c}#max`").alias("max_value"),
        )
        for c in df.columns
    ]
    return wide.select(F.inline(F.array(*entries)))


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Number of child rows whose parent is missing, in one row."""
    known = parent.select(F.col(pk).alias(fk))
    return without_known(child, known, [fk]).agg(F.count(F.lit(1)).alias("orphans"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys found more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")


def bag_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one side holds more often than the other.

    ``surplus`` > 0 counts copies only ``a`` has, < 0 copies only ``b`` has. One
    grouping answers both directions of EXCEPT ALL.
    """
    signed = a.withColumn("_side", F.lit(1)).unionByName(b.select(*a.columns).withColumn("_side", F.lit(-1)))
    return (
        signed.groupBy(*a.columns).agg(F.sum("_side").alias("surplus")).filter("surplus <> 0")
    )


def row_hash(cols: list[str], seed: int) -> Column:
    """64 bits of a whole row. Which columns are null is hashed too, as the hash of a row
    passes over nulls."""
    nulls = F.concat(*[F.when(F.col(c).isNull(), "1").otherwise("0") for c in cols])
    return F.xxhash64(F.lit(seed), *[F.col(c) for c in cols], nulls)


def bag_digests(df: DataFrame, by: list[str], cols: list[str]) -> DataFrame:
    """Per group a digest of its rows that depends neither on their order nor on how they
    are partitioned: count, sum and exclusive or of row hashes. Rows are merged map-side;
    what is shuffled is one row per group and task."""
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("digest_rows"), F.sum(row_hash(cols, 1).cast("decimal(38,0)")).alias("digest_sum"),
        F.bit_xor(row_hash(cols, 2)).alias("digest_xor"))


def differing_digests(a: DataFrame, b: DataFrame, by: list[str]) -> DataFrame:
    """Groups whose digests differ, or that only one side has. Null is a group."""
    digests = ["digest_rows", "digest_sum", "digest_xor"]
    other = b.select(*[F.col(c).alias(f"_b_{c}") for c in [*by, *digests]])
    same, equal = F.lit(True), F.lit(True)
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    for c in digests:
        equal = equal & F.col(c).eqNullSafe(F.col(f"_b_{c}"))
    missing = F.col("digest_rows").isNull()
    return a.join(other, same, "full_outer").filter(~equal).select(
        *[F.when(missing, F.col(f"_b_{c}")).otherwise(F.col(c)).alias(c) for c in by])


#: Groups of rows by hash whose digests are compared.
BUCKETS = 1024


def bag_difference_by_digest(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The same rows as ``bag_difference``. Each side is read once and reduced to one digest
    per bucket of row hashes; whole rows are grouped only in buckets that differ, so equal
    tables shuffle no row."""
    cols = a.columns
    types = {f.name: f.dataType for f in a.schema.fields}
    bucket = F.pmod(row_hash(cols, 3), F.lit(buckets)).cast("int")
    sides = [df.select(*[F.col(c).cast(types[c]).alias(c) for c in cols]) for df in (a, b)]
    first, second = (bag_digests(s.withColumn("_bucket", bucket), ["_bucket"], cols) for s in sides)
    # At most ``buckets`` numbers.
    parted = [r[0] for r in differing_digests(first, second, ["_bucket"]).collect()]
    if not parted:
        return a.limit(0).withColumn("surplus", F.lit(0).cast("bigint"))
    return bag_difference(*[s.filter(bucket.isin(parted)) for s in sides])
