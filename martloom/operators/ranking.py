"""Latest rows, modal values, exact quantile scores and ranks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from martloom.session import cut_lineage


def latest_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """The row of each key that is last in ``order_cols``.

    Filtering on row number 1 lets Spark keep one row per key and task before the
    shuffle, so a hot key does not reach one task whole. The last order column
    must break ties.
    """
    newest = W.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(newest)).filter("_rn = 1").drop("_rn")


def first_per_key(df: DataFrame, keys: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    oldest = W.partitionBy(*keys).orderBy(*[F.col(c).asc() for c in order_cols])
    return df.withColumn("_rn", F.row_number().over(oldest)).filter("_rn = 1").drop("_rn")


def modal_value(df: DataFrame, keys: Sequence[str], value: str, name: str) -> DataFrame:
    """Most frequent value per key, the smallest of equally frequent ones."""
    counted = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    best = W.partitionBy(*keys).orderBy(F.col("_n").desc(), F.col(value).asc())
    return (
        counted.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1")
        .select(*keys, F.col(value).alias(name))
    )


def first_event(df: DataFrame, key: str, ts: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.min(ts).alias(name))


def oldest(df: DataFrame, first_ts: str, key: str, n: int = 10) -> DataFrame:
    """The ``n`` keys with the smallest first time; each task keeps only ``n``."""
    return df.orderBy(F.col(first_ts).asc(), F.col(key).asc()).limit(n)


def top(df: DataFrame, count_col: str, tie: str, n: int) -> DataFrame:
    return df.orderBy(F.col(count_col).desc(), F.col(tie).asc()).limit(n)


def with_exact_rank(df: DataFrame, order: Sequence[Column], rank: str, rows: str) -> DataFrame:
    """Position of every row in a total order, from 1, beside the row count.

    A window without partitions would sort all rows in one task. Here rows are
    range-partitioned and sorted in parallel, the position inside a partition is
    read off the row id, and the sizes of the earlier partitions are added. The
    row ids must not change between the two uses, hence the checkpoint. ``order``
    must be free of ties.
    """
    numbered = cut_lineage(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id: partition number in the upper 31 bits, row
    # number in the lower 33.
    numbered = numbered.withColumns({
        "_part": F.shiftright("_id", 33).cast("int"),
        "_pos": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)),
    })
    # One row per partition: small whatever the data size.
    by_part = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_part",
            F.coalesce(F.sum("_n").over(by_part), F.lit(0)).alias("_before"),
            F.sum("_n").over(W.partitionBy()).alias(rows),
        )
    )
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_before") + F.col("_pos") + 1)
        .drop("_id", "_part", "_pos", "_before")
    )


def with_running_total(df: DataFrame, order: Sequence[Column], amount: str, upto: str, whole: str) -> DataFrame:
    """Sum of ``amount`` up to and with each row in a total order, beside the whole sum.

    As in ``with_exact_rank``, rows are range-partitioned, summed inside a partition, and
    the sums of the earlier partitions are added.
    """
    ranked = cut_lineage(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inside = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    by_part = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = ranked.groupBy("_part").agg(F.sum(amount).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(by_part), F.lit(0)).alias("_before"), F.sum("_n").over(W.partitionBy()).alias(whole))
    return (ranked.withColumn("_in", F.sum(amount).over(inside)).join(F.broadcast(offsets), "_part")
            .withColumn(upto, F.col("_before") + F.col("_in")).drop("_part", "_in", "_before"))


def quantile_of_rank(rank: Column, rows: Column, n: int) -> Column:
    """Group 1..n of a position; sizes differ by at most one, larger groups first."""
    small = F.floor(rows / n)
    larger = F.pmod(rows, F.lit(n))
    in_larger = larger * (small + 1)
    return (
        F.when(rank <= in_larger, F.floor((rank - 1) / (small + 1)) + 1)
        .otherwise(larger + F.floor((rank - 1 - in_larger) / F.greatest(small, F.lit(1))) + 1)
        .cast("int")
    )


def with_quantile(df: DataFrame, order: Sequence[Column], n: int, name: str) -> DataFrame:
    """Same groups as NTILE(n) over the given order, computed in parallel."""
    ranked = with_exact_rank(df, order, "_rank", "_rows")
    return ranked.withColumn(name, quantile_of_rank(F.col("_rank"), F.col("_rows"), n)).drop("_rank", "_rows")


def with_quantile_approx(df: DataFrame, measures: dict[str, str], n: int, accuracy: int = 10_000) -> DataFrame:
    """Quantile scores from approximate cut points, one pass for all measures.

    ``measures`` maps a numeric column to its score column. Equal values get
    equal scores; nulls get score 1.
    """
    steps = [i / n for i in range(1, n)]
    # A null ranks below every value, as in the exact scores.
    cuts = df.agg(*[F.percentile_approx(F.coalesce(F.col(c).cast("double"), F.lit(float("-inf"))), steps, accuracy).alias(c)
                    for c in measures]).first()

    def score(c: str) -> Column:
        passed = [F.when(F.col(c) > F.lit(cut), 1).otherwise(0) for cut in (cuts[c] or [])]
        return sum(passed, F.lit(1)).cast("int")

    return df.withColumns({name: score(c) for c, name in measures.items()})


def with_dense_ranks(df: DataFrame, count_col: str, overall: str, within: str, group: str) -> DataFrame:
    """Dense rank by descending count, overall and inside each group.

    Ranks depend only on which counts occur. There are far fewer of those than
    rows: counts that add up to N take at most sqrt(2N) different values. The
    windows therefore run over the distinct counts, and the ranks are joined back.
    """
    levels = df.select(group, count_col).distinct()
    in_group = levels.withColumn(
        within, F.dense_rank().over(W.partitionBy(group).orderBy(F.col(count_col).desc()))
    )
    in_all = levels.select(count_col).distinct().withColumn(
        overall, F.dense_rank().over(W.orderBy(F.col(count_col).desc()))
    )
    levels = in_group.join(in_all, count_col).withColumnsRenamed({group: "_group", count_col: "_count"})
    same = F.col(group).eqNullSafe(F.col("_group")) & (F.col(count_col) == F.col("_count"))
    return df.join(levels, same).drop("_group", "_count")
