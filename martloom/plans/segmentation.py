"""Audience segmentation by recency, frequency and spend (Bult & Wansbeek, 1995)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F

from martloom.functions.scalars import total
from martloom.operators.joins import keep_all
from martloom.operators.ranking import quantile_of_rank, with_quantile_approx, with_running_total
from martloom.operators.rows import with_statuses
from martloom.operators.selection import with_quantiles


def user_measures(users: DataFrame, orders: DataFrame, closed: str) -> DataFrame:
    """Last order date, number of orders and spend of every user.

    Users without a closed order stay: no date, no orders, no spend.
    """
    per_user = with_statuses(orders, "status", [closed]).groupBy("user_id").agg(
        F.max("order_date").alias("last_order"),
        F.count(F.lit(1)).alias("orders"),
        total("amount").alias("spend"),
    )
    return keep_all(users.select("user_id"), per_user, ["user_id"],
                    {"orders": 0, "spend": Decimal("0.00")})


def segment_scores(measures: DataFrame, n: int = 5) -> DataFrame:
    """Scores 1..n per measure, n the best; ties are broken by user id."""
    scored = with_quantiles(measures, {"last_order": "recency", "orders": "frequency", "spend": "monetary"}, "user_id", n)
    return _with_segment(scored)


def segment_scores_approx(measures: DataFrame, n: int = 5) -> DataFrame:
    """One-pass scores from approximate cut points, without sorting the users."""
    numeric = measures.withColumns({
        "_recency": F.unix_date("last_order"),
        "_spend": F.col("spend").cast("double"),
    })
    scored = with_quantile_approx(
        numeric, {"_recency": "recency", "orders": "frequency", "_spend": "monetary"}, n
    )
    return _with_segment(scored.drop("_recency", "_spend"))


def within_rank_error(scored: DataFrame, n: int = 5, accuracy: int = 10_000) -> DataFrame:
    """``user_id`` and, per measure, whether the approximate score is right: some rank in
    ``[lowest - e, highest + e]`` has it, where equal values span ``lowest`` to ``highest``
    of the exact ranks and e is the rank error promised for the cut points."""
    out = scored.select("user_id")
    for value, score in (("last_order", "recency"), ("orders", "frequency"), ("spend", "monetary")):
        counts = scored.groupBy(F.col(value).alias("v")).agg(F.count(F.lit(1)).alias("same"))
        # Running totals over the distinct values, range by range.
        ranked = with_running_total(counts, [F.col("v").asc_nulls_first()], "same", "highest", "rows")
        error = F.ceil(F.col("rows") / accuracy) + 1
        low = quantile_of_rank(F.greatest(F.lit(1), F.col("highest") - F.col("same") + 1 - error), F.col("rows"), n)
        high = quantile_of_rank(F.least(F.col("rows"), F.col("highest") + error), F.col("rows"), n)
        bounds = ranked.select("v", low.alias("low"), high.alias("high"))
        checked = scored.select("user_id", F.col(value).alias("x"), score).join(bounds, F.col("x").eqNullSafe(F.col("v"))).select(
            "user_id", F.col(score).between(F.col("low"), F.col("high")).alias(f"{score}_ok"))
        out = out.join(checked, "user_id")
    return out


def _with_segment(scored: DataFrame) -> DataFrame:
    return scored.withColumn("segment", F.concat(*[F.col(c).cast("string") for c in ("recency", "frequency", "monetary")]))


def segment_summary(segments: DataFrame) -> DataFrame:
    return segments.groupBy("segment").agg(
        F.count(F.lit(1)).alias("users"),
        F.sum("orders").alias("orders"),
        total("spend").alias("spend"),
    )
