"""Weekly customer retention."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from martloom.functions.scalars import MONEY_TOTAL, total, week_start
from martloom.operators.rows import signed_amount, with_statuses


def weekly_retention(orders: DataFrame, statuses: Iterable[str], refunded: str) -> DataFrame:
    """Per week: customers with one order, with several, and with a refund.

    A customer with a refund can also be in one of the other two groups. The
    revenue of a group is the signed sum over all rows of its customers.
    """
    wanted = with_statuses(orders, "status", statuses)
    signed = signed_amount(wanted, "amount", F.col("status") == refunded)
    per_customer = signed.groupBy(week_start("order_date").alias("week"), "user_id").agg(
        F.count_if(F.col("status") != refunded).alias("bought"),
        F.count_if(F.col("status") == refunded).alias("gave_back"),
        total("signed_amount").alias("revenue"),
    )

    def group(member: Column, name: str) -> list[Column]:
        return [
            F.count_if(member).alias(f"{name}_customers"),
            F.coalesce(total(F.when(member, F.col("revenue"))), F.lit(0).cast(MONEY_TOTAL))
            .alias(f"{name}_revenue"),
        ]

    return per_customer.groupBy("week").agg(
        *group(F.col("bought") == 1, "new"),
        *group(F.col("bought") > 1, "returning"),
        *group(F.col("gave_back") > 0, "refunded"),
    )


def cohort_retention(orders: DataFrame) -> DataFrame:
    """Customers of each first-order week that are active k weeks later.

    One row per customer and week is left before anything is windowed, so a
    customer with very many orders is no larger than the number of weeks.
    """
    active = orders.select("user_id", week_start("order_date").alias("week")).distinct()
    cohorts = active.withColumn("cohort_week", F.min("week").over(W.partitionBy("user_id")))
    return cohorts.groupBy(
        "cohort_week", F.floor(F.datediff("week", "cohort_week") / 7).cast("bigint").alias("weeks_since")
    ).agg(F.count(F.lit(1)).alias("customers"))
