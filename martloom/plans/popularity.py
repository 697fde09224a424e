"""Dish popularity and per-user order counters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.operators.joins import enrich
from martloom.operators.ranking import top, with_dense_ranks


def user_item_counts(lines: DataFrame, item: str) -> DataFrame:
    """Orders per user and item. ``lines`` has distinct ``(order_id, item)`` with
    the user of the order, so counting rows counts orders."""
    return lines.groupBy("user_id", item).agg(F.count(F.lit(1)).alias("orders"))


def dish_popularity(lines: DataFrame, dishes: DataFrame) -> DataFrame:
    """Orders and users per dish, ranked overall and inside the category.

    Built on the per-user counters: a popular dish is spread over its users
    before it is summed up, and no distinct count expands the rows.
    """
    counts = user_item_counts(lines, "dish_id").groupBy("dish_id").agg(
        F.sum("orders").alias("orders"), F.count(F.lit(1)).alias("users")
    )
    # A dish that the lookup does not hold stays, without name and category.
    named = enrich(counts, dishes, "dish_id")
    return with_dense_ranks(named, "orders", "rank_overall", "rank_in_category", "category")


def top_dishes(popularity: DataFrame, n: int) -> DataFrame:
    return top(popularity, "orders", "dish_id", n)
