"""Communities: conversion to the first message, and net membership."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.functions.scalars import ratio
from martloom.operators.joins import only_known
from martloom.operators.ranking import first_event, latest_per_key, oldest


def user_steps(log: DataFrame, messages: DataFrame, enter: str) -> DataFrame:
    """Per community and user: did they enter, did they write. Repeated events of
    a user are merged before the shuffle."""
    entered = log.select("group_id", "user_id", (F.col("event") == enter).alias("entered"), F.lit(False).alias("wrote"))
    wrote = messages.select("group_id", "user_id", F.lit(False).alias("entered"), F.lit(True).alias("wrote"))
    return entered.unionAll(wrote).groupBy("group_id", "user_id").agg(
        F.bool_or("entered").alias("entered"), F.bool_or("wrote").alias("wrote")
    )


def community_conversion(log: DataFrame, messages: DataFrame, enter: str, n: int = 10) -> DataFrame:
    """Share of joined users who wrote at least one message, for the ``n`` oldest
    communities. A community nobody joined stays, with a null conversion."""
    # At most n rows: safe to broadcast whatever the size of the log.
    first = F.broadcast(oldest(first_event(log, "group_id", "ts", "first_ts"), "first_ts", "group_id", n))

    def chosen(df: DataFrame) -> DataFrame:
        return only_known(df, first, ["group_id"])

    counted = user_steps(chosen(log), chosen(messages), enter).groupBy("group_id").agg(
        F.count_if("entered").alias("joined_users"),
        F.count_if(F.col("entered") & F.col("wrote")).alias("writers"),
    )
    # Every chosen community has an event in the log, and null is one as well.
    first = first.withColumnRenamed("group_id", "_group")
    return counted.join(first, F.col("group_id").eqNullSafe(F.col("_group"))).drop("_group").withColumn(
        "conversion", ratio(F.col("writers"), F.col("joined_users"))
    )


def current_members(log: DataFrame, enter: str, leave: str) -> DataFrame:
    """(community, user) whose last enter or leave event is an enter."""
    moves = log.filter(F.col("event").isin(enter, leave))
    last = latest_per_key(moves, ["group_id", "user_id"], ["ts", "event_id"])
    return last.filter(F.col("event") == enter).select("group_id", "user_id", F.col("ts").alias("member_since"))
