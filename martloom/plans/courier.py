"""Monthly courier settlement."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from martloom.functions.scalars import MONEY_TOTAL, bounded, total
from martloom.session import stored

#: Width of the cells by which mean rates meet their tier. It changes the size of the
#: join, not its result: a tier takes one row per cell that it reaches into.
CELL = Decimal("0.25")
MONTH = ["courier_id", "settlement_year", "settlement_month"]


def checked_tiers(tiers: DataFrame) -> DataFrame:
    """The rate card, refused when it is empty or has an overlap or a gap. ``[lo, hi)``
    earns ``pct`` of the amount, at least ``floor``. Only counts reach the driver."""
    card = tiers.select("lo", "hi", "pct", "floor")
    # A rate card is a small table: one row per tier.
    below = card.withColumn("before", F.lag("hi").over(W.orderBy("lo", "hi")))
    n, empty, unmet = below.agg(
        F.count(F.lit(1)), F.count_if((F.col("lo") >= F.col("hi")) | F.col("lo").isNull() | F.col("hi").isNull()),
        F.count_if(F.col("before") != F.col("lo"))).first()
    if not n:
        raise ValueError("the rate card has no tiers")
    if empty:
        raise ValueError("the rate card has an empty tier")
    if unmet:
        raise ValueError("tiers must meet: there is a gap or an overlap")
    return card


def _cell(value: Column) -> Column:
    return F.floor(value / F.lit(CELL)).cast("bigint")


def with_tier(months: DataFrame, tiers: DataFrame) -> DataFrame:
    """``pct`` and ``floor`` of the tier that holds the mean rate ``rate_sum / orders``.

    An equi join on cells of the rate finds the few tiers near it. The tier is then
    chosen by sums, so that no division rounds a mean onto a bound; cells beside those
    of the tier's bounds are included for the same reason. Means outside the card get
    nulls.
    """
    cells = tiers.withColumn("_cell", F.explode(F.sequence(_cell(F.col("lo")) - 1, _cell(F.col("hi")) + 1)))
    n = F.col("orders_count")
    placed = months.withColumn("_at", _cell(F.col("_rate_sum") / n))
    inside = (F.col("_rate_sum") >= F.col("lo") * n) & (F.col("_rate_sum") < F.col("hi") * n)
    return placed.join(cells, (F.col("_at") == F.col("_cell")) & inside, "left").drop("_at", "_cell", "lo", "hi")


def courier_ledger(deliveries: DataFrame, tiers: DataFrame, fee: Decimal) -> DataFrame:
    """Orders, amounts, mean rate, tips, payout and reward per courier and month.

    ``deliveries`` has one row per courier and order. Months are summed up first; their
    tier then prices each order. The months are stored, so that the join back may split
    the rows of a very busy courier. A mean rate outside the whole card leaves payout
    and reward null.
    """
    dated = deliveries.withColumns({"settlement_year": F.year("order_date"), "settlement_month": F.month("order_date")})
    months = dated.groupBy(*MONTH).agg(
        F.count(F.lit(1)).alias("orders_count"),
        total("amount").alias("orders_total"),
        F.sum("rate").alias("_rate_sum"),
        total("tips").alias("tips_total"),
    )
    months = stored(with_tier(months, checked_tiers(tiers)), "courier-months")
    terms = months.select(*[F.col(c).alias(f"_{c}") for c in MONTH], "pct", "floor")
    same = F.lit(True)
    for c in MONTH:
        same = same & F.col(c).eqNullSafe(F.col(f"_{c}"))
    pay = bounded(F.round(F.col("pct") * F.col("amount"), 2), lo=F.col("floor"))
    paid = dated.join(terms, same).groupBy(*MONTH).agg(
        F.sum(F.when(F.col("pct").isNotNull(), pay)).cast(MONEY_TOTAL).alias("payout"))
    paid = paid.select(*[F.col(c).alias(f"_{c}") for c in MONTH], "payout")
    kept = F.lit(Decimal(1) - fee)
    return months.join(paid, same).select(
        *MONTH, "orders_count", "orders_total",
        (F.col("_rate_sum").cast("double") / F.col("orders_count").cast("double")).alias("mean_rate"),
        "tips_total",
        "payout",
        (F.col("payout") + F.round(F.col("tips_total") * kept, 2)).cast(MONEY_TOTAL).alias("reward"),
    )
