"""Marts over the event lake: by user, by zone, and friend recommendations."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from martloom.functions.scalars import month_start, week_start
from martloom.operators.joins import block_join, block_pairs
from martloom.operators.rows import computed_once
from martloom.session import stored


def user_mart(events: DataFrame, types: Sequence[str]) -> DataFrame:
    """First and last activity, counts by event type, last and most visited zone.

    Everything comes from one pass: per (user, zone) first, then per user, so a
    very active user is already reduced to one row per zone. Only fixed-width
    values are aggregated over the events, which keeps that step a hash
    aggregation. Ties go to the smallest zone id; unknown zones lose.
    """
    per_zone = events.groupBy("user_id", "zone_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
        *[F.count_if(F.col("event_type") == t).alias(t) for t in types],
    )
    rank_last = F.struct(-F.unix_micros(F.col("last_ts").cast("timestamp")), F.col("zone_id"))
    rank_modal = F.struct(-F.col("n"), F.col("zone_id"))
    known = F.col("zone_id").isNotNull()
    return per_zone.groupBy("user_id").agg(
        F.min("first_ts").alias("first_activity"),
        F.max("last_ts").alias("last_activity"),
        F.min_by("zone_id", F.when(known, rank_last)).alias("last_zone"),
        F.min_by("zone_id", F.when(known, rank_modal)).alias("modal_zone"),
        *[F.sum(t).alias(f"{t}_events") for t in types],
    )


def zone_weeks(events: DataFrame, types: Sequence[str]) -> DataFrame:
    """Events of each type per zone and week."""
    return events.groupBy(week_start("ts").alias("week"), "zone_id").agg(
        *[F.count_if(F.col("event_type") == t).alias(f"week_{t}") for t in types]
    )


def with_month_totals(weeks: DataFrame, types: Sequence[str]) -> DataFrame:
    """The month's totals beside each week; a week belongs to the month of its Monday."""
    dated = weeks.withColumn("month", month_start("week"))
    month = W.partitionBy("zone_id", "month")
    return dated.withColumns({f"month_{t}": F.sum(f"week_{t}").over(month) for t in types})


def zone_mart(events: DataFrame, types: Sequence[str]) -> DataFrame:
    return with_month_totals(zone_weeks(events, types), types)


def undirected(sent: DataFrame, received: DataFrame) -> DataFrame:
    """Contacts ``(a, b)`` with ``a < b`` from lists of sent and received messages."""
    both = sent.select("from_id", "to_id").unionByName(received.select("from_id", "to_id"))
    return both.filter("from_id <> to_id").select(
        F.least("from_id", "to_id").alias("a"), F.greatest("from_id", "to_id").alias("b")
    ).distinct()


#: A community of n members weighs this over n, rounded down.
UNIT = 1_000_000


def zone_thresholds(members: DataFrame, times: int) -> DataFrame:
    """``(zone_id, min_weight)``: ``times`` the mean weight of a community that two users of
    the zone share. Weights fall as communities grow, and so does this: about the same
    share of the sharing pairs reaches it at any size."""
    sizes = members.groupBy("zone_id", "group_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = F.col("n") * (F.col("n") - 1)
    sums = sizes.groupBy("zone_id").agg(
        F.sum(F.floor(F.lit(UNIT) / F.col("n")).cast("bigint") * pairs).alias("weight"), F.sum(pairs).alias("pairs"))
    return sums.select("zone_id", F.expr(f"greatest(1, {int(times)} * (weight div greatest(1, pairs)))").cast("bigint").alias("min_weight"))


#: Users in more communities than this are paired by sums, as their lists are too long to
#: be held at each of their communities.
LONG_LIST = 1000
#: Words of 64 bits in the parity sketch of a list.
SKETCH = range(4)


def shared_community_pairs(members: DataFrame, min_weight: int | DataFrame, long_list: int = LONG_LIST) -> DataFrame:
    """User pairs of one zone whose shared communities weigh ``min_weight`` or more: a
    number, or ``(zone_id, min_weight)``.

    ``members`` has distinct ``(zone_id, user_id, group_id)``; a community weighs the less
    the more members of the zone it has. Result: ``(zone_id, a, b, shared, weight)`` with
    ``a < b``.

    Prefix filtering (Chaudhuri, Ganti & Kaushik, ICDE 2006), by weight: a user's
    communities stand in one order for all, the heaviest first, and the last ones that
    together stay below the threshold are left out. Two users who reach it first meet in a
    community that neither leaves out, so members meet in those alone: any number of
    communities that everyone is in weigh next to nothing and pair nobody. Of several
    meetings only that in the first community counts. There both lists are at hand, so
    counts and weights are complete, and pairs below the threshold go before any shuffle.
    Meetings of users with long lists are few and are summed up by pair instead.

    Should rows of ``members`` repeat, copies of a community meet each with each, but for
    those that both leave out, which count once.
    """
    if isinstance(min_weight, int) and min_weight < 1:
        raise ValueError("min_weight must be at least 1")
    group = ["zone_id", "group_id"]
    limits = None if isinstance(min_weight, int) else stored(min_weight, "zone-thresholds")

    def limited(df: DataFrame) -> DataFrame:
        return df.withColumn("min_weight", F.lit(min_weight).cast("bigint")) if limits is None else df.join(limits, "zone_id")

    held = members.groupBy(*group, "user_id").agg(F.count(F.lit(1)).alias("c"))
    sizes = held.groupBy(*group).agg(F.floor(F.lit(UNIT) / F.sum("c")).cast("bigint").alias("w"), F.max("c").alias("most"))
    light_first = W.partitionBy("zone_id", "user_id").orderBy(F.col("w").asc(), F.col("group_id").desc())
    lighter = light_first.rowsBetween(W.unboundedPreceding, -1)
    up_to = light_first.rowsBetween(W.unboundedPreceding, 0)
    weighed = (
        limited(held.join(sizes, group))
        .withColumn("room", F.col("min_weight") - 1 - F.coalesce(F.sum(F.col("w") * F.col("c")).over(lighter), F.lit(0)))
        .withColumn("meets", F.sum(F.col("w") * F.col("c") * F.col("most")).over(up_to) >= F.col("min_weight"))
        # Copies that stay below the threshold with all that is lighter.
        .withColumn("left_out", F.expr("CASE WHEN room < 0 THEN 0 WHEN w = 0 THEN c ELSE least(c, room div w) END"))
        # This community and all that are lighter: their number and a parity sketch.
        .withColumn("rest", F.count(F.lit(1)).over(up_to))
        .withColumn("place", F.pmod(F.xxhash64("group_id"), F.lit(64 * len(SKETCH))).cast("int"))
        .withColumns({f"sketch_{k}": F.bit_xor(F.expr(f"if(place div 64 = {k}, shiftleft(1L, place % 64), 0L)")).over(up_to) for k in SKETCH})
    )
    item = ["group_id", "w", "c", "left_out", "meets", "rest", *[f"sketch_{k}" for k in SKETCH]]
    # Read several times below, so it is computed once.
    users = stored(
        weighed.groupBy("zone_id", "user_id", "min_weight").agg(F.sort_array(F.collect_list(F.struct((-F.col("w")).alias("order"), *item))).alias("items")),
        "listed-members",
    ).withColumn("is_long", F.size("items") > long_list)
    rows = [*group, "user_id", "min_weight", "is_long"]

    # Lists of moderate length: each pair where it first meets.
    repeats = F.exists("items", lambda i: i["c"] > 1)
    kept = F.size(F.filter("items", lambda i: i["left_out"] == 0))
    head = users.filter("NOT is_long").select(
        "zone_id", "user_id", "min_weight", F.col("items.group_id").alias("ids"), F.col("items.w").alias("weights"),
        F.when(repeats, F.transform("items", lambda i: F.struct(i["c"].alias("c"), i["left_out"].alias("left_out")))).alias("copies"), kept.alias("kept"),
        F.inline(F.filter("items", lambda i: i["meets"]))).drop("c", "left_out", "meets", "order")
    single = F.col("copies").isNull() & F.col("other_copies").isNull()

    def in_reach(shared: Column) -> Column:
        """The first community is the heaviest that they share."""
        return ~single | (shared * F.col("w") >= F.col("min_weight"))

    # Two lists differ in as many places at least as their sketches.
    apart = sum(F.bit_count(F.col(f"sketch_{k}").bitwiseXOR(F.col(f"other_sketch_{k}"))) for k in SKETCH)
    at_most = F.shiftright(F.col("rest") + F.col("other_rest") - apart, 1)
    met = computed_once(block_pairs(head, group, "user_id").filter(in_reach(at_most)), "both", F.array_intersect("ids", "other_ids"))
    first = met.filter((F.get("both", F.lit(0)) == F.col("group_id")) & in_reach(F.size("both")))

    def times(x: Column, y: Column) -> Column:
        out = x["left_out"] * y["left_out"]
        return x["c"] * y["c"] - out + F.least(out, F.lit(1))

    def at(values: str, g: Column) -> Column:
        return F.get(values, F.array_position("ids", g).cast("int") - 1)

    def copies_of(side: str, g: Column) -> Column:
        place = F.array_position(f"{side}ids", g).cast("int") - 1
        one = F.struct(F.lit(1).cast("bigint").alias("c"), (place >= F.col(f"{side}kept")).cast("bigint").alias("left_out"))
        return F.coalesce(F.get(f"{side}copies", place), one)

    def times_of(g: Column) -> Column:
        return times(copies_of("", g), copies_of("other_", g))

    def total(value: Callable[[Column], Column]) -> Column:
        return F.aggregate("both", F.lit(0).cast("bigint"), lambda acc, g: acc + value(g))

    def ends(shared: Column, weight: Column) -> list[Column | str]:
        return ["zone_id", F.least("user_id", "other_user_id").alias("a"), F.greatest("user_id", "other_user_id").alias("b"),
                shared.alias("shared"), weight.alias("weight"), "min_weight"]

    found = first.select(*ends(
        F.when(single, F.size("both").cast("bigint")).otherwise(total(times_of)),
        F.when(single, total(lambda g: at("weights", g))).otherwise(total(lambda g: at("weights", g) * times_of(g))),
    )).filter("weight >= min_weight")

    # Long lists: each meeting with anyone.
    every = users.select("zone_id", "user_id", "min_weight", "is_long", F.inline("items")).select(*rows, "w", "c", "left_out")
    others = every.select(*group, *[F.col(c).alias(f"other_{c}") for c in ("user_id", "is_long", "c", "left_out")])
    one, other = (F.struct(*[F.col(p + c).alias(c) for c in ("c", "left_out")]) for p in ("", "other_"))
    meetings = block_join(every.filter("is_long"), others, group, "user_id", "other_user_id").filter(
        "user_id <> other_user_id AND (NOT other_is_long OR user_id < other_user_id)").select(
        *ends(times(one, other), F.col("w") * times(one, other)))

    return (
        found.unionAll(meetings)
        .repartition("a", "b")  # of which what follows by pair has use as well
        .groupBy("zone_id", "a", "b")
        .agg(F.sum("shared").alias("shared"), F.sum("weight").alias("weight"), F.max("min_weight").alias("min_weight"))
        .filter("weight >= min_weight").drop("min_weight")
    )


def friend_recommendations(members: DataFrame, contacts: DataFrame, min_weight: int | DataFrame) -> DataFrame:
    """Pairs of one zone with enough shared communities and no contact so far (common
    neighbours weighed by their size: Adamic & Adar, Social Networks 2003)."""
    # No end of a pair is null: joined by plain equality, pairs stay where they are. Contacts
    # are hashed, as there may be far more pairs, which would be sorted.
    known = contacts.select("a", "b").distinct().hint("shuffle_hash")
    return shared_community_pairs(members, min_weight).join(known, ["a", "b"], "left_anti").select(
        "zone_id", "a", "b", "shared", "weight")
