import datetime as dt
import itertools
import random
from decimal import Decimal as D

import pytest

from conftest import plan, rows
from martloom.plans import community, courier, lake, popularity, retention, segmentation

ORDER_SCHEMA = "order_id long, user_id long, status string, amount decimal(18,2), order_date date"


def _orders(spark, items):
    return spark.createDataFrame([(i, u, s, D(a), dt.date.fromisoformat(d)) for i, (u, s, a, d) in enumerate(items)], ORDER_SCHEMA)


def test_users_without_closed_orders_stay(spark):
    users = spark.createDataFrame([(1,), (2,), (3,)], "user_id long")
    orders = _orders(spark, [(1, "F", "5.00", "2024-01-01"), (1, "F", "7.00", "2024-02-01"), (2, "O", "9.00", "2024-03-01")])
    out = segmentation.user_measures(users, orders, "F")
    assert rows(out) == [
        (1, dt.date(2024, 2, 1), 2, D("12.00")), (2, None, 0, D("0.00")), (3, None, 0, D("0.00"))]


def test_no_orders_is_the_worst_recency(spark):
    users = spark.createDataFrame([(i,) for i in range(5)], "user_id long")
    orders = _orders(spark, [(i, "F", f"{10 * i}.00", f"2024-01-0{i}") for i in range(1, 5)])
    scores = segmentation.segment_scores(segmentation.user_measures(users, orders, "F"))
    assert rows(scores, "user_id", "segment") == [(i, str(i + 1) * 3) for i in range(5)]
    summary = segmentation.segment_summary(scores)
    assert rows(summary, "segment", "users", "orders")[0] == ("111", 1, 0)


def test_weekly_groups(spark):
    orders = _orders(spark, [
        (1, "F", "10.00", "2024-01-01"), (1, "O", "5.00", "2024-01-07"),   # Monday and Sunday of one week
        (2, "F", "8.00", "2024-01-03"),
        (3, "F", "4.00", "2024-01-02"), (3, "P", "4.00", "2024-01-04"),    # bought and refunded
        (2, "P", "8.00", "2024-01-08"),                                    # refunded a week later
        (4, "X", "99.00", "2024-01-03"),                                   # status that is not wanted
    ])
    out = {r.week: r for r in retention.weekly_retention(orders, ["F", "O", "P"], "P").collect()}
    first, second = out[dt.date(2024, 1, 1)], out[dt.date(2024, 1, 8)]
    assert (first.new_customers, first.new_revenue) == (2, D("8.00"))
    assert (first.returning_customers, first.returning_revenue) == (1, D("15.00"))
    assert (first.refunded_customers, first.refunded_revenue) == (1, D("0.00"))
    assert (second.new_customers, second.new_revenue, second.refunded_customers, second.refunded_revenue) == (0, D("0.00"), 1, D("-8.00"))


def test_cohort_starts_with_everyone(spark):
    rng = random.Random(5)
    day = dt.date(2024, 1, 1)
    orders = _orders(spark, [(rng.randrange(30), "F", "1.00", str(day + dt.timedelta(days=rng.randrange(90)))) for _ in range(200)])
    out = rows(retention.cohort_retention(orders))
    starts = {c: n for c, k, n in out if k == 0}
    assert sum(starts.values()) == orders.select("user_id").distinct().count()
    assert all(n <= starts[c] and k >= 0 for c, k, n in out)


TIERS = [("0", "3.9", "0.04", "50"), ("3.9", "4.1", "0.06", "80"), ("4.1", "99", "0.09", "120")]


def _tiers(spark, items=TIERS):
    return spark.createDataFrame([tuple(map(D, t)) for t in items], "lo decimal(4,2), hi decimal(4,2), pct decimal(4,2), floor decimal(6,2)")


def _deliveries(spark, items):
    return spark.createDataFrame(
        [(i, c, D(r), D(a), D(t), dt.date.fromisoformat(d)) for i, (c, r, a, t, d) in enumerate(items)],
        "order_id long, courier_id long, rate decimal(4,2), amount decimal(18,2), tips decimal(18,2), order_date date")


def test_a_rate_on_the_bound_is_in_the_upper_tier(spark):
    out = courier.courier_ledger(_deliveries(spark, [
        (1, "3.80", "1000.00", "10.00", "2024-01-31"), (1, "4.00", "2000.00", "0.00", "2024-01-01"),  # mean 3.90
        (1, "5.00", "2000.00", "1.00", "2024-02-01"),                                                   # next month
        (2, "3.89", "100.00", "0.00", "2024-01-10"),                                                    # below the floor
    ]), _tiers(spark), D("0.05"))
    got = rows(out, "courier_id", "settlement_month", "orders_count", "payout", "reward")
    assert got == [
        (1, 1, 2, D("200.00"), D("209.50")),
        (1, 2, 1, D("180.00"), D("180.95")),
        (2, 1, 1, D("50.00"), D("50.00")),
    ]
    text = plan(out)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_a_long_rate_card(spark):
    """A thousand tiers of a hundredth, each paying its own share."""
    card = [(f"{i / 100:.2f}", f"{(i + 1) / 100:.2f}", f"{i / 100:.2f}", "0") for i in range(1000)]
    rates = ["0.00", "0.01", "3.33", "3.34", "9.99", "10.00"]
    out = courier.courier_ledger(
        _deliveries(spark, [(k, r, "100.00", "0.00", "2024-01-01") for k, r in enumerate(rates)]
                    + [(9, "1.00", "100.00", "0.00", "2024-01-01"), (9, "1.01", "100.00", "0.00", "2024-01-02"),
                       (9, "1.01", "100.00", "0.00", "2024-01-03")]), _tiers(spark, card), D("0"))
    paid = {r.courier_id: r.payout for r in out.collect()}
    assert [paid[k] for k in range(6)] == [D("0.00"), D("1.00"), D("333.00"), D("334.00"), D("999.00"), None]
    assert paid[9] == D("300.00")  # the mean 1.00666... is in [1.00, 1.01)


@pytest.mark.parametrize("bad", [
    [TIERS[0], TIERS[2]],
    [("0", "4.0", "0.04", "50"), TIERS[1]],
    [("4", "4", "0.04", "50")],
    [],
])
def test_rate_cards_with_gaps_or_overlaps_are_refused(spark, bad):
    with pytest.raises(ValueError):
        courier.checked_tiers(_tiers(spark, bad))


LOG = "group_id long, user_id long, event_id long, event string, ts timestamp_ntz"


def _log(spark, items):
    t = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([(g, u, i, e, t + dt.timedelta(hours=h)) for i, (g, u, e, h) in enumerate(items)], LOG)


def test_conversion(spark):
    log = _log(spark, [
        (1, 1, "enter", 0), (1, 1, "enter", 1), (1, 2, "enter", 2), (1, 3, "leave", 3),
        (2, 1, "leave", 1),                                   # nobody entered
        *[(g, 1, "enter", 10) for g in range(3, 13)],         # tie at the tenth place
    ])
    messages = _log(spark, [(1, 1, "m", 5), (1, 1, "m", 6), (1, 3, "m", 6), (99, 1, "m", 0)]).select("group_id", "user_id", "ts")
    out = {r.group_id: r for r in community.community_conversion(log, messages, "enter").collect()}
    assert sorted(out) == [1, 2, 3, 4, 5, 6, 7, 8, 9, 10]
    assert (out[1].joined_users, out[1].writers, out[1].conversion) == (2, 1, 0.5)
    assert (out[2].joined_users, out[2].writers, out[2].conversion) == (0, 0, None)
    assert out[3].conversion == 0.0


def test_membership_follows_the_last_move(spark):
    log = _log(spark, [(1, 1, "enter", 0), (1, 1, "leave", 1), (1, 1, "enter", 2), (1, 2, "enter", 0), (1, 2, "leave", 1), (1, 2, "m", 3)])
    assert rows(community.current_members(log, "enter", "leave"), "group_id", "user_id") == [(1, 1)]


EVENT = "event_id long, ts timestamp_ntz, user_id long, event_type string, zone_id int"


def test_user_and_zone_marts(spark):
    def at(day):
        return dt.datetime(2024, 1, day, 12)

    events = spark.createDataFrame([
        (1, at(1), 1, "view", 7), (2, at(2), 1, "view", 3), (3, at(3), 1, "click", None), (4, at(29), 2, "click", 5),
        (5, dt.datetime(2024, 2, 2), 2, "click", 5), (6, dt.datetime(2024, 2, 5), 2, "click", 5),
    ], EVENT)
    users = {r.user_id: r for r in lake.user_mart(events, ["view", "click"]).collect()}
    assert (users[1].first_activity, users[1].last_activity) == (at(1), at(3))
    assert (users[1].last_zone, users[1].modal_zone, users[1].view_events, users[1].click_events) == (3, 3, 2, 1)
    zones = rows(lake.zone_mart(events, ["view", "click"]), "zone_id", "week", "month", "week_click", "month_click")
    # The week of 29 January runs into February and counts for January.
    assert (5, dt.date(2024, 1, 29), dt.date(2024, 1, 1), 2, 2) in zones
    assert (5, dt.date(2024, 2, 5), dt.date(2024, 2, 1), 1, 1) in zones


def _brute_pairs(members, least):
    by_user, sizes = {}, {}
    for z, u, g in members:
        by_user.setdefault((z, u), set()).add(g)
        sizes[z, g] = sizes.get((z, g), 0) + 1
    out = []
    for (z, u), (y, v) in itertools.combinations(sorted(by_user), 2):
        both = by_user[z, u] & by_user[y, v] if z == y else set()
        weight = sum(lake.UNIT // sizes[z, g] for g in both)
        if both and weight >= least:
            out.append((z, u, v, len(both), weight))
    return sorted(out)


@pytest.mark.parametrize("least", [1, 90_000, 300_000, 600_000])
def test_pairs_equal_brute_force_under_skew(spark, least):
    rng = random.Random(least)
    members = set()
    for u in range(120):
        zone = 0 if u % 3 else 1
        if rng.random() < 0.8:
            members.add((zone, u, 7))
        for _ in range(rng.randrange(5)):
            members.add((zone, u, rng.randrange(25)))
    df = spark.createDataFrame(sorted(members), "zone_id int, user_id long, group_id long")
    got = rows(lake.shared_community_pairs(df, least), "zone_id", "a", "b", "shared", "weight")
    assert sorted(got) == _brute_pairs(members, least)


@pytest.mark.parametrize("hot", [1, 5])
def test_hot_communities_are_not_paired(spark, hot):
    """Everybody is in the hot communities and in one private one: no pair is built,
    however many users there are."""
    for users in (100, 400):
        members = [(0, u, g) for u in range(users) for g in range(hot)] + [(0, u, 1000 + u) for u in range(users)]
        df = spark.createDataFrame(members, "zone_id int, user_id long, group_id long")
        assert lake.shared_community_pairs(df, 500_000).count() == 0
        # Each user meets the others in no community: the private one has one member.
        assert plan(lake.shared_community_pairs(df, 500_000)).count("CartesianProduct") == 0


def test_contacts_are_not_recommended(spark):
    members = spark.createDataFrame([(0, u, g) for u in (1, 2, 3) for g in (5, 6)], "zone_id int, user_id long, group_id long")
    sent = spark.createDataFrame([(2, 1), (3, 3)], "from_id long, to_id long")
    received = spark.createDataFrame([(1, 2)], "from_id long, to_id long")
    contacts = lake.undirected(sent, received)
    assert rows(contacts) == [(1, 2)]
    found = lake.friend_recommendations(members, contacts, 1)
    assert rows(found, "a", "b", "shared", "weight") == [(1, 3, 2, 666_666), (2, 3, 2, 666_666)]


def test_dish_popularity(spark):
    lines = spark.createDataFrame([(1, 10, 1), (2, 10, 1), (3, 11, 1), (3, 11, 2), (4, 12, 2), (5, 13, 3)], "order_id long, user_id long, dish_id long")
    dishes = spark.createDataFrame([(1, "soup", "hot"), (2, "tea", "hot"), (3, "cake", "sweet")], "dish_id long, dish_name string, category string")
    out = popularity.dish_popularity(lines, dishes)
    assert rows(out, "dish_id", "orders", "users", "rank_overall", "rank_in_category") == [
        (1, 3, 2, 1, 1), (2, 2, 2, 2, 2), (3, 1, 1, 3, 1)]
    assert [r.dish_id for r in popularity.top_dishes(out, 2).collect()] == [1, 2]
    assert rows(popularity.user_item_counts(lines, "dish_id"))[0] == (10, 1, 2)


def test_a_null_community_keeps_its_place(spark):
    log = _log(spark, [(None, 1, "enter", 0), (None, 2, "enter", 1), (5, 1, "enter", 2), (6, 1, "enter", 3)])
    messages = _log(spark, [(None, 1, "m", 5)]).select("group_id", "user_id", "ts")
    out = rows(community.community_conversion(log, messages, "enter", 2), "group_id", "joined_users", "writers")
    assert sorted(out, key=repr) == [(5, 1, 0), (None, 2, 1)]


def test_unknown_dishes_and_categories_are_ranked(spark):
    lines = spark.createDataFrame([(1, 10, 1), (2, 10, 2), (3, 10, 2), (4, 10, None)], "order_id long, user_id long, dish_id long")
    dishes = spark.createDataFrame([(1, "soup", None)], "dish_id long, dish_name string, category string")
    out = popularity.dish_popularity(lines, dishes)
    got = rows(out, "dish_id", "dish_name", "orders", "rank_overall", "rank_in_category")
    assert sorted(got, key=repr) == [(1, "soup", 1, 2, 2), (2, None, 2, 1, 1), (None, None, 1, 2, 2)]


def test_threshold_follows_the_size_of_the_zone(spark):
    """Four times the users in communities four times as large: about the same share passes."""
    shares = []
    for users in (60, 240):
        rng = random.Random(users)
        data = [(z, u, g) for z in range(2) for u in range(users) for g in rng.sample(range(30), 6)]
        df = spark.createDataFrame(data, "zone_id long, user_id long, group_id long")
        sharing = lake.shared_community_pairs(df, 1).count()
        got = lake.shared_community_pairs(df, lake.zone_thresholds(df, 3))
        shares.append(got.count() / sharing)
        weights = {r.zone_id: r.min_weight for r in lake.zone_thresholds(df, 3).collect()}
        every = lake.shared_community_pairs(df, 1).collect()
        assert sorted((r.zone_id, r.a, r.b) for r in every if r.weight >= weights[r.zone_id]) == sorted(rows(got, "zone_id", "a", "b"))
    assert 0.02 < shares[0] and abs(shares[0] - shares[1]) < 0.3 * shares[0]
    # Nobody shares anything: no threshold to fall below.
    alone = spark.createDataFrame([(1, 1, 1), (1, 2, 2)], "zone_id long, user_id long, group_id long")
    assert rows(lake.zone_thresholds(alone, 3)) == [(1, 1)]


def test_pairs_stay_where_they_are_summed_up(spark):
    members = spark.createDataFrame([(1, u, g) for u in range(4) for g in range(2)], "zone_id long, user_id long, group_id long")
    contacts = spark.createDataFrame([(0, 1)], "a long, b long")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = lake.friend_recommendations(members, contacts, 1)
        joins = plan(out).split("LeftAnti", 1)[1]
        before_sums = joins.split("HashAggregate", 1)[0]
        assert "Exchange" not in before_sums and "(0, 1)" not in str([(r["a"], r["b"]) for r in out.collect()])
        assert out.columns == ["zone_id", "a", "b", "shared", "weight"] and out.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def _members(seed, users=90, groups=25):
    rng = random.Random(seed)
    members = {(u % 2, u, 7) for u in range(users)}
    members |= {(u % 2, u, rng.randrange(groups)) for u in range(users) for _ in range(rng.randrange(12))}
    return sorted(members)


@pytest.mark.parametrize("long_list", [0, 4, 1000])
def test_pairs_of_long_and_short_lists_equal_brute_force(spark, long_list):
    members = _members(long_list)
    df = spark.createDataFrame([*members, (1, None, 7), (None, 5, 7), (1, 5, None)], "zone_id int, user_id long, group_id long")
    for least in (60_000, 250_000):
        got = rows(lake.shared_community_pairs(df, least, long_list), "zone_id", "a", "b", "shared", "weight")
        # The extra rows: one member more of community 7 in zone 1, who meets nobody.
        sizes = {}
        for z, _, g in [*members, (1, None, 7)]:
            sizes[z, g] = sizes.get((z, g), 0) + 1
        of = {}
        for z, u, g in members:
            of.setdefault((z, u), set()).add(g)
        expected = []
        for (z, u), (y, v) in itertools.combinations(sorted(of), 2):
            both = of[z, u] & of[y, v] if z == y else set()
            weight = sum(lake.UNIT // sizes[z, g] for g in both)
            if weight >= least:
                expected.append((z, u, v, len(both), weight))
        assert sorted(got) == expected and expected


@pytest.mark.parametrize("long_list", [0, 1000])
def test_repeated_members_meet_as_often(spark, long_list):
    """User 1 twice in all: two copies meet one, as long as one of the two does not leave it out."""
    members = [(0, 1, g) for g in (5, 6)] * 2 + [(0, u, g) for u in (2, 3) for g in (5, 6)]
    df = spark.createDataFrame(members, "zone_id int, user_id long, group_id long")
    got = rows(lake.shared_community_pairs(df, 1, long_list), "a", "b", "shared", "weight")
    assert got == [(1, 2, 4, 1_000_000), (1, 3, 4, 1_000_000), (2, 3, 2, 500_000)]
    # User 1 leaves out both copies of one, users 2 and 3 one of their own.
    got = rows(lake.shared_community_pairs(df, 500_001, long_list), "a", "b", "shared", "weight")
    assert got == [(1, 2, 3, 750_000), (1, 3, 3, 750_000)]


def test_only_pairs_of_the_result_are_shuffled(spark, monkeypatch):
    df = spark.createDataFrame(_members(3), "zone_id int, user_id long, group_id long")
    dealt, repartition = [], type(df).repartition

    def seen(self, *args):
        dealt.append(self)
        return repartition(self, *args)

    monkeypatch.setattr(type(df), "repartition", seen)
    out = lake.shared_community_pairs(df, 250_000)
    assert [d.count() for d in dealt] == [out.count()] and out.count() > 20
