from __future__ import annotations

import random
import re

from helpers import DOCS, awkward, clashing, empty, prose
from pyspark.sql import functions as F

from martloom.llm import mixing


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    goal, full = share * sum(sizes.values()), set()
    while True:
        rest = goal - sum(most * sizes[s] for s in full)
        level = rest / sum(weight[s] for s in sizes if s not in full) if full != set(sizes) else 0
        above = {s for s in sizes if s not in full and weight[s] * level > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in full else min(weight[s] * level, most * sizes[s]) for s in sizes}
        full |= above


def corpus(spark, n=1500):
    pick = random.Random(11)
    rows = []
    for i in range(n):
        source = pick.choice(["s0"] * 6 + ["s1", "s2", "S3", "é", None])
        text = prose(i, pick.choice([3, 10, 40, 200]))
        rows.append((i, text, "en", source, len(text)))
    return spark.createDataFrame(rows, DOCS)


def test_targets_and_sizes(spark):
    docs = corpus(spark)
    out = mixing.mix(docs).collect()
    sources = {r.doc_id: r.source for r in docs.collect()}
    sizes: dict = {}
    for r in docs.collect():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
        sizes[r.source] = sizes.get(r.source, 0) + words
    want = plain_targets(sizes)
    taken: dict = {}
    for r in out:
        source = sources[r.doc_id]
        assert r.source_size == sizes[source] and abs(r.target - want[source]) < 1e-6 * r.target
        assert r.taken in (0, r.size, 2 * r.size)
        taken[source] = taken.get(source, 0) + r.taken
    assert len(out) == 1500
    for source, words in taken.items():
        assert abs(words - want[source]) <= 200  # half of the largest document on either side
    assert abs(sum(want.values()) - 1.5 * sum(sizes.values())) < 1e-3


def test_reruns_agree_whatever_the_partitions(spark):
    docs = corpus(spark, 400)
    first, second = mixing.mix(docs), mixing.mix(docs.repartition(7, F.rand(3)))
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, second.collect()))


def test_ranks_are_pareto(spark):
    """Shares of odds: a chance of one half ranks by the random number itself."""
    rank = spark.range(1).select(mixing.pareto_rank(F.lit(0.3), F.lit(0.5)).alias("a"),
                                 mixing.pareto_rank(F.lit(0.3), F.lit(0.9)).alias("b")).first()
    odds = (0.3 / 0.7) / 9
    assert abs(rank.a - 0.3) < 1e-12 and abs(rank.b - odds / (1 + odds)) < 1e-12


def test_documents_are_repeated(spark):
    docs = clashing(corpus(spark, 300), "copies", "rank", "cut", "whole", "size")
    taken = {r.doc_id: r.taken // r.size for r in mixing.mix(docs).collect()}
    out = mixing.mixed_documents(docs)
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert out.columns == docs.columns
    assert counts == {d: n for d, n in taken.items() if n}


def test_awkward_rows(spark):
    out = mixing.mix(awkward(spark)).collect()
    assert len(out) == 11
    assert all(r.taken <= 2 * r.size and r.size >= 0 for r in out)
    assert mixing.mix(empty(spark)).count() == 0
    assert mixing.mixed_documents(empty(spark)).count() == 0
    blank = spark.createDataFrame([(1, None, None, "a", 0), (2, "", None, "b", 0)], DOCS)
    assert [(r.target, r.taken) for r in mixing.mix(blank).collect()] == [(0.0, 0), (0.0, 0)]


def plain_level(sizes, target, most=2.0):
    """The level at which the expected copies of all documents meet the target, by halving."""
    bits = lambda n: max(1, n.bit_length())
    low, high = 0.0, 2 * most
    for _ in range(100):
        mid = (low + high) / 2
        if sum(min(most, mid * bits(n)) * n for n in sizes) < target:
            low = mid
        else:
            high = mid
    return [min(most, high * bits(n)) for n in sizes]


def test_expected_copies_meet_the_target(spark):
    docs = corpus(spark, 500)
    sized = mixing.slim(docs)
    cuts = mixing.plan(sized)
    rows = sized.alias("d").join(cuts.alias("c"), F.col("d.source").eqNullSafe(F.col("c.source"))).select(
        "d.source", "size", "target", mixing.expected(F.col("size"), F.col("level")).alias("e"),
        mixing.whole_copies(F.col("size"), F.col("level")).alias("whole"), mixing.chance(F.col("size"), F.col("level")).alias("chance")).collect()
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert abs(sum(r.e * r.size for r in own) - own[0].target) < 1e-6 * own[0].target
        want = plain_level([r.size for r in own], own[0].target)
        assert all(abs(r.e - w) < 1e-6 and abs(r.whole + r.chance - r.e) < 1e-6 for r, w in zip(own, want))
        assert len({round(r.e, 9) for r in own}) > 1 or own[0].target > 1.99 * sum(r.size for r in own)


def test_inclusion_frequencies_are_the_probabilities(spark):
    """Over many seeds, each size is taken as often as its chance says, and the order by
    Pareto ranks differs from a plain random one."""
    pick = random.Random(5)
    rows = [(i, prose(i, pick.choice([2, 20, 300])), "en", "ab"[i % 2], 0) for i in range(300)]
    sized = mixing.slim(spark.createDataFrame(rows, DOCS))
    wanted, got, seeds = {}, {}, 16
    for seed in range(seeds):
        cuts = mixing.plan(sized, seed=seed)
        out = mixing._copies(sized, cuts, 2.0, seed).select(
            "source", "size", "copies", mixing.expected(F.col("size"), F.col("level")).alias("e")).collect()
        for r in out:
            key = r.source, r.size
            wanted[key] = r.e
            got.setdefault(key, []).append(r.copies)
    assert len({round(e, 6) for e in wanted.values()}) >= 4
    for key, e in wanted.items():
        mean = sum(got[key]) / len(got[key])
        assert abs(mean - e) < 0.06, (key, e, mean)


def test_plan_of_copies_does_not_pass_the_most(spark):
    rows = [(i, "w " * (1 + i % 7), "en", "only", 0) for i in range(50)] + [(100, "x " * 5000, "en", "big", 0)]
    out = mixing.mix(spark.createDataFrame(rows, DOCS), share=5.0).collect()
    assert all(r.taken == 2 * r.size for r in out)
