"""Mixes sources to target weights by Pareto order sampling.

A source's target is a share of the wanted words by weight, at most ``MOST`` times its
size; what exceeds that goes to the others by weight until none is above. Inside a source
documents are wanted unequally: longer ones more, by the bits of their length. A document's
expected copies are its weight times a level that the source's target sets, at most
``MOST``; sizes of one number of bits share a weight, so the level comes from one small row
per source and number of bits.

The whole part of the expected copies is allotted for certain. The rest is the inclusion
probability of one copy more, in a sample of fixed size in words: documents are ranked by
random odds divided by their inclusion odds, and taken in that order until the words are
there.

Where the order is cut is found by digits of the rank: sums by (source, digit) narrow the
cut to one of ``DIGIT`` ranges, three times, so no source is ever sorted in one task.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; a source of size 0 has target 0; rows equal in id and text share one decision; an
empty table gives an empty table. Reruns agree, since the random numbers are hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.rows import fresh, text_hash
from martloom.operators.ranking import with_exact_rank
from martloom.session import stored

WEIGHTS, SHARE, MOST = (3, 1, 2), 1.5, 2.0
DIGIT, LEVELS, SEED = 1024, 3, 20
WORD = r"[^\x20\x09-\x0D]+"
#: Chances closer to 0 than this are none.
NONE = 1e-9


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_size, target) from (source, source_size). Weights repeat over the
    sources by code point, null last. Each round ends with two sums on the driver."""
    ranked = with_exact_rank(sources, [F.col("source").isNull(), F.col("source")], "rank", "sources").withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                               (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = stored(ranked.select("source", "source_size", "weight"), "mix_sources")
    goal = share * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    full, before = F.lit(False), -1
    while True:
        row = ranked.agg(
            F.sum(F.when(full, F.col("source_size") * most).otherwise(0.0)),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.sum(full.cast("int"))).first()
        capped, weight, n_full = row[0] or 0.0, row[1] or 0.0, row[2] or 0
        level = max(0.0, goal - capped) / weight if weight else 0.0
        if n_full == before or not weight:
            break
        before = n_full
        full = full | (F.col("weight") * level > F.col("source_size") * most)
    target = F.when(full, F.col("source_size") * most).otherwise(
        F.least(F.col("weight") * level, F.col("source_size") * most))
    return ranked.select("source", "source_size", target.cast("double").alias("target"))


def _uniform(seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "doc_id", "text_hash"), 11)
    return (bits.cast("double") + 0.5) / F.lit(float(1 << 53))


def pareto_rank(uniform: Column, chance: Column) -> Column:
    """Random odds over inclusion odds, folded into 0 to 1 without a change of order."""
    chance = F.least(F.greatest(chance, F.lit(NONE)), F.lit(1 - NONE))
    odds = (uniform / (1 - uniform)) / (chance / (1 - chance))
    return odds / (1 + odds)


def bits(size: Column) -> Column:
    """The bits of a size, 1 at least: the weight of a document."""
    return F.greatest(F.lit(1), F.length(F.bin(size))).cast("int")


def levels(classes: DataFrame, sources: DataFrame, most: float = MOST) -> DataFrame:
    """``sources`` with the level that makes the expected copies of a source meet its target,
    from (source, bits, words). A class at ``most`` copies gives what it is too much to the
    others: the level is that of the heaviest class that stays below."""
    above = Window.partitionBy("s.source").orderBy(F.desc("bits")).rowsBetween(Window.unboundedPreceding, -1)
    below = Window.partitionBy("s.source").orderBy(F.desc("bits")).rowsBetween(0, Window.unboundedFollowing)
    tried = classes.alias("c").join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).select(
        "s.source", "target", "bits", "words",
        F.coalesce(F.sum("words").over(above), F.lit(0)).alias("full"), F.sum(F.col("words") * F.col("bits")).over(below).alias("weighed"))
    level = F.when(F.col("weighed") > 0, F.greatest(F.lit(0.0), F.col("target") - most * F.col("full")) / F.col("weighed")).otherwise(0.0)
    fits = tried.withColumn("level", level).filter(F.col("level") * F.col("bits") <= most * (1 + 1e-9))
    best = fits.groupBy("source").agg(F.max_by("level", "bits").alias("level"))
    # Where none fits, all classes are at their most.
    return sources.alias("s").join(best.alias("b"), F.col("s.source").eqNullSafe(F.col("b.source")), "left").select(
        "s.*", F.coalesce("level", F.lit(float(most))).alias("level"))


def expected(size: Column, level: Column, most: float = MOST) -> Column:
    return F.least(F.lit(float(most)), bits(size) * level)


def whole_copies(size: Column, level: Column, most: float = MOST) -> Column:
    return F.floor(expected(size, level, most) + NONE).cast("int")


def chance(size: Column, level: Column, most: float = MOST) -> Column:
    """Inclusion probability of one copy more."""
    return F.greatest(F.lit(0.0), expected(size, level, most) - whole_copies(size, level, most))


def plan(slim: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """One row per source: source, source_size, target, level, rest (words that the sample
    is to take), and cut, the last (rank, doc_id, text_hash) that it takes, null if none.

    ``slim`` has doc_id, text_hash, source, size and is read once per digit.
    """
    classes = stored(slim.groupBy("source", bits(F.col("size")).alias("bits")).agg(F.sum("size").alias("words")), "mix_classes")
    sources = targets(classes.groupBy("source").agg(F.sum("words").alias("source_size")), weights, share, most)
    sources = levels(classes, sources, most)
    certain = F.floor(F.least(F.lit(float(most)), F.col("bits") * F.col("level")) + NONE) * F.col("words")
    sure = classes.alias("c").join(sources.alias("s"), F.col("c.source").eqNullSafe(F.col("s.source"))).groupBy("s.source").agg(
        F.sum(certain).alias("sure"))
    sources = stored(sources.alias("s").join(sure.alias("u"), F.col("s.source").eqNullSafe(F.col("u.source"))).select(
        "s.*", (F.col("target") - F.col("sure")).alias("rest")), "mix_plan")
    ranked = _ranked(slim, sources, most, seed)
    open_ = sources.select("source", F.lit(0).cast("long").alias("head"), "rest")
    for level in range(1, LEVELS + 1):
        inside = (ranked.withColumn("code", F.floor(F.col("rank") * F.lit(float(DIGIT ** level))).cast("long"))
                  .alias("r").join(open_.alias("o"), F.col("r.source").eqNullSafe(F.col("o.source"))
                                   & (F.floor(F.col("code") / DIGIT) == F.col("head")))
                  .groupBy("o.source", "code").agg(F.sum("size").alias("words"), F.first("o.rest").alias("rest")))
        upto = Window.partitionBy("source").orderBy("code").rowsBetween(Window.unboundedPreceding, 0)
        inside = inside.withColumn("total", F.sum("words").over(upto)).filter("total > rest")
        open_ = stored(inside.groupBy("source").agg(F.min_by(F.struct(
            F.col("code").alias("head"), (F.col("rest") - F.col("total") + F.col("words")).alias("rest")), "code").alias("x"))
            .select("source", "x.head", "x.rest"), "mix_cut")
    # What is left is a few documents per source, or rows that cannot be told apart.
    last = (ranked.withColumn("code", F.floor(F.col("rank") * F.lit(float(DIGIT ** LEVELS))).cast("long"))
            .alias("r").join(open_.alias("o"), F.col("r.source").eqNullSafe(F.col("o.source")) & (F.col("code") == F.col("head")))
            .groupBy("o.source", "rank", "doc_id", "text_hash").agg(F.sum("size").alias("words"), F.first("o.rest").alias("rest")))
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "text_hash")
    last = last.withColumn("total", F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    taken = F.col("total") - F.col("words") / 2 <= F.col("rest")
    cut = F.struct("rank", "doc_id", "text_hash")
    cuts = stored(last.groupBy("source").agg(F.max(F.when(taken, cut)).alias("cut"), F.min("rank").alias("floor")), "mix_cuts")
    return sources.alias("s").join(cuts.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")), "left").select(
        "s.source", "source_size", "target", "level", "rest", "cut", "floor")


def _ranked(slim: DataFrame, sources: DataFrame, most: float, seed: int) -> DataFrame:
    """Documents with a chance, and their rank."""
    own = chance(F.col("size"), F.col("level"), most)
    return slim.alias("d").join(sources.select("source", "level").alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))).select(
        "d.*", own.alias("chance")).filter(F.col("chance") > NONE).withColumn("rank", pareto_rank(_uniform(seed), F.col("chance")))


def _copies(keyed: DataFrame, cuts: DataFrame, most: float, seed: int) -> DataFrame:
    """``keyed`` with the columns of ``cuts`` and copies. ``keyed`` has source, doc_id,
    text_hash and size."""
    joined = keyed.alias("d").join(cuts.withColumnRenamed("source", "of_source").alias("c"),
                                   F.col("d.source").eqNullSafe(F.col("of_source")))
    own = chance(F.col("size"), F.col("level"), most)
    rank = pareto_rank(_uniform(seed), own)
    # Without a cut the sample takes all that ranks below the narrowed range.
    chosen = F.when(F.col("cut").isNotNull(), F.struct(rank.alias("rank"), "doc_id", "text_hash") <= F.col("cut")) \
        .when(F.col("floor").isNotNull(), rank < F.col("floor")).otherwise(F.col("rest") > 0)
    more = F.when(own > NONE, chosen.cast("int")).otherwise(0)
    return joined.withColumn("copies", whole_copies(F.col("size"), F.col("level"), most) + more)


def slim(docs: DataFrame) -> DataFrame:
    """Ids, sources and sizes, stored once: the texts are read a single time."""
    return stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"),
                              "source", n_words(F.col("text")).alias("size")), "mix_slim")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, seed: int = SEED) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row."""
    sized = slim(docs)
    cuts = stored(plan(sized, weights, share, most, seed), "mix_choice")
    return _copies(sized, cuts, most, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST,
                    seed: int = SEED) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own columns.
    The texts are not shuffled: the plan is one row per source."""
    cuts = stored(plan(slim(docs), weights, share, most, seed), "mix_choice")
    (whole,) = fresh(docs, "whole_row")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(whole)).select(
        whole, F.col(f"{whole}.doc_id").cast("long").alias("doc_id"), F.col(f"{whole}.source").alias("source"),
        text_hash(f"{whole}.text").alias("text_hash"), n_words(F.col(f"{whole}.text")).alias("size"))
    return (_copies(keyed, cuts, most, seed).filter("copies > 0")
            .select(whole, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select(f"{whole}.*"))
