"""The trie against one that is built from the rebuilt texts themselves."""

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

from helpers import clashing
from martloom.llm import trie

TURNS = "conv_id long, turn long, role string, text string"
COLS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def crc_rule(c):
    return c - (c % 20 if c >= 0 else -(-c % 20)), zlib.crc32(str(c).encode()) % 4


def plain(rows, rule=crc_rule):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in convs.items()}
    whole = {}
    for c, turns in own.items():
        base, head = rule(c)
        whole[c] = tuple(own.get(base, [])[:head] + turns[head:])
    nodes = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        under = [p for p in nodes if p[:len(path)] == path]
        words = {p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0 for p in under}
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(path))
        out.append((min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
                    sum(len(p) == len(path) + 1 for p in under),
                    sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in under) for p in under),
                    sum((len(nodes[p]) - 1) * words[p] for p in under), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    assert df.columns == list(COLS)
    return sorted((tuple(r) for r in df.collect()), key=repr)


def random_turns(seed, convs, texts):
    pick = random.Random(seed)
    return [(c, t, pick.choice(["user", "assistant"]) if t else "user", pick.choice(texts)) for c in range(convs) for t in range(pick.randint(1, 7))]


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_a_plain_trie(spark, seed):
    rows = random_turns(seed, 90, ["one", "two words", "", "three more words"])
    found = got(trie.rebuilt(spark.createDataFrame(rows, TURNS).repartition(5)))
    assert found == plain(rows)
    assert max(r[6] for r in found) > 0


def test_awkward_rows(spark):
    rows = [(None, 1, "user", "nobody's"), (1, None, None, "first"), (1, 0, "user", None), (2, 1, "user", "same"), (2, 1, "user", "same"),
            (2, 1, "assistant", "tie"), (47, 0, "user", "short"), (45, 0, "a", "bc"), (46, 0, "ab", "c"), (-7, 3, "user", "below zero"),
            (20, 9, "x" * 30, "long role"), (20, 9, "x" * 20, "zz"), (20, 9, "x" * 20, "aa"), (61, 0, "user", "w " * 20_000), (9, 0, "user", "x" * 1_000_000)]
    docs = clashing(spark.createDataFrame(rows, TURNS), "depth", "a", "b", "part", "words")
    found = got(trie.rebuilt(docs))
    assert found == plain(rows)
    # Conversations all of whose turns are cut away are members of the root alone.
    assert any(r[1] == 0 and r[7] != hashlib.sha256(b"").hexdigest() for r in found)


def test_empty_table(spark):
    assert got(trie.rebuilt(spark.createDataFrame([], TURNS))) == []


def test_conversations_over_many_ranges(spark):
    rows = [(3, t, "user", f"turn {t % 5}") for t in range(400)] + [(c, t, "user", f"turn {t % 5}") for c in (0, 1, 5) for t in range(6)]
    cut = spark.createDataFrame(rows, TURNS).repartition(6)
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = trie.scanned(cut, 12, trie.PRIME)
        assert turns.filter("conv_id = 3").select("part").distinct().count() > 1
        assert got(trie.rebuilt(cut)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)


def test_other_bases_and_a_shared_first_turn(spark):
    rows = random_turns(4, 60, ["a", "b"]) + [(c, -1, "system", "hello there") for c in range(60)]
    conv = F.col("conv_id")
    found = got(trie.trie(spark.createDataFrame(rows, TURNS), conv % 3, F.lit(5)))
    assert found == plain(rows, lambda c: (c % 3, 5))


def test_collisions_are_seen_and_hashed_again(spark):
    rows = random_turns(5, 40, ["one", "two", "three", "four"])
    turns = spark.createDataFrame(rows, TURNS)
    conv = F.col("conv_id")
    rule = conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4
    assert got(trie.trie(turns, *rule, tries=((1, 3), (1, 5), *trie.TRIES))) == plain(rows)
    with pytest.raises(RuntimeError):
        trie.trie(turns, *rule, tries=((1, 3),))


_map = st.tuples(st.integers(1, trie.PRIME - 1), st.integers(0, trie.PRIME - 1))


@given(_map, _map, _map)
def test_products_are_a_group(x, y, z):
    p = trie.PRIME
    assert trie.then(trie.then(x, y, p), z, p) == trie.then(x, trie.then(y, z, p), p)
    assert trie.then(x, trie.inverse(x, p), p) == trie.then(trie.inverse(x, p), x, p) == (1, 0)


def test_digest_of_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE", 7)
    rows = spark.range(300).select((F.col("id") % 3 % 2).alias("k"), F.col("id").alias("v"))
    found = {r.k: r.digest for r in trie.ordered_digest(rows.repartition(7), ["k"], "v").collect()}
    for k in (0, 1):
        joined = ",".join(str(v) for v in range(300) if v % 3 % 2 == k)
        assert found[k] == hashlib.sha256(joined.encode()).hexdigest()
