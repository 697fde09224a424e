from __future__ import annotations

import random
import re

import numpy as np
import xxhash
from helpers import DOCS, awkward, clashing, empty, prose

from martloom.llm import graph, simhash


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """rows of (doc_id, fingerprint): doc_id -> smallest reachable."""
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if label[j] < label[i] and (rows[i][1] ^ rows[j][1]).bit_count() <= 3:
                    label[i], changed = label[j], True
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids.setdefault(label[i], []).append(doc)
    return [(doc, min((d for d in ids[label[i]] if d is not None), default=None)) for i, (doc, _) in enumerate(rows)]


def test_fingerprint_is_the_definition():
    for seed in range(20):
        text = prose(seed, seed * 3)
        assert simhash.fingerprint(text) & (1 << 64) - 1 == plain_fingerprint(text)
    assert simhash.fingerprint(None) == simhash.fingerprint(" \x0b\n") == 0


def test_chain_never_misses_a_close_pair():
    pick = random.Random(5)
    for _ in range(3000):
        bits = pick.sample(range(64), pick.randint(0, 3))
        difference = sum(1 << b for b in bits)
        segments = [(difference >> 8 * s & 255).bit_count() for s in range(8)]
        assert any(all(sum(segments[(s + k) % 8] for k in range(n)) <= simhash.quotas(3)[n - 1] for n in range(1, 9))
                   for s in range(8))


def near_rows(spark):
    """Fingerprints at chosen distances, as texts are unlikely to give them."""
    pick = random.Random(7)
    values = [pick.getrandbits(64) for _ in range(30)]
    for _ in range(200):
        values.append(pick.choice(values) ^ sum(1 << b for b in pick.sample(range(64), pick.randint(1, 5))))
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    return values, spark.createDataFrame([(v,) for v in signed], "fp long").distinct()


def test_pairs_against_brute_force(spark):
    values, groups = near_rows(spark)
    mask = (1 << 64) - 1
    got = {frozenset((r.a & mask, r.b & mask)) for r in simhash.close_pairs(groups).collect()}
    distinct = sorted(set(values))
    want = {frozenset((x, y)) for i, x in enumerate(distinct) for y in distinct[:i] if (x ^ y).bit_count() <= 3}
    assert got == want and len(want) > 50


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}


def documents(spark):
    base = prose(2, 300)
    rows = [(10, base), (11, base.replace("the1 ", "the2 ", 1)), (12, base), (13, prose(3, 300)), (14, None), (15, ""), (9, "the of")]
    return spark.createDataFrame([(i, t, "en", "a", len(t or "")) for i, t in rows], DOCS)


def test_query_shape_against_brute_force(spark):
    for docs in (documents(spark), awkward(spark)):
        rows = [(r.doc_id, plain_fingerprint(r.text)) for r in docs.collect()]
        got = simhash.near_duplicates(docs).collect()
        assert sorted(((r.doc_id, r.component_id) for r in got), key=repr) == sorted(plain_components(rows), key=repr)
        assert sorted(((r.doc_id, r.fp & (1 << 64) - 1) for r in got), key=repr) == sorted(rows, key=repr)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = clashing(documents(spark), "fp", "row", "own_id", "component")
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [9, 10, 13, 14]
    kept = simhash.drop_near_duplicates(awkward(spark)).collect()
    assert sorted((r.doc_id for r in kept), key=repr) == sorted([1, 2, 5, 7, 7, None, 9], key=repr)
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


def test_edited_copies_are_found_by_words_and_verified(spark):
    """Every 40th word edited: a similarity of about 0.8 on five words, but more than
    three bits on three."""
    pick = random.Random(12)
    rows, base = [], [prose(50 + g, 400).split() for g in range(12)]
    for g, words in enumerate(base):
        rows.append((100 * g, " ".join(words)))
        for c in range(1, 4):
            edited = list(words)
            for at in pick.sample(range(400), 6):
                edited[at] = f"edit{c}x{at}"
            rows.append((100 * g + c, " ".join(edited)))
    rows.append((9000, " ".join(sorted(base[0]))))  # the same words, another text
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCS)
    alone = {r.doc_id for r in simhash.drop_near_duplicates(docs, similar=None).collect()}
    kept = {r.doc_id for r in simhash.drop_near_duplicates(docs, similar=(5, 0.8)).collect()}
    assert {100 * g for g in range(12)} | {9000} <= kept <= alone
    assert len(kept) <= 13 + 9 < len(alone)


def test_no_id_is_not_minus_one(spark):
    rows = [(None, "one text of some words", "en", "a", 1), (-1, "one text of some words", "en", "b", 2), (-1, "another text altogether here", "en", "z", 3),
            (-1, "another text altogether here", "en", "c", 3)]
    for parts in (1, 4):
        out = simhash.drop_near_duplicates(spark.createDataFrame(rows, DOCS).repartition(parts)).collect()
        assert sorted((r.doc_id, r.source) for r in out) == [(-1, "b"), (-1, "c")]
    alone = simhash.drop_near_duplicates(spark.createDataFrame(rows[:1], DOCS)).collect()
    assert [r.doc_id for r in alone] == [None]


def test_parity_sketches_never_disprove_a_similar_pair(spark):
    """Sets of every similarity: those of 0.8 or more always pass, far ones of some hundred
    elements do not."""
    pick, rows = random.Random(31), []
    for _ in range(300):
        size, lost = pick.randint(1, 400), pick.random() ** 2
        x = {pick.getrandbits(64) - (1 << 63) for _ in range(size)}
        y = {v for v in x if pick.random() > lost} | {pick.getrandbits(64) - (1 << 63) for _ in range(int(size * lost * pick.random()))}
        rows.append((len(x & y) / len(x | y), simhash.parity(sorted(x)), len(x), simhash.parity(sorted(y)), len(y)))
    rows.append((1.0, simhash.parity([]), 0, simhash.parity([]), 0))
    pairs = spark.createDataFrame(rows, "s double, a_sketch array<long>, a_size long, b_sketch array<long>, b_size long")
    out = pairs.select("s", simhash.may_be_similar("a_", "b_", 0.8).alias("passes")).collect()
    assert all(r.passes for r in out if r.s >= 0.8) and sum(r.s >= 0.8 for r in out) > 30
    assert sum(r.passes for r in out if r.s < 0.6) < 0.2 * sum(r.s < 0.6 for r in out)
