from __future__ import annotations

import os
import random

import numpy as np
import pytest
from helpers import clashing
from pyspark.sql import functions as F

from martloom.llm import vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows):
    usable = []
    for i, v, label in rows:
        ok = label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v) and i is not None
        x = np.array(v, dtype=np.float32).astype(float) if ok else None
        usable.append(x / np.linalg.norm(x) if ok else None)
    n = len(rows)
    links = [[j for j in range(n) if j != i and usable[i] is not None and usable[j] is not None and rows[i][2] == rows[j][2]
              and float(usable[i] @ usable[j]) >= 0.93] for i in range(n)]
    least = [r[0] for r in rows]
    for _ in range(n):
        new = [min([least[i], *(least[j] for j in links[i])], key=lambda x: (x is None, x or 0)) for i in range(n)]
        if new == least:
            break
        least = new
    return sorted(((rows[i][0], len(links[i]), least[i], rows[i][0] == least[i]) for i in range(n)), key=repr)


def clouds(n=500, dim=16):
    pick = np.random.default_rng(3)
    rows = []
    centres = pick.normal(size=(40, dim))
    for i in range(n):
        kind = i % 4
        v = pick.normal(size=dim) if kind == 0 else centres[i % 40] + pick.normal(size=dim) * (0.02, 0.1, 0.25)[kind - 1]
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 3))
    rows += [(1000 + i, rows[7][1], rows[7][2]) for i in range(30)]
    return rows


def test_recall_against_brute_force(spark):
    rows = clouds()
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.vec_id: r for r in vectors.near_vectors(df).collect()}
    want = {w[0]: w for w in plain(rows)}
    assert len(got) == len(rows)
    true = sum(w[1] for w in want.values())
    assert all(got[i].n_links <= w[1] for i, w in want.items())
    assert true > 1000 and sum(r.n_links for r in got.values()) >= 0.97 * true
    same = sum(got[i].component_id == w[2] for i, w in want.items())
    assert same >= 0.97 * len(rows)


def test_exact_when_all_cells_are_visited(spark, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK", 20)
    monkeypatch.setattr(vectors, "fit", lambda *a, f=vectors.fit: (f(*a)[0], 100.0, 1.0))
    rows = clouds(160)
    got = vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)


def test_traversal_is_in_order():
    pick = np.random.default_rng(1)
    index = vectors.MultiIndex(pick.normal(size=(9, 4)), pick.normal(size=(9, 4)))
    for _ in range(20):
        d1, d2 = pick.random(9), pick.random(9)
        order = list(index.traverse(d1, d2))
        sums = [t for t, _ in order]
        assert sums == sorted(sums) and sorted(c for _, c in order) == list(range(81))
        assert all(abs(d1[c // 9] + d2[c % 9] - t) < 1e-12 for t, c in order)
        near = index.visited(d1, d2, 0.3)
        assert sorted(near) == sorted(c for t, c in order if t <= sums[0] + 0.3)


def test_awkward_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
            (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (2, [2.0, 0.0], 1), (11, [1.0, 0.3], 1), (12, [-1.0, 0.0], 1)]
    df = clashing(spark.createDataFrame(rows, SCHEMA), "n", "unit", "cells", "links")
    got = vectors.near_vectors(df).collect()
    assert sorted(map(tuple, got), key=repr) == plain(rows)
    assert vectors.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    odd = spark.createDataFrame([(1, [1.0, 0.0, 0.0], 1), (2, [1.0, 0.0, 0.0], 1), (3, [1.0, 0.0], 1)], SCHEMA)
    assert sorted(r.n_links for r in vectors.near_vectors(odd).collect()) == [0, 1, 1]


def pairs_and_rest(hot, pairs, rest, dim=32):
    """A tight group, ordinary pairs of cosine 0.935 to 0.99, and vectors without links."""
    pick = np.random.default_rng(11)
    unit = lambda v: v / np.linalg.norm(v)
    centre, rows = unit(pick.normal(size=dim)), []
    rows += [unit(centre + pick.normal(size=dim) * 0.002) for _ in range(hot)]
    for _ in range(pairs):
        x, other = unit(pick.normal(size=dim)), pick.normal(size=dim)
        cosine = pick.uniform(0.935, 0.99)
        rows += [x, cosine * x + np.sqrt(1 - cosine ** 2) * unit(other - (other @ x) * x)]
    rows += [unit(pick.normal(size=dim)) for _ in range(rest)]
    return [(i, [float(v) for v in row.astype(np.float32)], 1) for i, row in enumerate(rows)]


def found_pairs(spark, rows, hot, pairs):
    got = {r.vec_id: r.n_links for r in vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    return sum(got[hot + 2 * k] > 0 for k in range(pairs))


def test_a_hot_group_does_not_set_the_slack_of_the_others(spark):
    assert found_pairs(spark, pairs_and_rest(700, 600, 200), 700, 600) >= 0.98 * 600


def test_rare_pairs_are_found_by_the_proven_bound(spark):
    assert found_pairs(spark, pairs_and_rest(0, 20, 1500), 0, 20) == 20


def test_every_length_is_indexed(spark):
    """Pairs of a rare length, shorter or longer than most, link like any other."""
    rows = pairs_and_rest(0, 30, 300)
    extra = [(9000 + 100 * d + k, v, 1) for d in (2, 3, 33, 70) for k, v in enumerate(
        [r[1] for r in pairs_and_rest(0, 10, 0, dim=d)] if d > 3 else [[1.0, 0.01] + [0.0] * (d - 2), [1.0, 0.0] + [0.0] * (d - 2), [0.0, 1.0] + [0.0] * (d - 2)])]
    rows = rows + extra
    got = {r.vec_id: r for r in vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {w[0]: w for w in plain_by_length(rows)}
    assert all(got[i].n_links <= w[1] for i, w in want.items())
    of = lambda ids: (sum(got[i].n_links for i in ids), sum(want[i][1] for i in ids))
    found, true = of([r[0] for r in extra])
    assert true >= 44 and found >= 0.95 * true
    found, true = of(list(want))
    assert found >= 0.97 * true


def plain_by_length(rows):
    out = []
    for n in sorted({len(r[1]) for r in rows}):
        out += plain([r for r in rows if len(r[1]) == n])
    return out


def test_a_hot_cell_is_many_join_keys(spark, monkeypatch):
    """All vectors in one cell: pairs of blocks are keys, and every link is found."""
    monkeypatch.setattr(vectors, "BLOCK", 16)
    rows = [(i, [float(x) for x in v], 1) for i, v in enumerate(
        (np.ones(8) + np.random.default_rng(5).normal(size=(150, 8)) * 0.01).astype(np.float32))]
    got = vectors.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r.n_links, r.component_id) for r in got} == {(149, 0)}


def test_made_neighbours_lie_at_the_least_cosine():
    pick = np.random.default_rng(2)
    points = pick.normal(size=(50, 12))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    x, y = vectors.made_neighbours(points, 400)
    assert np.allclose((x * y).sum(1), vectors.COSINE) and np.allclose(np.linalg.norm(y, axis=1), 1) and len(x) > 380
    same = np.repeat(points[:1], 5, axis=0)
    assert len(vectors.made_neighbours(same, 10)[0]) == 5


def test_codewords_grow_with_the_rows():
    assert vectors.codewords(10) == vectors.codewords(100_000) == 32
    assert vectors.codewords(10 ** 9) == 1398


def test_recall_on_the_test_data(spark):
    path = "/root/testdata/check_s/embeddings.parquet"  # those of the smaller scales have no links
    if not os.path.exists(path):
        pytest.skip("test data not there")
    df = spark.read.parquet(path)
    rows = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    x = np.array([r[1] for r in rows], dtype=np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    hit = (x @ x.T >= vectors.COSINE) & (label[:, None] == label[None, :])
    np.fill_diagonal(hit, False)
    got = vectors.near_vectors(df).agg(F.sum("n_links")).first()[0]
    assert hit.sum() > 50_000 and 0.995 * hit.sum() <= got <= hit.sum()
