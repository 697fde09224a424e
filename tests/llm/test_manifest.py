"""The manifest against a plain tree, on small packs so that several lie above each other."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from helpers import DOCS, awkward, clashing, empty
from martloom.llm import manifest


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_leaf(row, more=0):
    out = ""
    for name in manifest.COLUMNS:
        value = row[name]
        if value is not None and name == "n_chars":
            value += more
        out += "-" if value is None else f"{len(str(value).encode())}:{value}"
    return h(out)


def plain_tree(leaves, arity):
    """Levels from the leaves up."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + arity])) for i in range(0, len(levels[-1]), arity)])
    return levels


def plain_path(levels, rank, arity):
    path = []
    for level in levels[:-1]:
        first = rank // arity * arity
        run = level[first:first + arity]
        path.append((run[:rank - first], run[rank - first + 1:]))
        rank //= arity
    return path


def plain(rows, arity=2):
    groups = {}
    for row in rows:
        groups.setdefault(row["lang"], []).append(row)
    order = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for name in order:
        groups[name].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r)))
        trees[name] = plain_tree([plain_leaf(r) for r in groups[name]], arity)
    top = plain_tree([trees[name][-1][0] for name in order], arity) if order else []
    out = []
    for k, name in enumerate(order):
        for rank, row in enumerate(groups[name]):
            path = plain_path(trees[name], rank, arity) + plain_path(top, k, arity)
            tampered = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0
            own = plain_leaf(row, int(tampered))
            for left, right in path:
                own = h("".join(left) + own + "".join(right))
            root = top[-1][0]
            out.append((row["doc_id"], plain_leaf(row), trees[name][-1][0], root,
                        h("".join("".join(left) + "".join(right) for left, right in path)), own, own == root))
    return sorted(out, key=repr)


def got(df):
    cols = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("arity, levels", [(2, 10), (2, 3), (3, 2)])
def test_proofs_equal_a_plain_tree(spark, arity, levels):
    rows = [(i * 37 % 101, f"text {i}", ["en", "de", "é", None][min(i % 7, 3)], f"s{i % 3}", None if i % 5 == 0 else i) for i in range(90)]
    docs = spark.createDataFrame([*rows, *rows[:9], (500, "alone", "zz", None, 1)], DOCS)
    found = got(manifest.verified(docs, arity, levels))
    assert found == plain(docs.collect(), arity)
    assert {r[-1] for r in found} == {True, False}


def test_awkward_rows(spark):
    docs = awkward(spark)
    assert got(manifest.verified(docs, levels=2)) == plain(docs.collect())
    assert got(manifest.verified(clashing(docs, "tree", "rank", "digest", "leaf", "n", "part"), levels=2)) == plain(docs.collect())


def test_one_row_is_its_own_root(spark):
    docs = awkward(spark).filter("doc_id = 1")
    (row,) = got(manifest.verified(docs))
    assert row[1] == row[2] == row[3] and row[4] == h("")


def test_empty_table(spark):
    assert got(manifest.verified(empty(spark))) == []


def test_a_hot_group_with_equal_rows_is_spread(spark):
    docs = spark.createDataFrame([(1, "same", "en", "s", 4)] * 700 + [(i, "x", "de", "s", 1) for i in range(200)], DOCS)
    assert got(manifest.verified(docs, levels=3)) == plain(docs.collect())


def test_some_requests_only(spark):
    docs = spark.createDataFrame([(i, f"t{i}", "en" if i % 3 else "de", "s", i) for i in range(60)], DOCS)
    columns = {c: F.col(c) for c in manifest.COLUMNS}
    book = manifest.manifest(docs, F.col("lang"), ["doc_id"], manifest.leaf(columns), {"doc_id": F.col("doc_id")}, levels=2)
    wanted = book.leaves.filter("doc_id IN (3, 4, 59)").select("tree", "rank", F.col("doc_id").cast("string").alias("note"))
    found = manifest.proofs(book, wanted, levels=2).withColumn("up", manifest.folded(F.col("leaf"), F.col("path"))).collect()
    assert sorted(r.note for r in found) == ["3", "4", "59"]
    assert all(r.up == r.root for r in found)
    # The store maps a digest to its children.
    for pack in book.trees.packs.collect():
        assert all(h(kids) == name for name, kids in zip(pack.names, pack.children))
