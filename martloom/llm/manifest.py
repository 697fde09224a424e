"""Merkle manifest of a data set: a content-addressed DAG of digests, and proofs from it.

A node is the SHA-256 of its children's hexadecimal digests, and the store maps a digest
to its children. Records are kept in packs: one pack holds ``LEVELS`` levels below one
digest, so a lookup by digest brings the whole descent through them. Building goes up pack
by pack; a proof goes down from the root: the digits of a leaf's rank choose the child on
each level, the children that were not chosen are collected, and the path is reversed at
the end. Requests that share a prefix of digits are one request until they part, so a
proof of every leaf walks each pack once.

Two storeys: the leaves of one group (a language) are a tree, and the roots of all groups
are the leaves of the last tree. Every task holds at most ``arity ** levels`` nodes; groups
of any size are ranked by a range sort, so a hot one is spread. The number of levels grows
with the logarithm of the rows.

Defined results: null is ``-`` in a leaf; a null group is a group of its own, the first
one; rows with the same order key are ordered by their leaves, and equal rows are leaves
of their own; an empty table has no leaves, no root and no proofs; other columns of the
table are not looked at.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W
from pyspark.sql import functions as F

from martloom.llm.rows import map_columns
from martloom.session import stored

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: Children of a node, and levels of a pack: a pack has at most ARITY ** LEVELS lowest nodes.
ARITY, LEVELS = 2, 10
#: The tree over the roots of all groups; a group's own tree is named by its value.
TOP, NULL_GROUP, GROUP = "top", "-", "="
_HEX = 64


def framed(value: Column) -> Column:
    """Byte count, colon, value; a dash for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def leaf(columns: dict[str, Column]) -> Column:
    return digest(*[framed(c) for c in columns.values()])


def group_name(value: Column) -> Column:
    """Null first, then the values by their bytes."""
    return F.coalesce(F.concat(F.lit(GROUP), value.cast("string")), F.lit(NULL_GROUP))


def ranked(nodes: DataFrame, order: list[str]) -> tuple[DataFrame, DataFrame]:
    """``nodes`` (with ``tree``) and their ``rank`` in the tree from 0; (tree, n).

    Rows are sorted by ranges, so that a tree of any size is spread over the tasks; a
    rank is the place in the range plus the rows of the same tree in earlier ranges.
    """
    # Equal rows may go to different ranges as well.
    keys, place = ["tree", *order, "place"], F.monotonically_increasing_id()
    rows = nodes.withColumn("place", place).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = stored(rows.withColumn("at", place).drop("place"), "ranks").withColumn("part", F.shiftright("at", 33))
    chunks = rows.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = W.partitionBy("tree").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    chunks = stored(chunks.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))), "chunks")
    out = rows.join(chunks.select("tree", "part", "first", "before"), ["tree", "part"]).withColumn(
        "rank", F.col("at") - F.col("first") + F.col("before")).drop("at", "first", "before", "part")
    return out, chunks.groupBy("tree").agg(F.sum("n").alias("n"))


def _grown(level: list[str], levels: int, whole: bool, arity: int) -> tuple[dict[str, str], str, int]:
    """Records of the nodes above ``level``, the topmost digest and the levels added: all
    of ``levels``, or up to a single node where ``level`` is a whole level of its tree."""
    records: dict[str, str] = {}
    height = 0
    while height < levels and not (whole and len(level) == 1):
        above = []
        for i in range(0, len(level), arity):
            children = "".join(level[i:i + arity])
            name = hashlib.sha256(children.encode()).hexdigest()
            records[name] = children
            above.append(name)
        level, height = above, height + 1
    return records, level[0], height


@dataclass(frozen=True)
class Forest:
    """``packs`` (digest, height, names, children) and ``roots`` (tree, digest, n)."""

    packs: DataFrame
    roots: DataFrame


def forest(nodes: DataFrame, sizes: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> Forest:
    """Build the trees over ``nodes`` (tree, rank, digest); ``sizes`` is (tree, n)."""
    width = arity ** levels
    level, left = nodes.select("tree", "rank", "digest"), F.col("n")
    packs = roots = None
    while packs is None or not level.isEmpty():
        groups = level.groupBy("tree", F.floor(F.col("rank") / width).alias("slot")).agg(
            F.sort_array(F.collect_list(F.struct("rank", "digest"))).alias("m")).join(sizes, "tree").withColumn("left", left)

        def make():
            def work(trees, slots, ns, lefts, members):
                built = [_grown([x["digest"] for x in m], levels, left <= width, arity)
                         for m, left in zip(members, lefts, strict=True)]
                return (trees, slots, ns, [-(-x // width) for x in lefts], [b[1] for b in built], [b[2] for b in built],
                        [list(b[0]) for b in built], [list(b[0].values()) for b in built])
            return work

        fields = [("tree", "string"), ("rank", "long"), ("n", "long"), ("left", "long"), ("digest", "string"),
                  ("height", "long"), ("names", "array<string>"), ("children", "array<string>")]
        built = stored(map_columns(groups, ["tree", "slot", "n", "left", "m"], fields, make, slice_rows=4), "packs")
        own = built.filter("height > 0").select("digest", "height", "names", "children")
        done = built.filter("left = 1").select("tree", "digest", "n")
        packs, roots = (own, done) if packs is None else (packs.unionByName(own), roots.unionByName(done))
        level, left = built.filter("left > 1").select("tree", "rank", "digest"), F.ceil(left / width)
    # Equal subtrees are one record of the store.
    return Forest(packs.dropDuplicates(["digest"]), roots)


def _digits(local: int, height: int, arity: int) -> list[int]:
    out = []
    for _ in range(height):
        out.append(local % arity)
        local //= arity
    return out[::-1]


def _descended(name: str, height: int, records: dict[str, str], local: int, arity: int) -> tuple[str, list[str], list[str]]:
    """The digest that the digits of ``local`` lead to, and per level what is left and right."""
    lefts, rights = [], []
    for digit in _digits(local, height, arity):
        children = records[name]
        at = digit * _HEX
        lefts.append(children[:at])
        rights.append(children[at + _HEX:])
        name = children[at:at + _HEX]
    return name, lefts, rights


_CARRIED = [("tree", "string"), ("subroot", "string"), ("digest", "string"), ("lefts", "array<string>"), ("rights", "array<string>")]


def descend(packs: DataFrame, starts: DataFrame, wanted: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """Go from the roots of trees down to the wanted leaves.

    ``starts``: (tree, n, subroot, digest, lefts, rights) with the path down to each root;
    ``wanted``: (tree, rank, note), each leaf at most once. Gives (tree, subroot, digest,
    lefts, rights, rank, note): the digest found and the unselected children of every
    level, from the root down.
    """
    width = arity ** levels
    bands, reach = F.lit(0), width ** 0
    while reach < (1 << 62):
        bands, reach = bands + (F.col("n") > reach).cast("int"), reach * width
    starts = stored(starts.withColumn("bands", bands), "starts")
    deepest = starts.agg(F.max("bands")).first()[0] or 0
    carried = [c for c, _ in _CARRIED]
    # A tree of one leaf: its root is the leaf.
    found = starts.filter("bands = 0").select(*carried).join(wanted, "tree")
    frontier = None
    for band in range(deepest, 0, -1):
        begin = starts.filter(F.col("bands") == band).select(*carried, F.lit(0).cast("long").alias("slot"))
        frontier = begin if frontier is None else frontier.unionByName(begin)
        asked = wanted.withColumn("rank", F.floor(F.col("rank") / width ** (band - 1)))
        if band > 1:
            asked = asked.select("tree", "rank").distinct().withColumn("note", F.lit(None).cast("string"))
        asked = asked.groupBy("tree", F.floor(F.col("rank") / width).alias("slot")).agg(
            F.collect_list("rank").alias("ranks"), F.collect_list(F.coalesce("note", F.lit(""))).alias("notes"))
        visits = frontier.join(asked, ["tree", "slot"]).join(packs, "digest")

        def make():
            def work(trees, subroots, names, lefts, rights, slots, ranks, notes, heights, keys, children):
                for k, slot in enumerate(slots):
                    records = dict(zip(keys[k], children[k], strict=True))
                    steps = [_descended(names[k], heights[k], records, rank - slot * width, arity) for rank in ranks[k]]
                    n = len(steps)
                    yield ([trees[k]] * n, [subroots[k]] * n, [s[0] for s in steps], [lefts[k] + s[1] for s in steps],
                           [rights[k] + s[2] for s in steps], ranks[k], notes[k])
            return lambda *columns: _merged(work(*columns), 7)

        reached = map_columns(visits, [*carried, "slot", "ranks", "notes", "height", "names", "children"],
                              [*_CARRIED, ("rank", "long"), ("note", "string")], make, slice_rows=1)
        if band > 1:
            frontier = stored(reached.select(*carried, F.col("rank").alias("slot")), "frontier")
        else:
            found = found.unionByName(reached)
    return found


def _merged(parts, width: int) -> list[list]:
    out: list[list] = [[] for _ in range(width)]
    for part in parts:
        for column, values in zip(out, part, strict=True):
            column += values
    return out


@dataclass(frozen=True)
class Manifest:
    """``leaves`` (tree, rank, digest, and the columns kept), the store of both storeys,
    and ``root`` (tree, digest, n), one row or none."""

    leaves: DataFrame
    trees: Forest
    top: Forest
    names: DataFrame


def manifest(rows: DataFrame, group: Column, order: list[str], digest_of: Column, kept: dict[str, Column] | None = None,
             arity: int = ARITY, levels: int = LEVELS) -> Manifest:
    """The manifest of ``rows``: leaves ``digest_of`` by ``group``, ordered by ``order``
    and then by digest. ``kept`` names more columns for the leaf table."""
    kept = kept or {}
    nodes = rows.select(group_name(group).alias("tree"), digest_of.alias("digest"), *[c.alias(k) for k, c in kept.items()])
    leaves, sizes = ranked(nodes, [*order, "digest"])
    leaves = stored(leaves, "leaves")
    trees = forest(leaves.select("tree", "rank", "digest"), sizes, arity, levels)
    names, top_sizes = ranked(trees.roots.select(F.lit(TOP).alias("tree"), F.col("tree").alias("name"), "digest", "n"), ["name"])
    names = stored(names, "subroots")
    return Manifest(leaves, trees, forest(names.select("tree", "rank", "digest"), top_sizes, arity, levels), names)


def proofs(book: Manifest, wanted: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """Proofs of ``wanted`` (tree, rank, note): (tree, rank, note, leaf, subroot, root, path).

    ``path`` goes from the leaf to the root; each level has the digests to the left and to
    the right of the own one. Each leaf may be asked for once.
    """
    none = F.array().cast("array<string>")
    root = book.top.roots.select("tree", "n", F.col("digest").alias("subroot"), "digest", none.alias("lefts"), none.alias("rights"))
    subroots = book.names.select("tree", "rank", F.to_json(F.struct("name", F.col("n").cast("string").alias("n"))).alias("note"))
    down = descend(book.top.packs, root, subroots, arity, levels)
    told = F.from_json("note", "name string, n string")
    starts = down.select(told["name"].alias("tree"), told["n"].cast("long").alias("n"),
                         F.to_json(F.struct(F.col("digest").alias("subroot"), F.col("subroot").alias("root"))).alias("subroot"),
                         "digest", "lefts", "rights")
    out = descend(book.trees.packs, starts, wanted, arity, levels)
    above = F.from_json("subroot", "subroot string, root string")
    # The path from the root, reversed.
    path = F.reverse(F.arrays_zip("lefts", "rights"))
    return out.select("tree", "rank", "note", F.col("digest").alias("leaf"), above["subroot"].alias("subroot"),
                      above["root"].alias("root"), path.alias("path"))


def folded(start: Column, path: Column) -> Column:
    """The root that ``start`` and the digests beside its path give."""
    return F.aggregate(path, start, lambda own, at: digest(at["lefts"], own, at["rights"]))


def siblings(path: Column) -> Column:
    """All digests beside a path, level by level, left to right."""
    return F.array_join(F.transform(path, lambda at: F.concat(at["lefts"], at["rights"])), "")


def verified(docs: DataFrame, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """Each row's leaf, subroot, root, digest of its proof, and whether the row as it is
    now (``n_chars`` one too many where 7 divides the hash of ``doc_id``) still proves it."""
    columns = {c: F.col(c) for c in COLUMNS}
    added = F.col("n_chars").cast("decimal(38,0)") + 1
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    altered = F.when(tampered & F.col("n_chars").isNotNull(), leaf(columns | {"n_chars": added}))
    book = manifest(docs.select(*COLUMNS), F.col("lang"), ["doc_id"], leaf(columns),
                    {"doc_id": F.col("doc_id"), "altered": altered}, arity, levels)
    note = F.concat_ws(",", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "altered")
    proven = proofs(book, book.leaves.select("tree", "rank", note.alias("note")), arity, levels)
    parts = F.split("note", ",")
    now = F.coalesce(F.get(parts, F.lit(1)), F.col("leaf"))
    out = proven.select(F.expr("try_cast(element_at(split(note, ','), 1) AS bigint)").alias("doc_id"), "leaf", "subroot", "root",
                        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"), folded(now, F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
