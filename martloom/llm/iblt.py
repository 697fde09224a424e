"""Document fingerprints as invertible Bloom lookup sketches.

A text's paragraphs are its lines, long ones broken near the ends of sentences. Each
different paragraph's 64-bit digest goes into one cell of each of ``TABLES`` tables: the
cell counts it and XORs its digest and a checksum in. A table has about half as many cells
as the text has paragraphs, in a power of two, so that the larger of two sketches can be
folded to the size of the smaller one. The fingerprint is this sketch, printed.

Two sketches are subtracted cell by cell, so equal paragraphs vanish; a cell that holds a
single digest (its checksum and its place agree) gives it away, the digest is taken out of
its other cells, and so on until nothing is left: the digests of the paragraphs in which
the versions differ, and on which side. Likeness is the number of common paragraphs over
that of all. If cells are left over, as is the rule for texts that have little in common,
the pair is tried again with tables sized for all paragraphs of both; the few that fail
again are compared digest by digest.

Only SQL functions are used. Documents are dealt to buckets of neighbouring ids; the first
document of each bucket is copied to the bucket before it, so that every document meets
the next one with a single shuffle of the texts and no task sorts more than a bucket.

Defined results: a null text is empty, and an empty text has no paragraphs; two texts
without paragraphs are alike (1.0); a null doc_id comes before all others; rows that share
an id come in order of their text's hash; a single document is its own next one; an empty
table gives an empty table.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.session import stored

TABLES, ROUNDS, MORE_ROUNDS = 3, 6, 4
#: Least and most cells of a table.
LEAST_CELLS, MOST_CELLS = 8, 1 << 20
#: Documents in a bucket of ids, and most buckets (their borders are held by the driver).
BUCKET_ROWS, MOST_BUCKETS = 2000, 65_536
#: Documents whose sketches are made and peeled in one task: a paragraph becomes nine rows.
DEALT_ROWS = 1000
PARAGRAPH = r"[^\n]{1,120}[^\n.!?]{0,120}[.!?]*"


def digests(text: Column) -> Column:
    """Digests of the different paragraphs."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(PARAGRAPH), 0), lambda p: F.xxhash64(p)))


def cell_of(digest: Column, table: Column | int, cells: Column) -> Column:
    """Cell of a digest in a table of ``cells`` (a power of two): 20 of its bits."""
    table = F.lit(table) if isinstance(table, int) else table
    turned = F.call_function("shiftrightunsigned", digest, table * 20)
    return turned.bitwiseAND((cells - 1).cast("long")).cast("int")


def sketch_cells(paragraphs: Column) -> Column:
    """Cells of each table of the sketch of a text with so many different paragraphs."""
    return F.least(F.lit(MOST_CELLS), F.greatest(F.lit(LEAST_CELLS), F.pow(F.lit(2), F.ceil(F.log2(paragraphs / 2))))).cast("int")


def borders(docs: DataFrame) -> tuple[list[int], int | None, bool]:
    """First ids of all buckets but the first, the least id, and whether ids are null.
    Every border is a document's id."""
    n, least, nulls = docs.agg(F.count("*"), F.min("doc_id"), F.coalesce(F.max(F.col("doc_id").isNull()), F.lit(False))).first()
    buckets = max(1, min(MOST_BUCKETS, math.ceil(n / BUCKET_ROWS)))
    if least is None or buckets == 1:
        return [], least, nulls
    cuts = docs.agg(F.percentile_approx("doc_id", [i / buckets for i in range(1, buckets)], max(10_000, 4 * buckets))).first()[0]
    firsts = docs.filter("doc_id IS NOT NULL").groupBy(_bucket(F.col("doc_id"), sorted(set(cuts)))).agg(F.min("doc_id"))
    return sorted(r[1] for r in firsts.collect())[1:], least, nulls


def _bucket(doc_id: Column, cuts: list[int]) -> Column:
    """How many of the sorted ``cuts`` are not above ``doc_id``, found in two steps of
    the square root of their number."""
    if not cuts:
        return F.lit(0)
    width = max(1, math.isqrt(len(cuts)))
    parts = [cuts[i:i + width] for i in range(0, len(cuts), width)]
    nested = F.from_json(F.lit(json.dumps(parts)), "array<array<bigint>>")
    heads = F.from_json(F.lit(json.dumps([p[0] for p in parts])), "array<bigint>")
    part = F.size(F.filter(heads, lambda c: c <= doc_id)) - 1
    inside = F.size(F.filter(F.get(nested, part), lambda c: c <= doc_id))
    return F.when(doc_id.isNull() | (part < 0), 0).otherwise(part * width + inside)


def with_next(docs: DataFrame) -> DataFrame:
    """doc_id, text and the next document's text for every row."""
    cuts, least, nulls = borders(docs)
    bucket = _bucket(F.col("doc_id"), cuts)
    is_first = F.col("doc_id").isNull() if nulls else F.col("doc_id") == F.lit(least)
    at_border = F.lit(False) if not cuts else F.coalesce(
        (F.col("bucket") > 0) & (F.get(F.from_json(F.lit(json.dumps(cuts)), "array<bigint>"), F.col("bucket") - 1) == F.col("doc_id")),
        F.lit(False))
    own = F.array(F.struct(F.col("bucket").alias("place"), F.lit(False).alias("copy")))
    none = F.array().cast("array<struct<place:int,copy:boolean>>")
    copies = F.concat(
        own, F.when(at_border, F.array(F.struct((F.col("bucket") - 1).alias("place"), F.lit(True).alias("copy")))).otherwise(none),
        F.when(is_first, F.array(F.struct(F.lit(len(cuts)).alias("place"), F.lit(True).alias("copy")))).otherwise(none))
    dealt = (docs.withColumn("bucket", bucket.cast("int")).select("doc_id", "text", F.explode(copies).alias("to"))
             .select("doc_id", "text", "to.place", "to.copy", F.xxhash64("text").alias("tie")))
    order = Window.partitionBy("place").orderBy("copy", F.col("doc_id").asc_nulls_first(), "tie")
    return dealt.withColumn("next", F.lead("text").over(order)).filter("NOT copy").select("doc_id", "text", "next")


def versions(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, and the digests of the text, of the edited text and
    of the next text."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    both = with_next(texts).withColumn("n_chars", F.length("text"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    both = both.withColumn("edited", F.concat(
        F.substring("text", F.lit(1), F.col("n_chars") - cut), F.substring("next", F.lit(1), cut)))
    return both.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("edited"), digests(F.col("next")).alias("next"))


def _entry(table, cell, n, digest, checksum) -> Column:
    return F.struct(table.cast("int").alias("table"), cell.cast("long").alias("cell"), n.cast("long").alias("n"),
                    digest.cast("long").alias("digest"), checksum.cast("long").alias("checksum"))


def _entries(digest: Column, n: Column, cells: Column) -> Column:
    """What a digest adds to each table."""
    return F.array(*[_entry(F.lit(t), cell_of(digest, t, cells), n, digest, F.xxhash64(digest)) for t in range(TABLES)])


def _settle(cells: DataFrame, *keys: str) -> DataFrame:
    """Sums up what falls into a cell; empty cells go."""
    return (cells.groupBy(*keys, "cells", "table", "cell")
            .agg(F.sum("n").alias("n"), F.bit_xor("digest").alias("digest"), F.bit_xor("checksum").alias("checksum"))
            .filter("n != 0 OR digest != 0 OR checksum != 0"))


def sketches(lists: DataFrame, *keys: str) -> DataFrame:
    """The cells in use (``keys``, cells, table, cell, n, digest, checksum) of the sketch of
    each list ``digests``, dealt by some of the keys."""
    each = lists.select(*keys, sketch_cells(F.size("digests")).alias("cells"), F.explode("digests").alias("d"))
    return _settle(each.select(*keys, "cells", F.explode(_entries(F.col("d"), F.lit(1), F.col("cells"))).alias("e"))
                   .select(*keys, "cells", "e.*"), *keys)


def printed() -> Column:
    """Aggregate of a sketch's cells as text: place, count, digests, checksums in hex."""
    place = F.col("table") * MOST_CELLS + F.col("cell")
    cell = F.struct(place.alias("at"), F.concat(F.lpad(F.hex(place), 6, "0"), F.lpad(F.hex("n"), 6, "0"),
                                                F.lpad(F.hex("digest"), 16, "0"), F.lpad(F.hex("checksum"), 16, "0")).alias("hex"))
    return F.lower(F.array_join(F.transform(F.array_sort(F.collect_list(cell)), lambda c: c["hex"]), ""))


def subtracted(cells: DataFrame) -> DataFrame:
    """Differences of sketches: cells of (row, kind) with the ``sign`` of their side, folded
    to ``fold`` cells a table."""
    folded = F.col("cell").bitwiseAND((F.col("fold") - 1).cast("long"))
    return _settle(cells.select("row", "kind", F.col("fold").alias("cells"), "table", folded.alias("cell"),
                                (F.col("n") * F.col("sign")).alias("n"), "digest", "checksum"), "row", "kind")


def larger(pairs: DataFrame) -> DataFrame:
    """Differences of new sketches of the lists ``left`` and ``right``, with tables for all."""
    both = F.size("left") + F.size("right")
    cells = F.least(F.lit(MOST_CELLS), F.pow(F.lit(2), F.ceil(F.log2(4.0 * both)))).cast("int")
    sides = F.concat(F.transform("left", lambda d: F.struct(d.alias("d"), F.lit(1).alias("n"))),
                     F.transform("right", lambda d: F.struct(d.alias("d"), F.lit(-1).alias("n"))))
    each = pairs.select("row", "kind", cells.alias("cells"), F.explode(sides).alias("v")).select("row", "kind", "cells", "v.*")
    return _settle(each.select("row", "kind", "cells", F.explode(_entries(F.col("d"), F.col("n"), F.col("cells"))).alias("e"))
                   .select("row", "kind", "cells", "e.*"), "row", "kind")


def peeled(cells: DataFrame, rounds: int) -> DataFrame:
    """(row, kind, gone, new, left): the digests that only the left and only the right side
    has, as far as recovered, and the number of cells left over.

    ``cells`` is dealt by row, so all sums below stay in the task. A round takes the lone
    digests of one table: each is in one cell of it, so none is taken twice. What was
    recovered is kept as cells of table -1.
    """
    for round_ in range(rounds):
        table = round_ % TABLES
        digest, n, size = F.col("digest"), F.col("n"), F.col("cells")
        lone = ((F.col("table") == table) & (F.abs("n") == 1) & (F.xxhash64("digest") == F.col("checksum"))
                & (cell_of(digest, table, size) == F.col("cell")))
        out = [_entry(F.lit(t), cell_of(digest, t, size), -n, digest, F.col("checksum")) for t in range(TABLES) if t != table]
        out.append(_entry(F.lit(-1), digest, n, digest, F.col("checksum")))
        same = F.array(_entry(F.col("table"), F.col("cell"), n, digest, F.col("checksum")))
        cells = _settle(cells.select("row", "kind", "cells", F.explode(F.when(lone, F.array(*out)).otherwise(same)).alias("e"))
                        .select("row", "kind", "cells", "e.*"), "row", "kind")
    found = F.col("table") < 0
    return cells.groupBy("row", "kind").agg(
        F.collect_list(F.when(found & (F.col("n") > 0), F.col("digest"))).alias("gone"),
        F.collect_list(F.when(found & (F.col("n") < 0), F.col("digest"))).alias("new"),
        F.sum((F.col("table") >= 0).cast("int")).alias("left"))


def _likeness(n_left: Column, n_right: Column, differing: Column) -> Column:
    return F.when(n_left + n_right == 0, 1.0).otherwise((n_left + n_right - differing) / (n_left + n_right + differing))


def _version(number: int, name: str, *folds: tuple[int, int, str]) -> Column:
    """A version of a row: its digests, and the pairs (kind, sign) that it is part of with the
    cells a table that the other version allows."""
    own = sketch_cells(F.size(name))
    return F.struct(F.lit(number).alias("version"), F.col(name).alias("digests"), F.array(*[
        F.struct(F.lit(kind).alias("kind"), F.lit(sign).alias("sign"), F.least(own, sketch_cells(F.size(other))).alias("fold"))
        for kind, sign, other in folds]).alias("folds"))


def first_try(rows: DataFrame) -> DataFrame:
    """``peeled`` for the fingerprints of each row's text and edited text (kind 0), and of its
    text and the next one (kind 1). ``rows`` is dealt by row."""
    lists = rows.select("row", F.explode(F.array(
        _version(0, "own", (0, 1, "edited"), (1, 1, "next")), _version(1, "edited", (0, -1, "own")),
        _version(2, "next", (1, -1, "own")))).alias("v")).select("row", "v.*")
    cells = sketches(lists, "row", "version", "folds")
    return peeled(subtracted(cells.select("row", "table", "cell", "n", "digest", "checksum", F.explode("folds").alias("f"))
                             .select("*", "f.*")), ROUNDS)


def _dealt(rows: DataFrame) -> DataFrame:
    """Dealt by row to as many parts as documents ask for: the lists are far smaller than
    what is made of them, so their bytes say too little."""
    return rows.repartition(max(1, math.ceil(rows.count() / DEALT_ROWS)), "row")


def solved_pairs(rows: DataFrame) -> DataFrame:
    """(row, kind, gone, new, left, tries) of pairs that differ, after the larger second try."""
    dealt = _dealt(rows.select("row", "own", "edited", "next"))
    first = stored(first_try(dealt), "peeled")
    # Joined by row alone, so the lists stay where they are.
    again = first.filter("left > 0").groupBy("row").agg(F.collect_set("kind").alias("kinds"))
    both = F.array(*[F.struct(F.lit(kind).alias("kind"), F.col("own").alias("left"), F.col(other).alias("right"))
                     for kind, other in enumerate(("edited", "next"))])
    failed = dealt.join(again.hint("merge"), "row").select(
        "row", F.explode(F.filter(both, lambda p: F.array_contains("kinds", p["kind"]))).alias("p")).select("row", "p.*")
    second = peeled(larger(failed), MORE_ROUNDS)
    return first.filter("left = 0").withColumn("tries", F.lit(1)).unionByName(second.withColumn("tries", F.lit(2)))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next, and the numbers of recovered digests that only the text (n_gone) and only the
    edited text (n_new) has, for every row."""
    rows = stored(versions(docs), "versions").withColumn("row", F.monotonically_increasing_id())
    only = F.struct(F.size("gone").alias("gone"), F.size("new").alias("new"))
    solved = stored(solved_pairs(rows).groupBy("row").agg(*[
        F.max(F.when((F.col("kind") == k) & (F.col("left") == 0), only)).alias(c) for k, c in ((0, "d_edited"), (1, "d_next"))]), "solved")
    dealt = _dealt(rows)
    lists = dealt.select("row", F.explode(F.array(
        F.struct(F.lit(0).alias("version"), F.col("own").alias("digests")),
        F.struct(F.lit(1).alias("version"), F.col("edited").alias("digests")))).alias("v")).select("row", "v.*")
    prints = (sketches(lists, "row", "version").groupBy("row", "version").agg(printed().alias("print"))
              .groupBy("row").agg(*[F.coalesce(F.max(F.when(F.col("version") == v, F.col("print"))), F.lit("")).alias(c)
                                    for v, c in ((0, "fingerprint"), (1, "edited_fingerprint"))]))
    # No row in ``solved``: nothing differs, or nothing was there to compare.
    joined = dealt.join(prints.hint("merge"), "row", "left").join(solved.hint("merge"), "row", "left")

    def only_in(one: str, other: str, found: str, side: str) -> Column:
        return F.coalesce(F.col(f"{found}.{side}"), F.size(F.array_except(one, other))).cast("long")

    def likeness(other: str, found: str) -> Column:
        return _likeness(F.size("own"), F.size(other), only_in("own", other, found, "gone") + only_in(other, "own", found, "new"))

    return joined.select("doc_id", "n_chars", "edited_sha256", *[F.coalesce(c, F.lit("")).alias(c) for c in ("fingerprint", "edited_fingerprint")],
                         likeness("edited", "d_edited").alias("near_edited"), likeness("next", "d_next").alias("near_next"),
                         only_in("own", "edited", "d_edited", "gone").alias("n_gone"), only_in("edited", "own", "d_edited", "new").alias("n_new"))
