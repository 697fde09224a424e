"""The prefix trie of rebuilt conversations, from fingerprints that compose.

A turn is an affine map x -> a x + b modulo a prime, its two numbers taken from a hash of
role and text; a sequence of turns is the product of its maps. Products compose and have
inverses, so the fingerprint of a rebuilt prefix (the first turns of a base, then own turns
after the head) is ``base[head] * own[head]^-1 * own[d]``, put together from the running
products of the two stored conversations: no rebuilt text is ever made. Lengths and word
counts are parts of the same product and compose alike.

Running products of a conversation of any length are a scan: turns are sorted by ranges,
multiplied inside a range, and the products of earlier ranges are put in front.

Prefixes with the same depth and fingerprint are one node. Each has a reference to the
stored turn that it ends with; a node is sound if its members agree on the fingerprint of
the prefix before and if all turns referred to are equal, role and text. If any node is
not, the whole is done again with another hash.

Sums over subtrees need no walk: a conversation is the smallest member of the nodes from
some depth ``d0`` of its path to the end, so what it shares below a node of depth d is its
words from d to ``d0``, and a childless node is one of its smallest member alone.

Defined results: turns are ordered by ``turn`` (null first), then role and text, so repeated
rows are turns of their own; null role or text is empty; rows without a conv_id belong to
no conversation; an empty table has no nodes, not even a root; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import map_columns, prepare
from martloom.session import stored

PRIME = (1 << 61) - 1
#: (seed of the turn hash, modulus) of the first try and of those after it.
TRIES = ((12, PRIME), (13, PRIME), (14, PRIME))
#: Ids in one piece of text on the way to a digest.
PIECE = 50_000
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_KEY = ["depth", "a", "b"]

Map = tuple[int, int]


def turn_map(role: str, text: str, seed: int, p: int) -> Map:
    raw = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=32, key=bytes([seed])).digest()
    return 1 + int.from_bytes(raw[:16], "big") % (p - 1), int.from_bytes(raw[16:], "big") % p


def then(x: Map, y: Map, p: int) -> Map:
    """The product: the turns of x, then those of y."""
    return x[0] * y[0] % p, (x[0] * y[1] + x[1]) % p


def inverse(x: Map, p: int) -> Map:
    a = pow(x[0], -1, p)
    return a, -a * x[1] % p


def _turns(conversations: DataFrame) -> DataFrame:
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).filter("conv_id IS NOT NULL")


def scanned(conversations: DataFrame, seed: int, p: int) -> DataFrame:
    """Stored turns with their place and products inside (conversation, range): (conv_id,
    part, i, role, text, words, a, b, upto)."""
    prepare(conversations.sparkSession)
    # Ranges cut a conversation between turns, and rows of one turn by role and text as far
    # as a short key can tell; the order inside a range is the full one.
    short = F.length("role") <= 20
    ranges = ["conv_id", "turn", F.substring("role", 1, 20), ~short, F.when(short, F.substring("text", 1, 40)).otherwise("")]
    rows = _turns(conversations).repartitionByRange(*ranges).sortWithinPartitions("conv_id", "turn", "role", "text")
    schema = "conv_id long, part int, i long, role string, text string, words long, a long, b long, upto long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv = None
        i, product, upto = 0, (1, 0), 0
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for c, role, text in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3)), strict=True):
                if c != conv:
                    conv, i, product, upto = c, 0, (1, 0), 0
                product = then(product, turn_map(role, text, seed, p), p)
                words = len(_WORD.findall(text))
                upto += words
                for column, value in zip(out, (i, words, *product, upto), strict=True):
                    column.append(value)
                i += 1
            numbers = [pa.array(v, type=pa.int64()) for v in out]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * batch.num_rows, type=pa.int32()), numbers[0], batch.column(2), batch.column(3),
                 *numbers[1:]], names=["conv_id", "part", "i", "role", "text", "words", "a", "b", "upto"])

    return stored(rows.mapInArrow(run, schema), "turns")


def carries(turns: DataFrame, p: int) -> DataFrame:
    """What stands before each range of the conversations that lie in several: (conv_id,
    part, c_n, c_a, c_b, c_upto). A range begins or ends at most two such conversations, so
    there are at most twice as many rows as ranges."""
    chunks = turns.groupBy("conv_id", "part").agg(
        F.count(F.lit(1)).alias("n"), F.max_by(F.struct("a", "b", "upto"), "i").alias("x"))
    whole = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(
        "part", "n", F.col("x.a").alias("a"), F.col("x.b").alias("b"), F.col("x.upto").alias("upto")))).alias("m")).filter(F.size("m") > 1)

    def make():
        def work(convs, members):
            rows = []
            for conv, chunk in zip(convs, members, strict=True):
                n, product, upto = 0, (1, 0), 0
                for c in chunk:
                    rows.append((conv, c["part"], n, *product, upto))
                    n, product, upto = n + c["n"], then(product, (c["a"], c["b"]), p), upto + c["upto"]
            return [list(x) for x in zip(*rows)] if rows else [[]] * 6
        return work

    fields = [("conv_id", "long"), ("part", "int"), ("c_n", "long"), ("c_a", "long"), ("c_b", "long"), ("c_upto", "long")]
    return map_columns(whole, ["conv_id", "m"], fields, make)


def _placed(turns: DataFrame, carry: DataFrame) -> DataFrame:
    return turns.join(F.broadcast(carry), ["conv_id", "part"], "left").withColumn("pos", F.col("i") + F.coalesce("c_n", F.lit(0)))


def references(turns: DataFrame, carry: DataFrame, p: int) -> DataFrame:
    """One narrow row per stored turn: (conv_id, pos, words, a, b, upto), the products and
    word counts up to and with it."""
    rows = _placed(turns, carry)

    def make():
        def work(convs, pos, words, a, b, upto, c_a, c_b, c_upto):
            whole = [then((x, y), (u, v), p) if x is not None else (u, v) for x, y, u, v in zip(c_a, c_b, a, b, strict=True)]
            return (convs, pos, words, [x[0] for x in whole], [x[1] for x in whole],
                    [u + (c or 0) for u, c in zip(upto, c_upto, strict=True)])
        return work

    fields = [("conv_id", "long"), ("pos", "long"), ("words", "long"), ("a", "long"), ("b", "long"), ("upto", "long")]
    return stored(map_columns(rows, ["conv_id", "pos", "words", "a", "b", "upto", "c_a", "c_b", "c_upto"], fields, make), "refs")


def plans(refs: DataFrame, base: Column, head: Column, p: int) -> DataFrame:
    """How each conversation is rebuilt: (conv_id, base_id, head, shift, len, first, c_a,
    c_b, c_upto). ``first`` holds the base's turns that stand in front (a head is short);
    the c_ columns compose with an own product after the head; ``shift`` moves its place."""
    specs = refs.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumns({"base_id": base.cast("long"), "head": head.cast("long")})
    specs = stored(specs, "specs")
    longest = specs.agg(F.max("head")).first()[0] or 0
    heads = refs.filter(F.col("pos") < longest).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("pos", "words", "a", "b", "upto"))).alias("m"))
    no_turn = F.array().cast("array<struct<pos:long,words:long,a:long,b:long,upto:long>>")
    joined = (specs.join(heads.select(F.col("conv_id").alias("base_id"), F.col("m").alias("first")), "base_id", "left")
              .join(heads.select("conv_id", F.col("m").alias("mine")), "conv_id", "left")
              .withColumn("first", F.slice(F.coalesce("first", no_turn), F.lit(1), F.col("head").cast("int")))
              .withColumn("mine", F.slice(F.coalesce("mine", no_turn), F.lit(1), F.col("head").cast("int"))))

    def make():
        def work(convs, bases, heads, owns, firsts, mines):
            out: list[list] = [[] for _ in range(9)]
            for conv, base_id, head, own, first, mine in zip(convs, bases, heads, owns, firsts, mines, strict=True):
                before, upto = ((first[-1]["a"], first[-1]["b"]), first[-1]["upto"]) if first else ((1, 0), 0)
                if mine:
                    before = then(before, inverse((mine[-1]["a"], mine[-1]["b"]), p), p)
                    upto -= mine[-1]["upto"]
                shift = len(first) - head
                row = (conv, base_id, head, shift, len(first) + max(0, own - head), before[0], before[1], upto,
                       [x for f in first for x in (f["words"], f["a"], f["b"], f["upto"])])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            return out
        return work

    fields = [(c, "long") for c in ("conv_id", "base_id", "head", "shift", "len", "c_a", "c_b", "c_upto")] + [("first", "array<long>")]
    return stored(map_columns(joined, ["conv_id", "base_id", "head", "own", "first", "mine"], fields, make), "plans")


_ROW = [(c, "long") for c in ("conv_id", "depth", "len", "words", "upto", "a", "b", "p_a", "p_b", "ref_conv", "ref_pos")]


def prefixes(refs: DataFrame, plan: DataFrame, p: int) -> DataFrame:
    """A row for every rebuilt conversation and depth from 1: its fingerprint, that of the
    prefix before, words of the last turn and of all, and the stored turn it ends with."""
    def heads():
        def work(convs, bases, lens, firsts):
            rows = []
            for conv, base_id, n, first in zip(convs, bases, lens, firsts, strict=True):
                before = (1, 0)
                for k in range(len(first) // 4):
                    words, a, b, upto = first[4 * k:4 * k + 4]
                    rows.append((conv, k + 1, n, words, upto, a, b, *before, base_id, k))
                    before = a, b
            return [list(x) for x in zip(*rows)] if rows else [[]] * len(_ROW)
        return work

    def suffixes():
        def work(convs, pos, words, a, b, upto, q_a, q_b, shift, n, c_a, c_b, c_upto):
            out: list[list] = [[] for _ in _ROW]
            for k, conv in enumerate(convs):
                front = c_a[k], c_b[k]
                own, before = then(front, (a[k], b[k]), p), then(front, (q_a[k], q_b[k]), p)
                row = (conv, pos[k] + shift[k] + 1, n[k], words[k], upto[k] + c_upto[k], *own, *before, conv, pos[k])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            return out
        return work

    # The product before a turn is the one of the turn before it.
    earlier = refs.select("conv_id", (F.col("pos") + 1).alias("pos"), F.col("a").alias("q_a"), F.col("b").alias("q_b"))
    own = refs.join(plan.select("conv_id", "head", "shift", "len", "c_a", "c_b", "c_upto"), "conv_id").filter("pos >= head")
    own = own.join(earlier, ["conv_id", "pos"], "left").withColumns({"q_a": F.coalesce("q_a", F.lit(1)), "q_b": F.coalesce("q_b", F.lit(0))})
    tail = map_columns(own, ["conv_id", "pos", "words", "a", "b", "upto", "q_a", "q_b", "shift", "len", "c_a", "c_b", "c_upto"], _ROW, suffixes)
    front = map_columns(plan.filter(F.size("first") > 0), ["conv_id", "base_id", "len", "first"], _ROW, heads)
    return stored(front.unionByName(tail), "prefixes")


def unequal(rows: DataFrame, groups: DataFrame, stored_turns: DataFrame) -> int:
    """Nodes whose members do not agree: on the prefix before, or on the last turn, which
    is read through the references where a node has more than one."""
    parted = groups.filter("p_low != p_high").count()
    several = groups.filter("ref_low != ref_high").select(*_KEY)
    asked = rows.join(several, _KEY, "left_semi").select(*_KEY, F.col("ref_conv").alias("conv_id"), F.col("ref_pos").alias("pos")).distinct()
    turn = F.struct("role", "text")
    read = asked.join(stored_turns.select("conv_id", "pos", "role", "text"), ["conv_id", "pos"])
    return parted + read.groupBy(*_KEY).agg(F.min(turn).alias("low"), F.max(turn).alias("high")).filter("low != high").count()


def ordered_digest(rows: DataFrame, keys: Sequence[str], number: str) -> DataFrame:
    """SHA-256 (hexadecimal) of the ascending, comma-joined numbers of each key (long columns).

    Ranges of the sorted rows become pieces of text, so a hot key is spread; its pieces then
    pass through one running hash, which holds one piece at a time.
    """
    prepare(rows.sparkSession)
    keys = list(keys)
    names = [*keys, "first", "piece"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, []

        def piece():
            return [[k] for k in at] + [[held[0]], [",".join(map(str, held))]]

        def batch_of(values):
            kinds = [pa.int64()] * (len(keys) + 1) + [pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(v, type=t) for v, t in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            ready: list[list] = [[] for _ in names]
            for *key, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and (key != at or len(held) >= PIECE):
                    for column, x in zip(ready, piece(), strict=True):
                        column += x
                    held = []
                at = key
                held.append(value)
            if ready[0]:
                yield batch_of(ready)
        if held:
            yield batch_of(piece())

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, running = None, None

        def batch_of(done):
            columns = [pa.array([d[0][k] for d in done], type=pa.int64()) for k in range(len(keys))]
            return pa.RecordBatch.from_arrays([*columns, pa.array([d[1] for d in done], type=pa.string())], names=[*keys, "digest"])

        for batch in batches:
            done = []
            for *key, _, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if key != at:
                    if at is not None:
                        done.append((at, running.hexdigest()))
                    at, running = key, hashlib.sha256(piece.encode())
                else:
                    running.update(b"," + piece.encode())
            if done:
                yield batch_of(done)
        if at is not None:
            yield batch_of([(at, running.hexdigest())])

    longs = ", ".join(f"`{k}` long" for k in keys)
    sorted_rows = rows.select(*keys, number).repartitionByRange(*keys, number).sortWithinPartitions(*keys, number)
    pieces = sorted_rows.mapInArrow(cut, f"{longs}, first long, piece string")
    return pieces.repartition(*keys).sortWithinPartitions(*keys, "first").mapInArrow(whole, f"{longs}, digest string")


def trie(conversations: DataFrame, base: Column, head: Column, tries: Sequence[tuple[int, int]] = TRIES) -> DataFrame:
    """Nodes of the prefix trie: (conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256).

    ``base`` and ``head`` are expressions over ``conv_id``: which conversation the first
    turns come from, and how many.
    """
    for seed, p in tries:
        turns = scanned(conversations, seed, p)
        carry = stored(carries(turns, p), "carries")
        refs = references(turns, carry, p)
        plan = plans(refs, base, head, p)
        rows = prefixes(refs, plan, p)
        before, ref = F.struct("p_a", "p_b"), F.struct("ref_conv", "ref_pos")
        groups = stored(rows.groupBy(*_KEY).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv_id").alias("owner"), (F.max("len") > F.col("depth")).alias("inner"),
            F.min(before).alias("p_low"), F.max(before).alias("p_high"), F.min(ref).alias("ref_low"), F.max(ref).alias("ref_high")), "nodes")
        if not unequal(rows, groups, _placed(turns, carry)):
            return _nodes(plan, rows, groups)
    raise RuntimeError("turn hashes collided in every try")


def _nodes(plan: DataFrame, rows: DataFrame, groups: DataFrame) -> DataFrame:
    n_convs, first = plan.agg(F.count(F.lit(1)), F.min("conv_id")).first()
    known = stored(rows.join(groups.select(*_KEY, "owner", "inner"), _KEY), "owned")
    mine = F.col("owner") == F.col("conv_id")
    # Per conversation: the depth and the words where its own nodes begin, whom it shares the
    # node above with, and whether its last node is a childless one of its own.
    start = F.col("upto") - F.col("words")
    lives = stored(known.groupBy("conv_id").agg(
        F.min(F.when(mine, F.col("depth"))).alias("d0"), F.coalesce(F.min(F.when(mine, start)), F.max("upto")).alias("w0"),
        F.max(F.when(~mine, F.struct("depth", "owner")))["owner"].alias("above"),
        F.max((mine & ~F.col("inner") & (F.col("depth") == F.col("len"))).cast("long")).alias("leaf")), "lives")
    sums = known.join(lives, "conv_id").groupBy(*_KEY).agg(
        F.sum(F.greatest(F.lit(0), F.col("w0") - start)).alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    children = groups.groupBy((F.col("depth") - 1).alias("depth"), F.col("p_low.p_a").alias("a"), F.col("p_low.p_b").alias("b")).agg(
        F.count(F.lit(1)).alias("n_children"))
    ends = ordered_digest(rows.filter("depth = len"), _KEY, "conv_id")
    parent = F.when(F.col("depth") == 1, F.lit(first)).when(F.col("depth") == F.col("d0"), F.col("above")).otherwise(F.col("conv_id"))
    none = F.lit(hashlib.sha256(b"").hexdigest())
    sums = stored(sums, "sums")
    below = (groups.withColumnRenamed("owner", "conv_id").join(sums, _KEY).join(children, _KEY, "left").join(ends, _KEY, "left")
             .join(lives.select("conv_id", "d0", "above"), "conv_id").select(
        "conv_id", "depth", parent.cast("long").alias("parent_conv_id"), "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"),
        "n_leaves", "saved_tokens", F.coalesce("digest", none).alias("ends_sha256")))
    # The root has no turn: its members are all conversations, and what its children save it saves.
    at_root = F.lit(0).cast("long")
    silent = ordered_digest(plan.filter("len = 0").select(at_root.alias("depth"), "conv_id"), ["depth"], "conv_id").select("digest")
    own = sums.filter("depth = 1").agg(F.count(F.lit(1)).alias("n_children"), F.coalesce(F.sum("n_leaves"), F.lit(1)).alias("n_leaves"),
                                       F.coalesce(F.sum("saved_tokens"), at_root).alias("saved_tokens"))
    root = own.join(silent, how="left").select(
        F.lit(first).cast("long").alias("conv_id"), at_root.alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        F.lit(n_convs).cast("long").alias("n_convs"), "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", none).alias("ends_sha256")).filter("n_convs > 0")
    return below.unionByName(root)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """The trie where each conversation begins with up to three turns of the one whose
    number is the next lower multiple of 20."""
    conv = F.col("conv_id")
    return trie(conversations, conv - conv % 20, F.crc32(conv.cast("string").cast("binary")) % 4)
