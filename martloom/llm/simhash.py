"""SimHash near-duplicates, with candidates from a ring of segments.

The 64 bits are a ring of ``SEGMENTS`` equal segments. If two fingerprints differ in at
most ``r`` bits, some segment starts a chain in which every first ``n`` segments together
differ in at most ``floor(n * r / SEGMENTS)`` bits. For 3 bits and 8 segments the quotas
are 0, 0, 1, 1, 1, 2, 2, 3: two segments equal, and the next three with one differing bit
at most, so one half of those 24 bits is equal as well. That gives 16 exact keys of 28
bits; the rest of the chain's quotas then prunes before the full comparison.

Defined results: a null or empty text, or one without words, has fingerprint 0 and is
linked like any other; rows that share a fingerprint are one node, so groups of copies
cost one row; an empty table gives an empty table; a null doc_id is never the smallest
of a group that has others. Extra columns are ignored (``near_duplicates``) or kept
(``drop_near_duplicates``).
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm.graph import components
from martloom.llm.rows import fresh, map_columns, text_hash
from martloom.session import stored

SEGMENTS, WIDTH, SEED = 8, 8, 42
WORD_SEEDS = (42, 43, 44)
#: Shingles whose bits are added at once.
CHUNK = 8192
#: Bits of a parity sketch.
PARITY = 512


def split_words(text: str | None) -> list[bytes]:
    return (text or "").encode().lower().split()


def shingles(words: list[bytes], size: int) -> list[bytes]:
    """Runs of ``size`` words, the whole text if it has fewer, none if it has none."""
    return [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))] if words else []


def majority(features: list[bytes], seed: int = SEED) -> int:
    """Signed 64-bit SimHash: a bit is 1 if it is set in over half of the hashes."""
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(features), CHUNK):
        hashes = np.array([xxhash.xxh64_intdigest(x, seed) for x in features[at:at + CHUNK]], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(features), bitorder="little").view("<i8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    return majority(shingles(split_words(text), shingle))


def word_fingerprints(text: str | None) -> list[int]:
    """Independent SimHashes of the different words: an edited word changes one feature,
    not the several shingles that hold it."""
    words = sorted(set(split_words(text)))
    return [majority(words, seed) for seed in WORD_SEEDS]


def shingle_set(text: str | None, words: int) -> list[int]:
    """Sorted hashes of the different shingles, as signed numbers."""
    return sorted({xxhash.xxh64_intdigest(s, SEED) - (1 << 63) for s in shingles(split_words(text), words)})


def parity(hashes: list[int]) -> list[int]:
    """Each hash of a set flips one of ``PARITY`` bits. Two sketches differ in no more bits
    than the two sets have elements that the other one lacks."""
    places = np.array(hashes, dtype=np.int64).astype(np.uint64) % np.uint64(PARITY)
    odd = np.bincount(places.astype(np.int64), minlength=PARITY) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view("<i8").tolist()


def may_be_similar(x: str, y: str, similarity: float) -> Column:
    """False only for sets of a Jaccard similarity s below ``similarity``: the elements that
    one of two sets lacks are (1 - s) / (1 + s) of the sum of their sizes. ``x`` and ``y`` are
    prefixes of the columns ``sketch`` and ``size``."""
    apart = sum((F.bit_count(F.get(f"{x}sketch", i).bitwiseXOR(F.get(f"{y}sketch", i))) for i in range(PARITY // 64)), F.lit(0))
    return apart * (1 + similarity) <= (1 - similarity) * (F.col(f"{x}size") + F.col(f"{y}size")) + 1e-6


def fingerprints(docs: DataFrame, shingle: int = 3, text: str = "text", doc_id: str = "doc_id",
                 similar_words: int | None = None) -> DataFrame:
    """(doc_id, text_hash, fp) for every row; with ``similar_words`` also word_fps, and the
    parity sketch and size of the set of shingles of so many words."""
    keyed = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    keyed = keyed.withColumn("text_hash", text_hash())

    def make():
        def work(ids, hashes, texts):
            out = [ids, hashes, [fingerprint(t, shingle) for t in texts]]
            if similar_words is None:
                return out
            sets = [shingle_set(t, similar_words) for t in texts]
            return [*out, [word_fingerprints(t) for t in texts], [parity(s) for s in sets], [len(s) for s in sets]]
        return work

    fields = [("doc_id", "long"), ("text_hash", "long"), ("fp", "long")]
    if similar_words is not None:
        fields += [("word_fps", "array<long>"), ("sketch", "array<long>"), ("size", "long")]
    return map_columns(keyed, ["doc_id", "text_hash", "text"], fields, make)


def quotas(radius: int) -> list[int]:
    return [n * radius // SEGMENTS for n in range(1, SEGMENTS + 1)]


def _ring(fp: Column, start: int) -> Column:
    """The fingerprint turned so that segment ``start`` is its lowest."""
    turn = start * WIDTH
    return fp if not turn else F.shiftrightunsigned(fp, turn).bitwiseOR(F.shiftleft(fp, 64 - turn))


def chain_keys(fp: Column) -> Column:
    """The 16 keys (place, bits) of a fingerprint for up to 3 differing bits."""
    keys = []
    for start in range(SEGMENTS):
        ring = _ring(fp, start)
        equal = ring.bitwiseAND(F.lit(0xFFFF))
        for half in range(2):
            more = F.shiftrightunsigned(ring, 16 + 12 * half).bitwiseAND(F.lit(0xFFF))
            keys.append(F.shiftleft(F.lit(2 * start + half).cast("long"), 28)
                        .bitwiseOR(F.shiftleft(equal, 12)).bitwiseOR(more))
    return F.array(*keys)


def chain_holds(key: Column, x: Column, y: Column, radius: int) -> Column:
    """Whether the chain that starts at the key's segment stays within every quota."""
    start = F.shiftrightunsigned(key, 29).cast("int")
    difference = x.bitwiseXOR(y)
    turned = F.coalesce(*[F.when(start == s, _ring(difference, s)) for s in range(SEGMENTS)])
    holds = F.lit(True)
    for n, most in enumerate(quotas(radius), 1):
        part = turned if n == SEGMENTS else turned.bitwiseAND(F.lit((1 << (n * WIDTH)) - 1))
        holds = holds & (F.bit_count(part) <= most)
    return holds


def close_pairs(groups: DataFrame, radius: int = 3) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct ``fp`` of ``groups`` within ``radius`` bits."""
    if not 0 <= radius <= 3:
        raise ValueError("the keys hold for up to 3 differing bits")
    keyed = groups.select("fp", F.explode(chain_keys(F.col("fp"))).alias("key"))
    left, right = keyed.withColumnRenamed("fp", "a"), keyed.withColumnRenamed("fp", "b")
    return (left.join(right, "key").filter("a < b")
            .filter(chain_holds(F.col("key"), F.col("a"), F.col("b"), radius))
            .select("a", "b").distinct())


def _jaccard_links(docs: DataFrame, candidates: DataFrame, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of text hashes whose sets of shingles are similar enough. Only texts
    that are compared are cut into shingles."""
    asked = candidates.select(F.explode(F.array("a", "b")).alias("asked")).distinct()
    rows = docs.select(text_hash().alias("text_hash"), "text")
    # As many as there are near copies, so never broadcast: one plan at every size.
    rows = rows.join(asked.hint("merge"), F.col("text_hash") == F.col("asked"), "left_semi")

    def make():
        def work(hashes, values):
            return hashes, [shingle_set(t, words) for t in values]
        return work

    sets = stored(map_columns(rows, ["text_hash", "text"], [("text_hash", "long"), ("shingles", "array<long>")], make)
                  .dropDuplicates(["text_hash"]), "shingles")
    pairs = candidates
    for side in "ab":
        pairs = pairs.join(sets.select(F.col("text_hash").alias(side), F.col("shingles").alias(f"{side}_set")), side)
    common = F.size(F.array_intersect("a_set", "b_set"))
    return pairs.filter(common >= similarity * (F.size("a_set") + F.size("b_set") - common)).select("a", "b")


def star_pairs(keyed: DataFrame) -> DataFrame:
    """Distinct pairs (text_hash, head): each text of a key (k, key) with the key's head, one
    pair a text and key. Heads differ by key, so a large group gets many of them."""
    turn = F.struct(F.xxhash64("text_hash", "k", "key").alias("turn"), "text_hash")
    heads = keyed.groupBy("k", "key").agg(F.min(turn).alias("top"), F.count("*").alias("n")).filter("n > 1").select(
        "k", "key", F.col("top.text_hash").alias("head"))
    return keyed.join(heads, ["k", "key"]).filter("text_hash != head").select("text_hash", "head").distinct()


def first_heads(stars: DataFrame) -> DataFrame:
    """One pair of each text: with its head that most texts have."""
    common = stars.groupBy("head").agg(F.count("*").alias("n"))
    return stars.join(common, "head").groupBy("text_hash").agg(F.max(F.struct("n", "head"))["head"].alias("head"))


def _ordered_pairs(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("text_hash", "head").alias("a"), F.greatest("text_hash", "head").alias("b")).distinct()


def open_pairs(keyed: DataFrame, texts: DataFrame, radius: int, similarity: float) -> DataFrame:
    """Distinct pairs (a, b) of ``text_hash`` that meet in a key within ``radius`` bits of
    their ``word_fp``, are not in one ``component`` yet and whose parity sketches allow the
    similarity. Texts of a key's largest component are met by the others only, so what is
    linked already costs no comparison."""
    sizes = keyed.groupBy("k", "key", "component").agg(F.count("*").alias("n"))
    mixed = sizes.groupBy("k", "key").agg(F.max_by("component", F.struct("n", "component")).alias("top"),
                                          F.count("*").alias("components")).filter("components > 1").drop("components")
    mixed = keyed.join(mixed, ["k", "key"]).join(texts.select("text_hash", "sketch", "size"), "text_hash")
    mixed = stored(mixed, "open_keys")
    names = ("text_hash", "word_fp", "component", "sketch", "size")
    left = mixed.filter("component != top").select("k", "key", *[F.col(c).alias(f"a_{c}") for c in names])
    right = mixed.select("k", "key", "top", *[F.col(c).alias(f"b_{c}") for c in names])
    met = left.join(right, ["k", "key"]).filter(
        "a_component != b_component AND (b_component = top OR a_text_hash < b_text_hash)").filter(
        chain_holds(F.col("key"), F.col("a_word_fp"), F.col("b_word_fp"), radius)).filter(
        may_be_similar("a_", "b_", similarity))
    return met.select(F.least("a_text_hash", "b_text_hash").alias("a"), F.greatest("a_text_hash", "b_text_hash").alias("b")).distinct()


def similar_classes(docs: DataFrame, prints: DataFrame, links: DataFrame, radius: int, words: int, similarity: float) -> DataFrame:
    """(node, component) of ``fp`` by ``links`` and by the pairs of texts whose sets of
    shingles of ``words`` words have a Jaccard similarity of ``similarity`` or more, found
    within ``radius`` bits of any of the fingerprints of their words.

    First each text is compared with one head of its keys, the commonest, which links a large
    group of near copies at one comparison a text; then with the heads of its other keys that
    are in another component; then all pairs of a key that are still in different components.
    The last two skip pairs whose parity sketches prove that they are not similar.
    So each pair of the keys is compared, connected or disproved. What grows with a square is
    only a group whose word fingerprints agree and whose texts do not.
    """
    texts = stored(prints.groupBy("text_hash").agg(*[F.min(c).alias(c) for c in ("fp", "word_fps", "sketch", "size")]), "texts")
    keyed = stored(texts.select("text_hash", "fp", F.posexplode("word_fps").alias("k", "word_fp")).withColumn(
        "key", F.explode(chain_keys(F.col("word_fp")))), "text_keys")

    def linked(pairs):
        """Verified pairs of texts as links of their fingerprints."""
        pairs = _jaccard_links(docs, pairs, words, similarity)
        for side in "ab":
            pairs = pairs.join(texts.select(F.col("text_hash").alias(side), F.col("fp").alias(f"{side}_fp")), side)
        return pairs.select(F.col("a_fp").alias("a"), F.col("b_fp").alias("b")).filter("a != b").distinct()

    def placed(classes):
        """Texts with the component of their fingerprint."""
        return texts.join(classes.withColumnRenamed("node", "fp"), "fp", "left").select(
            "text_hash", F.coalesce("component", "fp").alias("component"), "sketch", "size")

    stars = stored(star_pairs(keyed), "star_pairs")
    classes = stored(components(links.union(linked(stored(_ordered_pairs(first_heads(stars)), "first_pairs")))), "star_classes")
    where = stored(placed(classes), "star_places")
    of_head = where.select(F.col("text_hash").alias("head"), *[F.col(c).alias(f"head_{c}") for c in ("component", "sketch", "size")])
    apart = (stars.join(where, "text_hash").join(of_head, "head").filter("component != head_component")
             .filter(may_be_similar("", "head_", similarity)))
    classes = stored(merged_classes(classes, linked(stored(_ordered_pairs(apart), "apart_pairs"))), "head_classes")
    whole = keyed.join(classes.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    return merged_classes(classes, linked(stored(open_pairs(whole, texts, radius, similarity), "open_pairs")))


def merged_classes(classes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more links (a, b): components of components, so that what was
    linked before is not walked again."""
    for side in "ab":
        links = links.join(classes.select(F.col("node").alias(side), F.col("component").alias(f"{side}_class")), side, "left")
    more = stored(components(links.select(F.coalesce("a_class", "a").alias("a"), F.coalesce("b_class", "b").alias("b"))), "merged")
    met = more.select(F.col("node").alias("old"), F.col("component").alias("new"))
    moved = classes.join(met, F.col("component") == F.col("old"), "left").select("node", F.coalesce("new", "component").alias("component"))
    alone = more.join(classes.select("node"), "node", "left_anti").select("node", "component")
    return moved.union(alone)


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3, similar: tuple[int, float] | None = None) -> DataFrame:
    """(doc_id, text_hash, fp, component_id, chosen): the smallest doc_id reachable, and
    the text_hash of the row of the component that stays. With ``similar`` (words of a
    shingle, similarity) the links of ``similar_classes`` are added."""
    prints = stored(fingerprints(docs, shingle, similar_words=similar[0] if similar else None), "fingerprints")
    # A row without an id sorts after every id.
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    groups = stored(prints.groupBy("fp").agg(F.min(order).alias("first")), "fingerprint_groups")
    links = close_pairs(groups, radius)
    classes = similar_classes(docs, prints, links, radius, *similar) if similar else components(links)
    linked = groups.join(classes.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("component", "fp").alias("component"))
    tops = linked.groupBy("component").agg(F.min("first").alias("top"))
    labelled = stored(linked.join(tops, "component").select(
        "fp", F.col("top.doc_id").alias("component_id"), F.col("top.text_hash").alias("chosen")), "fingerprint_classes")
    return prints.join(labelled, "fp").select("doc_id", "text_hash", "fp", "component_id", "chosen")


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3,
                         similar: tuple[int, float] | None = None) -> DataFrame:
    """One document of each group, with all its columns: the smallest doc_id's. Of rows
    with one id and one text a single row stays."""
    kept = (near_duplicates(docs, shingle, radius, similar)
            .filter(F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("chosen")))
            .select("doc_id", "text_hash").distinct())
    an_id, a_hash, k_id, k_hash, row = fresh(docs, "own_id", "own_hash", "kept_id", "kept_hash", "row")
    keyed = docs.withColumns({an_id: F.col("doc_id").cast("long"), a_hash: text_hash()})
    kept = kept.select(F.col("doc_id").alias(k_id), F.col("text_hash").alias(k_hash))
    joined = keyed.join(kept, F.col(an_id).eqNullSafe(F.col(k_id)) & (F.col(a_hash) == F.col(k_hash)), "left_semi")
    # Rows of one id and text: the least by all columns, wherever they lie.
    one = Window.partitionBy(an_id, a_hash).orderBy(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])))
    return joined.withColumn(row, F.row_number().over(one)).filter(F.col(row) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
