"""Line dedup: runs of lines that an earlier place already holds are deleted.

Windows are measured in words: from every line on, and from every line back, the lines up
to the first at which ``min_words`` words are together. The line of least hash in a window
is selected, and its hash is the fingerprint of that place, so a text has fewer
fingerprints than lines. Places are joined by fingerprint; one that no other place has
goes no further. A run of ``min_words`` words or more that is repeated holds the same
windows at both places, so both have the fingerprint, and each of the run's lines lies in
one of its windows. Where a fingerprint is met at several places, the first place for each
content of its windows is an anchor, so that a common line does not hide one run behind
another. Every other place is joined to the anchor's document, matched lines are extended
both ways as far as they agree, and matched runs of ``min_words`` words or more are
deleted. A deleted line equals an earlier one, so the earliest of each stays.

Defined results: lines end at a line feed and are compared without white space at their
ends; a null text stays null, an empty one empty; a text that loses all its lines is
empty; documents come in order of doc_id, null first, then of their text's hash; rows
equal in id and text share one decision; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import fresh, map_columns, text_hash
from martloom.session import stored

MIN_WORDS = 50
BASE, PRIME = 0x9E3779B97F4A7C1, (1 << 61) - 1


def line_hashes(text: str | None) -> tuple[list[int], list[int]]:
    """Hash and number of words of each line."""
    lines = (text or "").split("\n")
    hashes = [xxhash.xxh64_intdigest(x.strip().encode()) - (1 << 63) for x in lines]
    return hashes, [len(x.split()) for x in lines]


def _windows(hashes: list[int], words: list[int], min_words: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, place of the least hash) of every window that reaches ``min_words``."""
    queue: list[int] = []  # places of the window with rising hashes
    head = end = held = 0
    for start in range(len(hashes)):
        while held < min_words and end < len(hashes):
            while len(queue) > head and hashes[queue[-1]] >= hashes[end]:
                queue.pop()
            queue.append(end)
            held += words[end]
            end += 1
        if held < min_words:
            return
        yield start, end, queue[head]
        held -= words[start]
        if queue[head] == start:
            head += 1


def fingerprints(hashes: list[int], words: list[int], min_words: int = MIN_WORDS) -> dict[int, list[int]]:
    """The places selected by windows read forwards and backwards, with what each of their
    windows holds as one number. The fingerprint of a place is its line's hash."""
    n = len(hashes)
    windows = set(_windows(hashes, words, min_words))
    windows |= {(n - e, n - s, n - 1 - p) for s, e, p in _windows(hashes[::-1], words[::-1], min_words)}
    if not windows:
        return {}
    # Hashes of any run of lines from those of the heads of the text.
    heads, powers = [0], [1]
    for h in hashes:
        heads.append((heads[-1] * BASE + h) % PRIME)
        powers.append(powers[-1] * BASE % PRIME)
    found: dict[int, set[int]] = {}
    for s, e, p in windows:
        found.setdefault(p, set()).add((heads[e] - heads[s] * powers[e - s]) % PRIME)
    return {p: sorted(held) for p, held in sorted(found.items())}


def matched_runs(own: list[int], words: list[int], other: list[int], min_words: int = MIN_WORDS) -> list[tuple[int, int]]:
    """Runs (start, end) of places at which both lists agree, of ``min_words`` words or more."""
    n = min(len(own), len(other))
    same = np.zeros(n + 2, dtype=np.int8)
    same[1:-1] = np.asarray(own[:n], dtype=np.int64) == np.asarray(other[:n], dtype=np.int64)
    steps = np.flatnonzero(np.diff(same))
    total = np.concatenate([[0], np.cumsum(words[:n])])
    return [(int(a), int(b)) for a, b in zip(steps[::2], steps[1::2], strict=True) if total[b] - total[a] >= min_words]


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    def make():
        def work(ids, keys, texts):
            out = [line_hashes(t) for t in texts]
            prints = [fingerprints(h, w, min_words) for h, w in out]
            return (ids, keys, [h for h, _ in out], [w for _, w in out], [list(p) for p in prints],
                    [[h[place] for place in p] for (h, _), p in zip(out, prints, strict=True)], [list(p.values()) for p in prints])

        return work

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("key"), "text")
    return map_columns(keyed, ["doc_id", "key", "text"],
                       [("doc_id", "long"), ("key", "long"), ("hashes", "array<long>"), ("words", "array<int>"),
                        ("places", "array<int>"), ("prints", "array<long>"), ("windows", "array<array<long>>")], make)


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, key, runs): the runs (from, to) of line numbers to delete, from 0, ``to``
    exclusive, for documents that have any. They may overlap."""
    lines = stored(_lines(docs, min_words), "lines")
    same = ["doc_id", "key"]
    places = stored(lines.select(*same, F.size("hashes").alias("n"), F.explode(F.arrays_zip("places", "prints", "windows")).alias("p")).select(
        *same, "n", F.col("p.places").alias("line"), F.col("p.prints").alias("print"), F.col("p.windows").alias("windows")), "line_prints")
    place = F.struct(*same, "line")
    repeated = (places.groupBy("print").agg(F.min(place).alias("first"), F.max(place).alias("last"))
                .filter("first < last").select("print"))
    # Fingerprints grow with the corpus, so they are never broadcast: one plan at every size.
    met = stored(places.join(repeated.hint("merge"), "print", "left_semi")
                 .select(*same, "n", "line", "print", F.explode("windows").alias("window")), "line_windows")
    anchors = met.groupBy("print", "window").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter("first < last").drop("last")
    # A run that is met by many of its lines is one row: same documents, same shift.
    met = (met.join(anchors, ["print", "window"]).filter(place > F.col("first"))
           .select(*same, "n", F.col("first.doc_id").alias("a_id"), F.col("first.key").alias("a_key"),
                   (F.col("first.line") - F.col("line")).alias("shift")).distinct())
    theirs = lines.select(F.col("doc_id").alias("b_id"), F.col("key").alias("b_key"), F.col("hashes").alias("theirs")) \
        .dropDuplicates(["b_id", "b_key"])
    own = lines.select(F.col("doc_id").alias("o_id"), F.col("key").alias("o_key"), "hashes", "words") \
        .dropDuplicates(["o_id", "o_key"])
    start = F.greatest(F.lit(0), -F.col("shift"))  # first own line that has a partner
    part = F.slice("theirs", F.greatest(F.lit(0), F.col("shift")) + 1, F.col("n"))
    pairs = met.join(theirs, F.col("a_id").eqNullSafe(F.col("b_id")) & (F.col("a_key") == F.col("b_key"))).select(
        *same, start.alias("start"), part.alias("theirs"))
    pairs = pairs.join(own, F.col("doc_id").eqNullSafe(F.col("o_id")) & (F.col("key") == F.col("o_key"))).select(
        *same, "start", "theirs", F.expr("slice(hashes, start + 1, size(hashes))").alias("own"),
        F.expr("slice(words, start + 1, size(words))").alias("words"))

    def make():
        def work(ids, keys, starts, theirs, own, words):
            out = [(i, k, s + a, s + b) for i, k, s, t, o, w in zip(ids, keys, starts, theirs, own, words, strict=True)
                   for a, b in matched_runs(o, w, t, min_words)]
            return zip(*out, strict=True) if out else ([], [], [], [])

        return work

    runs = map_columns(pairs, ["doc_id", "key", "start", "theirs", "own", "words"],
                       [("doc_id", "long"), ("key", "long"), ("from", "int"), ("to", "int")], make)
    return runs.groupBy(*same).agg(F.collect_set(F.struct("from", "to")).alias("runs"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, length: str | None = "n_chars") -> DataFrame:
    """``docs`` with the repeated runs deleted from ``text`` and ``length`` set anew."""
    frame, runs = with_runs(docs, min_words)
    frame = frame.withColumn("text", kept_lines("text", runs))
    if length and length in docs.columns:
        frame = frame.withColumn(length, F.length("text").cast(docs.schema[length].dataType))
    return frame.select(*[F.col(f"`{c}`") for c in docs.columns])


def with_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, str]:
    """``docs`` with a column of the runs to delete, null if none, and its name."""
    an_id, a_key, b_id, b_key, runs = fresh(docs, "own_id", "own_key", "runs_id", "runs_key", "runs")
    found = stored(repeated_runs(docs, min_words), "line_runs").select(
        F.col("doc_id").alias(b_id), F.col("key").alias(b_key), F.col("runs").alias(runs))
    keyed = docs.withColumns({an_id: F.col("doc_id").cast("long"), a_key: text_hash()})
    # The runs grow with the corpus, so they are never broadcast: one plan at every size.
    joined = keyed.join(found.hint("merge"), F.col(an_id).eqNullSafe(F.col(b_id)) & (F.col(a_key) == F.col(b_key)), "left")
    return joined.drop(an_id, a_key, b_id, b_key), runs


def kept_lines(text: str, runs: str):
    """The text without the lines of ``runs``."""
    lines = F.split(F.col(text), "\n", -1)
    kept = F.filter(lines, lambda line, i: ~F.exists(F.col(runs), lambda r: (i >= r["from"]) & (i < r["to"])))
    return F.when(F.col(runs).isNull(), F.col(text)).otherwise(F.array_join(kept, "\n"))


def summary(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, n_lines, n_deleted, kept_sha256 (of the text that stays) for every row."""
    frame, runs = with_runs(docs.select("doc_id", "text"), min_words)
    kept = F.coalesce(kept_lines("text", runs), F.lit(""))
    gone = F.coalesce(F.size(F.array_distinct(F.flatten(F.transform(
        runs, lambda r: F.sequence(r["from"], r["to"] - 1))))), F.lit(0))
    return frame.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.size(F.split(F.coalesce("text", F.lit("")), "\n", -1)).cast("long").alias("n_lines"),
                        F.greatest(gone, F.lit(0)).cast("long").alias("n_deleted"),
                        F.sha2(kept, 256).alias("kept_sha256"))
