"""Personal data: exact patterns, and identifiers that bootstrapped contexts lead to.

Base spans of the four kinds are the seeds. Each seed's left context gives lexical
patterns: the word before it, and the two words before it. All identifier-like words of
the corpus, and all runs of digits in groups, that the patterns lead to form a graph of
patterns and instances. In each round Spark scores the patterns by the share of their
distinct instances that are known to be of a kind (those with few known ones are not
trusted; unknown ones whose shape fits the kind count neither for nor against), then scores
unknown instances by the patterns that hold them, 1 - prod(1 - share), and takes those whose
own shape fits the kind as known. It stops when a round finds none. Every place of a
discovered identifier becomes a span, unless it lies within another one of its kind.

Defined results: a null or empty text has no spans and the digest of the empty string;
rows that share an id are documents of their own; an empty table gives an empty table.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import map_columns
from martloom.session import stored

KINDS = ("email", "ip", "card", "phone")
#: Distinct known instances that a pattern needs, its least share of them, and the least
#: score of an unknown instance.
MIN_KNOWN, MIN_SHARE, MIN_SCORE = 5, 0.8, 0.9
#: Longest identifier that is discovered: an address of 64 characters, its sign, 255 more.
LONGEST = 320
#: Digits of a run in groups.
RUN_DIGITS = range(7, 20)

_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_NUMBERS = re.compile(r"[0-9][0-9.]*")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9]+|@|\((?:at|AT)\)|\[(?:at|AT)\]")
_RUN = re.compile(r"[+(\[]{0,2}[0-9]+(?:[ ().\[\]/_-]{1,3}[0-9]+)+")
_EDGE = ".,;:!?\"'()[]<>{}«»“”„"


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        doubled = digit * (1 + place % 2)
        total += doubled - 9 * (doubled > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Anchored on each ``@``: a match starts where the run of local characters before it
    starts, so long runs are read once."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        match = _DOMAIN.match(text, at) if start < at else None
        if match:
            done = match.end()
            out.append((start, done))
        at = text.find("@", max(at + 1, done))
    return out


def ips(text: str) -> list[tuple[int, int]]:
    out = []
    for block in _NUMBERS.finditer(text):
        if block.group().count(".") >= 3:
            for match in _IP.finditer(text, *block.span()):
                if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in match.group().split(".")):
                    out.append(match.span())
    return out


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def cards(text: str) -> list[tuple[int, int]]:
    out = []
    for match in _CARD.finditer(text):
        if 16 <= match.end() - match.start() <= 40:
            digits = _digits(match.group())
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(match.span())
    return out


def phones(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in _PHONE.finditer(text) if 8 <= len(_digits(m.group())) <= 15]


FINDERS = (emails, ips, cards, phones)


def base_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(kind number, start, end), by kind, then start."""
    text = text or ""
    return [(k, a, b) for k, find in enumerate(FINDERS) for a, b in find(text)]


def contexts(text: str, start: int) -> list[str]:
    """The word before, and the two words before, in lower case, digits as 0."""
    words = re.sub("[0-9]", "0", text[max(0, start - 80):start].lower()).split()[-2:]
    words = [w.strip(_EDGE) or w for w in words]
    return [" ".join(words[-n:]) for n in range(1, len(words) + 1)]


def candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, str]]:
    """Words with a digit or a sign for "at", and digits in groups, that no base span touches:
    start, end, value."""
    out, end = [], 0
    held = sorted((a, b) for _, a, b in taken)
    at = 0
    for mark in _MARK.finditer(text):
        if mark.start() < end:
            continue
        start, end = mark.start(), mark.end()
        while start > 0 and not text[start - 1].isspace() and mark.start() - start <= LONGEST:
            start -= 1
        while end < len(text) and not text[end].isspace() and end - start <= LONGEST:
            end += 1
        a, b = start, end
        while a < b and text[a] in _EDGE:
            a += 1
        while a < b and text[b - 1] in _EDGE:
            b -= 1
        while at < len(held) and held[at][1] <= a:
            at += 1
        if 5 <= b - a <= LONGEST and not (at < len(held) and held[at][0] < b):
            out.append((a, b, text[a:b]))
    return sorted({*out, *_digit_runs(text, held)})


def _digit_runs(text: str, held: list[tuple[int, int]]) -> list[tuple[int, int, str]]:
    """Digits in groups with spaces, as words are cut at them."""
    out, at = [], 0
    for run in _RUN.finditer(text):
        a, b = run.span()
        while at < len(held) and held[at][1] <= a:
            at += 1
        if " " in run.group() and len(_digits(run.group())) in RUN_DIGITS and not (at < len(held) and held[at][0] < b):
            out.append((a, b, run.group()))
    return out


def fits(value: str) -> list[int]:
    """Kinds whose shape a value has, more loosely than the base pattern."""
    digits = len(_digits(value))
    plain = set(value) <= set("0123456789 ().-+_/[]")
    out = []
    if re.fullmatch(r"[^\s@]+(?:@|[(\[](?:at|AT)[)\]])[^\s@]+", value):
        out.append(0)
    if re.fullmatch(r"[0-9]{1,3}(?:[._:-][0-9]{1,3}){3}", value) or re.fullmatch(r"(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}", value):
        out.append(1)
    if plain and 13 <= digits <= 19:
        out.append(2)
    if plain and 7 <= digits <= 15:
        out.append(3)
    return out


def _extract(docs: DataFrame) -> DataFrame:
    """One row per document: base spans, and parallel lists of identifier-like places.
    ``kinds`` is the seed's kind or -1, ``shapes`` the fitting kinds as bits."""
    fields = [("doc_id", "long"), ("base", "array<string>"), *[(f"n_{k}", "long") for k in KINDS],
              ("values", "array<string>"), ("kinds", "array<int>"), ("shapes", "array<int>"),
              ("starts", "array<int>"), ("ends", "array<int>"), ("near", "array<string>"), ("far", "array<string>")]

    def make():
        def work(ids, texts):
            out = []
            for doc_id, text in zip(ids, texts, strict=True):
                text = text or ""
                base = base_spans(text)
                places = [(text[a:b], k, 0, a, b) for k, a, b in base]
                places += [(v, -1, sum(1 << k for k in fits(v)), a, b) for a, b, v in candidates(text, base)]
                around = [(contexts(text, p[3]) + [None, None])[:2] for p in places]
                out.append((doc_id, [f"{KINDS[k]}:{a}:{b}" for k, a, b in base],
                            *[sum(1 for s in base if s[0] == k) for k in range(len(KINDS))],
                            *[[p[i] for p in places] for i in range(5)], [c[0] for c in around], [c[1] for c in around]))
            return list(zip(*out, strict=True)) if out else [[]] * len(fields)
        return work

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_columns(keyed, ["doc_id", "text"], fields, make)


def pattern_shares(edges: DataFrame, known: DataFrame) -> DataFrame:
    """(pattern, kind, share) of the trusted patterns. An unknown instance whose shape fits
    the kind is what is asked for, so it is not counted."""
    marked = edges.select("value", "pattern", "shapes").join(known, "value", "left")
    counted = marked.groupBy("pattern").agg(F.count("*").alias("all"), *[
        c for k in range(len(KINDS)) for c in (
            F.count_if(F.col("kind") == k).alias(f"held_{k}"),
            F.count_if(F.expr(f"kind IS NULL AND (shapes & {1 << k}) != 0")).alias(f"open_{k}"))])
    by_kind = counted.select("pattern", "all", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(f"held_{k}").alias("held"), F.col(f"open_{k}").alias("open"))
        for k in range(len(KINDS))])).alias("c")).select("pattern", "all", "c.*")
    return (by_kind.filter(F.col("held") >= MIN_KNOWN)
            .select("pattern", "kind", (F.col("held") / (F.col("all") - F.col("open"))).alias("share"))
            .filter(F.col("share") >= MIN_SHARE))


def instance_scores(edges: DataFrame, shapes: DataFrame, patterns: DataFrame, known: DataFrame) -> DataFrame:
    """(value, kind) of unknown instances that trusted patterns hold with certainty."""
    missed = F.sum(F.log(F.greatest(F.lit(1e-6), 1 - F.col("share"))))
    scored = (edges.join(patterns, "pattern").join(known.select("value"), "value", "left_anti")
              .groupBy("value", "kind").agg((1 - F.exp(missed)).alias("score")).filter(F.col("score") >= MIN_SCORE))
    fitting = scored.join(shapes, "value").filter(F.expr("(shapes & shiftleft(1, kind)) != 0"))
    # One kind each: the best score, then the first kind.
    return fitting.groupBy("value").agg(F.min_by("kind", F.struct(-F.col("score"), "kind")).alias("kind"))


def discover(found: DataFrame) -> DataFrame:
    """(value, kind) of identifiers that are not base matches, found in rounds."""
    places = found.select(F.explode(F.arrays_zip("values", "kinds", "shapes", "near", "far")).alias("p")).select(
        F.lower("p.values").alias("value"), "p.kinds", "p.shapes", "p.near", "p.far")
    # Counts and joins work on distinct (instance, pattern) pairs: copies weigh nothing.
    edges = stored(places.select("value", "kinds", "shapes", F.explode(F.array("near", "far")).alias("pattern"))
                   .filter("pattern IS NOT NULL").groupBy("value", "pattern")
                   .agg(F.max("kinds").alias("kinds"), F.max("shapes").alias("shapes")), "pii_edges")
    known = stored(edges.filter("kinds >= 0").groupBy("value").agg(F.min("kinds").alias("kind")), "pii_known")
    shapes = stored(edges.filter("kinds < 0 AND shapes > 0").groupBy("value").agg(F.max("shapes").alias("shapes")), "pii_shapes")
    new = known.filter("false")
    while True:
        patterns = stored(pattern_shares(edges, known), "pii_patterns")
        fresh = stored(instance_scores(edges, shapes, patterns, known), "pii_new")
        if fresh.isEmpty():
            return new
        new, known = new.unionByName(fresh), known.unionByName(fresh)


def personal_data(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans, n_added."""
    found = stored(_extract(docs), "pii_places").withColumn("row", F.monotonically_increasing_id())
    new = stored(discover(found), "pii_discovered").select(F.col("value").alias("new_value"), "kind")
    places = (found.filter("exists(kinds, k -> k < 0)")
              .select("row", F.explode(F.arrays_zip("values", "kinds", "starts", "ends")).alias("p")).filter("p.kinds < 0"))
    added = (places.join(new, F.lower("p.values") == F.col("new_value"))
             .groupBy("row").agg(F.collect_set(F.struct(
                 F.col("kind").alias("k"), F.col("p.starts").alias("a"), F.col("p.ends").alias("b"))).alias("more")))
    base = F.transform("base", lambda s: F.struct(
        F.array_position(F.array(*map(F.lit, KINDS)), F.split_part(s, F.lit(":"), F.lit(1))).cast("int") - 1,
        F.split_part(s, F.lit(":"), F.lit(2)).cast("int"), F.split_part(s, F.lit(":"), F.lit(3)).cast("int")))
    base = base.cast("array<struct<k:int,a:int,b:int>>")
    more = F.coalesce(F.col("more"), F.array().cast("array<struct<k:int,a:int,b:int>>"))
    more = F.filter(more, lambda s: ~F.exists(more, lambda t: (t["k"] == s["k"]) & (t["a"] <= s["a"]) & (t["b"] >= s["b"]) & (t != s)))
    every = F.array_join(F.transform(F.array_sort(F.concat(base, more)), lambda s: F.concat_ws(
        ":", F.element_at(F.array(*map(F.lit, KINDS)), s["k"] + 1), s["a"], s["b"])), ",")
    return found.join(added, "row", "left").select(
        "doc_id", *[f"n_{k}" for k in KINDS], F.sha2(F.array_join("base", ","), 256).alias("base_sha256"),
        every.alias("spans"), F.size(more).cast("long").alias("n_added"))
