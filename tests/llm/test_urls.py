from __future__ import annotations

import math
import random
import re
from collections import Counter

from helpers import clashing
from pyspark.sql import functions as F

from martloom.llm import urls

PAGES = "page_id long, url string, html string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def plain_rule(host, path):
    best = None
    for rule, verdict in urls.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = rule, verdict
    return best or (None, None)


ODD = [None, "", "no scheme", "://", "http://", "http://ORG", "http://ORG/x", "https://a.Org/?q#f", "x://example.org/es/1", "x://example.org/es",
       "x://www.example.org/en/1?x=/", "x://example.org/en/2", "x://notexample.com/fr/", "x://a.com/de/5#x", "x://com/fr/", "x://b.net?u=://c.org/",
       "x://y://z.org/", "x://é.com/fr/é", "x://a.com:80/fr/1", "x://org", "x://org?/", "x://.org/"]


def corpus(spark, n=600):
    pick = random.Random(9)
    rows = []
    for i in range(n):
        good = pick.random() < 0.5
        word = "".join(pick.choice("aeiou" if good else "xzqjk") for _ in range(8))
        kind = pick.choice(["org/", "com/fr/"]) if good else pick.choice(["com/de/", "example.org/es/"])
        place = kind if pick.random() < 0.6 else "net/"
        rows.append((i, f"http://{'x.' if place.startswith('example') else word + '.'}{place}{word}", None))
    return spark.createDataFrame(rows, PAGES)


def test_parts_and_rules(spark):
    df = spark.createDataFrame([(i, u, None) for i, u in enumerate(ODD)], PAGES)
    out = {r.page_id: r for r in urls.judge(df).collect()}
    for i, u in enumerate(ODD):
        host, path = plain_parts(u)
        rule, verdict = plain_rule(host, path)
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule), u
        assert out[i].verdict == verdict if rule else out[i].verdict in ("allow", "block")


def plain_model(rows):
    """rows of (url, accepted): log share of a symbol after two others."""
    def symbols(u):
        return [0, 0] + [ord(c) - 32 if 33 <= ord(c) <= 95 else 0 for c in (u or "").upper()]

    counts = {k: Counter(tuple(symbols(u)[i:i + 3]) for u, a in rows if a == k for i in range(len(symbols(u)) - 2)) for k in (True, False)}

    def share(kind, a, b, c):
        p = 1 / 64
        for fits in (lambda g: True, lambda g: g[1] == b, lambda g: g[:2] == (a, b)):
            inside = {}
            for g, n in counts[kind].items():
                if fits(g):
                    inside[g[2]] = inside.get(g[2], 0) + n
            total, kinds = sum(inside.values()), len(inside)
            p = (inside.get(c, 0) + kinds * p) / (total + kinds) if total else p
        return p

    return lambda u: sum(math.log(share(True, *g) / share(False, *g)) for g in
                         (tuple(symbols(u)[i:i + 3]) for i in range(len(symbols(u)) - 2))) / max(1, len(symbols(u)) - 2)


def test_scores_against_brute_force(spark):
    docs = corpus(spark, 60)
    marked = docs.withColumn("held", F.pmod(F.xxhash64("url", F.lit(urls.SEED)), F.lit(4)) == 0).collect()
    rows = [(r.url, plain_rule(*plain_parts(r.url))[1] == "allow") for r in marked
            if plain_rule(*plain_parts(r.url))[1] and not r.held]
    score = plain_model(rows)
    for r, out in zip(sorted(marked, key=lambda r: r.page_id), sorted(urls.judge(docs).collect(), key=lambda r: r.page_id), strict=True):
        assert abs(out.score - score(r.url)) < 1e-4


def test_verdicts_of_urls_without_a_rule(spark):
    docs = corpus(spark)
    out = {r.page_id: r for r in urls.judge(docs).collect()}
    free = [r for r in docs.collect() if out[r.page_id].rule is None]
    right = sum((out[r.page_id].verdict == "allow") == any(v in r.url.split("/")[-1] for v in "aeiou") for r in free)
    assert len(free) > 150 and right == len(free)


def test_awkward_rows(spark):
    rows = [(1, None, None), (1, None, None), (None, "x" * 20000, None), (2, "http://a.net/1", None), (2, "http://a.net/1", None)]
    df = clashing(spark.createDataFrame(rows, PAGES), "row", "gram", "score", "host")
    out = urls.judge(df).collect()
    assert len(out) == 5 and {r.verdict for r in out} == {"allow"} and all(r.score == 0 for r in out)
    assert urls.judge(spark.createDataFrame([], PAGES)).count() == 0
