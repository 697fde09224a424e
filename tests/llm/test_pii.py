from __future__ import annotations

import hashlib
import random
import re

from helpers import DOCS, awkward, clashing, empty

from martloom.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                    "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, *m.span()))
    return out


def luhn(digits):
    total = 0
    for i, d in enumerate(int(c) for c in digits[::-1]):
        if i % 2:
            d = d * 2 - 9 if d * 2 > 9 else d * 2
        total += d
    return total % 10 == 0


def test_base_spans_are_the_patterns():
    pick = random.Random(6)
    bits = ["a.b@c.de", "x@y", "@", "1.2.3.4", "300.1.1.1", "1.2.3.4.5.6.7.8", "4539 1488 0343 6467", "4539148803436467", "12-34",
            "+1 (555) 123-4567", "+", "++49 30 1234567", "é", " ", "-", ".", ",", "7", "00", "a@b.c@d.e", "_%+"]
    for _ in range(4000):
        text = "".join(pick.choice(bits) for _ in range(pick.randint(0, 9)))
        assert [(pii.KINDS[k], a, b) for k, a, b in pii.base_spans(text)] == plain_spans(text), text


def test_long_runs_are_read_once():
    assert pii.base_spans("a" * 200_000 + " " + "1" * 200_000 + "." * 1000 + "@" * 1000) == []


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def check(rows, docs):
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(plain_spans(r.text))
    for r in rows:
        options = [s for s in want[r.doc_id] if hashlib.sha256(joined(s).encode()).hexdigest() == r.base_sha256]
        assert options
        spans = options[0]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in pii.KINDS]
        found = [tuple(x.split(":")) for x in r.spans.split(",") if x]
        found = [(k, int(a), int(b)) for k, a, b in found]
        assert set(spans) <= set(found) and r.n_added == len(set(found) - set(spans))
        assert found == sorted(found, key=lambda s: (pii.KINDS.index(s[0]), s[1]))


def test_contexts_lead_to_unseen_identifiers(spark):
    pick = random.Random(8)
    rows = []
    for i in range(60):
        rows.append((i, f"Please write to user{i}.{pick.randint(0, 99)}@mail.example.com for help", "en", "a", 0))
    rows += [(100 + i, f"Number {i}, version 3.{i}.x of the table", "en", "a", 0) for i in range(60)]
    rows += [(200, "Please write to anna(at)host.example for help", "en", "a", 0),
             (201, "again anna(at)host.example alone", "en", "a", 0), (202, "Please write to v2.x1 for help", "en", "a", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    out = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    check(out.values(), docs)
    assert out[200].spans == "email:16:36" and out[201].spans == "email:6:26"
    assert out[202].spans == "" and sum(r.n_added for r in out.values()) == 2


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), "kind", "row", "value", "spans")
    out = pii.personal_data(docs).collect()
    assert len(out) == 11
    check(out, docs)
    assert pii.personal_data(empty(spark)).count() == 0


def test_spaced_phones_and_cards_are_found_where_many_are_unseen(spark):
    """Over a fifth of the identifiers of each context are of unseen forms, in groups."""
    pick = random.Random(9)
    rows, unseen = [], {}
    for i in range(40):
        rows.append((i, f"Please call +49 30 {pick.randint(10 ** 6, 10 ** 7 - 1)} for help", "en", "a", 0))
        start = f"4539 1488 {pick.randint(1000, 9999)} {pick.randint(100, 999)}"
        last = next(d for d in range(10) if luhn(re.sub(" ", "", start) + str(d)))
        rows.append((100 + i, f"Charge the card {start}{last} today", "en", "a", 0))
        if i < 20:
            phone = f"({pick.randint(100, 999)}) {pick.randint(1000, 9999)} {pick.randint(1000, 9999)}"
            card = f"{start}{(last + 1) % 10}"
            for at, kind, head, value in ((200 + i, "phone", "Please call ", phone), (300 + i, "card", "Charge the card ", card)):
                rows.append((at, f"{head}{value} now", "en", "a", 0))
                unseen[at] = f"{kind}:{len(head)}:{len(head) + len(value)}"
    docs = spark.createDataFrame(rows, DOCS)
    out = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    check(out.values(), docs)
    assert {at: out[at].spans for at in unseen} == unseen
