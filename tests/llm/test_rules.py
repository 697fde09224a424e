"""The cascade against plain rules, whatever its order."""

import random

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from helpers import DOCS, awkward, clashing, empty, prose
from martloom.llm import rules
from martloom.llm.rules import RULES, Rule, Sampled, Text

BLANKS = " \t\n\x0b\x0c\r"


def plain_words(text):
    out, word = [], ""
    for ch in text + " ":
        if ch in BLANKS:
            out += [word] if word else []
            word = ""
        else:
            word += ch
    return out


def plain(text):
    """The base measures, counted one by one."""
    text = text or ""
    words = plain_words(text)
    lines = [x for x in text.split("\n") if plain_words(x)]
    windows = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    inside = {i + k for i, x in enumerate(windows) if windows.count(x) > 1 for k in range(5)}
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text), dup, len(inside)


@given(st.text(st.sampled_from("ab#\n é|\t"), max_size=80))
@settings(max_examples=300, deadline=None)
def test_measures_equal_a_plain_count(text):
    found = Text(text)
    assert tuple(found[m] for m in rules.MEASURED) == plain(text)


@given(st.lists(st.sampled_from("abc"), max_size=60))
@settings(max_examples=300, deadline=None)
def test_repeated_words(words):
    assert rules.repeated_words(words) == plain(" ".join(words))[4]


def test_query_on_awkward_rows(spark):
    docs = clashing(awkward(spark), "kept", "rejected_by", "n_words", "mask")
    found = rules.judged(docs).collect()
    assert found[0].asDict().keys() == {"doc_id", *rules.MEASURED, "base_failed", "kept"}
    texts = sorted((r.doc_id or -1, plain(r.text)) for r in docs.select("doc_id", "text").collect())
    assert sorted((r.doc_id or -1, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in found) == texts
    for r in found:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert not (r.base_failed and r.kept)
    assert sum(r.kept for r in found) == 3


def test_empty_table(spark):
    assert rules.judged(empty(spark)).collect() == []
    assert rules.good_documents(empty(spark)).collect() == []


def test_good_documents_keep_their_columns(spark):
    docs = clashing(awkward(spark), "rejected_by", "n_asked")
    kept = rules.good_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [5, 5, 6]


def test_verdict_does_not_depend_on_the_order():
    pick = random.Random(3)
    texts = [prose(k, 5 + k) + pick.choice(["", " ###" * k, " X" * k, "\nsame line" * k]) for k in range(60)]
    for text in texts:
        verdicts = set()
        for _ in range(5):
            shuffled = pick.sample(RULES, len(RULES))
            verdicts.add(rules.first_failed(Text(text), shuffled)[0] is None)
        assert verdicts == {not any(rules.fails(r, Text(text)) for r in RULES)}


def test_order_is_rejection_per_cost():
    rule = {n: Rule(n, (m,), lambda x: True) for n, m in
            (("dear", "n_repeat_words"), ("cheap", "n_symbols"), ("idle", "n_words"), ("shared", "word_chars"))}
    seconds = {"words": 5.0, "n_repeat_words": 5.0, "n_symbols": 1.0, "n_words": 1.0, "word_chars": 1.0}
    failed = {frozenset({"dear"}): 40, frozenset({"dear", "cheap"}): 5, frozenset({"cheap"}): 5, frozenset({"shared"}): 15, frozenset(): 100}
    names = [r.name for r in rules.ordered(list(rule.values()), Sampled(seconds, failed))]
    # cheap: 10 / 1; then dear: 40 / 10, shared: 15 / 6; then shared costs 1 as the words are there.
    assert names == ["cheap", "dear", "shared", "idle"]
    # With the words at hand, shared comes to 15 / 1 and dear to 45 / 5.
    names = [r.name for r in rules.ordered(list(rule.values()), Sampled(seconds, failed), known=["n_words"])]
    assert names == ["shared", "cheap", "dear", "idle"]


def test_later_measures_are_not_computed():
    text = Text("### ### ###")
    assert rules.first_failed(text, sorted(RULES, key=lambda r: r.name != "symbols")) == ("symbols", 1)
    assert "n_repeat_words" not in text._held and "lines" not in text._held


def test_sample_is_bounded_and_counts_failures(spark, monkeypatch):
    monkeypatch.setattr(rules, "SAMPLE", 50)
    docs = spark.createDataFrame([(i, "# " * 20 if i % 2 else prose(i, 30), "en", "s", 1) for i in range(400)], DOCS)
    sample = rules.sampled(docs)
    assert 0 < sum(sample.failed.values()) <= 50
    assert all(("symbols" in failed) == bool(failed) for failed in sample.failed)
    assert all(s >= 0 for s in sample.seconds.values()) and sample.seconds["words"] > 0
    assert rules.plan(docs)[0].name in {r.name for r in RULES}


def test_one_unbroken_megabyte_and_many_words(spark):
    docs = spark.createDataFrame([(1, "x" * 1_000_000, "en", "s", 1), (2, prose(2, 30_000), "en", "s", 1)], DOCS)
    found = {r.doc_id: r for r in rules.verdicts(docs, ["doc_id"], ["n_words", "longest_word", "n_repeat_words"]).collect()}
    assert (found[1].n_words, found[1].longest_word, found[1].rejected_by is None) == (1, 1_000_000, False)
    assert (found[2].n_words, found[2].rejected_by) == (30_000, None)
