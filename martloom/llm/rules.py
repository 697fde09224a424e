"""Quality rules as a short-circuit cascade.

A rule needs measures of a text and says whether they pass; measures need other measures,
such as the words. On a sample the time of every measure and the rules that each text
fails are taken. The order is then greedy: the next rule is the one that rejects most of
the texts still alive per second of what it has to compute on top of the rules before it,
so correlated rules and shared measures count as they are. Over all rows a text stops at
its first failing rule, and only the measures up to there are computed.

The order follows measured times, so it may differ between runs; the verdict does not, as
a text is kept if it passes all rules. Thresholds are fixed and whole-numbered.

Sample: ``SAMPLE`` rows at most. Everything else reads all rows and whole texts.

Defined results: null is an empty text; it has no words and fails ``words``. A line is what
``\\n`` separates, a word what is free of the six ASCII blanks. Rows are judged one by one,
so equal rows, null keys and other columns do not matter; an empty table gives an empty one.
"""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import keep_rows, map_columns

SAMPLE, SEED, WINDOW = 2000, 13, 5

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SYMBOL = re.compile(r"[#*$%&|<>]")
_LETTER, _UPPER, _LOWER = regex.compile(r"\p{L}"), regex.compile(r"\p{Lu}"), regex.compile(r"\p{Ll}")


class Text:
    """The measures of one text, each computed when it is first asked for."""

    def __init__(self, text: str | None):
        self._held: dict = {"text": text or ""}
        self.took: dict[str, float] = {}

    def __getitem__(self, name: str):
        if name not in self._held:
            self._held[name] = MEASURES[name](self)
        return self._held[name]

    def timed(self, name: str) -> None:
        """Compute a measure and note its own time, without that of what it needs."""
        for need in NEEDS[name]:
            if need not in self._held:
                self.timed(need)
        start = time.perf_counter()
        self[name]
        self.took[name] = time.perf_counter() - start


def repeated_words(words: Sequence[str], window: int = WINDOW) -> int:
    """Words that lie in a window of ``window`` words found at least twice."""
    shifted = [words[k:] for k in range(window)]
    count = Counter(zip(*shifted))
    if len(count) == max(0, len(words) - window + 1):
        return 0
    total = end = 0
    for at, found in enumerate(zip(*shifted)):
        if count[found] > 1:
            total += at + window - max(at, end)
            end = at + window
    return total


def _upper(words: Iterable[str]) -> int:
    return sum(len(w) > 1 and _UPPER.search(w) is not None and _LOWER.search(w) is None for w in words)


#: Each measure and what it needs.
MEASURES: dict[str, Callable[[Text], object]] = {
    "words": lambda t: _WORD.findall(t["text"]),
    "lines": lambda t: [line for line in t["text"].split("\n") if _WORD.search(line)],
    "n_words": lambda t: len(t["words"]),
    "n_lines": lambda t: len(t["lines"]),
    "word_chars": lambda t: sum(map(len, t["words"])),
    "longest_word": lambda t: max(map(len, t["words"]), default=0),
    "n_symbols": lambda t: len(_SYMBOL.findall(t["text"])),
    "n_dup_lines": lambda t: len(t["lines"]) - len(set(t["lines"])),
    "n_repeat_words": lambda t: repeated_words(t["words"]),
    "n_letter_words": lambda t: sum(_LETTER.search(w) is not None for w in t["words"]),
    "n_upper_words": lambda t: _upper(t["words"]),
    "n_bullet_lines": lambda t: sum(line.lstrip(" \t")[:1] in ("-", "*", "•") for line in t["lines"]),
    "n_open_lines": lambda t: sum(line.rstrip(" \t\r").endswith(("...", "…")) for line in t["lines"]),
}
NEEDS = {name: () for name in ("words", "lines", "n_symbols")} | dict.fromkeys(
    ("n_words", "word_chars", "longest_word", "n_repeat_words", "n_letter_words", "n_upper_words"), ("words",)) | dict.fromkeys(
    ("n_lines", "n_dup_lines", "n_bullet_lines", "n_open_lines"), ("lines",))


@dataclass(frozen=True)
class Rule:
    """``passes`` gets the values of ``needs``."""

    name: str
    needs: tuple[str, ...]
    passes: Callable[..., bool]


RULES = (
    Rule("words", ("n_words",), lambda n: n >= 10),
    Rule("word_length", ("n_words", "word_chars"), lambda n, chars: 3 * n <= chars <= 10 * n),
    Rule("longest_word", ("longest_word",), lambda chars: chars <= 1000),
    Rule("symbols", ("n_symbols", "n_words"), lambda symbols, n: 10 * symbols <= n),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda dup, n: 2 * dup <= n),
    Rule("repeated_words", ("n_repeat_words", "n_words"), lambda rep, n: 100 * rep <= 20 * n),
    Rule("letters", ("n_letter_words", "n_words"), lambda letters, n: 10 * letters >= 6 * n),
    Rule("capitals", ("n_upper_words", "n_words"), lambda upper, n: 10 * upper <= 3 * n),
    Rule("bullets", ("n_bullet_lines", "n_lines"), lambda bullets, n: 10 * bullets <= 9 * n),
    Rule("open_lines", ("n_open_lines", "n_lines"), lambda cut, n: 10 * cut <= 3 * n),
)
#: The two rules that the contract of the query names.
BASE = ("words", "repeated_words")


def fails(rule: Rule, text: Text) -> bool:
    return not rule.passes(*[text[n] for n in rule.needs])


def first_failed(text: Text, rules: Iterable[Rule]) -> tuple[str | None, int]:
    """The first rule that rejects, and how many were asked."""
    asked = 0
    for rule in rules:
        asked += 1
        if fails(rule, text):
            return rule.name, asked
    return None, asked


def closure(names: Iterable[str]) -> set[str]:
    """Measures with all that they need."""
    out: set[str] = set()
    todo = list(names)
    while todo:
        name = todo.pop()
        if name not in out:
            out.add(name)
            todo += NEEDS[name]
    return out


@dataclass(frozen=True)
class Sampled:
    """Seconds a text takes for each measure, and how many texts fail which rules."""

    seconds: dict[str, float]
    failed: dict[frozenset[str], int]


def sampled(docs: DataFrame, rules: Sequence[Rule] = RULES, column: str = "text") -> Sampled:
    total = docs.count()
    share = min(1.0, SAMPLE / max(1, total))
    some = docs.select(F.col(f"`{column}`").alias("text")).sample(share, SEED).limit(SAMPLE)
    names = sorted(closure(n for r in rules for n in r.needs))

    def make():
        def work(texts):
            took, masks = [0.0] * len(names), []
            for value in texts:
                text = Text(value)
                for name in names:
                    if name not in text.took:
                        text.timed(name)
                took = [a + text.took[n] for a, n in zip(took, names, strict=True)]
                masks.append(sum(1 << k for k, r in enumerate(rules) if fails(r, text)))
            found = Counter(masks)
            # One row per pattern; the times stand in the first.
            return list(found), list(found.values()), [took] + [None] * (len(found) - 1) if found else []
        return work

    rows = map_columns(some, ["text"], [("mask", "long"), ("n", "long"), ("took", "array<double>")], make).collect()
    n = sum(r.n for r in rows)
    seconds = {name: sum(r.took[k] for r in rows if r.took) / max(1, n) for k, name in enumerate(names)}
    failed: Counter = Counter()
    for r in rows:
        failed[frozenset(rule.name for k, rule in enumerate(rules) if r.mask >> k & 1)] += r.n
    return Sampled(seconds, dict(failed))


def ordered(rules: Sequence[Rule], sample: Sampled, known: Iterable[str] = ()) -> list[Rule]:
    """Rules by rejection per cost, each given the ones before it; ``known`` measures are
    there anyway and cost nothing."""
    have, alive, left, out = closure(known), dict(sample.failed), list(rules), []
    while left:
        def worth(rule: Rule) -> tuple[float, float, str]:
            rejected = sum(n for failed, n in alive.items() if rule.name in failed)
            cost = sum(sample.seconds.get(n, 0.0) for n in closure(rule.needs) - have) + 1e-7
            return -rejected / cost, cost, rule.name

        best = min(left, key=worth)
        out.append(best)
        left.remove(best)
        have |= closure(best.needs)
        alive = {failed: n for failed, n in alive.items() if best.name not in failed}
    return out


def plan(docs: DataFrame, rules: Sequence[Rule] = RULES, known: Iterable[str] = (), column: str = "text") -> list[Rule]:
    return ordered(rules, sampled(docs, rules, column), known)


def verdicts(docs: DataFrame, keys: Sequence[str] = ("doc_id",), measures: Sequence[str] = (),
             rules: Sequence[Rule] = RULES) -> DataFrame:
    """``keys`` (long columns), ``measures`` of every row, ``rejected_by`` (the first rule
    of the cascade that fails, null if kept) and ``n_asked``, the rules asked until then."""
    cascade = plan(docs, rules, measures)

    def make():
        def work(*columns):
            *held, texts = columns
            out = [[] for _ in measures]
            names, asked = [], []
            for value in texts:
                text = Text(value)
                for column, name in zip(out, measures, strict=True):
                    column.append(text[name])
                name, n = first_failed(text, cascade)
                names.append(name)
                asked.append(n)
            return [*held, *out, names, asked]
        return work

    fields = [(k, "long") for k in keys] + [(m, "long") for m in measures] + [("rejected_by", "string"), ("n_asked", "long")]
    return map_columns(docs, [*keys, "text"], fields, make)


def good_documents(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs``, all columns, that pass every rule."""
    cascade = plan(docs, rules)

    def make():
        return lambda texts: [first_failed(Text(t), cascade)[0] is None for t in texts]

    return keep_rows(docs, "text", make)


MEASURED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judged(docs: DataFrame) -> DataFrame:
    """Per document the five base measures, whether it fails a base rule, and the verdict."""
    found = verdicts(docs, ["doc_id"], MEASURED)
    base_failed = F.expr("n_words < 10 OR 100 * n_repeat_words > 20 * n_words")
    return found.select("doc_id", *MEASURED, base_failed.alias("base_failed"), F.col("rejected_by").isNull().alias("kept"))
