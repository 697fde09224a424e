"""Toxicity by a weighted finite-state grammar over clauses.

Words are read as symbols by a lexical transducer: insults (stems and words, weighted by
what labelled rows show), threats, targets, negations, verbs of reporting, quotation
marks. Three more machines read the symbols: one knows whether a negation lies a few
words back, one whether speech is reported, one whether a target stands near. They are
composed into one machine whose arcs say in which context an insult or threat was met.
Only clauses with such a word are read. The sums of weights by context, on a logarithmic
scale, give the score by a logistic model fitted on labelled rows.

Learning takes at most ``MAX_LABELLED`` labelled rows, chosen by a hash of the id. Lines
are counted once each, so a toxic document with many copies teaches no more than one.
The model for half of the sample's rows is fitted on matches of stems learned from the
other half, so stems that fit by chance are not trusted.

Defined results: a null or empty text, or one without a match, gets the score of the
empty document; without labels the prior weights hold; repeated labels of a document
count each; an empty table gives an empty table.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import HELD_OUT, keep_rows, map_columns, share_below
from martloom.session import stored

MAX_LABELLED, THRESHOLD, SEED = 20_000, 0.7, 9
#: Lengths of stems; least log odds ratio, at 95 % confidence, of a stem; share of a stem's
#: lines that makes an extension stand for it.
STEMS, LEAST_ODDS, Z, SAME = range(3, 8), 2.0, 1.64, 0.95
PRIOR_WEIGHT, SCOPE = 2.0, 4

# Words of the grammar's own vocabulary, whatever the labels show.
INSULTS = ("idiot", "moron", "stupid", "scum", "loser", "trash", "worthless", "pathetic", "disgusting", "dumb",
           "idiota", "imbécil", "basura", "imbécile", "crétin", "ordure", "blödmann", "abschaum", "dummkopf")
THREATS = ("kill", "murder", "hurt", "strangle", "shoot", "töten", "umbringen", "tuer", "matar")
TARGETS = ("you", "your", "yours", "he", "she", "they", "them", "du", "dich", "dir", "ihr", "sie", "tu", "toi", "vous",
           "ils", "tú", "ustedes", "vosotros")
NEGATIONS = ("not", "no", "never", "nobody", "nicht", "kein", "keine", "nie", "ne", "pas", "jamais", "nunca", "jamás")
REPORTS = ("said", "says", "wrote", "called", "quoted", "reported", "sagte", "schrieb", "nannte", "dit", "écrit",
           "appelé", "dijo", "escribió", "llamó")

CONTEXTS = ("plain", "targeted", "negated", "reported", "threat")
PRIOR = np.array([-4.0, 2.0, 2.5, 1.0, 1.0, 2.0])
PRIOR_STRENGTH = np.array([0.01, 0.1, 0.1, 0.1, 0.1, 0.1])

_TOKEN = re.compile(r"[^\W\d_]+|[\"“”«»„]")
_WORD = re.compile(r"[^\W\d_]+")
_BORDER = re.compile(r"[.!?;:\n]")


def _compose() -> dict[tuple, tuple]:
    """(state, symbol) -> (state, context), where a state is what the negation, report
    and target machines hold. Symbols: w word, i insult, h threat, t target, n negation,
    r report, q quotation mark."""
    arcs = {}
    for negation in range(SCOPE + 1):
        for report in range(3):  # 0 none, 1 a verb of reporting, 2 inside quotation marks
            for target in range(SCOPE + 1):
                state = (negation, report, target)
                for symbol in "wihtnrq":
                    to = (SCOPE if symbol == "n" else max(0, negation - 1),
                          {"r": max(report, 1), "q": 0 if report == 2 else 2}.get(symbol, report),
                          SCOPE if symbol == "t" else max(0, target - 1))
                    context = None
                    if symbol in "ih":
                        context = "reported" if report else "negated" if negation else \
                            "threat" if symbol == "h" else "targeted" if target else "plain"
                    arcs[state, symbol] = (to, context)
    return arcs


ARCS = _compose()


@dataclass
class Grammar:
    stems: dict[str, float] = field(default_factory=dict)
    words: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.symbols = {w: s for s, ws in (("t", TARGETS), ("n", NEGATIONS), ("r", REPORTS)) for w in ws}
        self.threats = set(THREATS)
        self.words = {w: PRIOR_WEIGHT for w in INSULTS if w not in self.words} | self.words
        self.lengths = sorted({len(s) for s in self.stems})
        self.finder = ahocorasick.Automaton()
        for entry in {*self.stems, *self.words, *self.threats}:
            self.finder.add_word(entry, len(entry))
        self.finder.make_automaton()

    def symbol(self, word: str) -> tuple[str, float]:
        weight = self.words.get(word, 0.0)
        for n in self.lengths:
            weight = max(weight, self.stems.get(word[:n], 0.0))
        if weight > 0:
            return "i", weight
        if word in self.threats:
            return "h", PRIOR_WEIGHT
        return ("q" if not word.isalpha() else self.symbols.get(word, "w")), 0.0

    def clause(self, text: str) -> Counter:
        """Sum of weights by context. An insult with a target after it is targeted too."""
        sums: Counter = Counter()
        state, waiting = (0, 0, 0), []
        for at, word in enumerate(_TOKEN.findall(text)):
            symbol, weight = self.symbol(word)
            state, context = ARCS[state, symbol]
            if context:
                sums[context] += weight
                if context == "plain":
                    waiting.append((at, weight))
            elif symbol == "t":
                for place, held in waiting:
                    if at - place <= SCOPE:
                        sums["plain"] -= held
                        sums["targeted"] += held
                waiting = []
        return sums

    def features(self, text: str | None) -> list[float]:
        text = (text or "").lower()
        sums: Counter = Counter()
        done = -1
        for end, size in self.finder.iter(text):
            start = end - size + 1
            if start < done or (start and text[start - 1].isalpha()):
                continue
            # ``done`` is the border that ended the clause read last, so the text is read once.
            head = max(0, done)
            for border in _BORDER.finditer(text, head, start):
                head = border.end()
            tail = _BORDER.search(text, end)
            done = tail.start() if tail else len(text)
            sums.update(self.clause(text[head:done]))
        return [math.log1p(max(0.0, sums[c])) for c in CONTEXTS]


def weight(pos: float, neg: float, n_pos: float, n_neg: float, z: float = Z) -> float:
    """Lower confidence bound of the log odds ratio of a stem's lines."""
    ratio = math.log((pos + 0.5) / (n_pos - pos + 0.5)) - math.log((neg + 0.5) / (n_neg - neg + 0.5))
    return ratio - z * math.sqrt(1 / (pos + 0.5) + 1 / (neg + 0.5))


def lexicon(counts: list[tuple[str, int, int]], n_pos: int, n_neg: int, tested: int = 1) -> Grammar:
    """Stems end with ``*`` in ``counts``. What is kept must stand out among all
    ``tested`` stems and words. Of a stem and its extensions the longest that is met as
    often is kept, and none beside a shorter one that says as much."""
    z = max(Z, math.sqrt(2 * math.log(max(1, tested))))
    strong = {g: (p, weight(p, n, n_pos, n_neg)) for g, p, n in counts
              if weight(p, n, n_pos, n_neg, z) > 0 and weight(p, n, n_pos, n_neg) >= LEAST_ODDS}
    replaced = set()
    for gram, (pos, _) in strong.items():
        name = gram.rstrip("*")
        parent = (name[:-1] if gram.endswith("*") else name[:STEMS[-1]]) + "*"
        if parent in strong and pos >= SAME * strong[parent][0]:
            replaced.add(parent)
    stems: dict[str, float] = {}
    words: dict[str, float] = {}
    for gram in sorted(strong.keys() - replaced, key=lambda g: (len(g.rstrip("*")), g)):
        name, value = gram.rstrip("*"), strong[gram][1]
        if value > max((stems.get(name[:n], 0.0) for n in STEMS), default=0.0) + 0.5:
            (stems if gram.endswith("*") else words)[name] = value
    return Grammar(stems, words)


def fit(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic weights nearest the prior ones, by Newton's method."""
    beta = PRIOR.copy()
    x = np.hstack([np.ones((len(x), 1)), x.reshape(len(x), len(CONTEXTS))])
    pull = np.diag(PRIOR_STRENGTH) * max(1.0, math.sqrt(len(x)))
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (y - p) - pull @ (beta - PRIOR)
        curve = (x * (p * (1 - p))[:, None]).T @ x + pull
        step = np.linalg.solve(curve, slope)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return beta


@dataclass
class Model:
    grammar: Grammar
    beta: np.ndarray

    def score(self, text: str | None) -> float:
        return self.of(self.grammar.features(text))

    def of(self, features: list[float]) -> float:
        value = float(self.beta[0] + np.dot(self.beta[1:], features))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, value))))


def _grams(toxic, halves, texts):
    """Stems and words of each distinct line, with its label and half of the sample."""
    for label, half, text in zip(toxic, halves, texts, strict=True):
        for line in (text or "").lower().split("\n"):
            yield label, half, xxhash.xxh64_intdigest(line.encode()) - (1 << 63), line


def train(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> Model:
    """Learns from rows of ``labels`` whose document is not held out. ``docs`` needs
    doc_id and text."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
             .filter(f"toxic IS NOT NULL AND doc_id IS NOT NULL AND NOT ({HELD_OUT})"))
    share = min(1.0, max_labelled / max(1, known.count()))
    texts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .filter(share_below(F.col("doc_id"), share, SEED)).filter(f"NOT ({HELD_OUT})"))
    sample = stored(texts.join(known, "doc_id").select(
        F.col("toxic").cast("long").alias("toxic"), F.pmod(F.xxhash64("doc_id", F.lit(SEED + 1)), F.lit(2)).alias("half"),
        "text"), "toxicity_sample")

    def split_lines():
        def work(toxic, halves, values):
            out = list(_grams(toxic, halves, values))
            return zip(*out, strict=True) if out else ([], [], [], [])
        return work

    fields = [("toxic", "long"), ("half", "long"), ("key", "long"), ("line", "string")]
    lines = (map_columns(sample, ["toxic", "half", "text"], fields, split_lines)
             .groupBy("key").agg(F.max("toxic").alias("toxic"), F.min("half").alias("half"), F.first("line").alias("line")))

    def count_grams():
        def work(toxic, halves, values):
            counts: dict[str, list[int]] = {}
            for label, half, line in zip(toxic, halves, values, strict=True):
                at = 2 * half + (1 - label)
                words = set(_WORD.findall(line))
                for gram in {"", *(w for w in words if len(w) > 2), *(w[:n] + "*" for w in words for n in STEMS if len(w) >= n)}:
                    counts.setdefault(gram, [0, 0, 0, 0])[at] += 1
            return [list(counts), *([c[k] for c in counts.values()] for k in range(4))]
        return work

    sides = ["p0", "n0", "p1", "n1"]
    counted = stored(map_columns(lines, ["toxic", "half", "line"], [("gram", "string"), *[(s, "long") for s in sides]], count_grams)
               .groupBy("gram").agg(*[F.sum(s).alias(s) for s in sides]).filter("gram = '' OR p0 + p1 + n0 + n1 >= 3"), "toxicity_grams")
    tested = counted.count()
    # Bounded by the sample; most stay on the executors.
    rows = [tuple(r) for r in counted.filter("gram = '' OR p0 + p1 >= 3 AND p0 + p1 > n0 + n1").collect()]
    total = next((r[1:] for r in rows if r[0] == ""), (0, 0, 0, 0))
    rows = [r for r in rows if r[0]]
    halves = [lexicon([(g, c[2 * h], c[2 * h + 1]) for g, *c in rows], total[2 * h], total[2 * h + 1], tested) for h in (0, 1)]
    whole = lexicon([(g, c[0] + c[2], c[1] + c[3]) for g, *c in rows], total[0] + total[2], total[1] + total[3], tested)
    entries = [(g.stems, g.words) for g in halves]

    def read():
        grammars = [Grammar(*e) for e in entries]

        def work(toxic, half, values):
            out = [grammars[1 - h].features(t) for h, t in zip(half, values, strict=True)]
            return (toxic, *([row[k] for row in out] for k in range(len(CONTEXTS))))
        return work

    found = map_columns(sample, ["toxic", "half", "text"], [("toxic", "long"), *[(c, "double") for c in CONTEXTS]], read)
    table = np.array([tuple(r) for r in found.collect()], dtype=float).reshape(-1, 1 + len(CONTEXTS))
    return Model(whole, fit(table[:, 1:], table[:, 0]))


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    stems, words, beta = model.grammar.stems, model.grammar.words, model.beta

    def make():
        judge = Model(Grammar(stems, words), beta)
        return lambda ids, texts: (ids, [judge.score(t) for t in texts])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    scored = map_columns(keyed, ["doc_id", "text"], [("doc_id", "long"), ("score", "double")], make)
    return scored.select("doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold``."""
    stems, words, beta = model.grammar.stems, model.grammar.words, model.beta

    def make():
        judge = Model(Grammar(stems, words), beta)
        return lambda texts: [judge.score(t) < threshold for t in texts]

    return keep_rows(docs, "text", make)
