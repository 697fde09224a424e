"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts up to ``ORDER`` bytes. A byte's code length in
its longest known context is that of its share there; a byte not seen there costs the
escape (method C: as many escapes as different bytes were seen) and is coded in the next
shorter context, at last as one of 256. Statistics are frozen after training, so the
length of a byte depends on its last few bytes only. The trees are sparse: of each order,
sorted arrays of the contexts and bytes that were seen, with the languages that saw them
and their code lengths; equal runs of bytes are looked up once. A text goes to the language that codes all of its bytes in the fewest
bits; the score is that language's share of 2^-bits.

Training takes at most ``MAX_DOCS`` documents a language, chosen by a hash of the id, and
keeps every context of them, whatever the number of languages.

Defined results: null, or no letter: ``und`` with score 0; equal code lengths: the first
language by code point; no language to learn from: ``und`` for all; an empty table gives
an empty table. Upper case is read as lower case.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.rows import HELD_OUT, map_columns

ORDER, MAX_DOCS, SEED = 3, 500, 1
PAD = b"\n" * ORDER
#: Bytes scored at once.
BLOCK = 1 << 19


def as_bytes(text: str | None) -> bytes:
    return (text or "").lower().encode()


def grams(data: bytes) -> np.ndarray:
    """Every byte of ``data`` with the ``ORDER`` bytes before it, as one number."""
    codes = np.frombuffer(PAD + data, dtype=np.uint8).astype(np.int64)
    out = np.zeros(len(data), dtype=np.int64)
    for k in range(ORDER + 1):
        out = out << 8 | codes[k:k + len(data)]
    return out


@dataclass
class Sparse:
    """Values by (run of bytes, language): those of ``keys[i]`` are at ``starts[i]`` to
    ``starts[i + 1]``."""
    keys: np.ndarray
    starts: np.ndarray
    lang: np.ndarray
    bits: np.ndarray

    def of(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row of ``asked``, language and value of each entry."""
        at = np.minimum(np.searchsorted(self.keys, asked), max(0, len(self.keys) - 1))
        row = np.flatnonzero(self.keys[at] == asked) if len(self.keys) else np.zeros(0, dtype=np.int64)
        first = self.starts[at[row]]
        size = self.starts[at[row] + 1] - first
        entry = np.arange(size.sum()) + np.repeat(first - (size.cumsum() - size), size)
        return np.repeat(row, size), self.lang[entry], self.bits[entry]


def sparse(key: np.ndarray, lang: np.ndarray, bits: np.ndarray) -> Sparse:
    """From entries sorted by key, then language."""
    keys, starts = np.unique(key, return_index=True)
    return Sparse(keys, np.append(starts, len(key)), lang.astype(np.int32), bits.astype(np.float32))


@dataclass
class Trees:
    """By order: bits of an escape from a context, and of a byte in a context."""
    langs: list[str]
    escapes: list[Sparse]
    direct: list[Sparse]

    @property
    def bits(self) -> np.ndarray:
        return np.concatenate([t.bits for t in (*self.escapes, *self.direct)])

    def costs(self, gram: np.ndarray) -> np.ndarray:
        """Bits of each gram's last byte, by language."""
        out = np.full((len(gram), len(self.langs)), 8.0)
        for order, (escapes, direct) in enumerate(zip(self.escapes, self.direct, strict=True)):
            key = gram & (1 << 8 * (order + 1)) - 1
            row, lang, bits = escapes.of(key >> 8)
            out[row, lang] += bits
            row, lang, bits = direct.of(key)
            out[row, lang] = bits
        return out

    def lengths_of(self, texts: list[bytes]) -> np.ndarray:
        """Bits by text and language."""
        total = np.zeros((len(texts), len(self.langs)))
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
        every = np.concatenate([np.zeros(0, dtype=np.int64), *map(grams, texts)])
        # A block's table of costs stays small with many languages too.
        step = max(1, BLOCK * 8 // max(8, len(self.langs)))
        for at in range(0, len(every), step):
            runs, which = np.unique(every[at:at + step], return_inverse=True)
            costs, own = self.costs(runs), owner[at:at + step]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            for n in range(len(self.langs)):
                total[own[first], n] += np.add.reduceat(costs[which, n], first)
        return total

    def lengths(self, data: bytes) -> np.ndarray:
        """Bits by language."""
        return self.lengths_of([data])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        read = [i for i, t in enumerate(texts) if self.langs and t and any(map(str.isalpha, t))]
        out = [("und", 0.0)] * len(texts)
        if read:
            for i, bits in zip(read, self.lengths_of([as_bytes(texts[i]) for i in read]), strict=True):
                least = int(bits.argmin())
                out[i] = self.langs[least], float(1 / np.exp2(bits[least] - bits).sum())
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]


def build(langs: list[str], lang: np.ndarray, gram: np.ndarray, count: np.ndarray, max_contexts: int | None = None) -> Trees:
    """Trees from counts of (language number, bytes of context and next byte). More than
    ``max_contexts`` contexts, if given, are refused, never cut."""
    escapes, direct = [], []
    n_langs = max(1, len(langs))
    contexts = 0
    for order in range(ORDER + 1):
        key = gram & (1 << 8 * (order + 1)) - 1
        pair, inverse = np.unique(key * n_langs + lang, return_inverse=True)
        n = np.bincount(inverse, weights=count, minlength=len(pair))
        key, own = pair // n_langs, pair % n_langs
        context, inverse = np.unique((key >> 8) * n_langs + own, return_inverse=True)
        total = np.bincount(inverse, weights=n, minlength=len(context))
        different = np.bincount(inverse, minlength=len(context))
        direct.append(sparse(key, own, np.log2((total + different)[inverse]) - np.log2(n)))
        escapes.append(sparse(context // n_langs, context % n_langs, np.log2(total + different) - np.log2(different)))
        contexts += len(context)
    if max_contexts is not None and contexts > max_contexts:
        raise ValueError(f"{contexts} contexts, but at most {max_contexts} were asked for")
    return Trees(langs, escapes, direct)


def train(docs: DataFrame, max_docs: int = MAX_DOCS) -> Trees:
    """Learns from rows with a language that are not held out. ``docs`` has doc_id,
    text, lang. The driver gets one row per language and the counted contexts of the
    bounded sample."""
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").filter(
        f"lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL AND NOT ({HELD_OUT})")
    sizes = {r[0]: r[1] for r in known.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    if not langs:
        return build([], *[np.zeros(0, dtype=np.int64)] * 3)
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1.0, max_docs / sizes[x]))) for x in langs])
    number = F.coalesce(*[F.when(F.col("lang") == x, F.lit(i)) for i, x in enumerate(langs)])
    unit = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = known.filter(unit < share).select(number.cast("long").alias("lang"), "text")

    def make():
        def work(numbers, texts):
            found: dict[int, list[np.ndarray]] = {}
            for n, t in zip(numbers, texts, strict=True):
                found.setdefault(n, []).append(grams(as_bytes(t)))
            out = [(n, *np.unique(np.concatenate(g), return_counts=True)) for n, g in found.items()]
            return ([n for n, keys, _ in out for _ in keys], [k for _, keys, _ in out for k in keys.tolist()],
                    [c for _, _, counts in out for c in counts.tolist()])
        return work

    counted = (map_columns(sample, ["lang", "text"], [("lang", "long"), ("gram", "long"), ("n", "long")], make)
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # As Arrow: rows as Python objects would take many times the memory.
    table = counted.toArrow()
    return build(langs, *[table[c].to_numpy().astype(np.int64) for c in ("lang", "gram", "n")])


def predictions(docs: DataFrame, trees: Trees) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def make():
        model = shared.value

        def work(ids, texts):
            out = model.predict_all(texts)
            return ids, [x for x, _ in out], [s for _, s in out]
        return work

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    found = map_columns(keyed, ["doc_id", "text"], [("doc_id", "long"), ("lang_pred", "string"), ("score", "double")], make)
    return found.select("doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "lang_pred", "score")
