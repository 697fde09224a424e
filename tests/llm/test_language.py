from __future__ import annotations

import math
import random

import numpy as np
from helpers import DOCS, awkward, clashing, empty

from martloom.llm import language


def plain_lengths(training, text):
    """PPM by definition: method C, frozen counts, no exclusion."""
    out = []
    for texts in training:
        counts = {}
        for t in texts:
            data = language.PAD + language.as_bytes(t)
            for i in range(language.ORDER, len(data)):
                for k in range(language.ORDER + 1):
                    counts.setdefault(data[i - k:i], {}).setdefault(data[i], 0)
                    counts[data[i - k:i]][data[i]] += 1
        data, bits = language.PAD + language.as_bytes(text), 0.0
        for i in range(language.ORDER, len(data)):
            for k in range(language.ORDER, -2, -1):
                if k < 0:
                    bits += 8
                    break
                here = counts.get(data[i - k:i])
                if here is None:
                    continue
                n, q = sum(here.values()), len(here)
                if data[i] in here:
                    bits -= math.log2(here[data[i]] / (n + q))
                    break
                bits -= math.log2(q / (n + q))
        out.append(bits)
    return out


def trees(training):
    lang, gram = [], []
    for i, texts in enumerate(training):
        for t in texts:
            g = language.grams(language.as_bytes(t))
            gram.append(g)
            lang.append(np.full(len(g), i))
    lang, gram = np.concatenate(lang), np.concatenate(gram)
    keys, count = np.unique(np.stack([lang, gram]), axis=1, return_counts=True)
    return language.build([f"l{i}" for i in range(len(training))], keys[0], keys[1], count, 10 ** 6)


def test_code_lengths_are_exact(monkeypatch):
    pick = random.Random(1)
    training = [["".join(pick.choice(a) for _ in range(300)) for _ in range(3)] for a in ("abcab ", "xyzzy é", "mnopa")]
    # Contexts met once are pruned in production; here each text is doubled so that none is.
    training = [texts * 2 for texts in training]
    built = trees(training)
    for text in ("abcab xy", "é", "zzz qqq", "m" * 50, "abc" * 100 + "xyz" * 100):
        assert np.allclose(built.lengths(language.as_bytes(text)), plain_lengths(training, text), atol=1e-2)
    monkeypatch.setattr(language, "BLOCK", 7)
    assert np.allclose(built.lengths(b"abc" * 20), plain_lengths(training, "abc" * 20), atol=1e-2)


def corpus(spark, n=400):
    pick = random.Random(4)
    stems = {"en": ["the", "ing", "with", "er"], "de": ["sch", "ung", "der", "ß"], "fr": ["eau", "que", "é", "les"]}
    rows = []
    for i in range(n):
        lang = pick.choice(list(stems))
        text = " ".join("".join(pick.choice(stems[lang]) for _ in range(pick.randint(1, 3))) for _ in range(30))
        rows.append((i, text, lang if i % 5 else None, "a", len(text)))
    return spark.createDataFrame(rows, DOCS)


def test_held_out_accuracy(spark):
    docs = corpus(spark)
    out = {r.doc_id: r for r in language.predictions(docs, language.train(docs)).collect()}
    known = [r for r in docs.collect() if r.lang and out[r.doc_id].held_out]
    assert len(out) == 400 and len(known) > 60
    assert sum(out[r.doc_id].lang_pred == r.lang for r in known) >= 0.98 * len(known)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_inputs_are_the_text_alone(spark):
    docs = corpus(spark)
    model = language.train(docs)
    from pyspark.sql import functions as F
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit("y")})
    assert sorted(map(tuple, language.predictions(docs, model).collect())) == \
        sorted(map(tuple, language.predictions(other, model).collect()))
    held = docs.withColumn("text", F.when(F.expr(language.HELD_OUT), "zzz").otherwise(F.col("text")))
    assert np.array_equal(language.train(held).bits, model.bits)


def test_awkward_rows(spark):
    docs = clashing(awkward(spark), "score", "held_out")
    out = language.predictions(docs, language.train(corpus(spark))).collect()
    assert len(out) == 11
    for row, given in ((r, g) for r in out for g in docs.collect() if r.doc_id == g.doc_id and r.doc_id in (2, 3, 4)):
        assert (row.lang_pred, row.score) == ("und", 0.0)
    assert language.predictions(empty(spark), language.train(corpus(spark))).count() == 0
    nothing = language.train(empty(spark))
    assert {r.lang_pred for r in language.predictions(docs, nothing).collect()} == {"und"}


def test_many_languages_and_a_rare_one_keep_all_their_contexts(spark):
    """Each language is the same letters in an order of its own; the rare one has one text."""
    pick = random.Random(30)
    rows, held = [], []
    words = {n: ["".join(pick.sample("abcdefghij", 5)) for _ in range(6)] for n in range(60)}
    number = 0
    for n, own in words.items():
        for _ in range(1 if n == 59 else 6):
            number += 1
            while language_held_out(number):
                number += 1
            rows.append((number, " ".join(pick.choice(own) for _ in range(12 if n == 59 else 60)), f"l{n:02}", "a", 0))
        held.append((" ".join(pick.choice(own) for _ in range(20)), f"l{n:02}"))
    model = language.train(spark.createDataFrame(rows, DOCS))
    training = [[t for _, t, x, _, _ in rows if x == name] for name in model.langs]
    for text, _ in held[::20]:
        assert np.allclose(model.lengths(language.as_bytes(text)), plain_lengths(training, text), atol=1e-2)
    assert [model.predict(t)[0] for t, _ in held] == [name for _, name in held]


def language_held_out(doc_id):
    import zlib
    return zlib.crc32(str(doc_id).encode()) % 3 == 1
