"""Small tables with the awkward rows that every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of river stone light carry window seldom bright morning paper cloud table number follow answer garden".split()


def prose(seed: int, n: int) -> str:
    pick = random.Random(seed)
    return " ".join(pick.choice(WORDS) + str(pick.randint(0, 99)) for _ in range(n))


def awkward(spark):
    """Null and empty texts, null keys, ties, repeated rows, a long text."""
    long = prose(1, 4000)
    rows = [
        (1, "One small text. Another sentence!\nA second line", "en", "b", 47),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, "   \t\n ", "en", "a", 6),
        (5, long, "de", "b", len(long)),
        (5, long, "de", "b", len(long)),
        (6, long, None, None, len(long)),
        (7, "12345 --- !!!", "en", "c", 13),
        (7, "same id, other text", "en", "c", 19),
        (None, "no id at all", "fr", "a", 12),
        (9, "ünïcödé 中文 🙂 é", "fr", "", 15),
    ]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def clashing(df, *names):
    """``df`` with extra columns whose names operators might use themselves."""
    from pyspark.sql import functions as F
    for name in names:
        df = df.withColumn(name, F.lit("kept"))
    return df
