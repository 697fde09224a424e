from __future__ import annotations

import itertools
import os
import random
import re
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
import tiktoken
from helpers import DOCS, awkward, clashing, empty, prose

from martloom.llm import bpe

LABELS = "doc_id long, quality int, toxic int"
SF = "/root/testdata/sf0.001"


def test_stages_keep_columns_and_take_awkward_tables(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (awkward(spark), empty(spark)):
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            path = f"{tmp_path}/{name}-{docs.count()}"
            out.write.parquet(path)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            docs = spark.read.parquet(path)


def test_stage_finds_edited_copies_near_the_least_similarity(spark):
    """Six of 400 words edited, and a large group of near copies that all differ."""
    pick = random.Random(21)
    rows, base = [], [prose(70 + g, 400).split() for g in range(8)]
    for g, words in enumerate(base):
        for c in range(4 if g else 60):
            edited = list(words)
            for at in pick.sample(range(400), 6 if c and g else 3 if c else 0):
                edited[at] = f"edit{c}x{at}"
            rows.append((1000 * g + c, " ".join(edited)))
    docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in rows], DOCS)
    stage = dict(corpus_pipeline.STAGES)["near_dedup"]
    kept = {r.doc_id for r in stage(spark, docs, SF).collect()}
    assert {1000 * g for g in range(8)} <= kept and len(kept) <= 8 + 5


def test_run(spark):
    with open(public_tokenizers.path(corpus_pipeline.VOCABULARY), "rb") as file:
        ranks = bpe.read_ranks(file.read())
    public = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = corpus_pipeline.run(spark, SF)
    rows = out.collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert rows and all(r.intact and len(r.ids) == r.n_tokens for r in rows)
    # A text that lost no line is encoded whole.
    assert sum(public.encode_ordinary(docs[r.doc_id].text) == list(r.ids) for r in rows) > 0.8 * len(rows)


@pytest.mark.parametrize("name", ["op1_", "op2_", "op3_", "op4_", "op5_", "op6_", "op7_", "op8_", "op9_", "op10_", "op11_", "op12_", "op13_", "pipeline"])
def test_registered(name):
    import __spark_entry__
    assert sum(q.startswith(name) for q in __spark_entry__.queries()) == 1


def test_stages_keep_clashing_columns(spark, tmp_path):
    spark.createDataFrame([(1, 1, 0)], LABELS).write.parquet(str(tmp_path / "labels.parquet"))
    docs = clashing(awkward(spark), "own_id", "own_hash", "row", "runs", "copies", "rank", "size", "label", "score", "key")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/after_{name}")
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
        docs = spark.read.parquet(f"{tmp_path}/after_{name}")
    assert docs.count() > 0


def test_near_dedup_recall_against_brute_force(spark):
    """Of all pairs of different texts with a similarity of 0.8 or more on five words, at
    least 0.9 are not both kept."""
    path = "/root/testdata/sf0.1/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("test data not there")
    docs = spark.read.parquet(path)
    sets, holders = {}, {}
    for r in docs.select("doc_id", "text").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r.text or ""))
        own = frozenset(" ".join(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()
        sets[r.doc_id] = own
        for s in own:
            holders.setdefault(s, []).append(r.doc_id)
    common = Counter()
    for ids in holders.values():
        if len(ids) <= 50:  # a pair of the asked similarity shares rarer shingles as well
            common.update(itertools.combinations(ids, 2))
    pairs = [(a, b) for (a, b) in common if sets[a] != sets[b]
             and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    kept = {r.doc_id for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SF).collect()}
    missed = [p for p in pairs if p[0] in kept and p[1] in kept]
    print("near pairs", len(pairs), "missed", len(missed))
    assert len(pairs) > 30 and len(missed) <= 0.1 * len(pairs)
