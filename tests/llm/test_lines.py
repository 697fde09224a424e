from __future__ import annotations

import random

from helpers import DOCS, awkward, clashing, empty, prose

from martloom.llm import lines


def plain_deleted(texts, least=50):
    """By definition: a line goes if it lies in a run of ``least`` words or more that an
    earlier place holds too. Texts are in order."""
    rows = [[x.strip() for x in t.split("\n")] for t in texts]
    out = [set() for _ in rows]
    for d, own in enumerate(rows):
        for e in range(d + 1):
            for shift in range(-len(own) + 1, len(rows[e])):
                if e == d and shift >= 0:
                    continue
                run = []
                for i in range(len(own) + 1):
                    if i < len(own) and 0 <= i + shift < len(rows[e]) and own[i] == rows[e][i + shift]:
                        run.append(i)
                        continue
                    if sum(len(own[k].split()) for k in run) >= least:
                        out[d] |= set(run)
                    run = []
    return out


def corpus(seed, n=25):
    pick = random.Random(seed)
    pool = [prose(i, pick.randint(0, 40)) for i in range(30)]
    blocks = [[pick.choice(pool) for _ in range(pick.randint(1, 6))] for _ in range(8)]
    texts = []
    for i in range(n):
        parts = [prose(1000 * seed + 10 * i, 9)]
        for _ in range(pick.randint(0, 4)):
            parts += pick.choice(blocks)
            if pick.random() < 0.5:
                parts.append(prose(pick.randint(0, 10 ** 6), 12))
        texts.append("\n".join(parts))
    return texts


def test_a_repeated_run_has_common_fingerprints_that_cover_it():
    for seed in range(60):
        pick = random.Random(seed)
        shared = [(pick.getrandbits(60), pick.randint(0, 30)) for _ in range(6)]
        if sum(w for _, w in shared) < 50:
            continue
        found = []
        for _ in range(2):
            own = [(pick.getrandbits(60), pick.randint(0, 30)) for _ in range(pick.randint(0, 5))] + shared
            own += [(pick.getrandbits(60), pick.randint(0, 30)) for _ in range(pick.randint(0, 5))]
            hashes = [h for h, _ in own]
            prints = lines.fingerprints(hashes, [w for _, w in own])
            found.append({(hashes[p], window) for p, windows in prints.items() for window in windows})
        assert {h for h, _ in found[0] & found[1]} & {h for h, _ in shared}


def test_fewer_fingerprints_than_lines_each_the_least_of_a_window():
    pick = random.Random(3)
    hashes, words = [pick.getrandbits(60) for _ in range(2000)], [pick.randint(5, 25) for _ in range(2000)]
    places = lines.fingerprints(hashes, words)
    least = {min(range(s, e), key=hashes.__getitem__) for s in range(2000) for e in [next(
        (e for e in range(s + 1, 2001) if sum(words[s:e]) >= 50), None)] if e}
    assert least <= set(places) and len(places) < 0.8 * len(hashes)


def test_a_common_line_hides_no_run(spark):
    """All runs share the line of least hash, and the first document with it has another run."""
    pool = sorted((prose(i, 20) for i in range(12)), key=lambda x: lines.line_hashes(x)[0][0])
    common, rest = pool[0], pool[1:]
    first, second = [rest[0], common, rest[1]], [rest[2], common, rest[3]]
    texts = [[common, rest[4]], first, second, [rest[5], *second], [*first, rest[6]], [rest[7], common]]
    docs = spark.createDataFrame([(i, "\n".join(t), "en", "a", 0) for i, t in enumerate(texts)], DOCS)
    runs = {r.doc_id: {i for a, b in r.runs for i in range(a, b)} for r in lines.repeated_runs(docs).collect()}
    assert runs == {3: {1, 2, 3}, 4: {0, 1, 2}}


def test_deleted_lines(spark):
    for seed in range(3):
        texts = corpus(seed)
        docs = spark.createDataFrame([(i, t, "en", "a", len(t)) for i, t in enumerate(texts)], DOCS)
        runs = {r.doc_id: {i for a, b in r.runs for i in range(a, b)} for r in lines.repeated_runs(docs).collect()}
        got = [runs.get(i, set()) for i in range(len(texts))]
        want = plain_deleted(texts)
        assert got == want
        assert sum(map(len, want)) > 20


def test_first_of_each_stays_and_texts_change(spark):
    block = "\n".join(prose(i, 20) for i in range(4))
    docs = clashing(spark.createDataFrame(
        [(2, f"start\n{block}\nend", "en", "a", 0), (1, block, "en", "a", 0), (3, "own\n" + block.split("\n")[0], "en", "a", 0)], DOCS),
        "runs", "key", "hashes")
    out = {r.doc_id: r for r in lines.dedup_lines(docs).collect()}
    assert lines.dedup_lines(docs).columns == docs.columns
    assert out[1].text == block and out[1].n_chars == len(block)
    assert out[2].text == "start\nend" and out[2].n_chars == 9 and out[2].runs == "kept"
    assert out[3].text == "own\n" + block.split("\n")[0]  # 20 words: too short a run


def test_repeats_inside_one_text(spark):
    line = prose(4, 60)
    docs = spark.createDataFrame([(1, "\n".join([line] * 5 + ["x"]), "en", "a", 0)], DOCS)
    assert lines.dedup_lines(docs).first().text == line + "\nx"


def test_awkward_rows(spark):
    out = lines.dedup_lines(awkward(spark)).collect()
    assert len(out) == 11
    by_id = {}
    for row in out:
        by_id.setdefault(row.doc_id, []).append(row.text)
    assert by_id[2] == [None] and by_id[3] == [""] and by_id[6] == [""]
    assert len(set(by_id[5])) == 1 and by_id[5][0] != ""  # rows equal in id and text share a decision
    assert lines.dedup_lines(empty(spark)).count() == 0
    summary = lines.summary(awkward(spark)).collect()
    assert sum(r.n_deleted for r in summary) == 1 and len(summary) == 11
