import hashlib
import random

import numpy as np
import pytest

from quizmill.llm import near_nodes, paragraph_dedup
from quizmill.llm.paragraph_dedup import op9_banded_paragraph_dedup, tuned, without_repeats
from quizmill.llm.shingles import least_agreement
from test_chosen_path import sets_of


def brute(docs, least_words=10):
    places = []
    for d, t in sorted(set(docs), key=lambda x: (x[0] is not None, x[0] or 0)):
        for k, line in enumerate((t or "").split("\n")):
            if len(line.encode().split()) >= least_words:
                places.append(((d, t), k, sets_of(line, 5)))
    root = list(range(len(places)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, _, x) in enumerate(places):
        for j in range(i):
            y = places[j][2]
            if 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    gone, repeated = {}, {}
    size = [0] * len(places)
    for i in range(len(places)):
        size[find(i)] += 1
    for i, (key, k, _) in enumerate(places):
        if size[find(i)] > 1:
            repeated[key] = repeated.get(key, 0) + 1
        if find(i) != i:
            gone.setdefault(key, set()).add(k)
    out = []
    for d, t in docs:
        text = t or ""
        skip = gone.get((d, t), set())
        kept = "\n".join(line for k, line in enumerate(text.split("\n")) if k not in skip) if skip else text
        out.append((d, len(text.encode()), len(text.encode()) - len(kept.encode()), len(skip), repeated.get((d, t), 0), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def some_docs(seed):
    r = random.Random(seed)
    vocab = [f"{a}{b}" for a in "abcdefgé" for b in "XYzwuv "]
    line = lambda n: " ".join(r.choice(vocab).strip() for _ in range(n))
    shared = [line(r.choice([12, 40, 70, 120])) for _ in range(12)]

    def near(s):
        w = s.split(" ")
        for _ in range(r.randint(0, 2)):
            w[r.randrange(len(w))] = r.choice(vocab).strip()
        return " ".join(w)

    docs = []
    for d in range(50):
        parts = [near(r.choice(shared)) if r.random() < 0.4 else line(r.choice([3, 9, 15, 60])) for _ in range(r.randint(0, 6))]
        docs.append((d, "\n".join(parts)))
    return docs + [(60, None), (61, ""), (62, "\n\n"), (63, docs[7][1]), (5, docs[5][1]), (None, "\n".join(shared[:2]))]


@pytest.mark.parametrize("seed, limits", [(1, {}), (2, {"small": 3, "depth": 1, "block": 5})])
def test_against_brute_force(spark, seed, limits):
    docs = some_docs(seed)
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 as pos", "'x' as th")
    got = without_repeats(frame, **limits).collect()
    assert sorted(((r.doc_id, r._bytes, r._removed, r._spans, r._repeated, hashlib.sha256(r._kept.encode()).hexdigest()) for r in got), key=str) == brute(docs)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert op9_banded_paragraph_dedup(spark, str(tmp_path)).count() == 0


def test_bands_are_tuned():
    bands, rows = tuned(0.8)
    assert (1 - 0.8**rows) ** bands <= 1e-5 and bands * rows <= 24


def test_paragraphs_are_described_once(spark, monkeypatch):
    """Texts aren't cut into paragraphs a second time for the places; rows that come twice are one document."""
    calls, described = [], paragraph_dedup.described
    monkeypatch.setattr(paragraph_dedup, "described", lambda *a, **k: calls.append(a) or described(*a, **k))
    line = " ".join(f"word{k}" for k in range(30))
    other = " ".join(f"else{k}" for k in range(30))
    docs = [(None, line), (1, line), (1, line), (2, other), (2, other), (3, f"{line}\nend")]
    got = sorted(((r.doc_id, r._kept, r._spans, r._repeated) for r in without_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()), key=str)
    assert len(calls) == 1
    assert got == sorted([(None, line, 0, 1), (1, "", 1, 1), (1, "", 1, 1), (2, other, 0, 0), (2, other, 0, 0), (3, "end", 1, 1)], key=str)


@pytest.mark.parametrize("at_once", [near_nodes.PAIRS, 7])
def test_pairs_in_nodes_against_plain_form(spark, monkeypatch, at_once):
    monkeypatch.setattr(near_nodes, "PAIRS", at_once)
    r = random.Random(4)
    bases = [[r.randrange(1 << 32) for _ in range(24)] for _ in range(6)]
    members = {k: (r.randint(20, 30), [x if r.random() < 0.8 else r.randrange(1 << 32) for x in r.choice(bases)]) for k in range(80)}
    nodes = [r.choices(range(80), k=r.choice([1, 2, 2, 3, 9, 20])) for _ in range(60)]  # an id may be in a node twice
    frame = spark.createDataFrame([([(k, members[k][0], np.array(members[k][1], np.uint32).tobytes()) for k in node],) for node in nodes],
                                  "members array<struct<id: long, n: long, sig: binary>>")
    got = sorted((x.a, x.b) for x in near_nodes._pairs_in_nodes(frame, 80).collect())
    wanted = set()
    for node in nodes:
        for a in node:
            for b in node:
                (n, x), (m, y) = members[a], members[b]
                if a < b and 100 * min(n, m) >= 80 * max(n, m) and sum(p == q for p, q in zip(x, y)) >= least_agreement(0.8, 24):
                    wanted.add((a, b))
    assert got == sorted(wanted) and wanted
