import random
import re

import numpy as np
import pytest

from quizmill.llm.chosen_path import classes, keep_one, op7_chosen_path_near_dedup
from quizmill.llm.shingles import shingle_sets


def sets_of(text, width):
    w = [x for x in re.split("[\x20\t-\r]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if x]
    return {tuple(w[k:k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute(docs, width, percent):
    sets = [(d, sets_of(t, width)) for d, t in docs]
    root = {d: d for d, _ in docs if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted(((d, len(s), (find(d) if s else d) if d is not None else None) for d, s in sets), key=str)


def some_docs(seed, families=8, common=""):
    r = random.Random(seed)
    vocab = [f"{a}{b}" for a in "abcdefgé" for b in "XYzwuv "]
    text = lambda n: [r.choice(vocab) for _ in range(n)]
    docs = []
    for _ in range(families):
        base = text(r.choice([4, 30, 80, 200]))
        for _ in range(r.choice([1, 2, 5, 30])):
            w = list(base)
            for _ in range(r.randint(0, 5)):
                w[r.randrange(len(w))] = r.choice(vocab)
            docs.append(r.choice([" ", "\n", " \t"]).join(w) + common)
    docs += ["", None, "   \n", "one", "ONE two", "one TWO", "one"] + [" ".join(text(40)) + common for _ in range(40)]
    r.shuffle(docs)
    return [(3 * k + 1, t) for k, t in enumerate(docs)] + [(None, docs[0]), (1, docs[5]), (4, docs[1])]


@pytest.mark.parametrize("seed, limits", [(1, {}), (2, {"small": 4, "depth": 1, "block": 7})])
def test_against_brute_force(spark, seed, limits):
    docs = some_docs(seed, common=" a very common line of words ends every text" if seed > 1 else "")
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'q' as n", "1 as sig")
    got = classes(frame, 3, 85, **limits).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(docs, 3, 85)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_stage_keeps_one_of_each_group(spark):
    docs = some_docs(5)
    frame = spark.createDataFrame([(d, t, "x", k) for k, (d, t) in enumerate(docs)], "doc_id long, text string, component_id string, kept int")
    want = {d for d, _, c in brute(docs, 5, 80) if d == c or d is None}
    got = keep_one(frame)
    assert {r.doc_id for r in got.collect()} == want and got.columns == frame.columns
    assert keep_one(frame.limit(0)).count() == 0


def test_query(spark, tmp_path):
    docs = some_docs(7)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op7_chosen_path_near_dedup(spark, str(tmp_path)).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute(docs, 3, 85)


def test_long_texts_have_the_same_sets():
    r = random.Random(1)
    words = [r.choice("abcdefgh") * r.randint(1, 9) for _ in range(400_000)]
    text = " ".join(words)
    a, b = shingle_sets(["x", text, " ".join(words[:1000])], 3)[1:]
    assert len(a) == len(sets_of(text, 3)) and np.isin(b, a).all()
