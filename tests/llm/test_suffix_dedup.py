import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from quizmill.llm.suffix_dedup import op3_suffix_interval_dedup, repeated_windows, suffix_order, unresolved, without_repeats


def brute(docs, length):
    raw = [(t or "").encode() for _, t in docs]
    seen = Counter(r[k:k + length] for r in raw for k in range(len(r) - length + 1))
    out = []
    for (d, _), r in zip(docs, raw):
        gone = np.zeros(len(r) + 1, bool)
        for k in range(len(r) - length + 1):
            if seen[r[k:k + length]] > 1:
                gone[k:k + length] = True
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out.append((d, len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def some_docs(seed, scale):
    r = random.Random(seed)
    word = lambda n: "".join(r.choice("abé \n") for _ in range(n))
    shared = [word(r.randint(scale // 2, 4 * scale)) for _ in range(5)]
    docs = []
    for d in range(60):
        parts = [word(r.randint(0, 3 * scale)) if r.random() < 0.6 else r.choice(shared)[r.randint(0, scale):] for _ in range(r.randint(0, 5))]
        docs.append((d, "".join(parts)))
    copies = [(100 + k, docs[3][1]) for k in range(5)]
    edited = [(200 + k, docs[7][1][: 2 * scale] + str(k) + docs[7][1][2 * scale:]) for k in range(12)]
    return docs + copies + edited + [(300, None), (301, ""), (None, docs[5][1]), (302, "a" * (5 * scale)), (303, "ab" * (3 * scale)), (304, "q" * (scale - 1)), (4, docs[4][1])]


@pytest.mark.parametrize("seed, length, gram, limits", [(1, 12, 5, {}), (2, 12, 5, {"bucket_bytes": 2000, "most_segments": 3}), (3, 40, 20, {"bucket_bytes": 5000})])
def test_against_brute_force(spark, seed, length, gram, limits):
    docs = some_docs(seed, length)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = without_repeats(frame.selectExpr("*", "1 as th", "'x' as h"), length, gram, **limits).collect()
    assert sorted(((r.doc_id, r._bytes, r._removed, r._spans, hashlib.sha256(r._kept).hexdigest()) for r in got), key=str) == brute(docs, length)


def test_query(spark, tmp_path):
    docs = some_docs(4, 200)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op3_suffix_interval_dedup(spark, str(tmp_path)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(docs, 200)
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/e/documents.parquet")
    assert op3_suffix_interval_dedup(spark, f"{tmp_path}/e").count() == 0


def test_interval_expansion_gives_common_prefixes():
    r = random.Random(9)
    for _ in range(50):
        text = np.array([r.randint(1, 3) for _ in range(r.randint(1, 200))] + [0], np.int16)
        order = suffix_order(text, 400)
        for length in (1, 3, 9):
            shares = [i for i in range(1, len(text)) if list(text[order[i]:][:length]) == list(text[order[i - 1]:][:length]) and len(text) - max(order[i], order[i - 1]) > length]
            assert [i for i in unresolved(text, order, length) if text[order[i]:][:length].all()] == shares
    assert [h.tolist() for h in repeated_windows([b"abcabc", b"xbca", b"ab"], 3)] == [[True, True, False, True], [False, True], []]
