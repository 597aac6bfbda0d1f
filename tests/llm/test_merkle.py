"""Merkle manifest against a plain recursion over hash lists."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from quizmill.llm.merkle import ROW_LIMIT, manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, g string, idx long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, more=0):
    values = [row[0], row[1], row[2], None if row[3] is None else row[3] + more, row[4]]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def proofs(leaves):
    """(root, [(sibling, is_left) or None per level] for each leaf)."""
    paths, level, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for p, i in zip(paths, at):
            p.append((level[i ^ 1], i % 2 == 1) if i ^ 1 < len(level) else None)
        level = [h(*level[i: i + 2]) for i in range(0, len(level), 2)]
        at = [i // 2 for i in at]
    return level[0], paths


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(None if r[2] is None else r[2].encode(), []).append(r)
    keys = sorted(groups, key=lambda k: (k is not None, k or b""))
    made = {}
    for k in keys:
        groups[k].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        made[k] = proofs([leaf_of(r) for r in groups[k]])
    root, over = proofs([made[k][0] for k in keys])
    out = []
    for k, up in zip(keys, over):
        for r, path in zip(groups[k], made[k][1]):
            path = path + up
            touched = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = leaf_of(r, 1 if touched else 0)
            for step in path:
                folded = h(folded) if step is None else h(step[0], folded) if step[1] else h(folded, step[0])
            out.append((r[0], leaf_of(r), made[k][0], root, h(*[s[0] for s in path if s]), folded, folded == root))
    return out


def run(spark, rows, stride):
    docs = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA)
    got = manifest(docs, FIELDS, "lang", "doc_id", {"n_chars": F.expr("cast(n_chars AS decimal(38, 0)) + 1")},
                   F.crc32(F.col("doc_id").cast("string")) % 7 == 0, stride=stride)
    return [tuple(r) for r in got.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()]


def order(rows):
    return sorted(rows, key=repr)


def sample(n, seed):
    draw = random.Random(seed)
    rows = [(i, draw.choice(["a", "b", None]), draw.choice(["en", "en", "en", "de", "", None, "é"]), draw.choice([None, 0, 5, 1 << 62]),
             draw.choice([None, "", "text", "ü" * 50])) for i in draw.sample(range(10 * n), n)]
    return rows + [(None, "a", "en", 3, "no id"), (None, None, None, None, None), rows[0], rows[0], (rows[1][0], "b", rows[1][2], 9, "other")]


@pytest.mark.parametrize("n, stride", [(6, 1), (70, 2), (300, 3), (300, 8)])
def test_against_plain_lists(spark, n, stride):
    rows = sample(n, n + stride)
    assert order(run(spark, rows, stride)) == order(brute(rows))


@pytest.mark.parametrize("rows", [
    [(1, "s", "en", 4, "t")], [(1, "s", "en", 4, "t"), (2, "s", "de", 4, "t")], [(k, "s", "en", 4, "t") for k in range(9)],
    [(5, "s", "en", 4, "t")] * 17])
def test_small_trees(spark, rows):
    assert order(run(spark, rows, 2)) == order(brute(rows))


def test_only_touched_rows_fail(spark):
    rows = [(k, "s", "en", None if k % 5 == 0 else k, "t") for k in range(200)]
    for r in run(spark, rows, 4):
        assert r[-1] == (zlib.crc32(str(r[0]).encode()) % 7 != 0 or r[0] % 5 == 0)


def test_empty_table_and_setting_left_alone(spark):
    before = spark.conf.get(ROW_LIMIT, None)
    assert run(spark, [], 8) == []
    assert spark.conf.get(ROW_LIMIT, None) == before
