import itertools
import math

import numpy as np
import pytest

from quizmill.llm.lattice import NEAR, e8, hit_rate, op6_e8_lattice_near_dedup, vector_links


def brute(rows, cosine=0.93):
    good = [v is not None and i is not None and label is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v) for i, v, label in rows]
    n = [0] * len(rows)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(range(len(rows)), 2):
        if good[a] and good[b] and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
            x, y = np.array(rows[a][1], float), np.array(rows[b][1], float)
            if x @ y / (np.linalg.norm(x) * np.linalg.norm(y)) >= cosine:
                n[a] += 1
                n[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None and good[k]:
            least[find(k)] = min(i, least.get(find(k), i))
    out = [(i, n[k], least[find(k)] if good[k] else i) for k, (i, _, _) in enumerate(rows)]
    return sorted([(i, m, c, i is None or i == c) for i, m, c in out], key=str)


def some_vectors(seed, dim):
    r = np.random.default_rng(seed)
    rows = []
    for f in range(40):
        base = r.normal(size=dim)
        for _ in range(int(r.choice([1, 2, 6, 30]))):
            v = base + r.normal(size=dim) * r.choice([0, 0.05, 0.25, 0.35])
            rows.append((len(rows) + 5, [float(np.float32(x)) for x in v * r.choice([1, 3])], int(r.integers(0, 2)) if f % 3 else 1))
    v = rows[0][1]
    odd = [(900, None, 1), (901, [0.0] * dim, 1), (902, [float("nan")] + v[1:], 1), (903, [None] + v[1:], 1), (904, v, None), (None, v, 1), (905, [], 1), (906, v[:5], 1),
           (907, [2 * x for x in v[:5]], 1), (908, v, 1), (909, v, 1), (5, rows[3][1], 1), (910, [float("inf")] + v[1:], 1)]
    return rows + odd


@pytest.mark.parametrize("seed, dim, block", [(1, 64, 2048), (2, 24, 16)])
def test_against_brute_force(spark, tmp_path, seed, dim, block):
    rows = some_vectors(seed, dim)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((tuple(r) for r in vector_links(frame, block=block).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert op6_e8_lattice_near_dedup(spark, str(tmp_path)).count() == 0


def test_e8_decodes_to_the_nearest_point():
    r = np.random.default_rng(0)
    x = r.normal(size=(300, 8)) * 3
    p = e8(x)
    half = p * 2
    assert (half == np.rint(half)).all() and ((half % 2).sum(axis=1) % 8 == 0).all() and (p.sum(axis=1) % 2 == 0).all()
    own = ((x - p) ** 2).sum(axis=1)
    assert NEAR.shape == (240, 8) and all((own <= ((x - p - v) ** 2).sum(axis=1) + 1e-9).all() for v in NEAR)
    assert hit_rate(64, 1) > 0.8
