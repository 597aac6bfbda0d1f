import random

import pytest

from quizmill.llm.common import components


@pytest.mark.parametrize("shape", ["random", "chain", "stars", "none"])
def test_components_against_union_find(spark, shape):
    r = random.Random(2)
    ids = r.sample(range(1000), 120)
    edges = {"random": [(r.choice(ids), r.choice(ids)) for _ in range(90)], "chain": list(zip(ids, ids[1:])),
             "stars": [(max(x, 7), min(x, 7)) for x in ids] * 2, "none": []}[shape]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = sorted((find(a), find(b)))
            root[q] = p
    want = sorted((x, find(x)) for x in root)
    got = components(spark.createDataFrame(edges, "a long, b long"), "test").collect()
    assert sorted((x.id, x.component) for x in got) == want
