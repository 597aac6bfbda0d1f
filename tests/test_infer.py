"""Batch model calls: retries, errors as data, idempotent ids (K1-K5)."""

import json

import pandas as pd

import fakes
from quizmill.operators import infer


def test_retries_and_failures(spark):
    reqs = spark.createDataFrame([(f"r{i}", i, "Q", "remember") for i in range(6)],
                                 "request_id string, n int, question string, bloom string")

    def fails(b: pd.DataFrame) -> pd.Series:
        return b["n"].map({0: 0, 1: 1, 2: 2, 3: 3, 4: 9, 5: 0})

    res = {r["request_id"]: r for r in infer.run_requests(reqs, fakes.flaky(fakes.template_backend, fails),
                                                          validator=infer.json_validator).collect()}
    assert [res[f"r{i}"]["attempt_count"] for i in range(6)] == [1, 2, 3, 3, 3, 1]
    assert res["r2"]["error"] is None and len(json.loads(res["r2"]["raw"])) == 5
    assert res["r3"]["error"].startswith("RuntimeError") and res["r3"]["raw"] is None


def test_validator_failure_is_retried(spark):
    reqs = spark.createDataFrame([("a",)], "request_id string")

    def factory():
        return lambda batch, attempt: ["not json" if attempt < 3 else "[1]" for _ in range(len(batch))]
    r = infer.run_requests(reqs, factory, validator=infer.json_validator).first()
    assert r["attempt_count"] == 3 and r["error"] is None and r["raw"] == "[1]"


def test_raising_backend_and_short_replies_are_data(spark):
    reqs = spark.createDataFrame([(f"r{k}",) for k in range(5)], "request_id string")

    def broken():
        def call(batch, attempt):
            raise OSError("down")
        return call
    got = infer.run_requests(reqs, broken, per_task=2).collect()
    assert len(got) == 5 and all(r["error"] == "OSError: down" and r["attempt_count"] == 3 and r["raw"] is None for r in got)

    def short():
        return lambda batch, attempt: ["x"] * (len(batch) - 1)
    got = infer.run_requests(reqs, short, partitions=1, max_attempts=2).collect()
    assert sorted(r["raw"] or "" for r in got) == ["", "x", "x", "x", "x"]
    assert [r["error"] for r in got if r["raw"] is None] == ["RuntimeError: no reply"]


def test_extractive_section_shape():
    doc = json.loads(fakes.extractive_section("MCQs", "T", "Alpha beta gamma. Delta epsilon! Zeta eta theta?", 2))
    groups = doc["MCQs"]
    assert [g["bloom_taxonomy"] for g in groups] == ["remember", "understand", "apply", "analyze", "evaluate", "create"]
    q = groups[0]["questions"][0]
    assert len(q["options"]) == 4 and q["answer"] in q["options"] and "_____" in q["question"]
    infer.section_validator("MCQs")(json.dumps(doc))
