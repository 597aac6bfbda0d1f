"""The ledger of model responses: nothing paid for is asked again."""

import os
from collections import Counter

import pytest
from pyspark.errors import PySparkException
from py4j.protocol import Py4JJavaError

from quizmill.operators import ledger


def requests_of(spark, n, prompt="ask"):
    return spark.createDataFrame([(f"r{k}", k, f"{prompt} {k}") for k in range(n)], "request_id string, n int, prompt string")


def counting(folder, stop_at=None, failing=()):
    """Backend factory that leaves a file for every request it is asked; ``stop_at`` kills the worker."""
    def factory():
        def call(batch, attempt):
            out = []
            for r in batch["request_id"]:
                if r == stop_at:
                    os._exit(1)
                with open(os.path.join(folder, f"{r}-{attempt}-{os.getpid()}-{os.urandom(4).hex()}"), "w"):
                    pass
                out.append(RuntimeError("no") if r in failing else f"reply to {r}")
            return out
        return call
    return factory


def asked(folder):
    return Counter(f.split("-")[0] for f in os.listdir(folder))


def test_a_stopped_run_is_taken_up_where_it_ended(spark, tmp_path):
    where, first, second = str(tmp_path / "ledger"), tmp_path / "first", tmp_path / "second"
    first.mkdir()
    second.mkdir()
    reqs = requests_of(spark, 60)
    with pytest.raises((PySparkException, Py4JJavaError)):
        ledger.ask(reqs, counting(str(first), stop_at="r41"), where, per_task=2).collect()
    recorded = {r.request_id for r in ledger.read_ledger(spark, where).collect()}
    assert 0 < len(recorded) < 60 and "r41" not in recorded and recorded <= set(asked(first))
    got = ledger.ask(reqs, counting(str(second)), where, keep=["n"], per_task=2).collect()
    assert asked(second) == {f"r{k}": 1 for k in range(60) if f"r{k}" not in recorded}
    assert sorted((r.request_id, r.n, r.raw, r.error) for r in got) == sorted((f"r{k}", k, f"reply to r{k}", None) for k in range(60))


def test_a_repeated_run_asks_nothing(spark, tmp_path):
    where, folder = str(tmp_path / "ledger"), tmp_path / "again"
    folder.mkdir()
    reqs = requests_of(spark, 5)
    before = ledger.ask(reqs, counting(str(folder)), where).collect()
    (tmp_path / "none").mkdir()
    after = ledger.ask(reqs, counting(str(tmp_path / "none")), where).collect()
    assert sorted(before) == sorted(after) and asked(tmp_path / "none") == {}


def test_changed_prompts_other_models_and_failures_are_asked_again(spark, tmp_path):
    where = str(tmp_path / "ledger")
    for name in ("a", "b", "c", "d"):
        (tmp_path / name).mkdir()
    got = ledger.ask(requests_of(spark, 4), counting(str(tmp_path / "a"), failing=("r2",)), where, "m1", max_attempts=2).collect()
    assert {r.request_id: (r.attempt_count, r.raw is None) for r in got} == {"r0": (1, False), "r1": (1, False), "r2": (2, True), "r3": (1, False)}
    ledger.ask(requests_of(spark, 4), counting(str(tmp_path / "b")), where, "m1").collect()
    assert asked(tmp_path / "b") == {"r2": 1}
    ledger.ask(requests_of(spark, 4, "other"), counting(str(tmp_path / "c")), where, "m1").collect()
    ledger.ask(requests_of(spark, 4), counting(str(tmp_path / "d")), where, "m2").collect()
    assert len(asked(tmp_path / "c")) == len(asked(tmp_path / "d")) == 4


def test_reasons_and_best_replies(spark):
    rows = spark.createDataFrame([("a", "1", 3, None, "late"), ("a", "1", 1, "good", None), ("a", "1", 2, "better not", None),
                                  ("b", "1", 3, None, "late"), ("c", "0", 1, "old", None)], ledger.LEDGER_SCHEMA)
    best = {r.request_id: (r.raw, r.error) for r in ledger.best_replies(rows).collect()}
    assert best == {"a": ("better not", None), "b": (None, "late"), "c": ("old", None)}
    reqs = spark.createDataFrame([(k, "1") for k in "abcd"], "request_id string, prompt_digest string")
    todo = {r.request_id: r.reason for r in ledger.pending(reqs, ledger.best_replies(rows)).collect()}
    assert todo == {"b": "failed", "c": "changed", "d": "new"}
