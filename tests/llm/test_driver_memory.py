"""Tables that grow with the input aren't sent whole to the driver, however small Spark takes them to be."""

from quizmill import session
from quizmill.llm import chosen_path, near_nodes
from quizmill.operators import components


def _recorded(monkeypatch, *modules):
    plans = []

    def staged(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return session.staged(df, name)

    for m in modules:
        monkeypatch.setattr(m, "staged", staged)
    return plans


def test_no_join_of_near_copies_is_broadcast(spark, monkeypatch):
    plans = _recorded(monkeypatch, chosen_path, near_nodes, components)
    word = lambda k: f"w{k * 7919 % 104729}"
    rows = [(g * 100 + k, " ".join([*(word(g * 1000 + j) for j in range(60)), word(k)])) for g in range(4) for k in range(8)] + [(7, "a b c d"), (7, "e f g h")]
    out = chosen_path.classes(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85, small=4)
    plans.append(("result", out._jdf.queryExecution().executedPlan().toString()))
    assert {r.component_id for r in out.collect()} == {0, 100, 200, 300}
    assert len(plans) > 12
    for name, plan in plans:
        if not name.startswith("full-sets"):  # meets the texts, by a number of ids that is counted first
            assert "BroadcastHashJoin" not in plan, name


def test_ids_that_meet_texts_are_sent_while_few(spark, monkeypatch):
    ids = spark.range(5)
    meets = lambda: spark.range(9).join(session.sent_if_few(ids), "id", "left_semi")
    assert "BroadcastHashJoin" in meets()._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(session, "SENT_KEYS", 4)
    assert "SortMergeJoin" in meets()._jdf.queryExecution().executedPlan().toString()
    assert meets().count() == 5
