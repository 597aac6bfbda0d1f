"""Model verdicts: which replies count, which items they name, and the nested report."""

import json

from quizmill.operators import verification

ITEMS = "chapter_id long, topic_pos int, topic string, seq int, qtype string, bloom_ord int"


def reply(quality="good", duplicates=False, topic="t", **lists):
    return json.dumps({"topic": topic, **lists, "overall_quality": quality, "has_duplicates": duplicates})


def entry(index, issues=(), valid=False):
    return {"question_index": index, "is_valid": valid, "issues": [{"issue_type": t, "description": "d", "severity": s} for t, s in issues]}


def requests_of(spark, n):
    return spark.createDataFrame([(f"v{k}", 1 + k // 10, k % 10, f"t{k}") for k in range(n)], "request_id string, chapter_id long, topic_pos int, topic string")


def verdicts(spark, replies):
    rows = [(f"v{k}", r) for k, r in enumerate(replies) if r is not Ellipsis]
    return verification.topic_verdicts(requests_of(spark, len(replies)), spark.createDataFrame(rows, "request_id string, raw string"))


def test_faulty_replies_count_as_poor_without_entries(spark):
    good = [entry(0, [("unclear", "low"), ("duplicate", "high")]), entry(1, valid=True)]
    replies = [reply(mcq_verifications=good, duplicates=True), ..., None, '{"topic": ', reply("fine"), reply(None),
               reply(mcq_verifications=[entry(0, [("typo", "low")])]), reply(long_answer_verifications=[entry(0, [("unclear", "dire")])]),
               reply(mcq_verifications=[{"is_valid": True}]), "```json\n" + reply("fair") + "\n```", json.dumps({"topic": "t", "overall_quality": "good"})]
    got = {r.topic_pos + 10 * (r.chapter_id - 1): r for r in verification.topic_totals(verdicts(spark, replies)).collect()}
    assert [got[k].failure for k in range(11)] == [None, "no_reply", "no_reply", "no_json", "bad_topic", "bad_topic", "bad_entry", "bad_entry",
                                                   "bad_entry", None, "bad_topic"]
    assert (got[0].n_entries, got[0].n_issues, got[0].overall_quality, got[0].has_duplicates) == (2, 2, "good", True)
    assert all((got[k].n_entries, got[k].overall_quality, got[k].has_duplicates) == (0, "poor", False) for k in (1, 2, 3, 4, 5, 6, 7, 8, 10))
    assert got[9].overall_quality == "fair"


def test_entries_meet_their_items(spark):
    items = spark.createDataFrame([(1, 0, "t0", 10 + k, "MCQs", 6 - k) for k in range(3)] + [(1, 0, "t0", 99, "short_answer", 1)], ITEMS)
    replies = [reply(mcq_verifications=[entry(0, [("unclear", "low")]), entry(2), entry(0), entry(7, [("unclear", "low")])],
                     short_answer_verifications=[entry(0, [("incorrect", "critical")])])]
    entries = verification.item_entries(verdicts(spark, replies), items)
    got = [(r.qtype, r.entry_pos, r.question_index, r.seq) for r in entries.orderBy("qtype", "entry_pos").collect()]
    assert got == [("MCQs", 0, 0, 12), ("MCQs", 1, 2, 10), ("MCQs", 2, 0, 12), ("MCQs", 3, 7, None), ("short_answer", 0, 0, 99)]
    issues = {(r.seq, r.rule, r.issue_type, r.severity) for r in verification.entry_issues(entries).collect()}
    assert issues == {(12, "verifier", "unclear", "low"), (99, "verifier", "incorrect", "critical")}


def test_report_nests_topics_in_order(spark):
    replies = [reply("good", mcq_verifications=[entry(0, [("unclear", "low")])]), ..., reply("excellent")] + [reply()] * 7 + [reply("excellent", True), reply()]
    meta = spark.createDataFrame([(1, "c", "s", "one"), (2, "c", "s", "two"), (3, "c", "s", "unasked")],
                                 "chapter_id long, class_name string, subject_name string, chapter_name string")
    got = {r.chapter_id: r for r in verification.chapter_reports(verdicts(spark, replies), meta).collect()}
    assert set(got) == {1, 2}
    assert (got[1].n_topics, got[1].n_failed, got[1].total_issues, got[1].overall_pass) == (10, 1, 1, False)
    assert (got[2].n_topics, got[2].n_failed, got[2].total_issues, got[2].overall_pass) == (2, 0, 0, False)
    report = json.loads(got[1].report_json)
    assert list(report) == ["chapter_name", "topic_verifications", "overall_pass", "total_issues"]
    assert [t["topic"] for t in report["topic_verifications"]] == [f"t{k}" for k in range(10)]
    assert report["topic_verifications"][0]["mcq_verifications"] == [{**entry(0, [("unclear", "low")]), "suggestion": None}]
    assert report["topic_verifications"][1] == {"topic": "t1", "mcq_verifications": [], "fill_blank_verifications": [], "short_answer_verifications": [],
                                                "long_answer_verifications": [], "overall_quality": "poor", "has_duplicates": False}
    passing = verification.chapter_reports(verdicts(spark, [reply()]), meta).first()
    assert passing.overall_pass
