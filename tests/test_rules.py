"""Long-answer normaliser, item rules and verdict roll-ups."""

from pyspark.sql import functions as F

from quizmill.operators import quality, rollup
from quizmill.schemas import ITEM_FIELDS

ITEM_DDL = ("chapter_id bigint, topic_pos int, seq int, qtype string, bloom string, bloom_ord int, "
            "question string, options array<string>, answer string, explanation string, "
            "reference_answer string, reference_points array<string>, variations array<string>, terms array<string>")


def items_df(spark, rows):
    full = []
    for r in rows:
        d = {"chapter_id": 1, "topic_pos": 0, "seq": 0, "qtype": "MCQs", "bloom": "remember", "bloom_ord": 1,
             "question": "q", "options": None, "answer": None, "explanation": None, "reference_answer": None,
             "reference_points": None, "variations": [], "terms": ["q"]}
        d.update(r)
        full.append(d)
    return spark.createDataFrame(full, ITEM_DDL)


def test_long_answer_normaliser(spark):
    df = items_df(spark, [
        {"seq": 1, "qtype": "long_answer", "reference_points": [" a ", "", "b"], "reference_answer": "legacy"},
        {"seq": 2, "qtype": "long_answer", "reference_points": [str(i) for i in range(8)]},
        {"seq": 3, "qtype": "long_answer", "reference_points": [], "reference_answer": "One. Two! Three?"},
        {"seq": 4, "qtype": "long_answer", "reference_points": [" "], "reference_answer": "  "},
    ])
    got = {r["seq"]: r for r in quality.long_answer_points(df).collect()}
    assert got[1]["points"].split("\x1f") == ["a", "b"] and got[1]["reference_answer"] == ""
    assert got[2]["n_points"] == 8
    over = {(r["seq"], r["rule"]) for r in quality.rule_issues(df).collect()}
    assert (2, "long_answer_point_count") in over and (3, "long_answer_point_count") not in over
    assert got[3]["points"].split("\x1f") == ["One.", "Two!", "Three?"]
    assert got[4]["rejected"] and got[4]["n_points"] == 0


def test_item_rules_hits_and_misses(spark):
    df = items_df(spark, [
        {"seq": 1, "options": ["a", "b", "c", "d"], "answer": "a", "explanation": "Fine."},
        {"seq": 2, "options": ["a", "a", "None of the above", "d"], "answer": "z", "explanation": "A. B. C."},
        {"seq": 3, "qtype": "fill_in_the_blanks", "question": "x _____", "answer": "one two"},
        {"seq": 4, "qtype": "fill_in_the_blanks", "question": "x", "answer": "one two three four"},
    ])
    rules = {(r["seq"], r["rule"]) for r in quality.rule_issues(df).collect()}
    assert not any(s == 1 for s, _ in rules)
    assert {(2, "mcq_answer_not_in_options"), (2, "mcq_options_not_four_distinct"),
            (2, "mcq_all_none_of_above"), (2, "mcq_explanation_length")} <= rules
    assert (3, "blank_marker_missing") not in rules
    assert {(4, "blank_marker_missing"), (4, "blank_answer_length")} <= rules


def test_chapter_pass_rule(spark):
    tq = spark.createDataFrame([
        (1, 0, 10, 0, "excellent", False), (1, 1, 10, 3, "good", False),
        (2, 0, 10, 1, "fair", False),
        (3, 0, 10, 0, "excellent", True),
        (4, 0, 10, 9, "good", False)],
        "chapter_id bigint, topic_pos int, n_items bigint, n_issues bigint, overall_quality string, has_duplicates boolean")
    got = {r["chapter_id"]: (r["overall_pass"], r["total_issues"]) for r in rollup.chapter_quality(tq).collect()}
    assert got == {1: (True, 3), 2: (False, 1), 3: (False, 0), 4: (True, 9)}


def test_topic_rating_from_worst_severity(spark):
    it = items_df(spark, [{"seq": i, "topic_pos": t} for t, i in [(0, 0), (1, 1), (2, 2), (3, 3)]])
    iss = spark.createDataFrame([(1, 1, "MCQs", 1, "r", "poor_quality", "medium"),
                                 (1, 2, "MCQs", 2, "r", "unclear", "high"),
                                 (1, 3, "MCQs", 3, "r", "duplicate", "critical")],
                                "chapter_id bigint, topic_pos int, qtype string, seq int, rule string, "
                                "issue_type string, severity string")
    got = {r["topic_pos"]: (r["overall_quality"], r["has_duplicates"]) for r in rollup.topic_quality(it, iss).collect()}
    assert got == {0: ("excellent", False), 1: ("good", False), 2: ("fair", False), 3: ("poor", True)}


def test_item_fields_declared():
    assert [f.name for f in ITEM_FIELDS][:3] == ["question", "options", "answer"]


def test_enum_and_strict_type_checks(spark):
    import json

    from quizmill.operators import validate
    good = {"topic": "t", "mcq_verifications": [{"question_index": 0, "is_valid": False, "suggestion": None,
            "issues": [{"issue_type": "duplicate", "description": "d", "severity": "critical"}]}],
            "overall_quality": "good", "has_duplicates": True}
    bad = {"topic": "t", "fill_blank_verifications": [{"question_index": 1, "is_valid": False,
           "issues": [{"issue_type": "typo", "description": "d", "severity": "severe"}]}],
           "overall_quality": "fine", "has_duplicates": False}
    df = spark.createDataFrame([("a", json.dumps(good)), ("b", json.dumps(bad))], "request_id string, raw string")
    got = {r["request_id"]: (r["bad_issue_types"], r["bad_severities"], r["bad_quality"])
           for r in validate.verdict_enum_violations(df).collect()}
    assert got == {"a": (0, 0, False), "b": (1, 1, True)}

    ok = {"MCQs": [{"bloom_taxonomy": "remember", "questions": [
        {"question": "q", "options": ["a", "b", "c", "d"], "answer": "a", "explanation": "e", "variations": []}]}]}
    wrong = {"MCQs": [{"bloom_taxonomy": 3, "questions": [
        {"question": 12, "options": ["a", 2], "answer": "a", "explanation": "e"}]}]}
    sec = spark.createDataFrame([("ok", "MCQs", json.dumps(ok)), ("wrong", "MCQs", json.dumps(wrong))],
                                "request_id string, qtype string, raw string")
    got = {r["request_id"]: r["type_errors"] for r in validate.strict_type_violations(sec).collect()}
    assert got == {"ok": 0, "wrong": 3}


def test_questions_without_words_are_duplicates(spark):
    df = items_df(spark, [{"seq": k, "question": q, "qtype": "short_answer"} for k, q in enumerate(["???", " ??? ", "!!", "a b"])])
    df = df.withColumn("terms", F.filter(F.split(F.lower("question"), r"[^a-z]+"), lambda x: x != ""))
    assert {(r["seq"], r["n_corpus"]) for r in quality.exact_duplicates(df).collect()} == {(0, 2), (1, 2)}


def test_items_without_a_keyword_stay(spark):
    from quizmill.schemas import bloom_keywords_df
    df = spark.createDataFrame([(1, 0, "remember", ["define", "x"]), (1, 1, "remember", ["y"]), (1, 2, "apply", ["list"])],
                               "chapter_id bigint, seq int, bloom string, terms array<string>")
    got = {r["seq"]: (r["aligned"], r["keywords"]) for r in quality.bloom_alignment(df, bloom_keywords_df(spark)).collect()}
    assert got == {0: (True, "define"), 1: (None, ""), 2: (False, "list")}
