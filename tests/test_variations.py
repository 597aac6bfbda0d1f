"""Variation responses: unwrap, normalise every branch, pad and cap."""

import json

from pyspark.sql import functions as F

from quizmill.functions import variations as vx


def run(spark, raw, qtype="MCQs", question="Q?"):
    df = spark.createDataFrame([(raw, qtype, question)], "raw string, qtype string, question string")
    p = F.try_parse_json("raw")
    norm = vx.normalized_variations(p, F.col("qtype") == "MCQs")
    r = df.select(norm.alias("n"), vx.padded(norm, F.col("question")).alias("v")).first()
    return r["n"], r["v"]


def test_strings_blank_and_padding(spark):
    n, v = run(spark, json.dumps(["  a  ", " ", "b"]))
    assert n == ["a", "b"]
    assert v == ["a", "b", "a", "a", "a"]


def test_bundle_sorted_as_text(spark):
    n, _ = run(spark, json.dumps({"variations": [{"variation_2": "two", "variation_10": "ten",
                                                  "variation_1": "one", "variation_3": " "}]}))
    assert n == ["one | ten | two"]


def test_text_keys_and_mcq_parts(spark):
    item = {"question": " ", "text": "T", "options": ["x", " ", "y"], "answer": "x"}
    assert run(spark, json.dumps([item]))[0] == ["T | Options: x; y | Answer: x"]
    assert run(spark, json.dumps([item]), qtype="short_answer")[0] == ["T"]


def test_points_and_reference_answer(spark):
    assert run(spark, json.dumps({"question": "Q", "reference_points": ["a", "", "b"]}))[0] == ["Q | Key points: a; b"]
    assert run(spark, json.dumps([{"reference_answer": " R "}]))[0] == ["R"]
    assert run(spark, json.dumps([{"prompt": "P", "reference_answer": "R"}]))[0] == ["P | Reference answer: R"]


def test_fallbacks(spark):
    assert run(spark, '{"other": 1}')[0] == ['{"other":1}']
    assert run(spark, "7")[0] == ["7"]
    assert run(spark, "[true, null]")[0] == ["True", "None"]


def test_failed_call_not_padded(spark):
    n, v = run(spark, '["a", ')
    assert n is None and v == []


def test_more_than_five_are_kept(spark):
    _, v = run(spark, json.dumps([str(i) for i in range(8)]))
    assert v == [str(i) for i in range(8)]


def test_empty_list_pads_with_question(spark):
    _, v = run(spark, "[]", question="orig")
    assert v == ["orig"] * 5
