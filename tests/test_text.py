"""Cleaning, stripping, sentence and word splitting."""

from pyspark.sql import functions as F

from quizmill.functions import text as tx


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "x string").select(expr(F.col("x")).alias("y")).first()["y"]


def py_clean(text):
    if text.startswith("```json"):
        text = text[7:]
    if text.startswith("```"):
        text = text[3:]
    if text.endswith("```"):
        text = text[:-3]
    import re
    return re.sub(r"[\x00-\x08\x0b-\x1f\x7f-\x9f]", " ", text).strip()


def test_clean_response_branches(spark):
    cases = ['```json\n{"a": 1}\n```', '```\n[1]\n```', '```json[1]', '[1]```', '``````', '````',
             '\r\n  {"a": "x\x07y"}  ', '\x85 [1] \xa0', '```json```[2]```', 'plain']
    for c in cases:
        assert one(spark, tx.clean_response, c) == py_clean(c.strip()), repr(c)


def test_clean_is_idempotent(spark):
    for c in ['```json\n{"a": 1}\n```', ' \x07x ']:
        once = one(spark, tx.clean_response, c)
        assert one(spark, tx.clean_response, once) == once


def test_py_strip_unicode(spark):
    assert one(spark, tx.py_strip, "\xa0  a b \x1c\n") == "a b"


def test_sentences_and_words(spark):
    assert one(spark, tx.sentences, "One. Two!  Three?\nfour") == ["One.", "Two!", "Three?", "four"]
    assert one(spark, tx.words, "Élan, vital-force 42!") == ["élan", "vital", "force", "42"]


def test_heading_number_and_cap(spark):
    assert one(spark, tx.strip_heading_number, "6.1 Title") == "Title"
    assert one(spark, tx.strip_heading_number, "6.1.1 Title") == "6.1.1 Title"  # two-level only
    assert one(spark, tx.parts, "a" * 3000) == ["a" * 3000]
    assert one(spark, tx.parts, "a" * 3001 + "b") == ["a" * 3000, "ab"]
    assert one(spark, tx.parts, "") == [""]
    assert one(spark, tx.first_number, "chapter 09b") == "09"
    assert one(spark, tx.first_number, "intro") is None
