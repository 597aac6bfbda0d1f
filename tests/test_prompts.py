"""Rendered prompts against texts written out by hand, and unknown question types."""

import pytest

from quizmill.operators import requests
from quizmill.schemas import QTYPES, UnknownQuestionType

CHOICE = """You write assessment items for school textbooks. Every item must fit its cognitive level (remember, understand, apply, analyze, evaluate, create), be clear, correct and unique, and draw on the whole topic text.

Write 5 MCQs items for every cognitive level of the topic below.

Topic: 1.1 Cells
Class: Class 8
Subject: Biology
Chapter: Life
Text:
Cells are small {n}.

Answer with one JSON object whose only key is "MCQs": a list of six groups in the order remember, understand, apply, analyze, evaluate, create. Each group has "bloom_taxonomy" and "questions" (5 items). Each item has: question; options (list of 4 different texts); answer (one of the options); explanation. Leave "variations" empty.

Return JSON only, matching this schema:
{"type": "object", "properties": {"MCQs": {"type": "array", "items": {"type": "object", "properties": {"bloom_taxonomy": {"type": "string"}, "questions": {"type": "array", "items": {"type": "object", "properties": {"question": {"type": "string"}, "options": {"type": "array", "items": {"type": "string"}}, "answer": {"type": "string"}, "explanation": {"type": "string"}, "variations": {"type": "array", "items": {"type": "string"}}}, "additionalProperties": false}}}, "additionalProperties": false}}}, "additionalProperties": false}"""
FIELDS = {
    "fill_in_the_blanks": "Each item has: question (with _____ in place of the answer); answer (what the blank hides). Leave",
    "short_answer": "Each item has: question; reference_answer. Leave",
    "long_answer": "Each item has: question; reference_points (list of 3 to 6 texts, each below 20 words); reference_answer (empty text). Leave",
}


def frames(spark):
    sections = spark.createDataFrame([(1, 0, 0, "1.1 Cells", "Cells are small {n}.")], "chapter_id long, topic_pos int, part_pos int, topic string, section string")
    meta = spark.createDataFrame([(1, "Class 8", "Biology", "Life", 5)], "chapter_id long, class_name string, subject_name string, chapter_name string, questions_per_level int")
    return sections, meta


def test_section_prompts_by_hand(spark):
    got = {r.qtype: r for r in requests.section_requests(*frames(spark)).collect()}
    assert set(got) == set(QTYPES) and got["MCQs"].request_id == "generate:1:0:0:MCQs"
    assert got["MCQs"].prompt == CHOICE
    for q, text in FIELDS.items():
        assert text in got[q].prompt and f'whose only key is "{q}"' in got[q].prompt


def test_variation_prompt_by_hand(spark):
    row = [(1, 0, "Cells", 3, "short_answer", "apply", "Why?", None, None, "Because.", None, [])]
    items = spark.createDataFrame(row, "chapter_id long, topic_pos int, topic string, seq int, qtype string, bloom string, question string, options array<string>, "
                                       "answer string, reference_answer string, reference_points array<string>, variations array<string>")
    assert requests.variation_requests(items).first().prompt == (
        "You rewrite assessment items. Each rewrite tests the same idea at the same level and difficulty, keeps the item type, and uses new wording or context.\n\n"
        "Write 5 rewrites of this item.\n\nType: Short Answer\nLevel: apply\nTopic: Cells\n\nItem: Why?\n\nReference answer: Because.\n\n"
        "Answer with a JSON list of 5 strings.\n\nReturn JSON only.")


def test_unknown_type_is_a_named_error(spark):
    with pytest.raises(UnknownQuestionType, match="'essay'; known are MCQs"):
        requests.section_requests(*frames(spark), qtypes=["MCQs", "essay"])
    only = requests.section_requests(*frames(spark), qtypes=["long_answer"])
    assert [r.qtype for r in only.collect()] == ["long_answer"]
