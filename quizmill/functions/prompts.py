"""Prompt rendering for the model-call stages.

Templates are plain strings with ``{name}`` slots.  ``render`` turns one
into a single ``concat`` Column (constant parts fold at planning time), so
prompts are built JVM-side for every row of a request table at once.  The
wording is our own; users may pass their own templates with the same slots.
"""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import BLANK, BLOOMS, MAX_POINTS, MIN_POINTS, N_OPTIONS, POINT_WORDS, TOPIC_VERIFICATION, TYPE_FIELDS, known_types, section_schema

SYSTEM_GENERATE = (
    "You write assessment items for school textbooks. Every item must fit its cognitive level "
    "(remember, understand, apply, analyze, evaluate, create), be clear, correct and unique, "
    "and draw on the whole topic text."
)
SYSTEM_VERIFY = (
    "You review assessment items. Report duplicates, unclear wording, wrong answers, level "
    "mismatches and formatting problems, each with a severity of low, medium, high or critical."
)
SYSTEM_VARY = (
    "You rewrite assessment items. Each rewrite tests the same idea at the same level and "
    "difficulty, keeps the item type, and uses new wording or context."
)

SECTION_TEMPLATE = (
    "Write {n} {label} for every cognitive level of the topic below.\n\n"
    "Topic: {topic}\nClass: {class_name}\nSubject: {subject_name}\nChapter: {chapter_name}\n"
    "Text:\n{content}\n\n"
    "Answer with one JSON object whose only key is \"{key}\": a list of six groups in the order "
    + ", ".join(BLOOMS) + ". Each group has \"bloom_taxonomy\" and \"questions\" ({n} items). "
    "Each item has: {fields}. Leave \"variations\" empty."
)
COMBINED_TEMPLATE = (
    "Write a question bank for the topic below: {n} items per level for each of the four item types "
    "({total} items in all).\n\nTopic: {topic}\nClass: {class_name}\nSubject: {subject_name}\n"
    "Chapter: {chapter_name}\nText:\n{content}\n"
)
PREVIOUS_BLOCK = "\n\nAlready asked (do not repeat or paraphrase):\n{previous}\n\nCover new ideas only.\n"
VERIFY_TEMPLATE = "Review the items of this topic.\n\nTopic: {topic}\n\nItems:\n{items_json}\n"
VARY_TEMPLATE = (
    "Write 5 rewrites of this item.\n\nType: {type_name}\nLevel: {bloom}\nTopic: {topic}\n\n"
    "Item: {question}\n\n{details}\n\nAnswer with a JSON list of 5 strings."
)
TYPED_WRAP = "{system}\n\n{user}\n\nReturn JSON only, matching this schema:\n{schema}"
FREE_WRAP = "{system}\n\n{user}\n\nReturn JSON only."



def requested(qtype: str) -> tuple[str, str]:
    """(name of the type, what each item must hold), made from the declared fields and limits of a type."""
    known_types([qtype])
    fields = [f for f in TYPE_FIELDS[qtype] if f != "variations"]
    notes = {
        "question": f"with {BLANK} in place of the answer" if fields == ["question", "answer"] else "",
        "options": f"list of {N_OPTIONS} different texts",
        "answer": "one of the options" if "options" in fields else "what the blank hides",
        "reference_points": f"list of {MIN_POINTS} to {MAX_POINTS} texts, each below {POINT_WORDS} words",
        "reference_answer": "empty text" if "reference_points" in fields else "",
    }
    return f"{qtype.replace('_', ' ')} items", "; ".join(f"{f} ({notes[f]})" if notes.get(f) else f for f in fields)


_SLOT = re.compile(r"\{(\w+)\}")


def render(template: str, **slots) -> Column:
    """Fill ``{name}`` slots with Columns (or Python strings) in one concat."""
    parts: list[Column] = []
    pos = 0
    for m in _SLOT.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        v = slots[m.group(1)]
        parts.append(v if isinstance(v, Column) else F.lit(str(v)))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def render_sql(template: str, **slots: str) -> str:
    """The same template as a SQL ``||`` expression (used by the oracle)."""
    parts: list[str] = []
    pos = 0
    for m in _SLOT.finditer(template):
        if m.start() > pos:
            parts.append(_sql_lit(template[pos:m.start()]))
        parts.append(f"({slots[m.group(1)]})")
        pos = m.end()
    if pos < len(template):
        parts.append(_sql_lit(template[pos:]))
    return " || ".join(parts)


def _sql_lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def json_schema(kind: T.DataType) -> dict:
    """JSON schema of a Spark type: every field declared, objects closed."""
    if isinstance(kind, T.StructType):
        fields = {f.name: json_schema(f.dataType) for f in kind.fields}
        return {"type": "object", "properties": fields, "additionalProperties": False}
    if isinstance(kind, T.ArrayType):
        return {"type": "array", "items": json_schema(kind.elementType)}
    return {"type": {"string": "string", "int": "integer", "boolean": "boolean"}[kind.simpleString()]}


def schema_text(qtype: str) -> str:
    """What a generation reply must look like."""
    return json.dumps(json_schema(section_schema(qtype)))


#: What a verification reply must look like.
VERIFICATION_SCHEMA = json.dumps(json_schema(TOPIC_VERIFICATION))


def section_user_prompt(qtype: str, topic: Column, content: Column, class_name: Column,
                        subject_name: Column, chapter_name: Column, n: Column) -> Column:
    label, fields = requested(qtype)
    return render(SECTION_TEMPLATE, n=n.cast("string"), label=label, topic=topic, class_name=class_name,
                  subject_name=subject_name, chapter_name=chapter_name, content=content, key=qtype, fields=fields)


def wrap_typed(system: str, user: Column, schema: str) -> Column:
    return render(TYPED_WRAP, system=system, user=user, schema=schema)


def wrap_free(system: str, user: Column) -> Column:
    return render(FREE_WRAP, system=system, user=user)


def bullet_list(arr: Column) -> Column:
    return F.array_join(F.transform(arr, lambda x: F.concat(F.lit("- "), x)), "\n")


def variation_details(qtype: Column, options: Column, answer: Column, reference_answer: Column,
                      points: Column) -> Column:
    """Per-type block: options and answer; answer; reference answer; points or legacy text."""
    empty = F.array().cast("array<string>")
    return (F.when(qtype == "MCQs", F.concat(F.lit("Options:\n"), bullet_list(F.coalesce(options, empty)),
                                             F.lit("\n\nCorrect answer: "), F.coalesce(answer, F.lit(""))))
            .when(qtype == "fill_in_the_blanks", F.concat(F.lit("Answer: "), F.coalesce(answer, F.lit(""))))
            .when(qtype == "short_answer", F.concat(F.lit("Reference answer: "), F.coalesce(reference_answer, F.lit(""))))
            .when(F.size(F.coalesce(points, empty)) > 0, F.concat(F.lit("Reference points:\n"), bullet_list(points)))
            .otherwise(F.concat(F.lit("Legacy reference answer: "), F.coalesce(reference_answer, F.lit("")))))
