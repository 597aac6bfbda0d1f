"""Record schemas and the small static dimensions.

The dimensions here are fixed-size lookup tables (4 question types, 6
cognitive levels, a few dozen level keywords, 5 variation stems per level).
They are the only DataFrames the library broadcasts without a size check:
their size does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Keys, levels, keywords and limits, as the behaviour being rebuilt has them.
QTYPES = ["MCQs", "fill_in_the_blanks", "short_answer", "long_answer"]
QTYPE_VARIATION_NAME = {"MCQs": "MCQ", "fill_in_the_blanks": "Fill in the Blank",
                        "short_answer": "Short Answer", "long_answer": "Long Answer"}
BLOOMS = ["remember", "understand", "apply", "analyze", "evaluate", "create"]
BLOOM_KEYWORDS = {
    "remember": ["define", "list", "identify", "name", "state", "describe", "recognize"],
    "understand": ["explain", "summarize", "paraphrase", "classify", "compare", "interpret"],
    "apply": ["apply", "demonstrate", "solve", "use", "illustrate", "calculate"],
    "analyze": ["analyze", "compare", "contrast", "distinguish", "examine", "categorize"],
    "evaluate": ["evaluate", "judge", "critique", "defend", "assess", "prioritize"],
    "create": ["create", "design", "construct", "develop", "formulate", "propose"],
}
ISSUE_TYPES = ["duplicate", "unclear", "incorrect", "poor_quality", "grammatical"]
SEVERITIES = ["low", "medium", "high", "critical"]
QUALITY_RATINGS = ["excellent", "good", "fair", "poor"]
STAGES = ["generated", "verified", "varied"]
SECTION_PART = 3000
N_VARIATIONS = 5
MIN_POINTS = 3
MAX_POINTS = 6
POINT_WORDS = 20
N_OPTIONS = 4
BLANK = "_____"
MAX_ATTEMPTS = 3


# ---------------------------------------------------------------------------
# Record schemas (flat model; nesting only at the import/export edge).
# ---------------------------------------------------------------------------

ITEM_FIELDS = [
    T.StructField("question", T.StringType()),
    T.StructField("options", T.ArrayType(T.StringType())),
    T.StructField("answer", T.StringType()),
    T.StructField("explanation", T.StringType()),
    T.StructField("reference_answer", T.StringType()),
    T.StructField("reference_points", T.ArrayType(T.StringType())),
    T.StructField("variations", T.ArrayType(T.StringType())),
]

# Declared fields per type; anything else a response carries is dropped.
TYPE_FIELDS = {
    "MCQs": ["question", "options", "answer", "explanation", "variations"],
    "fill_in_the_blanks": ["question", "answer", "variations"],
    "short_answer": ["question", "reference_answer", "variations"],
    "long_answer": ["question", "reference_points", "reference_answer", "variations"],
}
REQUIRED_FIELDS = {
    "MCQs": ["question", "options", "answer", "explanation"],
    "fill_in_the_blanks": ["question", "answer"],
    "short_answer": ["question", "reference_answer"],
    "long_answer": ["question"],
}


class UnknownQuestionType(ValueError):
    """A question type that the library has no schema for."""

    def __init__(self, qtypes):
        super().__init__(f"unknown question type {', '.join(map(repr, qtypes))}; known are {', '.join(QTYPES)}")


def known_types(qtypes: list[str]) -> list[str]:
    """``qtypes``, if all are known."""
    unknown = [q for q in qtypes if q not in TYPE_FIELDS]
    if unknown:
        raise UnknownQuestionType(unknown)
    return list(qtypes)


def item_struct(qtype: str) -> T.StructType:
    wanted = set(TYPE_FIELDS[qtype])
    return T.StructType([f for f in ITEM_FIELDS if f.name in wanted])


def section_schema(qtype: str) -> T.StructType:
    """Schema of one typed section response: {qtype: [ {bloom_taxonomy, questions} ]}."""
    group = T.StructType([
        T.StructField("bloom_taxonomy", T.StringType()),
        T.StructField("questions", T.ArrayType(item_struct(qtype))),
    ])
    return T.StructType([T.StructField(qtype, T.ArrayType(group))])


ISSUE = T.StructType([
    T.StructField("issue_type", T.StringType()),
    T.StructField("description", T.StringType()),
    T.StructField("severity", T.StringType()),
])
VERDICT = T.StructType([
    T.StructField("question_index", T.IntegerType()),
    T.StructField("is_valid", T.BooleanType()),
    T.StructField("issues", T.ArrayType(ISSUE)),
    T.StructField("suggestion", T.StringType()),
])
VERIFICATION_KEYS = {"MCQs": "mcq_verifications", "fill_in_the_blanks": "fill_blank_verifications",
                     "short_answer": "short_answer_verifications",
                     "long_answer": "long_answer_verifications"}
TOPIC_VERIFICATION = T.StructType(
    [T.StructField("topic", T.StringType())]
    + [T.StructField(k, T.ArrayType(VERDICT)) for k in VERIFICATION_KEYS.values()]
    + [T.StructField("overall_quality", T.StringType()),
       T.StructField("has_duplicates", T.BooleanType())]
)

CHAPTER_CONTENT = T.StructType([
    T.StructField("chapter_name", T.StringType()),
    T.StructField("content", T.StringType()),
])
PAGE = T.StructType([
    T.StructField("page_number", T.IntegerType()),
    T.StructField("page_content", T.StringType()),
])
SUMMARY = T.StructType([
    T.StructField("summary", T.StructType([
        T.StructField("short", T.StringType()),
        T.StructField("detailed", T.StringType()),
    ])),
])
TOPICS_FILE = T.StructType([
    T.StructField("chapter_name", T.StringType()),
    T.StructField("total_topics", T.IntegerType()),
    T.StructField("topics", T.ArrayType(T.StructType([
        T.StructField("topic", T.StringType()),
        T.StructField("content", T.StringType()),
    ]))),
])


# ---------------------------------------------------------------------------
# Static dimensions as DataFrames (fixed size: safe to broadcast).
# ---------------------------------------------------------------------------

def bloom_keywords_df(spark: SparkSession) -> DataFrame:
    rows = [(kw, b, BLOOMS.index(b) + 1) for b, kws in BLOOM_KEYWORDS.items() for kw in kws]
    return spark.createDataFrame(rows, "keyword STRING, bloom STRING, bloom_ord INT")
