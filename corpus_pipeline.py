"""The corpus pipeline: raw documents to packed training sequences.

Each stage gets what its predecessor kept, as read back from Parquet, and its
decisions take effect.  All but the last return the columns of ``documents``;
the last gives one row per packed piece.

Nulls and odd rows pass by the rules of the operators: a document without a
letter is rejected by the first stage; of near copies without doc_id one stays
beside the one with the smallest doc_id; texts that lose all lines stay as empty texts and are packed as an end
token.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quizmill.llm import chosen_path, decontaminate, language, line_dedup, packing
from quizmill.session import staged
from quizmill.sources.tables import table


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents without a letter, or whose trigrams don't fit the learned languages found in them, go."""
    return language.keep_identified(docs)


def remove_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: boilerplate lines of many sites are cut from the texts."""
    return line_dedup.remove_boilerplate(docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of near copies (five-word shingles, similarity 0.8) the smallest doc_id stays."""
    return chosen_path.keep_one(docs)


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold ten words of a test item in a row, or a whole shorter item, go."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1: the remaining texts in sequences of several permitted lengths."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", remove_boilerplate),
    ("near_dedup", keep_one_of_each),
    ("decontamination", remove_benchmark),
    ("packing", pack),
]

#: Language ID and the near-copy search have no SQL form; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
