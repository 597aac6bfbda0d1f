"""Model verification: replies checked, joined back to items, and nested as one report per chapter.

A reply is a topic verdict: four lists of entries (question_index, is_valid,
issues, suggestion), an overall quality and a duplicate flag.  A reply that is
missing, is no JSON, lacks a required value or leaves a declared enum is a failed
call: its topic counts as ``poor`` without entries and without duplicates.  No
reply ever fails the chapter or the run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_response
from ..schemas import ISSUE_TYPES, QTYPES, QUALITY_RATINGS, SEVERITIES, TOPIC_VERIFICATION, VERDICT, VERIFICATION_KEYS
from .quality import question_index

LISTS = list(VERIFICATION_KEYS.values())


def _no_entries() -> Column:
    return F.array().cast(TOPIC_VERIFICATION[LISTS[0]].dataType)


def _no_issues() -> Column:
    return F.array().cast(VERDICT["issues"].dataType)


def _declared(value: Column, values: list[str]) -> Column:
    return F.coalesce(value.isin(*values), F.lit(False))


def _entry_faulty(e: Column) -> Column:
    return e["question_index"].isNull() | e["is_valid"].isNull() | F.exists(
        F.coalesce(e["issues"], _no_issues()),
        lambda i: i["description"].isNull() | ~_declared(i["issue_type"], ISSUE_TYPES) | ~_declared(i["severity"], SEVERITIES))


def topic_verdicts(requests: DataFrame, replies: DataFrame) -> DataFrame:
    """One row per requested topic: the four lists, quality and duplicate flag, with ``failure`` naming a failed call.

    ``requests``: request_id, chapter_id, topic_pos, topic.  ``replies``:
    request_id, raw; a topic without a reply has failed, too.  The reply is read
    once, in a projection of its own.
    """
    read = (requests.select("request_id", "chapter_id", "topic_pos", "topic")
            .join(replies.select("request_id", clean_response(F.col("raw")).alias("text")), "request_id", "left")
            .select("*", F.try_parse_json("text").isNotNull().alias("is_json"), F.from_json("text", TOPIC_VERIFICATION).alias("v")))
    read = read.select("*", F.concat(*[F.coalesce(F.col("v")[k], _no_entries()) for k in LISTS]).alias("entries"))
    v = F.col("v")
    failure = (F.when(F.col("text").isNull(), "no_reply").when(~F.col("is_json"), "no_json")
               .when(v["topic"].isNull() | v["has_duplicates"].isNull() | ~_declared(v["overall_quality"], QUALITY_RATINGS), "bad_topic")
               .when(F.exists("entries", _entry_faulty), "bad_entry"))
    good = F.col("failure").isNull()

    def entry(e: Column) -> Column:
        return F.struct(e["question_index"].alias("question_index"), e["is_valid"].alias("is_valid"),
                        F.coalesce(e["issues"], _no_issues()).alias("issues"), e["suggestion"].alias("suggestion"))

    return read.withColumn("failure", failure).select(
        "chapter_id", "topic_pos", "topic", "failure",
        *[F.when(good, F.transform(F.coalesce(v[k], _no_entries()), entry)).otherwise(_no_entries()).alias(k) for k in LISTS],
        F.when(good, v["overall_quality"]).otherwise("poor").alias("overall_quality"),
        F.when(good, v["has_duplicates"]).otherwise(F.lit(False)).alias("has_duplicates"))


def item_entries(verdicts: DataFrame, items: DataFrame) -> DataFrame:
    """Every verdict entry with the item it names: joined by (chapter, topic, type, question_index).

    ``seq`` is null where no item has that index.  Several entries may name one item.
    """
    named = F.explode(F.array(*[F.struct(F.lit(q).alias("qtype"), F.col(k).alias("found")) for q, k in VERIFICATION_KEYS.items()]))
    rows = (verdicts.select("chapter_id", "topic_pos", named.alias("one"))
            .select("chapter_id", "topic_pos", "one.qtype", F.posexplode("one.found").alias("entry_pos", "entry"))
            .select("chapter_id", "topic_pos", "qtype", "entry_pos", "entry.*"))
    return rows.join(question_index(items), ["chapter_id", "topic_pos", "qtype", "question_index"], "left")


def entry_issues(entries: DataFrame) -> DataFrame:
    """The issues of entries that name an item, in the shape of ``quality.all_issues``; the rule is ``verifier``."""
    return (entries.where("seq IS NOT NULL").select("chapter_id", "topic_pos", "qtype", "seq", F.explode("issues").alias("i"))
            .select("chapter_id", "topic_pos", "qtype", "seq", F.lit("verifier").alias("rule"), "i.issue_type", "i.severity"))


def _issue_count() -> Column:
    return F.aggregate(F.concat(*LISTS), F.lit(0).cast("bigint"), lambda n, e: n + F.size(e["issues"]))


def topic_totals(verdicts: DataFrame) -> DataFrame:
    """Entries (D5) and issues (D6) of each topic."""
    return verdicts.select("chapter_id", "topic_pos", "failure", F.size(F.concat(*LISTS)).cast("bigint").alias("n_entries"),
                           _issue_count().alias("n_issues"), "overall_quality", "has_duplicates")


def chapter_reports(verdicts: DataFrame, chapters: DataFrame) -> DataFrame:
    """One nested report per chapter (A8): its topics' verdicts in topic order, total_issues and overall_pass.

    ``chapters``: chapter_id, class_name, subject_name, chapter_name.  The
    largest group is one chapter's report, i.e. the document written.
    """
    topic = F.struct("topic", *LISTS, "overall_quality", "has_duplicates")
    nested = verdicts.withColumn("n_issues", _issue_count()).groupBy("chapter_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("topic_pos", topic.alias("t")))), lambda x: x["t"]).alias("topic_verifications"),
        F.count("*").cast("bigint").alias("n_topics"), F.count("failure").cast("bigint").alias("n_failed"),
        F.sum("n_issues").cast("bigint").alias("total_issues"),
        F.bool_and(~F.col("overall_quality").isin("poor", "fair") & ~F.col("has_duplicates")).alias("overall_pass"))
    report = F.struct("chapter_name", "topic_verifications", "overall_pass", "total_issues")
    return nested.join(chapters.select("chapter_id", "class_name", "subject_name", "chapter_name"), "chapter_id").select(
        "chapter_id", "class_name", "subject_name", "chapter_name", "n_topics", "n_failed", "total_issues", "overall_pass",
        F.to_json(report, {"ignoreNullFields": "false"}).alias("report_json"))
