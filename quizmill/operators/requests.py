"""Request tables for the three model-call stages.

A request row carries its rendered prompt and a deterministic id, so a
retried or speculative task re-renders exactly the same request.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import prompts as pr
from ..schemas import QTYPES, QTYPE_VARIATION_NAME, known_types


def _rid(stage: str, *cols) -> F.Column:
    return F.concat_ws(":", F.lit(stage), *[F.col(c).cast("string") for c in cols])


def section_requests(sections: DataFrame, meta: DataFrame, qtypes: list[str] = QTYPES) -> DataFrame:
    """Topic part x question type fan-out (one request per type and part of a section).

    The type dimension is a literal array exploded per topic (fixed size,
    no join); chapter metadata joins 1:N on the chapter key.  A type without a
    schema raises ``UnknownQuestionType`` before any row is made.
    """
    qtypes = known_types(qtypes)
    df = (sections.join(meta, "chapter_id")
          .withColumn("qtype", F.explode(F.array(*[F.lit(q) for q in qtypes]))))
    n = F.col("questions_per_level")
    prompt = None
    for q in qtypes:
        user = pr.section_user_prompt(q, F.col("topic"), F.col("section"), F.col("class_name"),
                                      F.col("subject_name"), F.col("chapter_name"), n)
        p = pr.wrap_typed(pr.SYSTEM_GENERATE, user, pr.schema_text(q))
        prompt = F.when(F.col("qtype") == q, p) if prompt is None else prompt.when(F.col("qtype") == q, p)
    return df.select(_rid("generate", "chapter_id", "topic_pos", "part_pos", "qtype").alias("request_id"),
                     F.lit("generate").alias("stage"), "chapter_id", "topic_pos", "part_pos", "qtype",
                     prompt.alias("prompt"), "topic", "section", "questions_per_level")


ITEM_JSON_FIELDS = ["qtype", "bloom", "question", "options", "answer", "explanation",
                    "reference_answer", "reference_points", "variations"]


def verification_requests(items: DataFrame) -> DataFrame:
    """One request per topic with all its items as JSON, in type/level/position order.

    A topic is the unit one reviewer call sees, so its item list is bounded
    by the per-topic item budget (4 types x 6 levels x n).
    """
    order = F.array_position(F.array(*[F.lit(q) for q in QTYPES]), F.col("qtype"))
    g = items.groupBy("chapter_id", "topic_pos", "topic").agg(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), F.col("bloom_ord"), F.col("seq"),
                                             F.struct(*ITEM_JSON_FIELDS).alias("item")))).alias("xs"))
    items_json = F.to_json(F.transform("xs", lambda x: x["item"]), {"ignoreNullFields": "false"})
    user = pr.render(pr.VERIFY_TEMPLATE, topic=F.col("topic"), items_json=items_json)
    return g.select(_rid("verify", "chapter_id", "topic_pos").alias("request_id"), F.lit("verify").alias("stage"),
                    "chapter_id", "topic_pos", F.size("xs").cast("bigint").alias("n_items"),
                    pr.wrap_typed(pr.SYSTEM_VERIFY, user, pr.VERIFICATION_SCHEMA).alias("prompt"),
                    "topic", items_json.alias("items_json"))


def variation_requests(items: DataFrame) -> DataFrame:
    """One request per item that has no variations yet (filter before the map)."""
    from .responses import needs_variations
    from .quality import normalized_points
    df = needs_variations(items)
    type_name = F.element_at(F.create_map(*[x for q in QTYPES for x in (F.lit(q), F.lit(QTYPE_VARIATION_NAME[q]))]),
                             F.col("qtype"))
    points = F.when(F.col("qtype") == "long_answer", normalized_points())
    details = pr.variation_details(F.col("qtype"), F.col("options"), F.col("answer"), F.col("reference_answer"), points)
    user = pr.render(pr.VARY_TEMPLATE, type_name=type_name, bloom=F.col("bloom"), topic=F.col("topic"),
                     question=F.col("question"), details=details)
    return df.select(_rid("vary", "chapter_id", "seq").alias("request_id"), F.lit("vary").alias("stage"),
                     "chapter_id", "topic_pos", "seq", "qtype", "bloom", "question",
                     pr.wrap_free(pr.SYSTEM_VARY, user).alias("prompt"))


def combined_requests(topics: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """One combined prompt per topic (H11), with an optional block listing
    questions already asked for that topic.

    ``topics``: chapter_id, topic_pos, topic, content, class_name,
    subject_name, chapter_name, questions_per_level.  ``previous``:
    chapter_id, topic_pos, question, seq -- collected per topic, i.e. one
    model call's worth of text.
    """
    n = F.col("questions_per_level")
    df = topics
    if previous is not None:
        prev = previous.groupBy("chapter_id", "topic_pos").agg(
            pr.bullet_list(F.transform(F.array_sort(F.collect_list(F.struct("seq", "question"))),
                                       lambda x: x["question"])).alias("previous"))
        df = df.join(prev, ["chapter_id", "topic_pos"], "left")
    else:
        df = df.withColumn("previous", F.lit(None).cast("string"))
    body = pr.render(pr.COMBINED_TEMPLATE, n=n.cast("string"), total=(n * 24).cast("string"), topic=F.col("topic"),
                     class_name=F.col("class_name"), subject_name=F.col("subject_name"),
                     chapter_name=F.col("chapter_name"), content=F.col("content"))
    user = F.when(F.coalesce(F.col("previous"), F.lit("")) != "",
                  F.concat(body, pr.render(pr.PREVIOUS_BLOCK, previous=F.col("previous")))).otherwise(body)
    return df.select(_rid("combined", "chapter_id", "topic_pos").alias("request_id"), "chapter_id", "topic_pos",
                     pr.wrap_free(pr.SYSTEM_GENERATE, user).alias("prompt"))
