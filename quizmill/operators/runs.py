"""Run bookkeeping: skip done chapters, content defaults, failed topics, summary.

Everything is an anti/left join or a hash aggregate on chapter keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def skip_processed(chapters: DataFrame, done: DataFrame) -> DataFrame:
    """Chapters still to process: those without an existing output (B1)."""
    return chapters.join(done.select("chapter_id"), "chapter_id", "left_anti")


def content_default(folders: DataFrame, content_files: DataFrame) -> DataFrame:
    """Chapter content, '' when the content file (or its key) is missing."""
    j = folders.select("chapter_id").join(content_files.select("chapter_id", "content"), "chapter_id", "left")
    return j.select("chapter_id", F.coalesce("content", F.lit("")).alias("content"),
                    F.col("content").isNull().alias("missing_file"))


def failed_topics(items: DataFrame) -> DataFrame:
    """Topics whose generation failed (B7, C4): attempted minus succeeded.

    A section succeeds when it has all six levels (the typed response would
    not validate otherwise); a topic succeeds when all four sections do.
    ``chapter_has_success`` is false when no topic of the chapter survived,
    which fails the chapter.
    """
    sec = (items.groupBy("chapter_id", "topic_pos", "qtype")
           .agg((F.count_distinct("bloom") == 6).alias("ok")))
    per_topic = sec.groupBy("chapter_id", "topic_pos").agg(F.count_if("ok").cast("bigint").alias("sections_ok"))
    attempted = items.select("chapter_id", "topic_pos").distinct()
    succeeded = per_topic.where("sections_ok = 4")
    failed = attempted.join(succeeded, ["chapter_id", "topic_pos"], "left_anti")
    chapter_ok = succeeded.groupBy("chapter_id").agg(F.lit(True).alias("chapter_has_success"))
    return (failed.join(per_topic, ["chapter_id", "topic_pos"], "left")
            .join(chapter_ok, "chapter_id", "left")
            .select("chapter_id", "topic_pos", F.coalesce("sections_ok", F.lit(0)).cast("bigint").alias("sections_ok"),
                    F.coalesce("chapter_has_success", F.lit(False)).alias("chapter_has_success")))


def chapter_status(chapters: DataFrame, done: DataFrame, rejects: DataFrame, topic_failures: DataFrame,
                   items: DataFrame) -> DataFrame:
    """Per chapter: skipped (output exists), failed (rejected or no topic
    generated) or processed; ``output_empty`` marks an existing empty output."""
    any_ok = (topic_failures.where(~F.col("chapter_has_success")).select("chapter_id").distinct()
              .withColumn("all_failed", F.lit(True)))
    with_items = items.select("chapter_id").distinct().withColumn("has_items", F.lit(True))
    j = (chapters.select("chapter_id")
         .join(done.select("chapter_id", "output_empty"), "chapter_id", "left")
         .join(rejects.select("chapter_id").distinct().withColumn("rejected", F.lit(True)), "chapter_id", "left")
         .join(any_ok, "chapter_id", "left")
         .join(with_items, "chapter_id", "left"))
    status = (F.when(F.col("output_empty").isNotNull(), "skipped")
              .when(F.col("rejected") | F.col("all_failed") | F.col("has_items").isNull(), "failed")
              .otherwise("processed"))
    return j.select("chapter_id", status.alias("status"), "output_empty")


def run_summary(status: DataFrame) -> DataFrame:
    """Processed / skipped / failed counts (D8), plus the legacy count in
    which a skipped chapter with a non-empty output counts as processed."""
    return status.agg(
        F.count_if(F.col("status") == "processed").cast("bigint").alias("processed"),
        F.count_if(F.col("status") == "skipped").cast("bigint").alias("skipped"),
        F.count_if(F.col("status") == "failed").cast("bigint").alias("failed"),
        F.count_if((F.col("status") == "processed") | ((F.col("status") == "skipped") & ~F.col("output_empty")))
        .cast("bigint").alias("legacy_processed"),
        F.count_if((F.col("status") == "skipped") & F.col("output_empty")).cast("bigint").alias("legacy_skipped"),
    )
