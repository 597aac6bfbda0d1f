"""Roll-ups: topic and chapter verdicts, run summary, coverage and tallies.

All of these are hash aggregates with partial (map-side) aggregation, so a
hot chapter or topic costs one row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEVERITY_RANK = "CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 WHEN 'critical' THEN 4 END"


def quality_from_rank(rank_col: str = "worst") -> F.Column:
    """Topic rating from the worst issue severity (none -> excellent)."""
    r = F.col(rank_col)
    return (F.when(r.isNull() | (r == 0), "excellent").when(r <= 2, "good")
            .when(r == 3, "fair").otherwise("poor"))


def topic_quality(items: DataFrame, issues: DataFrame) -> DataFrame:
    """Per topic: items, issues, worst severity, rating and duplicate flag."""
    topics = items.groupBy("chapter_id", "topic_pos").agg(F.count("*").alias("n_items"))
    iss = (issues.groupBy("chapter_id", "topic_pos")
           .agg(F.count("*").alias("n_issues"),
                F.max(F.expr(SEVERITY_RANK)).alias("worst"),
                F.max(F.col("issue_type") == "duplicate").alias("has_duplicates")))
    j = topics.join(iss, ["chapter_id", "topic_pos"], "left")
    return j.select(
        "chapter_id", "topic_pos",
        F.col("n_items").cast("bigint").alias("n_items"),
        F.coalesce(F.col("n_issues"), F.lit(0)).cast("bigint").alias("n_issues"),
        quality_from_rank().alias("overall_quality"),
        F.coalesce(F.col("has_duplicates"), F.lit(False)).alias("has_duplicates"),
    )


def chapter_quality(topic_q: DataFrame) -> DataFrame:
    """Per chapter: total issues and the pass verdict.

    A chapter fails when any topic is rated poor or fair or has duplicates;
    the issue count itself does not decide.
    """
    return topic_q.groupBy("chapter_id").agg(
        F.count("*").cast("bigint").alias("n_topics"),
        F.sum("n_issues").cast("bigint").alias("total_issues"),
        F.bool_and(~F.col("overall_quality").isin("poor", "fair") & ~F.col("has_duplicates")).alias("overall_pass"),
    )


def coverage_cube(items: DataFrame) -> DataFrame:
    """Type x level counts per chapter with all sub-totals (GROUP BY chapter, CUBE(type, level))."""
    sets = [[F.col("chapter_id"), F.col("qtype"), F.col("bloom")], [F.col("chapter_id"), F.col("qtype")],
            [F.col("chapter_id"), F.col("bloom")], [F.col("chapter_id")]]
    return (items.groupingSets(sets, "chapter_id", "qtype", "bloom")
            .agg(F.count("*").cast("bigint").alias("n_items")))


def issue_rollup(issues: DataFrame) -> DataFrame:
    """Issue distribution by severity, then type, with sub-totals and grand total."""
    return (issues.rollup("severity", "issue_type")
            .agg(F.count("*").cast("bigint").alias("n_issues"), F.grouping_id().alias("gid")))


def chapter_topic_counts(items: DataFrame) -> DataFrame:
    """(chapter_id, n_topics, questions_per_level): 8 per level below 5 topics, else 5."""
    return (items.select("chapter_id", "topic_pos").distinct()
            .groupBy("chapter_id").agg(F.count("*").cast("bigint").alias("n_topics"))
            .withColumn("questions_per_level", F.when(F.col("n_topics") < 5, 8).otherwise(5)))


def coverage_gaps(items: DataFrame) -> DataFrame:
    """Cells of the (topic, type, level) grid whose item count is not the expected n.

    The 24-cell grid is generated per topic with ``explode`` of a literal
    array (no join), then matched to actual counts by an equi-join.
    """
    from ..schemas import BLOOMS, QTYPES
    grid = F.array(*[F.struct(F.lit(q).alias("qtype"), F.lit(b).alias("bloom"), F.lit(i + 1).alias("bloom_ord"))
                     for q in QTYPES for i, b in enumerate(BLOOMS)])
    topics = (items.select("chapter_id", "topic_pos").distinct()
              .join(chapter_topic_counts(items), "chapter_id")
              .select("chapter_id", "topic_pos", "questions_per_level", F.inline(grid)))
    actual = items.groupBy("chapter_id", "topic_pos", "qtype", "bloom").agg(F.count("*").alias("actual"))
    j = topics.join(actual, ["chapter_id", "topic_pos", "qtype", "bloom"], "left")
    return (j.select("chapter_id", "topic_pos", "qtype", "bloom",
                     F.col("questions_per_level").cast("bigint").alias("expected"),
                     F.coalesce("actual", F.lit(0)).cast("bigint").alias("actual"))
            .where("actual <> expected"))


def expected_volume(items: DataFrame) -> DataFrame:
    """Expected vs actual item volume per chapter (6 x n per type, 24 x n per topic, x6 with variations)."""
    actual = items.groupBy("chapter_id").agg(F.count("*").cast("bigint").alias("actual_items"))
    c = chapter_topic_counts(items).join(actual, "chapter_id")
    n = F.col("questions_per_level")
    return c.select(
        "chapter_id", "n_topics", F.col("questions_per_level").cast("bigint").alias("questions_per_level"),
        (n * 6).cast("bigint").alias("per_type"),
        (n * 24).cast("bigint").alias("per_topic"),
        (n * 24 * F.col("n_topics")).cast("bigint").alias("expected_items"),
        (n * 24 * F.col("n_topics") * 6).cast("bigint").alias("expected_with_variations"),
        "actual_items")

