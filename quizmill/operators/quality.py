"""Deterministic quality rules over the flat item table.

The pipeline being rebuilt only *describes* these rules to a model; here
each rule is a boolean Column evaluated in one projection (no shuffle), and
violations become ``issues`` rows.  Rules that need other rows (duplicates,
keyword alignment) use aggregates and equi-joins, never windows over
unbounded keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schemas import BLOOM_KEYWORDS, MAX_POINTS, MIN_POINTS, N_VARIATIONS, REQUIRED_FIELDS
from ..session import sent_if_few, staged, unsent


def _arr(name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast("array<string>"))


def normalized_points() -> Column:
    """Long-answer points after the answer-outline normaliser (H6).

    Trimmed non-blank points; else the sentences of the legacy text; else an
    empty list (the record is rejected, I9).  None is cut: the count rule
    reports an excess.
    """
    return normalized(F.col("reference_points"), F.col("reference_answer"))[0]


def normalized(points: Column, answer: Column) -> tuple[Column, Column]:
    """(points, legacy text) after the normaliser: the text is cleared once it gave or gave way to points."""
    given = F.filter(F.transform(F.coalesce(points, F.array().cast("array<string>")), tx.py_strip), lambda x: x != "")
    text = F.coalesce(answer, F.lit(""))
    legacy = F.filter(F.transform(F.split(tx.py_strip(text), tx.SENTENCE_BREAK), tx.py_strip), lambda x: x != "")
    out = tx.let(given, lambda pts: F.when(F.size(pts) > 0, pts).otherwise(legacy))
    # there are points if any text is left, of the points or else between the sentences' breaks
    left = F.exists(F.coalesce(points, F.array().cast("array<string>")), lambda x: tx.py_strip(x) != "") | (F.size(legacy) > 0)
    return out, F.when(left, F.lit("")).otherwise(text)


def _n_sentences(col: str) -> Column:
    return F.size(tx.sentences(F.coalesce(F.col(col), F.lit(""))))


def _n_words(col: str) -> Column:
    return F.size(tx.words(F.coalesce(F.col(col), F.lit(""))))


def _blank(col: str) -> Column:
    return F.coalesce(F.length(tx.trim_ascii(F.col(col))) == 0, F.lit(True))


def _words(words: list[str]) -> Column:
    return F.array(*[F.lit(w) for w in words]).cast("array<string>")


# rule name, issue type, severity, predicate (True = violated), qtype scope
def item_rules() -> list[tuple[str, str, str, Column]]:
    mcq = F.col("qtype") == "MCQs"
    blank = F.col("qtype") == "fill_in_the_blanks"
    short = F.col("qtype") == "short_answer"
    long_ = F.col("qtype") == "long_answer"
    pts = F.col("points")
    varied = _arr("variations")
    own_words = _words([])
    for level, ws in BLOOM_KEYWORDS.items():
        own_words = F.when(F.col("bloom") == level, _words(ws)).otherwise(own_words)
    required_blank = F.lit(False)
    for qt, fields in REQUIRED_FIELDS.items():
        cond = F.lit(False)
        for f in fields:
            cond = cond | (F.size(_arr(f)) == 0 if f == "options" else _blank(f))
        required_blank = required_blank | ((F.col("qtype") == qt) & cond)
    return [
        ("mcq_answer_not_in_options", "incorrect", "critical",
         mcq & ~F.coalesce(F.array_contains(_arr("options"), F.col("answer")), F.lit(False))),
        ("mcq_options_not_four_distinct", "poor_quality", "high",
         mcq & (F.size(F.array_distinct(_arr("options"))) != 4)),
        ("mcq_all_none_of_above", "poor_quality", "medium",
         mcq & F.exists(_arr("options"), lambda x: F.lower(x).rlike("(all|none) of the above"))),
        ("mcq_explanation_length", "poor_quality", "low",
         mcq & ~_n_sentences("explanation").between(1, 2)),
        ("blank_marker_missing", "incorrect", "critical",
         blank & ~F.coalesce(F.col("question").contains("_____"), F.lit(False))),
        ("blank_answer_length", "poor_quality", "medium", blank & ~_n_words("answer").between(1, 3)),
        ("short_answer_length", "poor_quality", "medium", short & ~_n_sentences("reference_answer").between(2, 4)),
        ("long_answer_point_count", "poor_quality", "high", long_ & ~F.size(pts).between(MIN_POINTS, MAX_POINTS)),
        ("long_answer_point_too_long", "poor_quality", "medium",
         long_ & F.exists(pts, lambda x: F.size(tx.words(x)) >= 20)),
        ("long_answer_points_repeated", "poor_quality", "medium",
         long_ & (F.size(F.array_distinct(pts)) < F.size(pts))),
        ("required_field_blank", "unclear", "high", required_blank),
        ("mcq_options_not_uniform", "poor_quality", "low",
         mcq & (F.size(F.array_distinct(F.transform(_arr("options"), lambda x: x.rlike("[.!?]$")))) > 1)),
        ("level_keyword_mismatch", "poor_quality", "medium",
         F.arrays_overlap(F.col("terms"), _words([w for ws in BLOOM_KEYWORDS.values() for w in ws])) & ~F.arrays_overlap(F.col("terms"), own_words)),
        ("variations_not_five_unique", "poor_quality", "medium",
         (F.size(varied) > 0) & ((F.size(varied) != N_VARIATIONS) | (F.size(F.array_distinct(varied)) < F.size(varied))
                                 | F.coalesce(F.array_contains(varied, F.col("question")), F.lit(False)))),
        ("variation_shape_lost", "poor_quality", "medium",
         (blank & F.exists(varied, lambda x: ~x.contains("_____")))
         | (mcq & F.exists(varied, lambda x: F.size(F.split(F.regexp_extract(x, r"Options: ([^|]*)", 1), "; ")) != 4))),
    ]


def judged(items: DataFrame) -> DataFrame:
    """``items`` with the numbers of the rules (of ``item_rules``) that each violates in ``hits``."""
    df = items.withColumn("points", F.when(F.col("qtype") == "long_answer", normalized_points()))
    return df.withColumn("hits", F.array_compact(F.array(*[F.when(rule[-1], F.lit(k)) for k, rule in enumerate(item_rules())]))).drop("points")


def rule_issues(items: DataFrame) -> DataFrame:
    """One row per (item, violated rule)."""
    items = items if "hits" in items.columns else judged(items)
    rules = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(it).alias("issue_type"), F.lit(sev).alias("severity")) for name, it, sev, _ in item_rules()])
    return (tx.exploded(items, F.col("hits"), "hit", "chapter_id", "topic_pos", "qtype", "seq")
            .select("chapter_id", "topic_pos", "qtype", "seq", F.get(rules, F.col("hit")).alias("h"))
            .select("chapter_id", "topic_pos", "qtype", "seq", "h.rule", "h.issue_type", "h.severity"))


def duplicate_key() -> Column:
    """Key of exact duplicates: the words of a question, or its trimmed text where it has none."""
    return F.when(F.size("terms") > 0, F.array_join("terms", " ")).otherwise(tx.trim_ascii("question")).alias("norm")


def exact_duplicates(items: DataFrame) -> DataFrame:
    """Exact duplicate questions (normalised text) at corpus and topic scope.

    Keep the first occurrence, flag later ones.  Counts and first positions
    come from aggregates (map-side partial aggregation absorbs hot texts);
    only texts seen more than once are joined back, so the join side is
    small, and AQE splits a skewed text on the item side.
    """
    it = items.select("chapter_id", "topic_pos", "seq", "qtype", duplicate_key())
    corpus = (it.groupBy("norm")
              .agg(F.count("*").alias("n_corpus"), F.min(F.struct("chapter_id", "seq")).alias("first"))
              .where("n_corpus > 1"))
    topic = (it.groupBy("chapter_id", "topic_pos", "norm")
             .agg(F.count("*").alias("n_topic"), F.min("seq").alias("first_topic_seq")))
    j = it.join(corpus, "norm").join(topic, ["chapter_id", "topic_pos", "norm"])
    return j.select(
        "chapter_id", "topic_pos", "seq", "qtype",
        F.col("n_corpus").cast("bigint").alias("n_corpus"),
        F.col("first.chapter_id").alias("first_chapter_id"),
        F.col("first.seq").alias("first_seq"),
        F.col("n_topic").cast("bigint").alias("n_topic"),
        ((F.col("chapter_id") != F.col("first.chapter_id")) | (F.col("seq") != F.col("first.seq"))).alias("dup_in_corpus"),
        (F.col("seq") != F.col("first_topic_seq")).alias("dup_in_topic"),
    )


def repeated(items: DataFrame) -> DataFrame:
    """Key columns, those of ``RULED`` that ``items`` have, and ``repeats``: whether an item of the topic with a smaller seq has the same words.

    Texts are met by their digests, in a window over one topic.
    """
    from .similarity import digest
    own = [c for c in RULED if c in items.columns]
    it = items.select(*own, duplicate_key()).select(*own, *digest(F.col("norm")))
    first = F.min("seq").over(Window.partitionBy("chapter_id", "topic_pos", "k1", "k2"))
    known = F.col("chapter_id").isNotNull() & F.col("topic_pos").isNotNull() & F.col("k1").isNotNull()
    return it.withColumn("first", first).select(*own, F.coalesce(known & (F.col("seq") != F.col("first")), F.lit(False)).alias("repeats"))


def duplicate_issues(items: DataFrame) -> DataFrame:
    """Later exact duplicates inside a topic become critical duplicate issues."""
    return ((items if "repeats" in items.columns else repeated(items)).where("repeats")
            .select("chapter_id", "topic_pos", "qtype", "seq",
                    F.lit("exact_duplicate").alias("rule"), F.lit("duplicate").alias("issue_type"),
                    F.lit("critical").alias("severity")))


def near_duplicate_issues(items: DataFrame, ruled_items: DataFrame | None = None) -> DataFrame:
    """Later items of a group of near duplicates of a topic become high duplicate issues.

    Pairs with word sets of similarity 0.8 or more are links; of every connected
    group the first item stays.  An item that is an exact duplicate already is
    left to that rule.  ``ruled_items``: the same items as ``ruled`` gives them,
    read in place of ``items`` for all but their words.
    """
    from .components import components
    from .similarity import near_duplicate_items
    pairs = staged(near_duplicate_items(items), "near-item-pairs")
    key = lambda seq: F.struct("chapter_id", "topic_pos", F.col(seq).alias("seq"))
    groups = components(pairs.select(key("seq_a").alias("a"), key("seq_b").alias("b")), "near-items")
    it = items if ruled_items is None else ruled_items
    place = ["chapter_id", "topic_pos", "seq"]
    later = staged(groups.where("id <> component").select("id.*").join(unsent(duplicate_issues(it).select(*place)), place, "left_anti"), "near-items")
    return (it.select("chapter_id", "topic_pos", "qtype", "seq").join(sent_if_few(later), place, "left_semi")
            .select("chapter_id", "topic_pos", "qtype", "seq", F.lit("near_duplicate").alias("rule"), F.lit("duplicate").alias("issue_type"),
                    F.lit("high").alias("severity")))


def ordered(items: DataFrame) -> DataFrame:
    """``items`` with ``late``: whether an earlier item of the section has a higher level."""
    before = (Window.partitionBy("chapter_id", "topic_pos", "qtype").orderBy("seq", "bloom_ord")
              .rowsBetween(Window.unboundedPreceding, -1))
    top = F.greatest(F.max("bloom_ord").over(before), F.lit(0))  # skips nulls
    return items.withColumn("top", top).withColumn("late", F.coalesce(F.col("bloom_ord") < F.col("top"), F.lit(False))).drop("top")


def level_order_issues(items: DataFrame) -> DataFrame:
    """Items that stand behind an item of a higher level of their section.

    The highest level so far stands in a window over one section, i.e. one model
    call's output, in order of position.
    """
    return ((items if "late" in items.columns else ordered(items)).where("late")
            .select("chapter_id", "topic_pos", "qtype", "seq", F.lit("level_out_of_order").alias("rule"), F.lit("poor_quality").alias("issue_type"),
                    F.lit("low").alias("severity")))


#: Columns that the item rules read.
RULE_COLUMNS = ["chapter_id", "topic_pos", "seq", "qtype", "bloom", "bloom_ord", "question", "options", "answer", "explanation",
                "reference_answer", "reference_points", "variations", "terms"]
#: Those of them that issues show or verdicts read, and what the rules found.
RULED = ["chapter_id", "topic_pos", "seq", "qtype", "bloom_ord", "hits"]


def all_issues(items: DataFrame, sections: DataFrame | None = None) -> DataFrame:
    """Issues of every rule.  What rules, duplicates and order find is written once, without the items' texts.

    Items that are dealt by chapter (``tables.dealt_by``) stay where they are.  With ``sections`` (of ``corpus.topic_sections``) items that aren't grounded in
    their section are issues, too.
    """
    return issues_of(ruled(items), items, sections)


def ruled(items: DataFrame) -> DataFrame:
    """Key and level of the items, the rules they violate (``hits``), ``repeats`` and ``late``, written once."""
    return staged(ordered(repeated(judged(items.select(*RULE_COLUMNS)))), "ruled-items")


def issues_of(ruled_items: DataFrame, items: DataFrame, sections: DataFrame | None = None) -> DataFrame:
    """``all_issues`` of ``items`` that are ``ruled`` already."""
    issues = (rule_issues(ruled_items).unionByName(duplicate_issues(ruled_items)).unionByName(near_duplicate_issues(items, ruled_items))
              .unionByName(level_order_issues(ruled_items)))
    return issues if sections is None else issues.unionByName(grounding_issues(section_grounding(items, sections)))


def _lens(col: str) -> Column:
    return F.transform(F.col(col), lambda x: F.length(x))


def mcq_rules(items: DataFrame) -> DataFrame:
    """MCQ checks: answer among options, 4 distinct options, no all/none of
    the above, 1-2 sentence explanation, consistent option formatting."""
    return items.where("qtype = 'MCQs'").select(
        "chapter_id", "seq",
        F.coalesce(F.array_contains(_arr("options"), F.col("answer")), F.lit(False)).alias("answer_in_options"),
        (F.size(F.array_distinct(_arr("options"))) == 4).alias("four_distinct"),
        F.exists(_arr("options"), lambda x: F.lower(x).rlike("(all|none) of the above")).alias("all_none_of_above"),
        _n_sentences("explanation").cast("bigint").alias("explanation_sentences"),
        (F.array_max(_lens("options")) - F.array_min(_lens("options"))).cast("bigint").alias("option_len_spread"),
        (F.size(F.array_distinct(F.transform(_arr("options"), lambda x: x.rlike("[.!?]$")))) <= 1)
        .alias("punctuation_uniform"),
    )


def fill_blank_rules(items: DataFrame) -> DataFrame:
    """Blank marker present; answer of 1-3 words."""
    n = _n_words("answer")
    return items.where("qtype = 'fill_in_the_blanks'").select(
        "chapter_id", "seq",
        F.coalesce(F.col("question").contains("_____"), F.lit(False)).alias("has_marker"),
        n.cast("bigint").alias("answer_words"), n.between(1, 3).alias("answer_ok"))


def short_answer_rules(items: DataFrame) -> DataFrame:
    """Reference answer of 2-4 sentences."""
    n = _n_sentences("reference_answer")
    return items.where("qtype = 'short_answer'").select(
        "chapter_id", "seq", n.cast("bigint").alias("answer_sentences"), n.between(2, 4).alias("answer_ok"))


def long_answer_points(items: DataFrame) -> DataFrame:
    """Answer-outline normaliser (H6): points, cleared legacy text, reject flag."""
    pts = normalized_points()
    legacy_blank = F.length(tx.py_strip(F.coalesce(F.col("reference_answer"), F.lit("")))) == 0
    has_points = F.size(F.filter(F.transform(_arr("reference_points"), tx.py_strip), lambda x: x != "")) > 0
    return items.where("qtype = 'long_answer'").select(
        "chapter_id", "seq",
        F.array_join(pts, "\x1f").alias("points"),
        F.size(pts).cast("bigint").alias("n_points"),
        F.when(has_points | ~legacy_blank, F.lit("")).otherwise(F.coalesce(F.col("reference_answer"), F.lit("")))
        .alias("reference_answer"),
        (~has_points & legacy_blank).alias("rejected"),
    )


def long_answer_rules(items: DataFrame) -> DataFrame:
    """3-6 points, each under 20 words, all distinct."""
    df = items.where("qtype = 'long_answer'").withColumn("points", normalized_points())
    n = F.size("points")
    return df.select(
        "chapter_id", "seq", n.cast("bigint").alias("n_points"), n.between(MIN_POINTS, MAX_POINTS).alias("count_ok"),
        F.coalesce(F.array_max(F.transform("points", lambda x: F.size(tx.words(x)))), F.lit(0))
        .cast("bigint").alias("max_point_words"),
        (F.size(F.array_distinct("points")) == n).alias("points_distinct"),
    )


def bloom_alignment(items: DataFrame, keywords: DataFrame) -> DataFrame:
    """Level alignment by keyword list.

    Distinct question words meet the fixed keyword dimension in a broadcast
    join (36 rows, fixed size); an item is misaligned when it uses level
    keywords but none of its assigned level.  A keyword may name two levels;
    an item without any keeps a null ``aligned``.
    """
    toks = items.select("chapter_id", "seq", "bloom", F.explode(F.array_distinct("terms")).alias("keyword"))
    hits = toks.join(F.broadcast(keywords.select("keyword", F.col("bloom").alias("kw_bloom"))), "keyword")
    found = hits.groupBy("chapter_id", "seq").agg(
        F.array_join(F.array_sort(F.collect_set("kw_bloom")), ",").alias("keyword_levels"),
        F.array_join(F.array_sort(F.collect_set("keyword")), ",").alias("keywords"),
        F.max(F.col("kw_bloom") == F.col("bloom")).alias("aligned"))
    return items.select("chapter_id", "seq", "bloom").join(found, ["chapter_id", "seq"], "left").select(
        "chapter_id", "seq", "bloom", F.coalesce("keyword_levels", F.lit("")).alias("keyword_levels"),
        F.coalesce("keywords", F.lit("")).alias("keywords"), "aligned")


def question_index(items: DataFrame) -> DataFrame:
    """0-based index of an item inside its section (E1): level order, then
    position.  A section is one model call's output, so the window
    partition is bounded by the per-section item budget."""
    w = Window.partitionBy("chapter_id", "topic_pos", "qtype").orderBy("bloom_ord", "seq")
    return items.select("chapter_id", "topic_pos", "qtype", "seq",
                        (F.row_number().over(w) - 1).alias("question_index"))


def item_verdicts(items: DataFrame, issues: DataFrame) -> DataFrame:
    """Per item: issue count, worst severity and validity (no critical or
    high issue) joined back by item key (C5, J23)."""
    agg = issues.groupBy("chapter_id", "seq").agg(
        F.count("*").cast("bigint").alias("n_issues"),
        F.max(F.expr("CASE severity WHEN 'low' THEN 1 WHEN 'medium' THEN 2 WHEN 'high' THEN 3 "
                     "WHEN 'critical' THEN 4 END")).alias("worst"))
    j = question_index(items).join(agg, ["chapter_id", "seq"], "left")
    return j.select("chapter_id", "topic_pos", "qtype", "seq", "question_index",
                    F.coalesce("n_issues", F.lit(0)).cast("bigint").alias("n_issues"),
                    (F.coalesce("worst", F.lit(0)) < 3).alias("is_valid"))


_MARKS = "array<struct<term:string,shown:boolean,tested:boolean>>"


def content_coverage(items: DataFrame) -> DataFrame:
    """Share of a topic's distinct content terms that its answer keys test
    (options, answers, reference points) (J18).  Terms of both sides are marked
    and met in one aggregate on (topic, term); no join, no per-topic collection."""
    both = ["chapter_id", "topic_pos"]
    keyed = F.array_distinct(F.concat(
        F.coalesce(F.col("options"), F.array().cast("array<string>")),
        tx.words(F.coalesce(F.col("answer"), F.lit(""))),
        F.flatten(F.transform(F.coalesce(F.col("reference_points"), F.array().cast("array<string>")), tx.words))))
    marked = F.transform(F.array_distinct("terms"), lambda t: F.struct(t.alias("term"), F.lit(True).alias("shown"), F.lit(False).alias("tested")))
    tested = F.transform(keyed, lambda t: F.struct(t.alias("term"), F.lit(False).alias("shown"), F.lit(True).alias("tested")))
    none = F.array().cast(_MARKS)
    # a term that is in both lists of an item has a row of each
    terms = tx.exploded(items, F.concat(F.coalesce(marked, none), F.coalesce(tested, none)), "t", *both)
    terms = terms.select(*both, "t.*").groupBy(*both, "term").agg(F.max("shown").alias("shown"), F.max("tested").alias("tested")).where("shown")
    # equality never holds for a null
    j = terms.groupBy(*both).agg(F.count("*").alias("n_content_terms"), F.count_if(
        F.col("tested") & F.col("term").isNotNull() & F.col("chapter_id").isNotNull() & F.col("topic_pos").isNotNull()).alias("n_covered"))
    return j.select("chapter_id", "topic_pos", F.col("n_content_terms").cast("bigint"),
                    F.coalesce("n_covered", F.lit(0)).cast("bigint").alias("n_covered"),
                    F.round(F.coalesce("n_covered", F.lit(0)) / F.col("n_content_terms"), 6).alias("coverage"))


def grounding(passages: DataFrame, corpus_docs: DataFrame, k: int = 5) -> DataFrame:
    """Share of each passage's k-word shingles found anywhere in the corpus.

    Corpus shingles are deduplicated by a hash aggregate and the passage side
    is semi-joined against them; hot shingles cost one row each.
    """
    from .similarity import shingle_hashes, words_or_text
    p = (passages.select("item_id", words_or_text("text").alias("w")).where(F.size("w") > 0)
         .select("item_id", F.explode(shingle_hashes("w", k)).alias("h")))
    c = (corpus_docs.select(words_or_text("text").alias("w")).where(F.size("w") > 0)
         .select(F.explode(shingle_hashes("w", k)).alias("h")).distinct())
    found = p.join(c, "h", "left_semi").groupBy("item_id").agg(F.count("*").alias("n_found"))
    tot = p.groupBy("item_id").agg(F.count("*").alias("n_shingles"))
    j = tot.join(found, "item_id", "left")
    return j.select("item_id", F.col("n_shingles").cast("bigint"),
                    F.coalesce("n_found", F.lit(0)).cast("bigint").alias("n_found"),
                    F.round(F.coalesce("n_found", F.lit(0)) / F.col("n_shingles"), 6).alias("grounded_share"))


#: Shares below which a section counts as unused and an item as not grounded in its section.
LEAST_COVERED = 0.5
LEAST_GROUNDED = 0.5


def linked(sections: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(topics, parts) of sections: (chapter_id, topic_pos, at) and (chapter_id, at, part_pos, section).

    Sections come by topic, or as ``corpus.linked_sections`` gives them.
    """
    if "at" not in sections.columns:
        sections = sections.withColumn("at", F.col("topic_pos").cast("bigint"))
    topics = sections.where("topic_pos IS NOT NULL").select("chapter_id", "topic_pos", "at").distinct()
    return topics, sections.where("section IS NOT NULL").select("chapter_id", "at", "part_pos", "section")


def chapter_sections(sections: DataFrame, worked: Column) -> DataFrame:
    """(chapter_id, topics, parts): one row a chapter; ``topics`` are the different (topic_pos, at), ``parts`` (at, part_pos, made)
    with what ``worked`` makes of a part's words, the column ``w``.  ``sections`` as for ``linked``; a chapter is one document."""
    if "at" not in sections.columns:
        sections = sections.withColumn("at", F.col("topic_pos").cast("bigint"))
    known = sections.where("chapter_id IS NOT NULL").select("chapter_id", "topic_pos", "at", "part_pos", F.col("section").isNotNull().alias("has"), tx.words("section").alias("w"))
    known = known.select("chapter_id", F.when(F.col("topic_pos").isNotNull(), F.struct("topic_pos", "at")).alias("t"), F.when(F.col("has"), F.struct("at", "part_pos", worked.alias("made"))).alias("p"))
    return known.groupBy("chapter_id").agg(F.collect_set("t").alias("topics"), F.collect_list("p").alias("parts"))


def section_coverage(items: DataFrame, sections: DataFrame) -> DataFrame:
    """For each part of a topic's section: the share of its distinct words that the topic's items use.

    ``sections``: chapter_id, topic_pos, part_pos, section, or those of
    ``corpus.linked_sections``.  An item uses the words of its question, options,
    answer, reference answer and points.  The words of a part are cut once,
    however many topics share it.  Both sides meet chapter by chapter, so those
    that are dealt by chapter don't move.  ``unused`` marks parts below
    ``LEAST_COVERED``.
    """
    shown = F.flatten(F.array(
        "terms", *[tx.words(F.coalesce(F.col(c), F.lit(""))) for c in ("answer", "reference_answer")],
        *[F.flatten(F.transform(_arr(c), tx.words)) for c in ("options", "reference_points")]))
    used = (items.where("chapter_id IS NOT NULL AND topic_pos IS NOT NULL").select("chapter_id", "topic_pos", F.array_distinct(shown).alias("words"))
            .groupBy("chapter_id", "topic_pos").agg(F.array_distinct(F.flatten(F.collect_list("words"))).alias("words"))
            .groupBy("chapter_id").agg(F.collect_list(F.struct("topic_pos", "words")).alias("used")))
    chapters = chapter_sections(sections, F.array_distinct("w")).join(unsent(used), "chapter_id", "left")

    def met(part: Column, topic: Column) -> Column:
        words = F.get(F.filter("used", lambda u: u["topic_pos"] == topic["topic_pos"]), F.lit(0))["words"]
        both = F.size(F.array_intersect(part["made"], F.coalesce(words, F.array().cast("array<string>"))))
        return F.struct(topic["topic_pos"].alias("topic_pos"), part["at"].alias("at"), part["part_pos"].alias("part_pos"),
                        F.size(part["made"]).cast("bigint").alias("n_terms"), both.cast("bigint").alias("n_own"))

    worded = F.filter("parts", lambda p: F.size(p["made"]) > 0)
    rows = F.flatten(F.transform(worded, lambda p: F.transform(F.filter("topics", lambda t: t["at"] == p["at"]), lambda t: met(p, t))))
    rows = tx.exploded(chapters, rows, "r", "chapter_id").select("chapter_id", "r.*")
    # a part that comes twice is used twice
    n_used = F.sum("n_own").over(Window.partitionBy("chapter_id", "topic_pos", "part_pos", "at"))
    share = F.round(F.col("n_used") / F.col("n_terms"), 6)
    return (rows.withColumn("n_used", n_used)
            .select("chapter_id", "topic_pos", "part_pos", "n_terms", "n_used", share.alias("coverage"), (share < LEAST_COVERED).alias("unused")))


def section_grounding(items: DataFrame, sections: DataFrame, k: int = 5) -> DataFrame:
    """For each item of a topic with a section: the share of its question's k-word runs found in that section.

    ``sections`` as for ``section_coverage``; the runs of a part are made once,
    however many topics share it.  The runs of a topic's items meet those of its
    section in the chapter's row.  Items without words aren't judged.
    """
    from .similarity import shingle_hashes
    judged = items.where((F.size("terms") > 0) & F.col("chapter_id").isNotNull() & F.col("topic_pos").isNotNull())
    judged = (judged.select("chapter_id", "topic_pos", F.struct("qtype", "seq", shingle_hashes("terms", k).alias("hs")).alias("i"))
              .groupBy("chapter_id", "topic_pos").agg(F.collect_list("i").alias("its")))
    both = judged.withColumnRenamed("topic_pos", "pos").join(unsent(chapter_sections(sections, shingle_hashes("w", k))), "chapter_id")
    ats = F.transform(F.filter("topics", lambda t: t["topic_pos"] == F.col("pos")), lambda t: t["at"])
    own = tx.let(ats, lambda own: F.flatten(F.transform(F.filter("parts", lambda p: F.array_contains(own, p["at"])), lambda p: p["made"])))
    met = F.array_intersect(F.flatten(F.transform("its", lambda i: i["hs"])), own)
    rows = tx.let(met, lambda runs: F.transform("its", lambda i: F.struct(
        i["qtype"].alias("qtype"), i["seq"].alias("seq"), F.size(i["hs"]).cast("bigint").alias("n_runs"), F.size(F.array_intersect(i["hs"], runs)).cast("bigint").alias("n_own"))))
    both = both.where(F.exists("topics", lambda t: t["topic_pos"] == F.col("pos")))
    rows = tx.exploded(both, rows, "r", "chapter_id", "pos").select("chapter_id", F.col("pos").alias("topic_pos"), "r.*")
    # what comes twice under one key is found twice
    n_found = F.when(F.col("seq").isNotNull(), F.sum("n_own").over(Window.partitionBy("chapter_id", "topic_pos", "seq"))).otherwise(0)
    share = F.round(F.col("n_found") / F.col("n_runs"), 6)
    return rows.withColumn("n_found", n_found).select(
        "chapter_id", "topic_pos", "qtype", "seq", "n_runs", "n_found", share.alias("grounded_share"), (share < LEAST_GROUNDED).alias("ungrounded"))


def grounding_issues(grounded: DataFrame) -> DataFrame:
    """Items below ``LEAST_GROUNDED`` as issues."""
    return grounded.where("ungrounded").select("chapter_id", "topic_pos", "qtype", "seq", F.lit("not_grounded").alias("rule"),
                                               F.lit("incorrect").alias("issue_type"), F.lit("high").alias("severity"))
