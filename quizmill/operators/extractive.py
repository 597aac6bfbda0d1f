"""Offline backends expressed as Columns: stem-template variations (K7) and
items cut from the text itself (K6).

Five stems per level; each stem carries that level's keyword so the result
passes the keyword-alignment rule.  The stems are our own wording.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..schemas import BLOOMS

STEMS = {
    "remember": ["Define the idea in: {q}", "List the facts stated in: {q}", "Identify the key term in: {q}",
                 "Name the concept behind: {q}", "State what is said in: {q}"],
    "understand": ["Explain in your words: {q}", "Summarize the point of: {q}", "Paraphrase: {q}",
                   "Classify the idea in: {q}", "Interpret the meaning of: {q}"],
    "apply": ["Apply this idea to a new case: {q}", "Demonstrate with an example: {q}", "Solve using: {q}",
              "Use this to decide: {q}", "Illustrate with a case: {q}"],
    "analyze": ["Analyze the parts of: {q}", "Contrast two readings of: {q}", "Distinguish the causes in: {q}",
                "Examine the reasons for: {q}", "Categorize the elements of: {q}"],
    "evaluate": ["Evaluate the claim: {q}", "Judge how sound this is: {q}", "Critique: {q}",
                 "Defend or reject: {q}", "Assess the strength of: {q}"],
    "create": ["Design a task based on: {q}", "Construct an example of: {q}", "Develop a plan from: {q}",
               "Formulate a question about: {q}", "Propose a change to: {q}"],
}


def stems_for(level: Column) -> Column:
    m = F.create_map(*[x for b in BLOOMS for x in (F.lit(b), F.array(*[F.lit(s) for s in STEMS[b]]))])
    return F.element_at(m, level)


def template_variations(items: DataFrame) -> DataFrame:
    """Five variations per item: the level's stems with the question filled in."""
    v = F.transform(stems_for(F.col("bloom")), lambda s: F.replace(s, F.lit("{q}"), F.col("question")))
    return items.select("chapter_id", "seq", "qtype", "bloom", "question", v.alias("variations"))


def _keyed_sentences(chapters: DataFrame) -> DataFrame:
    """(chapter_id, seq, sentence, answer): every sentence that holds a word, with its longest word, the first of several."""
    rows = chapters.select("chapter_id", F.posexplode("l").alias("seq", "sentence"))
    return _with_answer(rows).select("chapter_id", "seq", "sentence", "answer").where("answer is not null")


def _with_answer(rows: DataFrame) -> DataFrame:
    """``answer``: the longest word of ``sentence``, the first of several; null without a word."""
    longest = F.array_min(F.transform("ws", lambda w, i: F.struct((-F.length(w)).alias("size"), i.alias("i"), w.alias("w"))))["w"]
    return rows.withColumn("ws", F.regexp_extract_all("sentence", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))).withColumn("answer", longest).drop("ws")


def extractive_items(chapters: DataFrame) -> DataFrame:
    """Blank and choice items from every sentence of a chapter (K6).

    ``chapters``: chapter_id, l (its sentences).  The key word of a sentence is
    its answer and is masked in the question.  The different key words of a
    chapter, by first appearance, form a ring; choices are the answer and the
    next three of the ring, so every sentence of a chapter with four key words
    has them (null in a chapter with fewer).  Equal questions of a chapter come
    once, at their first sentence; sentences without a word give none.  The ring
    is ordered by a window over one chapter's different key words.
    """
    rows = _keyed_sentences(chapters)
    ring = rows.groupBy("chapter_id", "answer").agg(F.min("seq").alias("at"))
    chapter = Window.partitionBy("chapter_id")
    ordered = chapter.orderBy("at")
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ring = ring.select("chapter_id", "answer", (F.row_number().over(ordered) - 1).alias("rank"), F.count("*").over(chapter).alias("size"),
                       F.array(*[F.lead("answer", k).over(ordered) for k in (1, 2, 3)]).alias("next"),
                       F.array(*[F.nth_value("answer", k).over(whole) for k in (1, 2, 3)]).alias("start"))
    # what lies behind the end of the ring is at its start
    nth = [F.when(F.col("rank") + k < F.col("size"), F.col("next")[k - 1]).otherwise(F.get("start", (F.col("rank") + k - F.col("size")).cast("int"))) for k in (1, 2, 3)]
    ring = ring.select("chapter_id", "answer", F.when(F.col("size") >= 4, F.array("answer", *nth)).alias("options"))
    at = F.instr(F.col("sentence"), F.col("answer"))
    question = F.concat(F.substring("sentence", F.lit(1), at - 1), F.lit("_____"), F.substring("sentence", at + F.length("answer"), F.length("sentence")))
    firsts = (rows.select("chapter_id", question.alias("question"), F.struct("seq", "answer").alias("one"))
              .groupBy("chapter_id", "question").agg(F.min("one").alias("one")).select("chapter_id", "one.seq", "question", "one.answer"))
    return firsts.join(ring, ["chapter_id", "answer"]).select("chapter_id", "seq", "question", "answer", "options")


#: Questions of items cut from several sentences; ``{key}`` is the key word of the first one.
SHORT_QUESTION = "In a few sentences, what does the text say about {key}?"
LONG_QUESTION = "Set out the points that the text makes from {key} on."


def extractive_open_items(chapters: DataFrame) -> DataFrame:
    """Short and long items from windows of a chapter's sentences (K6).

    A sentence begins a short item with the 2 to 4 sentences from it on as its
    reference answer, and a long one with the 3 to 6 sentences from it on as its
    points (2 + seq % 3 and 3 + seq % 4 of them, fewer at the chapter's end), if
    there are enough.  Points have fewer than 20 words and differ, else there is
    no long item.  Equal questions of a type come once, at their first sentence.

    Windows and key word of a position come from one row.  Where a chapter comes
    in several rows, the key words of a position meet its least windows: no other
    can be the first of its question.
    """
    windows = F.transform("l", lambda x, i: F.struct(i.alias("seq"), x.alias("sentence"), F.slice("l", i + 1, 2 + i % 3).alias("some"), F.slice("l", i + 1, 3 + i % 4).alias("points")))
    rows = _with_answer(tx.exploded(chapters.where("chapter_id IS NOT NULL"), windows, "x", "chapter_id").select("chapter_id", "x.*"))
    fine = (F.size("points") >= 3) & (F.size(F.array_distinct("points")) == F.size("points")) & F.forall("points", lambda p: F.size(tx.words(p)) < 20)
    rows = (rows.select("chapter_id", "seq", "answer", F.when(F.size("some") >= 2, F.array_join("some", " ")).alias("some"), F.when(fine, F.col("points")).alias("points"))
            .groupBy("chapter_id", "seq").agg(F.collect_set("answer").alias("answers"), F.min("some").alias("some"), F.min("points").alias("points"))
            .select("chapter_id", "seq", F.explode("answers").alias("answer"), "some", "points"))
    none = F.lit(None).cast("array<string>")
    short = F.when(F.col("some").isNotNull(), F.struct(F.lit("short_answer").alias("qtype"), F.replace(F.lit(SHORT_QUESTION), F.lit("{key}"), F.col("answer")).alias("question"),
                                                              F.col("some").alias("reference_answer"), none.alias("reference_points")))
    long_ = F.when(F.col("points").isNotNull(), F.struct(F.lit("long_answer").alias("qtype"), F.replace(F.lit(LONG_QUESTION), F.lit("{key}"), F.col("answer")).alias("question"),
                                                               F.lit("").alias("reference_answer"), F.col("points").alias("reference_points")))
    made = rows.select("chapter_id", "seq", F.explode(F.array(short, long_)).alias("it")).where("it is not null")
    return (made.groupBy("chapter_id", "it.qtype", "it.question").agg(F.min(F.struct("seq", "it.reference_answer", "it.reference_points")).alias("one"))
            .select("chapter_id", "one.seq", "qtype", "question", "one.reference_answer", "one.reference_points"))
