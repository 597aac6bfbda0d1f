"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Each query reads the driver tables (or views Spark derives from them) in
full; there are no id subsets or row caps.  Array results are rendered as
strings joined by the unit separator (chr 31) so that results hash the same
way on every engine.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import quality, rollup
from ..sources import views
from ..sources.tables import dealt, dealt_by, table

SEP = "\x1f"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def joined(col: str, alias: str | None = None):
    return F.array_join(F.col(col), SEP).alias(alias or col)


def _docs(spark, sf):
    return dealt(table(spark, sf, "documents"), "text")


def _keyed_docs(spark, sf):
    """Documents by doc_id, for queries that group what they derive from a document."""
    return dealt_by(table(spark, sf, "documents"), "doc_id", "text")


def _items(spark, sf):
    return views.items(_docs(spark, sf))


def _keyed_items(spark, sf):
    return views.items(_keyed_docs(spark, sf))


@register("sentences")
def q_sentences(spark, sf):
    return views.sentence_rows(_docs(spark, sf))


@register("items")
def q_items(spark, sf):
    it = _items(spark, sf)
    return it.select("chapter_id", "topic_pos", "seq", "qtype", "bloom", "bloom_ord", "question",
                     joined("options"), "answer", "explanation", "reference_answer",
                     joined("reference_points"), joined("variations"))


@register("exact_duplicates")
def q_exact_duplicates(spark, sf):
    return quality.exact_duplicates(_items(spark, sf))


@register("item_issues")
def q_item_issues(spark, sf):
    return quality.all_issues(_keyed_items(spark, sf))


@register("topic_quality")
def q_topic_quality(spark, sf):
    items = _keyed_items(spark, sf)
    it = quality.ruled(items)
    return rollup.topic_quality(it, quality.issues_of(it, items))


@register("chapter_quality")
def q_chapter_quality(spark, sf):
    items = _keyed_items(spark, sf)
    it = quality.ruled(items)
    return rollup.chapter_quality(rollup.topic_quality(it, quality.issues_of(it, items)))


@register("combine_pages")
def q_combine_pages(spark, sf):
    from ..operators import corpus
    return corpus.combine_pages(table(spark, sf, "conversations"), "conv_id", "turn", "text")


@register("structural_violations")
def q_structural_violations(spark, sf):
    from ..operators import validate
    return validate.structural_counts(_items(spark, sf))


@register("coverage_cube")
def q_coverage_cube(spark, sf):
    return rollup.coverage_cube(_items(spark, sf))


@register("issue_rollup")
def q_issue_rollup(spark, sf):
    return rollup.issue_rollup(quality.all_issues(_keyed_items(spark, sf)))


@register("coverage_gaps")
def q_coverage_gaps(spark, sf):
    return rollup.coverage_gaps(_items(spark, sf))


@register("expected_volume")
def q_expected_volume(spark, sf):
    return rollup.expected_volume(_items(spark, sf))


@register("mcq_rules")
def q_mcq_rules(spark, sf):
    return quality.mcq_rules(_items(spark, sf))


@register("fill_blank_rules")
def q_fill_blank_rules(spark, sf):
    return quality.fill_blank_rules(_items(spark, sf))


@register("short_answer_rules")
def q_short_answer_rules(spark, sf):
    return quality.short_answer_rules(_items(spark, sf))


@register("long_answer_rules")
def q_long_answer_rules(spark, sf):
    return quality.long_answer_rules(_items(spark, sf))


@register("long_answer_points")
def q_long_answer_points(spark, sf):
    return quality.long_answer_points(_items(spark, sf))


def _responses(spark, sf):
    return views.raw_responses(_items(spark, sf))


@register("clean_responses")
def q_clean_responses(spark, sf):
    from ..operators import responses
    df = responses.clean_and_parse(_responses(spark, sf))
    return df.select("chapter_id", "seq", "cleaned", F.col("parsed").isNotNull().alias("parsed_ok"))


@register("normalize_variations")
def q_normalize_variations(spark, sf):
    from ..operators import responses
    df = responses.variation_results(_responses(spark, sf))
    return df.select("chapter_id", "seq", F.array_join("norm", SEP).alias("normalized"),
                     F.size("norm").cast("bigint").alias("n_normalized"))


@register("pad_variations")
def q_pad_variations(spark, sf):
    from ..operators import responses
    df = responses.variation_results(_responses(spark, sf))
    return df.select("chapter_id", "seq", joined("new_variations", "variations"))


@register("variation_rules")
def q_variation_rules(spark, sf):
    from ..operators import responses
    return responses.variation_rules(responses.variation_results(_responses(spark, sf)))


@register("variation_tally")
def q_variation_tally(spark, sf):
    from ..operators import responses
    it = _items(spark, sf)
    return responses.variation_tally(it, responses.variation_results(views.raw_responses(it)))


@register("merge_variations")
def q_merge_variations(spark, sf):
    from ..operators import responses
    it = _items(spark, sf)
    res = responses.variation_results(views.raw_responses(responses.needs_variations(it)))
    m = responses.merge_variations(it, res)
    return m.select("chapter_id", "seq", joined("variations"))


# --- corpus preparation ------------------------------------------------------

def _matched(spark, sf):
    """Syllabus entries and matched ones, each written once: entries are parsed once, and
    joins that ask for labels only do not read the topics."""
    from ..operators import corpus
    from ..session import staged
    docs = _docs(spark, sf)
    entries = staged(corpus.parse_syllabus_entries(views.syllabus_entries(docs)), "entries")
    return docs, entries, staged(corpus.match_syllabus(views.chapters(table(spark, sf, "documents")), entries), "matched")


@register("path_metadata")
def q_path_metadata(spark, sf):
    from ..functions.paths import chapter_info
    return views.chapter_paths(_docs(spark, sf)).select("chapter_id", "path", chapter_info(F.col("path")).alias("i")) \
        .select("chapter_id", "path", "i.*")


@register("syllabus_scan")
def q_syllabus_scan(spark, sf):
    from ..operators import corpus
    e = corpus.parse_syllabus_entries(views.syllabus_entries(_docs(spark, sf)))
    return e.select("subject_key", "chapter_pos", "label", "title", joined("topics"), "shown_label")


@register("syllabus_match")
def q_syllabus_match(spark, sf):
    from ..operators import corpus
    _, _, m = _matched(spark, sf)
    n = F.size("topics")
    return m.select("chapter_id", "chapter_pos", "label", n.cast("bigint").alias("n_topics"),
                    corpus.questions_per_level(n).cast("bigint").alias("questions_per_level"))


@register("chapter_rejects")
def q_chapter_rejects(spark, sf):
    from ..operators import corpus
    _, _, m = _matched(spark, sf)
    return corpus.chapter_rejects(views.chapters(table(spark, sf, "documents")), m).select("chapter_id", "reason")


@register("available_labels")
def q_available_labels(spark, sf):
    from ..operators import corpus
    _, entries, m = _matched(spark, sf)
    return corpus.available_labels(entries, corpus.chapter_rejects(views.chapters(table(spark, sf, "documents")), m))


@register("explode_topics")
def q_explode_topics(spark, sf):
    from ..operators import corpus
    _, _, m = _matched(spark, sf)
    return corpus.explode_topics(m)


@register("topic_sections")
def q_topic_sections(spark, sf):
    from ..operators import corpus
    _, _, m = _matched(spark, sf)
    s = corpus.topic_sections(views.headed_chapters(_keyed_docs(spark, sf)), m)
    return s.select("chapter_id", "topic_pos", "topic", "strategy", "start",
                    F.col("section_len").cast("bigint").alias("section_len"), "part_pos", "section")


# --- run bookkeeping ---------------------------------------------------------

def _done(spark, sf):
    """Chapters with an existing output: the ``labels`` table (an empty
    output file where quality = 0)."""
    return table(spark, sf, "labels").select(F.col("doc_id").alias("chapter_id"),
                                             (F.col("quality") == 0).alias("output_empty"))


@register("skip_processed")
def q_skip_processed(spark, sf):
    from ..operators import runs
    ch = _docs(spark, sf).select(F.col("doc_id").alias("chapter_id"), F.col("source").alias("subject_key"))
    return runs.skip_processed(ch, _done(spark, sf))


@register("content_default")
def q_content_default(spark, sf):
    from ..operators import runs
    docs = _docs(spark, sf)
    folders = docs.select(F.col("doc_id").alias("chapter_id"))
    files = docs.join(table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi") \
        .select(F.col("doc_id").alias("chapter_id"), F.col("text").alias("content"))
    return runs.content_default(folders, files).select(
        "chapter_id", F.length("content").cast("bigint").alias("content_len"), "missing_file")


@register("failed_topics")
def q_failed_topics(spark, sf):
    from ..operators import runs
    return runs.failed_topics(_items(spark, sf))


@register("run_summary")
def q_run_summary(spark, sf):
    from ..operators import corpus, runs
    docs, entries, m = _matched(spark, sf)
    chs = views.chapters(docs)
    it = views.items(docs)
    status = runs.chapter_status(chs, _done(spark, sf), corpus.chapter_rejects(chs, m),
                                 runs.failed_topics(it), it)
    return runs.run_summary(status)


# --- request tables ----------------------------------------------------------

def _prompt_digest(df, *keys):
    return df.select(*keys, F.length("prompt").cast("bigint").alias("prompt_len"),
                     F.md5("prompt").alias("prompt_md5"))


@register("section_requests")
def q_section_requests(spark, sf):
    from ..operators import corpus, requests
    _, _, m = _matched(spark, sf)
    sections = corpus.topic_sections(views.headed_chapters(_keyed_docs(spark, sf)), m)
    meta = (views.chapters(table(spark, sf, "documents")).select("chapter_id", "class_name", F.col("subject_key").alias("subject_name"),
                                        "chapter_name")
            .join(m.select("chapter_id", corpus.questions_per_level(F.size("topics")).alias("questions_per_level")),
                  "chapter_id"))
    return _prompt_digest(requests.section_requests(sections, meta), "request_id", "chapter_id", "topic_pos", "part_pos", "qtype")


@register("verification_requests")
def q_verification_requests(spark, sf):
    from ..operators import requests
    r = requests.verification_requests(_items(spark, sf))
    return _prompt_digest(r, "request_id", "chapter_id", "topic_pos", "n_items")


@register("variation_requests")
def q_variation_requests(spark, sf):
    from ..operators import requests
    return _prompt_digest(requests.variation_requests(_items(spark, sf)), "request_id", "chapter_id", "seq", "qtype")


# --- typed responses and banks ----------------------------------------------

def _parsed_sections(spark, sf):
    from ..operators import responses
    return responses.parse_sections(views.typed_responses(responses.nest_sections(_keyed_items(spark, sf))))


@register("strict_types")
def q_strict_types(spark, sf):
    from ..operators import responses, validate
    r = views.typed_responses(responses.nest_sections(_keyed_items(spark, sf)))
    return validate.strict_type_violations(r).select("chapter_id", "topic_pos", "qtype", F.col("type_errors").cast("bigint").alias("type_errors"))


@register("verdict_enums")
def q_verdict_enums(spark, sf):
    from ..operators import validate
    v = validate.verdict_enum_violations(views.verification_replies(_items(spark, sf)))
    return v.select("request_id", F.col("bad_issue_types").cast("bigint").alias("bad_issue_types"),
                    F.col("bad_severities").cast("bigint").alias("bad_severities"), "bad_quality")


@register("parse_sections")
def q_parse_sections(spark, sf):
    p = _parsed_sections(spark, sf)
    return p.select("chapter_id", "topic_pos", "qtype", F.coalesce(F.size("groups"), F.lit(0)).cast("bigint").alias("n_groups"),
                    F.coalesce("reason", F.lit("")).alias("reason"))


@register("flatten_bank")
def q_flatten_bank(spark, sf):
    from ..operators import responses
    from ..session import staged
    # sections that are no typed record at all have no items
    typed = F.coalesce("reason", F.lit("")).isin("no_json", "no_section", "wrong_type", "unknown_level")
    # written once: a filter on the reason would be pushed below the parsing and do all of it a second time
    f = responses.flatten_sections(staged(_parsed_sections(spark, sf), "parsed").where(~typed))
    return f.select("chapter_id", "topic_pos", "qtype", "bloom", "bloom_ord", "group_pos", "q_pos", "question",
                    joined("options"), "answer", "explanation", "reference_answer", joined("reference_points"),
                    joined("variations"), (F.col("group_pos") + 1 == F.col("bloom_ord")).alias("level_order_ok"))


@register("combine_sections")
def q_combine_sections(spark, sf):
    from ..operators import responses
    return responses.combine_sections(_parsed_sections(spark, sf))


@register("chapter_assembly")
def q_chapter_assembly(spark, sf):
    from ..operators import responses
    return responses.chapter_assembly(responses.combine_sections(_parsed_sections(spark, sf)))


@register("bank_export")
def q_bank_export(spark, sf):
    from ..operators import responses
    meta = views.chapters(table(spark, sf, "documents")).select("chapter_id", "class_name", F.col("subject_key").alias("subject_name"),
                                       "chapter_name")
    b = responses.bank_documents(_keyed_items(spark, sf), meta)
    return b.select("chapter_id", "class_name", "subject_name", F.length("bank_json").cast("bigint").alias("json_len"),
                    F.md5("bank_json").alias("json_md5"))


# --- near duplicates ---------------------------------------------------------

@register("near_duplicates")
def q_near_duplicates(spark, sf):
    from ..operators import similarity
    return similarity.near_duplicate_documents(_docs(spark, sf))


@register("near_duplicate_items")
def q_near_duplicate_items(spark, sf):
    from ..operators import similarity
    return similarity.near_duplicate_items(_keyed_items(spark, sf))


# --- alignment, verdicts, template variations --------------------------------

@register("bloom_alignment")
def q_bloom_alignment(spark, sf):
    """Alignment of stem-templated items; every fifth item takes its stem
    from the next level (planted misalignment)."""
    from ..functions import text as tx
    from ..operators import extractive
    from ..schemas import BLOOMS, bloom_keywords_df
    it = _items(spark, sf)
    lvl = F.element_at(F.array(*[F.lit(b) for b in BLOOMS]),
                       ((F.col("bloom_ord") - 1 + F.when(F.col("seq") % 5 == 0, 1).otherwise(0)) % 6 + 1).cast("int"))
    stem = F.element_at(extractive.stems_for(lvl), (F.col("seq") % 5 + 1).cast("int"))
    t = it.select("chapter_id", "seq", "bloom", F.replace(stem, F.lit("{q}"), F.col("question")).alias("text"))
    return quality.bloom_alignment(t.withColumn("terms", tx.words("text")), bloom_keywords_df(spark))


@register("question_index")
def q_question_index(spark, sf):
    return quality.question_index(_items(spark, sf))


@register("item_verdicts")
def q_item_verdicts(spark, sf):
    items = _keyed_items(spark, sf)
    it = quality.ruled(items)
    return quality.item_verdicts(it, quality.issues_of(it, items))


@register("template_variations")
def q_template_variations(spark, sf):
    from ..operators import extractive
    t = extractive.template_variations(_items(spark, sf))
    return t.select("chapter_id", "seq", joined("variations"))


@register("extractive_items")
def q_extractive_items(spark, sf):
    from ..operators import extractive
    chapters = views.sentence_lists(_docs(spark, sf)).select(F.col("doc_id").alias("chapter_id"), "l")
    return extractive.extractive_items(chapters).select("chapter_id", "seq", "question", "answer", joined("options"))


@register("extractive_open_items")
def q_extractive_open_items(spark, sf):
    from ..operators import extractive
    chapters = views.sentence_lists(_keyed_docs(spark, sf)).select(F.col("doc_id").alias("chapter_id"), "l")
    t = extractive.extractive_open_items(chapters)
    return t.select("chapter_id", "seq", "qtype", "question", "reference_answer", joined("reference_points"))


@register("combined_requests")
def q_combined_requests(spark, sf):
    """Combined per-topic prompts; topics are the item view's blocks, their
    sentences the content, and the topic's own earlier questions the
    do-not-repeat list."""
    from ..operators import requests
    it = _items(spark, sf)
    topics = (it.groupBy("chapter_id", "topic_pos", "topic", "source", "lang")
              .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "question"))),
                                            lambda x: x["question"]), " ").alias("content"))
              .select("chapter_id", "topic_pos", "topic", "content", F.col("lang").alias("class_name"),
                      F.col("source").alias("subject_name"),
                      F.concat(F.lit("chapter "), F.col("chapter_id").cast("string")).alias("chapter_name"),
                      F.lit(5).alias("questions_per_level")))
    prev = it.select("chapter_id", "topic_pos", "seq", "question")
    return _prompt_digest(requests.combined_requests(topics, prev), "request_id", "chapter_id", "topic_pos")


# --- ledger and verification report -------------------------------------------

MODEL = "reviewer-1"


@register("pending_requests")
def q_pending_requests(spark, sf):
    """Verification requests still to be asked, given what earlier runs recorded."""
    from ..operators import ledger, requests
    from ..session import staged
    asked = staged(requests.verification_requests(_items(spark, sf)).select("request_id", "chapter_id", "topic_pos", "prompt"), "asked")
    rows = ledger.best_replies(views.ledger_rows(asked, MODEL))
    todo = ledger.pending(asked.withColumn("prompt_digest", ledger.prompt_digest(F.col("prompt"), MODEL)), rows)
    return todo.select("request_id", "prompt_digest", "reason")


def _verdicts(spark, sf):
    """(items, chapters, topic verdicts) of the planted verification replies; the verdicts are written once."""
    from ..operators import verification
    from ..session import staged
    docs = _docs(spark, sf)
    it = staged(views.items(docs).select("chapter_id", "topic_pos", "topic", "seq", "qtype", "bloom_ord"), "verified-items")
    topics = it.select("chapter_id", "topic_pos", "topic").distinct().withColumn(
        "request_id", F.concat_ws(":", F.lit("verify"), F.col("chapter_id").cast("string"), F.col("topic_pos").cast("string")))
    chapters = views.chapters(docs).select("chapter_id", "class_name", F.col("subject_key").alias("subject_name"), "chapter_name")
    return it, chapters, staged(verification.topic_verdicts(topics, views.verification_replies(it)), "verdicts")


@register("verification_report")
def q_verification_report(spark, sf):
    from ..operators import verification
    _, chapters, verdicts = _verdicts(spark, sf)
    r = verification.chapter_reports(verdicts, chapters)
    return r.select("chapter_id", "n_topics", "n_failed", "total_issues", "overall_pass",
                    F.length("report_json").cast("bigint").alias("json_len"), F.md5("report_json").alias("json_md5"))


@register("verification_topics")
def q_verification_topics(spark, sf):
    from ..operators import verification
    return verification.topic_totals(_verdicts(spark, sf)[2])


@register("verification_entries")
def q_verification_entries(spark, sf):
    from ..operators import verification
    it, _, verdicts = _verdicts(spark, sf)
    e = verification.item_entries(verdicts, it)
    return e.select("chapter_id", "topic_pos", "qtype", "question_index", "seq", "is_valid", F.size("issues").cast("bigint").alias("n_issues"),
                    F.get("issues", F.lit(0))["severity"].alias("severity"), "suggestion")


# --- snapshots ---------------------------------------------------------------

RUN_TS = "2024-01-02 03:04:05"


@register("snapshot_rows")
def q_snapshot_rows(spark, sf):
    from ..schemas import STAGES
    from ..sinks import writers
    from ..operators import responses
    from ..session import staged
    meta = views.chapters(table(spark, sf, "documents")).select("chapter_id", "class_name", F.col("subject_key").alias("subject_name"), "chapter_name")
    # written once for all stages
    banks = staged(responses.bank_documents(_keyed_items(spark, sf), meta), "banks")
    ts = F.to_timestamp(F.lit(RUN_TS))
    rows = None
    for st in STAGES:
        r = writers.snapshot_rows(banks, st, ts).withColumn("chapter_id", F.col("chapter_name"))
        rows = r if rows is None else rows.unionByName(r)
    return rows.select("chapter_id", "stage", "run_ts", "file_name", "header",
                       F.length("payload").cast("bigint").alias("payload_len"), F.md5("payload").alias("payload_md5"))


@register("content_coverage")
def q_content_coverage(spark, sf):
    return quality.content_coverage(_keyed_items(spark, sf))


def _sections(spark, sf):
    """(items, sections): the item view and the linked sections of the headed chapters, both by chapter and topic, dealt by chapter."""
    from ..operators import corpus
    _, _, m = _matched(spark, sf)
    docs = _keyed_docs(spark, sf)
    return views.items(docs), corpus.linked_sections(views.headed_chapters(docs), m)


@register("section_coverage")
def q_section_coverage(spark, sf):
    return quality.section_coverage(*_sections(spark, sf))


@register("section_grounding")
def q_section_grounding(spark, sf):
    return quality.section_grounding(*_sections(spark, sf))


@register("grounding")
def q_grounding(spark, sf):
    return quality.grounding(table(spark, sf, "benchmark"), _docs(spark, sf))
