"""End-to-end bank building (K10): all chapters at once, as one plan.

generate -> verify -> vary, expressed as DataFrames: syllabus match, topic
sections, typed section requests through a backend, parse/validate,
combine, rule-based verification, verification by a model with one report per
chapter, variation requests for items without variations, merge, nested export.
The model is whatever backends the caller passes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import corpus, infer, ledger, quality, requests, responses, rollup, verification
from ..session import staged
from ..schemas import QTYPES


def build_banks(chapters: DataFrame, entries: DataFrame, done: DataFrame | None = None,
                *, generate_backend, vary_backend, verify_backend=None, responses_ledger: str | None = None, model: str = "",
                partitions: int | None = None) -> dict[str, DataFrame]:
    """``chapters``: chapter_id, subject_key, class_name, subject_name,
    chapter_name, dir_name, chapter_number, content.  ``entries``: parsed
    syllabus entries.  ``done``: chapter_id of chapters already built.

    ``responses_ledger`` names a folder (see ``operators.ledger``) where every reply
    is recorded: a run that was stopped goes on from there, and one that is
    repeated asks nothing.  With ``verify_backend`` the items of each topic are
    verified by the model, too: ``verdicts``, ``verdict_entries`` and ``reports``.
    """
    def ask(asked, backend, **options):
        if responses_ledger is None:
            return infer.run_requests(asked, backend, partitions=partitions, **options)
        return ledger.ask(asked, backend, responses_ledger, model, partitions=partitions, **options)

    todo = chapters if done is None else chapters.join(done.select("chapter_id"), "chapter_id", "left_anti")
    # small (one row per chapter) and reused by four branches: written once
    matched = staged(corpus.match_syllabus(todo, entries), "matched")
    rejects = corpus.chapter_rejects(todo, matched)
    usable = matched.where(F.size("topics") > 0)
    sections = staged(corpus.topic_sections(todo.select("chapter_id", "content"), usable), "sections")
    meta = todo.select("chapter_id", "class_name", "subject_name", "chapter_name").join(
        usable.select("chapter_id", corpus.questions_per_level(F.size("topics")).alias("questions_per_level")),
        "chapter_id")
    reqs = requests.section_requests(sections, meta)
    res = ask(reqs.select("request_id", "chapter_id", "topic_pos", "part_pos", "prompt", "qtype", "topic", "section", "questions_per_level"),
              generate_backend, keep=["chapter_id", "topic_pos", "part_pos", "qtype"])
    parsed = staged(responses.parse_sections(res), "parsed")
    topics = responses.combine_sections(parsed)
    good = parsed.join(topics.where("topic_ok").select("chapter_id", "topic_pos"), ["chapter_id", "topic_pos"])
    flat = responses.flatten_sections(good)
    order = F.array_position(F.array(*[F.lit(q) for q in QTYPES]), F.col("qtype"))
    w = Window.partitionBy("chapter_id", "topic_pos").orderBy(order, "part_pos", "group_pos", "q_pos")
    names = sections.where("part_pos = 0").select("chapter_id", "topic_pos", "topic")
    items = (flat.withColumn("seq", F.col("topic_pos").cast("bigint") * (1 << 31) + F.row_number().over(w))
             .withColumn("terms", tx.words("question")).join(names, ["chapter_id", "topic_pos"]))
    items = staged(items, "items")
    issues = quality.all_issues(items, sections)
    topic_q = rollup.topic_quality(items, issues)
    chapter_q = rollup.chapter_quality(topic_q)
    generated = responses.bank_documents(items, meta)
    verified = {}
    if verify_backend is not None:
        checks = staged(requests.verification_requests(items), "verification-requests")
        replies = ask(checks, verify_backend, validator=infer.json_validator)
        verdicts = staged(verification.topic_verdicts(checks, replies), "verdicts")
        verified = {"verdicts": verdicts, "verdict_entries": verification.item_entries(verdicts, items),
                    "reports": verification.chapter_reports(verdicts, meta)}
    vreqs = requests.variation_requests(items)
    vres = ask(vreqs.select("request_id", "chapter_id", "seq", "qtype", "prompt", "question", "bloom"), vary_backend,
               validator=infer.json_validator, keep=["chapter_id", "seq", "qtype", "question"])
    varied = responses.merge_variations(items, responses.variation_results(vres))
    banks = responses.bank_documents(varied, meta)
    return {"matched": matched, "rejects": rejects, "sections": sections, "responses": res, "items": varied,
            "issues": issues, "topic_quality": topic_q, "chapter_quality": chapter_q, "generated_banks": generated, "banks": banks,
            "assembly": responses.chapter_assembly(topics), **verified}
