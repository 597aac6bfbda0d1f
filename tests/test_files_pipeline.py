"""File sources, end-to-end build, sinks, snapshots and the incremental stream
(A1-A9, B1, D1-D4, K10, M1).  Fixtures are built in a fresh temp folder."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

import fakes
from quizmill.operators import corpus
from quizmill.plans.pipeline import build_banks
from quizmill.sinks import writers
from quizmill.sources import files
from quizmill.functions.paths import chapter_info

CONTENT = ("# 8.1 What Are Mixtures?\nA mixture has two or more substances. Air is a mixture of gases. "
           "Salt water is another mixture.\n# 8.2 Pure Substances\nA pure substance has one kind of particle. "
           "Gold is an element. Water is a compound.\n")


BACKENDS = {"generate_backend": fakes.extractive_backend, "vary_backend": fakes.template_backend}


def make_tree(root, n_chapters=2, start=8):
    subj = os.path.join(root, "Sample", "Class 8", "Science")
    os.makedirs(subj, exist_ok=True)
    with open(os.path.join(subj, "syllabus.json"), "w") as f:
        json.dump({"subject": "Science", "Chapters": [
            {"Chapter": str(start + i), "Title": f"T{i}", "Topics": ["8.1 What Are Mixtures?", "8.2 Pure Substances"]}
            for i in range(n_chapters + 2)]}, f)
    for i in range(n_chapters):
        add_chapter(subj, start + i)
    return subj


def add_chapter(subj, n):
    d = os.path.join(subj, f"chapter {n}")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "chapter_content.json"), "w") as f:
        json.dump({"chapter_name": f"Chapter {n}", "content": CONTENT}, f)
    pages = CONTENT.split("\n# ")
    with open(os.path.join(d, "llm_output.json"), "w") as f:
        json.dump([{"page_number": i, "page_content": (p if i == 0 else "# " + p)} for i, p in enumerate(pages)], f)
    with open(os.path.join(d, "topics.json"), "w") as f:
        json.dump({"chapter_name": "x", "total_topics": 0, "topics": []}, f)
    with open(os.path.join(d, "summary.json"), "w") as f:
        json.dump({"summary": {"short": "s", "detailed": "d"}}, f)


def chapters_from_files(spark, root):
    ch = files.find_chapters(spark, root)
    return (ch.withColumn("i", chapter_info(F.col("chapter_dir")))
            .select(F.xxhash64("chapter_dir").alias("chapter_id"), F.col("i.class_name"), F.col("i.subject_name"),
                    F.col("i.chapter_name"), F.col("i.dir_name"), F.col("i.chapter_number"),
                    F.regexp_replace("chapter_dir", "/[^/]*$", "").alias("subject_key"), "content"))


def test_file_sources(spark):
    root = tempfile.mkdtemp(prefix="qm-src-")
    subj = make_tree(root)
    ch = files.find_chapters(spark, root).collect()
    assert sorted(os.path.basename(r["chapter_dir"]) for r in ch) == ["chapter 8", "chapter 9"]
    only = files.find_chapters(spark, os.path.join(subj, "chapter 8")).collect()
    assert [os.path.basename(r["chapter_dir"]) for r in only] == ["chapter 8"]
    pages = files.read_pages(spark, root)
    combined = {os.path.basename(r["chapter_dir"]): r["content"]
                for r in corpus.combine_pages(pages, "chapter_dir", "page_number", "page_content").collect()}
    assert combined["chapter 8"] == CONTENT.replace("\n# ", "\n\n# ")
    topics = files.read_topics_files(spark, root).collect()
    assert len(topics) == 2 and all(t["topic"] is None for t in topics)     # empty lists kept (outer)
    assert {r["short"] for r in files.read_summaries(spark, root).collect()} == {"s"}
    ent = corpus.parse_syllabus_entries(files.read_syllabus_files(spark, root)).collect()
    assert [e["label"] for e in sorted(ent, key=lambda e: e["chapter_pos"])] == ["8", "9", "10", "11"]


def test_end_to_end_banks_and_sinks(spark):
    root = tempfile.mkdtemp(prefix="qm-e2e-")
    make_tree(root)
    ch = chapters_from_files(spark, root)
    entries = corpus.parse_syllabus_entries(files.read_syllabus_files(spark, root))
    out = build_banks(ch, entries, **BACKENDS)
    asm = out["assembly"].collect()
    assert len(asm) == 2 and all(r["total_topics"] == 2 for r in asm)
    items = out["items"]
    # 2 chapters x 2 topics x 4 types x 6 levels x 8 per level (fewer than 5 topics)
    assert items.count() == 2 * 2 * 4 * 6 * 8
    assert items.where(F.size("variations") != 5).count() == 0
    banks = out["banks"].collect()
    doc = json.loads(banks[0]["bank_json"])
    assert doc["total_topics"] == 2 and len(doc["topics"][0]["MCQs"]) == 6
    assert set(doc["topics"][0]["fill_in_the_blanks"][0]["questions"][0]) == {"question", "answer", "variations"}
    sink = tempfile.mkdtemp(prefix="qm-sink-")
    assert doc["topics"][0]["topic"] == "8.1 What Are Mixtures?"
    assert out["issues"].where("rule = 'exact_duplicate' or rule like 'mcq_option%'").count() == 0
    where = os.path.join(sink, "banks")
    writers.write_banks(out["banks"], where, "20240101")
    first = {r["chapter_id"]: r["bank_json"] for r in writers.read_latest(spark, where).collect()}
    assert first == {r["chapter_id"]: r["bank_json"] for r in banks}
    # a second run of one chapter leaves the other's bank readable, and a retried run replaces only itself
    again = out["banks"].where(F.col("chapter_id") == banks[0]["chapter_id"]).withColumn("bank_json", F.lit("{}"))
    for _ in range(2):
        writers.write_banks(again, where, "20240102")
    second = {r["chapter_id"]: r["bank_json"] for r in writers.read_latest(spark, where).collect()}
    assert second == {**first, banks[0]["chapter_id"]: "{}"}
    reports = out["chapter_quality"].join(ch.select("chapter_id", "class_name", "subject_name"), "chapter_id")
    writers.write_reports(reports, os.path.join(sink, "reports"), "20240101")
    assert writers.read_latest(spark, os.path.join(sink, "reports")).count() == 2
    snap = os.path.join(sink, "snap")
    for st in ["generated", "varied"]:
        writers.write_snapshots(writers.snapshot_rows(out["banks"],
                                                      st, F.to_timestamp(F.lit("2024-01-02 03:04:05"))), snap)
    s = spark.read.parquet(snap)
    assert s.count() == 4 and s.where("stage = 'varied'").first()["file_name"].endswith("_varied_20240102_030405.txt")


def test_flatten_nest_round_trip(spark):
    from quizmill.operators import responses
    from quizmill.sources import views
    docs = spark.createDataFrame([(1, "One two three. Four five six! Seven eight? Nine ten.", "en", "s")],
                                 "doc_id bigint, text string, lang string, source string")
    it = views.items(docs)
    flat = responses.flatten_sections(responses.parse_sections(responses.nest_sections(it)))
    a = {(r["qtype"], r["bloom"], r["question"]) for r in it.collect()}
    b = {(r["qtype"], r["bloom"], r["question"]) for r in flat.collect()}
    assert a == b


def test_bank_export_keeps_text_as_it_is(spark):
    from quizmill.operators import responses
    rows = [(1, 0, "T\u0085 (a)", 0, "short_answer", "remember", 1, "Q\x07\u0085?", None, None, None, "A```", None, [])]
    it = spark.createDataFrame(rows, "chapter_id bigint, topic_pos int, topic string, seq int, qtype string, bloom string, bloom_ord int, question string, "
                               "options array<string>, answer string, explanation string, reference_answer string, reference_points array<string>, variations array<string>")
    meta = spark.createDataFrame([(1, "c", "s", "n")], "chapter_id bigint, class_name string, subject_name string, chapter_name string")
    doc = json.loads(responses.bank_documents(it, meta).first()["bank_json"])
    assert doc["topics"][0]["topic"] == "T\u0085 (a)" and doc["topics"][0]["MCQs"] is None
    assert doc["topics"][0]["short_answer"][0]["questions"][0] == {"question": "Q\x07\u0085?", "reference_answer": "A```", "variations": []}


def test_incremental_equals_batch(spark):
    from quizmill.streaming.incremental import incremental_ingest
    root = tempfile.mkdtemp(prefix="qm-stream-")
    subj = make_tree(root, n_chapters=1)
    out = tempfile.mkdtemp(prefix="qm-out-")
    ck = tempfile.mkdtemp(prefix="qm-ck-")

    def process(df):
        return df.select("chapter_dir", F.length("content").alias("n"))
    incremental_ingest(spark, root, out, ck, process)
    add_chapter(subj, 9)
    incremental_ingest(spark, root, out, ck, process)
    got = spark.read.parquet(out)
    assert got.count() == 2 and got.select("batch_id").distinct().count() == 2
    batch = process(files.find_chapters(spark, root)).collect()
    assert sorted(r["chapter_dir"] for r in got.collect()) == sorted(r["chapter_dir"] for r in batch)


def test_end_to_end_skips_done_chapters(spark):
    root = tempfile.mkdtemp(prefix="qm-skip-")
    make_tree(root)
    ch = chapters_from_files(spark, root)
    entries = corpus.parse_syllabus_entries(files.read_syllabus_files(spark, root))
    done = ch.where(F.col("dir_name") == "chapter 8").select("chapter_id")
    out = build_banks(ch, entries, done=done, **BACKENDS)
    names = {json.loads(r["bank_json"])["chapter_name"] for r in out["banks"].collect()}
    assert names == {"chapter 9"}


def test_end_to_end_verification_and_resuming(spark):
    """The model's verdicts come back as one report per chapter; a second run finds every reply in the ledger."""
    root, where = tempfile.mkdtemp(prefix="qm-verify-"), tempfile.mkdtemp(prefix="qm-ledger-") + "/replies"
    make_tree(root)
    ch = chapters_from_files(spark, root)
    entries = corpus.parse_syllabus_entries(files.read_syllabus_files(spark, root))
    out = build_banks(ch, entries, **BACKENDS, verify_backend=fakes.verdict_backend, responses_ledger=where)
    reports = {r["chapter_id"]: r for r in out["reports"].collect()}
    assert len(reports) == 2 and all(r["n_topics"] == 2 and r["n_failed"] == 0 for r in reports.values())
    report = json.loads(next(iter(reports.values()))["report_json"])
    assert report["topic_verifications"][0]["topic"].endswith("What Are Mixtures?")
    assert out["verdict_entries"].where("seq IS NULL").count() == 0
    sink = tempfile.mkdtemp(prefix="qm-reports-")
    writers.write_reports(out["reports"], sink, "20240101")
    assert writers.read_latest(spark, sink).count() == 2

    def silent():
        def call(batch, attempt):
            raise OSError("asked again")
        return call
    again = build_banks(ch, entries, generate_backend=silent, vary_backend=silent, verify_backend=silent, responses_ledger=where)
    assert {r["bank_json"] for r in again["banks"].collect()} == {r["bank_json"] for r in out["banks"].collect()}
    assert {r["report_json"] for r in again["reports"].collect()} == {r["report_json"] for r in reports.values()}


def test_a_run_stopped_between_two_writes_changes_nothing(spark, monkeypatch):
    """Three snapshots, two bank writes, one mark; readers see the former bank until the mark is there."""
    root, store = tempfile.mkdtemp(prefix="qm-run-"), tempfile.mkdtemp(prefix="qm-store-")
    make_tree(root)
    ch = chapters_from_files(spark, root)
    entries = corpus.parse_syllabus_entries(files.read_syllabus_files(spark, root))
    out = build_banks(ch, entries, **BACKENDS, verify_backend=fakes.verdict_backend)
    at = lambda text: F.to_timestamp(F.lit(text))
    assert writers.write_run(out, store, at("2024-01-02 03:04:05")) == "20240102_030405"
    read = lambda part="banks": {r["chapter_id"]: r["bank_json" if part == "banks" else "report_json"] for r in writers.read_finished(spark, store, part).collect()}
    former = read()
    assert former == {r["chapter_id"]: r["bank_json"] for r in out["banks"].collect()} and len(read("reports")) == 2
    snaps = spark.read.parquet(f"{store}/snapshots")
    assert {(r["stage"], r["run_ts"]): r["count"] for r in snaps.groupBy("stage", "run_ts").count().collect()} == {
        (s, "20240102_030405"): 2 for s in ("generated", "verified", "varied")}

    changed = {**out, "banks": out["banks"].withColumn("bank_json", F.lit("{}"))}
    whole = writers.write_snapshots

    def stopped(rows, where, repeated=False):
        if rows.first()["stage"] == "varied":
            raise KeyboardInterrupt
        whole(rows, where, repeated)
    monkeypatch.setattr(writers, "write_snapshots", stopped)
    with pytest.raises(KeyboardInterrupt):
        writers.write_run(changed, store, at("2024-01-03 00:00:00"))
    assert read() == former
    monkeypatch.setattr(writers, "write_snapshots", whole)
    writers.write_run(changed, store, at("2024-01-03 00:00:00"))
    assert set(read().values()) == {"{}"}
    assert spark.read.parquet(f"{store}/snapshots").count() == 12
