"""Paths, syllabus matching and topic sections."""

from pyspark.sql import functions as F

from quizmill.functions.paths import chapter_info
from quizmill.operators import corpus


def test_path_metadata(spark):
    df = spark.createDataFrame([("/x/Sample/Class 8/Science/chapter 8",), ("/x/CBSE/Class 10/English/Maths/chapter 9",),
                                ("/x/Sample/CBSE/C/M/S/ch 3",), ("/x/none/Class 8/Sci/chapter 1",), ("/x/Sample/Class 8",)],
                               "path string")
    got = [r["i"] for r in df.select(chapter_info(F.col("path")).alias("i")).collect()]
    assert (got[0]["class_name"], got[0]["subject_name"], got[0]["chapter_name"], got[0]["chapter_number"]) == \
        ("Class 8", "Science", "chapter 8", "8")
    assert (got[1]["subject_name"], got[1]["chapter_name"]) == ("Maths", "chapter 9")
    assert (got[2]["class_name"], got[2]["subject_name"], got[2]["chapter_name"]) == ("C", "S", "ch 3")  # CBSE wins
    assert got[3]["error"].startswith("Could not find") and got[3]["class_name"] is None
    assert (got[4]["subject_name"], got[4]["chapter_name"]) == ("Unknown", "Unknown")


def _chapters(spark, rows):
    return spark.createDataFrame(
        [(i, "subj", d, d, n) for i, d, n in rows],
        "chapter_id bigint, subject_key string, dir_name string, chapter_name string, chapter_number string")


def _entries(spark, labels):
    import json
    rows = [("subj", pos, json.dumps(e)) for pos, e in enumerate(labels)]
    return corpus.parse_syllabus_entries(spark.createDataFrame(rows, "subject_key string, chapter_pos bigint, entry_json string"))


def test_syllabus_first_match_and_traps(spark):
    ch = _chapters(spark, [(1, "chapter 1", "1"), (9, "chapter 9", "9"), (5, "chapter 5", "5"), (7, "chapter 7", "7")])
    en = _entries(spark, [
        {"chapter": "unit: chapter 10!", "topics": ["a"]},   # contains 'chapter 1' -> wins for chapter 1 (trap)
        {"chapter": "1", "topics": ["b"]},
        {"Chapter": "09", "Topics": ["c"]},                    # '09' != '9'
        {"Chapter": "", "chapter": "Chapter 5", "topics": []}, # empty Chapter falls back; no topics
        {"chapter": "7", "Topics": ["d"], "topics": []},       # 'topics' key wins even if empty
    ])
    m = {r["chapter_id"]: (r["chapter_pos"], r["topics"]) for r in corpus.match_syllabus(ch, en).collect()}
    assert m[1] == (0, ["a"])
    assert 9 not in m
    assert m[5] == (3, [])
    assert m[7] == (4, [])
    rej = {r["chapter_id"]: r for r in corpus.chapter_rejects(ch, corpus.match_syllabus(ch, en)).collect()}
    assert rej[9]["reason"] == "not_in_syllabus" and rej[5]["reason"] == "no_topics"
    labels = corpus.available_labels(en, corpus.chapter_rejects(ch, corpus.match_syllabus(ch, en))).orderBy("chapter_pos").collect()
    assert [r["label"] for r in labels] == ["unit: chapter 10!", "1", "09", "Chapter 5", "7"]


def _sections(spark, content, topics):
    cc = spark.createDataFrame([(1, content)], "chapter_id bigint, content string")
    m = spark.createDataFrame([(1, topics)], "chapter_id bigint, topics array<string>")
    out = {}
    for r in sorted(corpus.topic_sections(cc, m).collect(), key=lambda r: r["part_pos"]):
        out.setdefault(r["topic"], []).append(r)
    return out


def test_topic_sections_strategies(spark):
    content = ("intro\n## 6.1 What Is It?\nbody one\n# 6.1.1 Sub\nsub body\n# 6.2 Next\nnext body\n"
               "plain 6.3 Plain Topic here\n# 6.4 Last\nLAST (a) part")
    s = {k: v[0] for k, v in _sections(spark, content, ["6.1 What Is It?", "6.3 Plain Topic", "9.9 last (a) PART", "7.7 Missing", "6.2 Next"]).items()}
    assert s["6.1 What Is It?"]["strategy"] == 1
    assert s["6.1 What Is It?"]["section"] == "## 6.1 What Is It?\nbody one"     # ends at the sub-heading
    assert s["6.3 Plain Topic"]["strategy"] == 3
    assert s["9.9 last (a) PART"]["strategy"] == 4                                # literal, case-insensitive
    assert s["7.7 Missing"]["strategy"] is None and s["7.7 Missing"]["section"] == content
    assert s["6.2 Next"]["section"].startswith("# 6.2 Next\nnext body")


def test_topic_sections_come_whole_in_parts(spark):
    body = "".join(chr(97 + k % 26) for k in range(7000))
    parts = _sections(spark, f"# 1.1 T\n{body}\n# 1.2 U\ny", ["1.1 T"])["1.1 T"]
    assert "".join(p["section"] for p in parts) == f"# 1.1 T\n{body}" and [len(p["section"]) for p in parts] == [3000, 3000, 1008]
    assert all(p["section_len"] == 7008 for p in parts)
    parts = _sections(spark, f"# 1.1 T{body}", ["1.1 T"])["1.1 T"]                  # no next heading: to the end
    assert "".join(p["section"] for p in parts) == f"# 1.1 T{body}"
    parts = _sections(spark, body, ["9.9 absent"])["9.9 absent"]                    # not found: the whole chapter
    assert "".join(p["section"] for p in parts) == body and parts[0]["strategy"] is None
