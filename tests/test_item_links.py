"""Issues that need other rows: near duplicates, level order, and an item's section."""

import itertools
import random

from quizmill.operators import extractive, quality
from quizmill.operators.components import components
from quizmill.functions import text as tx

ITEM = ("chapter_id long, topic_pos int, seq int, qtype string, bloom string, bloom_ord int, question string, options array<string>, answer string, "
        "explanation string, reference_answer string, reference_points array<string>, variations array<string>")


def items_of(spark, rows):
    """rows: (chapter, topic, seq, qtype, bloom_ord, question, extra dict)."""
    made = []
    for c, t, s, q, b, text, *more in rows:
        e = more[0] if more else {}
        made.append((c, t, s, q, "remember", b, text, e.get("options"), e.get("answer"), None, e.get("reference_answer"), e.get("points"), None))
    return spark.createDataFrame(made, ITEM).withColumn("terms", tx.words("question"))


def flagged(df):
    return sorted((r.chapter_id, r.topic_pos, r.seq) for r in df.collect())


def test_components_of_structs_and_chains(spark):
    edges = [((1, k), (1, k + 1)) for k in range(40)] + [((2, 5), (2, 3)), ((2, 9), (2, 3)), ((3, 1), (3, 1))]
    frame = spark.createDataFrame(edges, "a struct<x:int,y:int>, b struct<x:int,y:int>")
    got = {tuple(r.id): tuple(r.component) for r in components(frame, "t").collect()}
    assert got == {**{(1, k): (1, 0) for k in range(41)}, (2, 3): (2, 3), (2, 5): (2, 3), (2, 9): (2, 3)}


def test_random_components_against_search(spark):
    r = random.Random(2)
    edges = [(r.randrange(120), r.randrange(120)) for _ in range(90)]
    root = list(range(120))
    for _ in range(120):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    frame = spark.createDataFrame(edges, "a int, b int")
    got = {x.id: x.component for x in components(frame, "t").collect()}
    assert got == {k: root[k] for e in edges if e[0] != e[1] for k in e}


def test_near_duplicates_keep_the_first_of_a_chain(spark):
    """a ~ b ~ c, a and c unlike: one group.  Reordered words are a near duplicate, equal questions an exact one."""
    words = [f"w{k}" for k in range(12)]
    a, b, c = words[:10], words[:9] + ["x"], words[1:9] + ["x", "y"]
    rows = [(1, 0, 5, "MCQs", 1, " ".join(a)), (1, 0, 6, "MCQs", 1, " ".join(b)), (1, 0, 7, "MCQs", 1, " ".join(c)), (1, 0, 8, "MCQs", 1, " ".join(reversed(a))),
            (1, 0, 9, "MCQs", 1, " ".join(a)), (1, 1, 10, "MCQs", 1, " ".join(a)), (2, 0, 5, "MCQs", 1, " ".join(b)), (1, 0, 11, "MCQs", 1, "other words entirely here")]
    it = items_of(spark, rows)
    assert flagged(quality.duplicate_issues(it)) == [(1, 0, 9)]
    assert flagged(quality.near_duplicate_issues(it)) == [(1, 0, 6), (1, 0, 7), (1, 0, 8)]


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(8)
    rows = []
    for t in range(6):
        base = [[r.choice("abcdefghijklmnop") + str(k) for k in range(9)] for _ in range(3)]
        for s in range(14):
            w = list(r.choice(base))
            for _ in range(r.randint(0, 2)):
                w[r.randrange(9)] = r.choice("xyz") + str(r.randrange(9))
            rows.append((1, t, 14 * t + s, "MCQs", 1, " ".join(w)))
    wanted = []
    for t in range(6):
        mine = [(x[2], x[5]) for x in rows if x[1] == t]
        root = {s: s for s, _ in mine}
        for _ in mine:
            for (s, x), (u, y) in itertools.combinations(mine, 2):
                p, q = set(x.split()), set(y.split())
                if 5 * len(p & q) >= 4 * len(p | q):
                    root[s] = root[u] = min(root[s], root[u])
        seen = set()
        for s, x in mine:
            if root[s] != s and x not in seen:
                wanted.append((1, t, s))
            seen.add(x)
    assert flagged(quality.near_duplicate_issues(items_of(spark, rows))) == sorted(wanted)


def test_levels_out_of_order(spark):
    rows = [(1, 0, k, "MCQs", b, f"q {k}") for k, b in enumerate([1, 1, 3, 2, 4, 4, 3, 6])] + [(1, 1, k, "MCQs", b, f"q {k}") for k, b in enumerate([1, 2, 6])]
    rows += [(1, 0, 20, "short_answer", 6, "q"), (1, 0, 21, "short_answer", 1, "q")]
    assert flagged(quality.level_order_issues(items_of(spark, rows))) == [(1, 0, 3), (1, 0, 6), (1, 0, 21)]


def test_section_coverage_and_grounding(spark):
    sections = spark.createDataFrame([(1, 0, 0, "The cell wall holds water in."), (1, 0, 1, "Nothing asked"), (1, 1, 0, "!!"), (2, 0, 0, "far away")],
                                     "chapter_id long, topic_pos int, part_pos int, section string")
    it = items_of(spark, [(1, 0, 0, "MCQs", 1, "the cell wall holds water", {"options": ["In", "x"]}), (1, 0, 1, "MCQs", 1, "who built this house of stone"),
                          (1, 0, 2, "short_answer", 1, "far away"), (1, 1, 3, "MCQs", 1, "any words"), (3, 0, 4, "MCQs", 1, "no section"), (1, 0, 5, "MCQs", 1, "?!")])
    cover = {(r.chapter_id, r.topic_pos, r.part_pos): (r.n_terms, r.n_used, r.unused) for r in quality.section_coverage(it, sections).collect()}
    assert cover == {(1, 0, 0): (6, 6, False), (1, 0, 1): (2, 0, True), (2, 0, 0): (2, 0, True)}
    ground = quality.section_grounding(it, sections)
    assert {r.seq: (r.n_runs, r.n_found, r.ungrounded) for r in ground.collect()} == {0: (1, 1, False), 1: (2, 0, True), 2: (1, 0, True), 3: (1, 0, True)}
    assert flagged(quality.grounding_issues(ground)) == [(1, 0, 1), (1, 0, 2), (1, 1, 3)]


def test_every_sentence_of_a_chapter_with_four_key_words_has_options(spark):
    r = random.Random(1)
    sents = [f"{r.choice(['alpha', 'gamma', 'delta', 'omega', 'sigma'])} is n{k}." for k in range(30)]
    chapters = spark.createDataFrame([(1, sents), (2, ["one two.", "three four.", "five."]), (3, ["...", "word."]), (4, [])], "chapter_id long, l array<string>")
    got = extractive.extractive_items(chapters).collect()
    ring = list(dict.fromkeys(s.split()[0] for s in sents))
    for x in (g for g in got if g.chapter_id == 1):
        at = ring.index(x.answer)
        assert x.options == [ring[(at + k) % len(ring)] for k in range(4)]
        assert x.question.replace("_____", x.answer) == sents[x.seq]
    assert all(x.options is None for x in got if x.chapter_id > 1) and {x.seq for x in got if x.chapter_id == 3} == {1}


def test_open_items_have_no_structural_violation(spark):
    from pyspark.sql import functions as F
    from quizmill.operators import validate
    long_sentence = " ".join(["many"] * 25) + "."
    sents = [f"Term{k} explains part {k} of it." for k in range(12)] + [long_sentence, "Last one.", "Last one."]
    made = extractive.extractive_open_items(spark.createDataFrame([(1, sents), (2, ["Alone here."])], "chapter_id long, l array<string>"))
    rows = made.collect()
    assert {r.chapter_id for r in rows} == {1}
    for r in rows:
        if r.qtype == "short_answer":
            assert r.reference_answer == " ".join(sents[r.seq: r.seq + 2 + r.seq % 3]) and r.reference_points is None
        else:
            assert r.reference_points == sents[r.seq: r.seq + 3 + r.seq % 4] and 3 <= len(r.reference_points) <= 6 and long_sentence not in r.reference_points
    as_items = made.select("chapter_id", F.lit(0).alias("topic_pos"), "seq", "qtype", F.lit("remember").alias("bloom"), F.lit(1).alias("bloom_ord"), "question",
                           F.lit(None).cast("array<string>").alias("options"), F.lit(None).cast("string").alias("answer"), F.lit(None).cast("string").alias("explanation"),
                           "reference_answer", "reference_points", F.lit(None).cast("array<string>").alias("variations")).withColumn("terms", tx.words("question"))
    assert validate.item_violations(as_items).where(F.size("violations") > 0).count() == 0
    assert quality.rule_issues(as_items).where("rule like 'short%' or rule like 'long%' or rule = 'required_field_blank'").count() == 0


def test_whole_chapters_are_linked_once(spark):
    """Topics that aren't found share one copy of their chapter; shares and counts are those of the copied sections."""
    from quizmill.operators import corpus
    content = "# 1.1 Cells\nthe cell wall holds water in\n# 1.2 Roots\nroots drink from the ground below"
    content = spark.createDataFrame([(1, content), (2, "nothing here"), (3, "")], "chapter_id long, content string")
    matched = spark.createDataFrame([(1, ["1.1 Cells", "gone", "1.2 Roots", "lost", "missing"]), (2, ["here", "away"]), (3, ["x"])], "chapter_id long, topics array<string>")
    copied, linked = (f(content, matched).cache() for f in (corpus.topic_sections, corpus.linked_sections))
    whole = linked.where("topic_pos IS NULL")
    assert copied.where("strategy IS NULL").count() == 5 and sorted(r.chapter_id for r in whole.collect()) == [1, 2, 3]
    topics, parts = quality.linked(linked)
    again = topics.join(parts, ["chapter_id", "at"]).select("chapter_id", "topic_pos", "part_pos", "section")
    assert sorted(again.collect()) == sorted(copied.select("chapter_id", "topic_pos", "part_pos", "section").collect())
    it = items_of(spark, [(1, 0, 0, "MCQs", 1, "the cell wall holds water"), (1, 1, 1, "MCQs", 1, "roots drink from the ground"), (1, 2, 2, "MCQs", 1, "the cell wall holds water"),
                          (1, 3, 3, "MCQs", 1, "the cell wall holds dust"), (2, 1, 4, "MCQs", 1, "here"), (3, 0, 5, "MCQs", 1, "x y")])
    for f in (quality.section_coverage, quality.section_grounding):
        got = sorted(map(tuple, f(it, linked).collect()))
        assert got == sorted(map(tuple, f(it, copied).collect())) and got
