"""What a query moves and how often it works something out, by its plan; results on rows that repeat or hold nulls."""

from pyspark.sql import functions as F

from quizmill.operators import corpus, extractive, quality, responses
from quizmill.plans.registry import QUERIES
from quizmill.sources import views
from quizmill.sources.tables import dealt_by

SMOKE = "/root/testdata/sf0.001"


def _plan(df, optimized=False):
    q = df._jdf.queryExecution()
    return (q.optimizedPlan() if optimized else q.executedPlan()).toString()


def _docs(spark):
    text = "Cells hold water. Roots drink it! Leaves use light? Stems carry both. Seeds wait. Fruit ripens late."
    return spark.createDataFrame([(k, "bio", "en", text) for k in range(4)], "doc_id long, source string, lang string, text string")


def test_only_the_documents_move(spark):
    items = views.items(dealt_by(_docs(spark), "doc_id", "text"))
    parsed = responses.parse_sections(views.typed_responses(responses.nest_sections(items)))
    for made in (responses.chapter_assembly(responses.combine_sections(parsed)), responses.flatten_sections(parsed), quality.content_coverage(items)):
        assert _plan(made).count("Exchange") == 1


def test_queries_move_the_documents_once(spark):
    for name in ("combine_sections", "chapter_assembly", "parse_sections", "content_coverage", "extractive_open_items"):
        assert _plan(QUERIES[name](spark, SMOKE)).count("Exchange") == 1, name
    # banks meet their chapters, which are read without the text
    assert _plan(QUERIES["bank_export"](spark, SMOKE)).count("repartition_by") + _plan(QUERIES["bank_export"](spark, SMOKE)).count("REPARTITION_BY") == 1


def test_banks_and_entries_are_made_once(spark):
    assert "Generate" not in _plan(QUERIES["snapshot_rows"](spark, SMOKE), True)
    for name in ("available_labels", "explode_topics", "chapter_rejects"):
        assert "to_json" not in _plan(QUERIES[name](spark, SMOKE), True), name


def test_lists_are_worked_out_once(spark):
    """No filter or join condition repeats the search of topics or the splitting of a text."""
    content = spark.createDataFrame([(1, "# 1.1 Cells\nhold water")], "chapter_id long, content string")
    matched = spark.createDataFrame([(1, ["1.1 Cells"])], "chapter_id long, topics array<string>")
    for df in (corpus.topic_sections(content, matched), corpus.linked_sections(content, matched), views.items(_docs(spark)), quality.content_coverage(views.items(_docs(spark)))):
        for line in _plan(df, True).splitlines():
            assert not any(sign in line and step in line for sign in ("Join ", "Filter ") for step in ("instr(", "split(", "array_distinct(")), line


def test_chapters_that_come_twice(spark):
    """Every key word of a position meets every window of it; the least one is kept; chapters without an id give none."""
    rows = [(1, ["Alpha one.", "Beta two.", "Gamma three."]), (1, ["Zeta ones.", "Aaa two.", "Gamma three."]), (None, ["Lost here.", "Lost there."])]
    made = extractive.extractive_open_items(spark.createDataFrame(rows, "chapter_id long, l array<string>"))
    assert "Join" not in _plan(made)
    got = {(r.chapter_id, r.seq, r.qtype, r.question.split()[-1].strip("?")): r.reference_answer for r in made.collect() if r.qtype == "short_answer"}
    assert got == {(1, 0, "short_answer", "Alpha"): "Alpha one. Beta two.", (1, 0, "short_answer", "Zeta"): "Alpha one. Beta two.",
                   (1, 1, "short_answer", "Beta"): "Aaa two. Gamma three.", (1, 1, "short_answer", "Aaa"): "Aaa two. Gamma three."}


def test_content_coverage_of_nulls(spark):
    cols = "chapter_id long, topic_pos int, terms array<string>, options array<string>, answer string, reference_points array<string>"
    rows = [(1, 0, ["a", "b", None], ["a", None], None, None), (1, 0, ["b", "c"], None, "C", None), (1, 1, ["a"], None, None, [None]),
            (1, 2, None, ["a"], "b", None), (None, 0, ["a"], ["a"], None, None)]
    got = {(r.chapter_id, r.topic_pos): (r.n_content_terms, r.n_covered) for r in quality.content_coverage(spark.createDataFrame(rows, cols)).collect()}
    assert got == {(1, 0): (4, 2), (1, 1): (1, 0), (None, 0): (1, 0)}


def test_sections_of_two_levels_with_one_order(spark):
    cols = "chapter_id long, topic_pos int, qtype string, bloom_ord int, bloom string, seq int, question string, options array<string>, answer string, " \
           "explanation string, reference_answer string, reference_points array<string>, variations array<string>"
    rest = (None, None, None, None, None, None)
    rows = [(1, 0, "MCQs", 2, "apply", 3, "d", *rest), (1, 0, "MCQs", 1, "b", 2, "c", *rest), (1, 0, "MCQs", 1, "a", 1, "b", *rest),
            (1, 0, "MCQs", 1, "b", 0, "a", *rest), (1, 0, "MCQs", None, None, 9, "n", *rest)]
    made = responses.nest_sections(spark.createDataFrame(rows, cols)).select(F.from_json("raw", responses.SECTION_ANY)["MCQs"].alias("gs")).first().gs
    assert [(g.bloom_taxonomy, [q.question for q in g.questions]) for g in made] == [(None, ["n"]), ("a", ["b"]), ("b", ["a", "c"]), ("apply", ["d"])]
