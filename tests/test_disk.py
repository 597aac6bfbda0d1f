"""What the checks of items and sections write and move, by their plans."""

from quizmill import session
from quizmill.operators import quality, similarity
from quizmill.plans.registry import QUERIES
from quizmill.sources import views
from quizmill.sources.tables import dealt_by

SMOKE = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _staged(monkeypatch):
    seen = {}

    def staged(df, name):
        seen[name] = (df.columns, _plan(df))
        return session.staged(df, name)

    for m in (quality, similarity):
        monkeypatch.setattr(m, "staged", staged)
    return seen


def test_issues_write_no_texts_and_move_only_the_documents(spark, monkeypatch):
    seen = _staged(monkeypatch)
    text = "Cells hold water. Roots drink it! Cells hold water. Stems carry both. Seeds wait. Fruit ripens late in the dry year."
    docs = spark.createDataFrame([(k, "bio", "en", text) for k in range(4)], "doc_id long, source string, lang string, text string")
    got = quality.all_issues(views.items(dealt_by(docs, "doc_id", "text"))).where("issue_type = 'duplicate'").collect()
    assert sorted((r.chapter_id, r.seq, r.rule) for r in got) == [(k, 2, "exact_duplicate") for k in range(4)]
    assert set(seen) == {"ruled-items", "near-item-pairs", "near-items"}  # no sets, prefixes or candidates
    assert not {"question", "terms", "options", "explanation", "reference_answer", "reference_points", "variations", "k1"} & set(seen["ruled-items"][0])
    for name in ("ruled-items", "near-item-pairs"):
        assert seen[name][1].count("Exchange") == 1, name


def test_queries_over_issues_deal_the_documents_once_a_table(spark, monkeypatch):
    for query in ("item_issues", "item_verdicts", "topic_quality", "chapter_quality", "issue_rollup"):
        seen = _staged(monkeypatch)
        QUERIES[query](spark, SMOKE)
        assert [seen[name][1].count("Exchange") for name in ("ruled-items", "near-item-pairs")] == [1, 1], query


def test_sections_and_items_meet_where_their_documents_are(spark, monkeypatch):
    """No section, word or run is written or moved: of both sides only the documents are dealt, and the syllabus."""
    for query in ("section_coverage", "section_grounding"):
        seen = _staged(monkeypatch)
        plan = _plan(QUERIES[query](spark, SMOKE))
        assert seen == {}, query
        moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert len(moved) <= 3 and all("REPARTITION_BY" in line or "ENSURE" in line and "doc_id" not in line for line in moved), (query, moved)


def test_sections_of_repeated_and_missing_keys(spark):
    """Parts and items that come twice count twice, as before; what has no chapter or topic meets nothing."""
    sections = [(1, 0, 0, "the cell wall holds water"), (1, 0, 0, "the cell wall holds water"), (1, 1, 0, None), (None, 0, 0, "the cell wall"), (1, None, 0, "the cell"), (2, 0, 0, "x y")]
    sections = spark.createDataFrame(sections, "chapter_id long, topic_pos int, part_pos int, section string")
    items = [(1, 0, 3, "a", ["the", "cell", "wall", "holds", "water"]), (1, 0, 3, "a", ["the", "cell", "wall", "holds", "water", "in"]), (1, 0, 4, "a", []), (1, 0, None, "a", ["dry"]),
             (1, 1, 5, "a", ["the", "cell"]), (None, 0, 6, "a", ["the"]), (1, None, 7, "a", ["the"]), (3, 0, 8, "a", ["the"]), (2, 0, 9, "a", None)]
    items = spark.createDataFrame(items, "chapter_id long, topic_pos int, seq int, qtype string, terms array<string>").selectExpr(
        "*", "CAST(NULL AS array<string>) AS options", "CAST(NULL AS string) AS answer", "CAST(NULL AS string) AS reference_answer", "CAST(NULL AS array<string>) AS reference_points")
    cover = sorted((r.chapter_id, r.topic_pos, r.part_pos, r.n_terms, r.n_used) for r in quality.section_coverage(items, sections).collect())
    assert cover == [(1, 0, 0, 5, 10), (1, 0, 0, 5, 10), (2, 0, 0, 2, 0)]
    ground = sorted((r.seq or 0, r.n_runs, r.n_found) for r in quality.section_grounding(items, sections).collect())
    assert ground == [(0, 1, 0), (3, 1, 2), (3, 2, 2), (5, 1, 0)]
