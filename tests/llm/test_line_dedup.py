from quizmill.llm.line_dedup import remove_boilerplate

SCHEMA = "doc_id long, text string, source string"


def cleaned(spark, rows):
    return {r.doc_id: r.text for r in remove_boilerplate(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_blocks_and_blank_lines(spark):
    rows = [(k, f"site map\nhelp\n\nhead {k}\n\nshare this\n\ntail {k}\n\nterms\nprivacy\ncontact", f"s{k}") for k in range(8)]
    rows += [(100 + k, f"a {k}\n\nseven sites\n\nb {k}", f"s{k % 7}") for k in range(40)]
    got = cleaned(spark, rows)
    assert all(got[k] == f"\nhead {k}\n\n\ntail {k}\n" for k in range(8))
    assert all(got[d] == t for d, t, _ in rows if d >= 100)


def test_copies_switch_nothing_off(spark):
    rows = [(k, f"head {k}\nterms", f"s{k}") for k in range(12)] + [(1000 + k, "copied\n\nterms\nend", f"s{k % 30}") for k in range(200)]
    got = cleaned(spark, rows)
    assert got[3] == "head 3" and got[1007] == "copied\n\nend"


def test_copies_alone_stay(spark):
    rows = [(k, f"copy {k % 7}\nshared\nby all\n\nof them", f"s{k % 30}") for k in range(210)]
    assert cleaned(spark, rows) == {d: t for d, t, _ in rows}
