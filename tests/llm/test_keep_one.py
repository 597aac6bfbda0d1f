import random

from quizmill.llm.chosen_path import keep_one


def test_one_row_of_each_group(spark):
    r = random.Random(5)
    text = lambda: " ".join("".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(40))
    a, b, c, e = text(), text(), text(), text()
    rows = [(1, a, "x"), (1, a, "x"), (1, a, "x"), (2, a + " more", "x"), (3, a, "y"), (3, b, "y"), (None, c, "z"), (None, c, "z"),
            (None, b + " more", "z"), (None, b + " most", "z"), (7, e, "x"), (7, e, "x"), (8, "", "x"), (8, "", "x"), (None, None, "x"), (None, None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = keep_one(docs)
    assert got.columns == docs.columns
    of_b = [x.text for x in got.collect() if x.doc_id is None and x.text and x.text.startswith(b)]
    assert len(of_b) == 1  # beside row 3
    want = [(None, of_b[0], "z"), (1, a, "x"), (3, b, "y"), (None, c, "z"), (7, e, "x"), (8, "", "x"), (8, "", "x"), (None, None, "x"), (None, None, "x")]
    assert sorted((tuple(x) for x in got.collect()), key=str) == sorted(want, key=str)
