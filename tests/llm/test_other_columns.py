"""Stages leave the user's own columns alone, whatever their names."""

import random

import pytest
from pyspark.sql import functions as F

from quizmill.llm import chosen_path, decontaminate, language, line_dedup

#: Names that the stages use inside, and names that need quoting.
NAMES = ["_lang", "_score", "_langs", "_fit", "_key", "_gone", "_gone_key", "_kept", "_lines", "_removed", "_node", "_words", "_hit", "_items", "_longest",
         "others", "th", "h", "line", "id", "site", "component_id", "a.b", "c`d"]


def documents(spark):
    r = random.Random(4)
    text = lambda: " ".join("".join(r.choice("aeioubcdlmnrst") for _ in range(r.randint(2, 9))) for _ in range(60))
    rows = [(k, text() + "\nfooter line", "en", f"s{k}", 400) for k in range(12)]
    rows += [(100, rows[0][1], "en", "s0", 400), (101, None, None, None, None), (102, "", "en", "x", 0)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return plain, plain.select("*", *[F.concat_ws("-", F.lit(n), F.col("doc_id")).alias(n) for n in NAMES])


STAGES = {"language": lambda spark, d: language.keep_identified(d), "lines": lambda spark, d: line_dedup.remove_boilerplate(d),
          "near": lambda spark, d: chosen_path.keep_one(d),
          "benchmark": lambda spark, d: decontaminate.decontaminate(d, spark.createDataFrame([(1, "footer line")], "item_id long, text string"))}


@pytest.mark.parametrize("stage", STAGES)
def test_columns_pass_unchanged(spark, stage):
    plain, more = documents(spark)
    wanted = sorted(map(tuple, STAGES[stage](spark, plain).collect()), key=repr)
    out = STAGES[stage](spark, more)
    assert out.columns == more.columns
    rows = out.collect()
    assert sorted((tuple(r)[:5] for r in rows), key=repr) == wanted
    assert all(list(tuple(r)[5:]) == [f"{n}-{r.doc_id}" for n in NAMES] for r in rows)
