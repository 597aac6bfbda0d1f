import random

import corpus_pipeline
from quizmill.llm.language import keep_identified, learn, identify
from quizmill.llm.line_dedup import remove_boilerplate, widespread
from test_chosen_path import brute as near_brute
from test_decontaminate import brute as leak_brute


def corpus():
    r = random.Random(4)
    tongues = {"aa": ["lorem", "dolor", "sitam", "konse", "adipi"], "bb": ["wzqx", "grtsch", "pfund", "schlk", "krzt"]}
    line = lambda tongue, n: " ".join(r.choice(tongues[tongue]) + r.choice("aeiou") + r.choice(tongues[tongue]) for _ in range(n))
    docs, items = [], [(k, line("aa", 14)) for k in range(6)]
    for k in range(120):
        tongue = r.choice(["aa", "bb"])
        lines = [line(tongue, r.randint(6, 20)) for _ in range(r.randint(2, 6))]
        docs.append([k, lines, tongue, f"s{k % 12}"])
    for k in range(0, 40):  # a line on all sites, among different neighbours
        docs[k][1].insert(r.randint(0, 2), "read our terms of use")
    more = line("aa", 1)
    docs += [[200 + k, docs[50][1] + [more] * (k % 2), docs[50][2], f"s{k % 12}"] for k in range(20)]
    docs += [[300 + k, [line("aa", 9), items[k][1], line("aa", 9)], "aa", "s1"] for k in range(4)]
    rows = [(d, "\n".join(lines), lang, source, 1) for d, lines, lang, source in docs]
    rows += [(400, None, "aa", "s0", 0), (401, "", None, None, 0), (402, "12 34 !!", "aa", "s0", 8), (None, line("bb", 30), "bb", None, 1)]
    return rows, items


def test_stages_against_brute_force(spark, tmp_path):
    rows, items = corpus()
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).repartition(5).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/out{k}")
        docs = spark.read.parquet(f"{tmp_path}/out{k}")
        kept.append(docs.collect())
        assert k == 4 or set(docs.columns) == {"doc_id", "text", "lang", "source", "n_chars"}
    want = [tuple(x) for x in rows if x[0] not in (400, 401, 402)]
    assert sorted((tuple(r) for r in kept[0]), key=str) == sorted(want, key=str)
    bare = {d: "\n".join(x for x in t.split("\n") if x != "read our terms of use") for d, t, *_ in want}
    assert {r.doc_id: r.text for r in kept[1]} == bare
    assert all(r.n_chars == len(r.text) for r in kept[1] if r.doc_id in range(40))
    stays = {d for d, _, c in near_brute(sorted(bare.items(), key=str), 5, 80) if d is None or d == c}
    assert {r.doc_id for r in kept[2]} == stays and 50 in stays and len(stays) < len(bare)
    hits = leak_brute([(d, bare[d]) for d in stays], items)
    clean = {d for d in stays if not hits[d][4]}
    assert {r.doc_id for r in kept[3]} == clean and not clean & {300, 301, 302, 303}
    assert sum(r.length for r in kept[4]) == sum(len(bare[d].split()) + 1 for d in clean)
    ran = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(ran.collect(), key=str) == sorted(kept[4], key=str)


def test_language_on_held_out_and_odd_rows(spark):
    rows, _ = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", "'x' as score")
    langs, model = learn(docs)
    assert langs == ["aa", "bb"]
    got = identify(docs, langs, model).collect()
    assert all(r._lang == ("und" if r.doc_id in (400, 401, 402) else r.lang) and 0 <= r._score <= 1 for r in got)
    mixed = spark.createDataFrame([(1, rows[50][1] + " " + rows[51][1] + " ".join(x[1] for x in rows[52:60]))], "doc_id long, text string")
    assert set(identify(mixed, langs, model).first()._langs) == {"aa", "bb"}
    assert [r._lang for r in identify(docs.limit(3), *learn(docs.limit(0))).collect()] == ["und"] * 3
    assert keep_identified(docs.limit(0)).count() == 0


def test_line_dedup_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "a"), (1, "", "a"), (None, "\n\n x \n", None), (2, "x", "b"), (2, "x", "b")], "doc_id long, text string, source string")
    got = sorted((tuple(r) for r in remove_boilerplate(docs).collect()), key=str)
    assert got == sorted((tuple(r) for r in docs.collect()), key=str)
    many = spark.createDataFrame([(k, f"head {k}\nterms\ntail {k}", f"s{k}") for k in range(8)] + [(50 + k, "same\ncopied\nend", f"s{k}") for k in range(30)], docs.schema)
    assert widespread(many).count() == 1
    out = {r.doc_id: r.text for r in remove_boilerplate(many).collect()}
    assert out[3] == "head 3\ntail 3" and out[55] == "same\ncopied\nend"
    assert remove_boilerplate(docs.limit(0)).count() == 0
