import hashlib
import random
import re

import pytest

from quizmill.llm.decontaminate import ItemAutomaton, decontaminate, op5_suffix_automaton_decontamination, scan_documents, without_words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = []
    for i, t in items:
        w = words(t)
        windows += [(i, tuple(w[k:k + window])) for k in range(max(1, len(w) - window + 1))] if w else []
    out = {}
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for i, g in windows:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k:k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found.add(i)
        ids = ",".join(sorted(str(i) for i in found if i is not None))
        out[d] = (len(w), len(hit), len([i for i in found if i is not None]), hashlib.sha256(ids.encode()).hexdigest(), bool(hit))
    return out


def tables(seed):
    r = random.Random(seed)
    vocab = ["ab", "Ba", "é1", "x", "Y2"]
    text = lambda n: "".join(r.choice(vocab) + r.choice([" ", ", ", "\n"]) for _ in range(n))
    items = [(i, text(r.choice([3, 9, 10, 12, 25]))) for i in range(8)] + [(8, ""), (9, None), (9, text(14)), (None, text(11))]
    docs = [(d, text(r.randint(0, 60)) + r.choice([t or "" for _, t in items])[: r.randint(0, 200)] + text(5)) for d in range(40)]
    return docs + [(40, None), (41, "")], items


@pytest.mark.parametrize("seed, block", [(1, 100_000), (2, 40)])
def test_scan_matches_brute_force(spark, tmp_path, seed, block):
    docs, items = tables(seed)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = brute(docs, items)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in op5_suffix_automaton_decontamination(spark, str(tmp_path)).collect()}
    assert got == want
    blocks = scan_documents(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/benchmark.parquet"), block_words=block)
    assert {r.doc_id: (r._words, sum(b - a for a, b in r._hit)) for r in blocks.collect()} == {d: v[:2] for d, v in want.items()}


def test_longest_match_is_tracked_past_the_window():
    a = ItemAutomaton([("i", " ".join(f"w{k}" for k in range(30)))], 10)
    hits, found, longest = a.scan([f"w{k}".encode() for k in range(5, 25)])
    assert longest == 20 and found == {"i"} and min(hits)[0] == 0 and max(hits)[1] == 20


def test_spans_are_cut_or_documents_go(spark):
    item = "one two three four five six seven eight nine ten"
    docs = spark.createDataFrame([(1, f"Keep this. {item.upper()}! And that é.", 9, "x"), (2, "clean", 5, None), (3, None, None, "y")],
                                 "doc_id long, text string, n_chars long, item_id string")
    items = spark.createDataFrame([("a", item)], "item_id string, text string")
    assert {r.doc_id for r in decontaminate(docs, items).collect()} == {2, 3}
    cut = {r.doc_id: r for r in decontaminate(docs, items, max_coverage=0.9).collect()}
    assert cut[1].text == "Keep this. ! And that é." and cut[1].n_chars == 24 and cut[2].n_chars == 5
    assert decontaminate(docs, items).columns == docs.columns
    assert decontaminate(docs, items.limit(0)).count() == 3 and decontaminate(docs.limit(0), items).count() == 0


def test_without_words():
    assert without_words("a b c d", [[1, 3]]) == "a  d" and without_words(None, []) is None
