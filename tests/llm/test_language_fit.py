import random

from quizmill.llm.language import identify, keep_identified, learn


def test_unlearned_text_goes_and_mixtures_stay(spark):
    r = random.Random(9)
    tongues = {"aa": "lorem dolor sitam konse adipi", "bb": "wzqx grtsch pfund schlk krzt", "cc": "hyvä päivää yksi kaksi kolme"}
    line = lambda t, n: " ".join(r.choice(tongues[t].split()) + r.choice(tongues[t].split()) for _ in range(n))
    rows = [(k, line(t, 40), t) for k, t in enumerate(list(tongues) * 40)]
    odd = [(1000, " ".join("".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(60)), None),
           (1001, "это совсем другой язык которого никто здесь не учил " * 5, None)]
    mixed = [(2000 + k, " ".join(line(t, 30) for t in tongues), None) for k in range(4)]
    docs = spark.createDataFrame(rows + odd + mixed, "doc_id long, text string, lang string")
    got = {x.doc_id: x for x in identify(docs, *learn(docs)).collect()}
    assert all(got[d]._score < 0.4 and len(got[d]._langs) == 3 for d, *_ in mixed)
    assert {x.doc_id for x in keep_identified(docs).collect()} == {d for d, *_ in rows + mixed}
