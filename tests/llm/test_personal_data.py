import hashlib
import random
import re

import numpy as np

from quizmill.llm.personal_data import (
    FEATURES, KINDS, _gradient, base_spans, candidates, decode, features, luhn, op10_semi_markov_personal_data, rewritten, spans_of, train,
    training_zones, zones)


def plain(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= sum(x in "0123456789" for x in m.group()) <= 15]


def test_base_is_leftmost_non_overlapping():
    r = random.Random(3)
    for _ in range(5000):
        t = "".join(r.choice("a@.1 23+-()45678x9%é") for _ in range(r.randint(0, 70)))
        assert base_spans(t) == plain(t), t
    assert base_spans("9" * 200_000) == [] and base_spans("a" * 200_000) == []


def test_query_and_model(spark, tmp_path):
    r = random.Random(5)
    card = "4387513035237269"
    def text(k):
        words = " ".join(r.choice(["alpha", "beta", "gamma", "room 12", "in 1999"]) for _ in range(12))
        return f"{words} mail u{k}.x@mail{k % 7}.example.com or +1 (988) 555-{1000 + k} from 10.0.{k % 250}.7 card {card} {words}"
    docs = [(k, text(k)) for k in range(60)] + [(60, None), (61, ""), (None, "nothing 5 here"), (62, "tel 1.2.3.400")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = op10_semi_markov_personal_data(spark, str(tmp_path)).collect()
    assert len(got) == len(docs)
    for row, (d, t) in zip(sorted(got, key=lambda x: (x.doc_id is None, x.doc_id)), sorted(docs, key=lambda x: (x[0] is None, x[0]))):
        base = plain(t or "")
        assert [row[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in base) for k in KINDS]
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert row.base_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert set(filter(None, said.split(","))) <= set(row.spans.split(","))
    weights = train(spark.read.parquet(f"{tmp_path}/documents.parquet"))
    found = wanted = 0
    for k in range(100, 130):  # forms that no base pattern takes
        plain_text = text(k)
        t, moved = rewritten(plain_text, base_spans(plain_text), r)
        want = {s for s in moved if s not in plain(t)}
        found += len(want & set(spans_of(t, weights)[1]))
        wanted += len(want)
    assert wanted > 60 and found > 0.9 * wanted
    assert spans_of("in 1999 room 12, 3 of 4; version 2.10.1", weights)[1] == []


def segmentations(segments, n):
    """Every choice of segments with a kind that don't overlap."""
    def more(at):
        yield []
        for k, (i, j) in enumerate(segments):
            if i >= at:
                for y in range(len(KINDS)):
                    for rest in more(j):
                        yield [(k, y), *rest]
    return list(more(0))


def test_dynamic_program_against_enumeration():
    """The best segmentation, and the gradient of the log likelihood, as all segmentations of small zones give them."""
    r, seen = random.Random(11), 0
    weights = np.random.default_rng(2).normal(0, 1.5, (len(KINDS), len(FEATURES)))
    while seen < 60:
        text = "".join(r.choice(["+1 ", "5551234", " ", "a@b.co ", "x", "44-55", " tel ", "(at)", "1234567890", "."]) for _ in range(5))
        for z in zones(text):
            segments = candidates(text, z)
            if not 0 < len(segments) <= 9:
                continue
            seen += 1
            feats = np.array([features(text, z[i][0], z[j - 1][1]) for i, j in segments], float)
            scores = feats @ weights.T
            every = segmentations(segments, len(z))
            values = np.array([sum(scores[k, y] for k, y in way) for way in every])
            place = {(z[i][0], z[j - 1][1]): k for k, (i, j) in enumerate(segments)}
            got = [(place[a, b], KINDS.index(kind)) for kind, a, b in decode(text, z, weights)]
            assert abs(sum(scores[k, y] for k, y in got) - values.max()) < 1e-9
            chance = np.exp(values - values.max())
            chance /= chance.sum()
            share = np.zeros_like(scores)
            for way, p in zip(every, chance):
                for k, y in way:
                    share[k, y] += p
            gold = {(KINDS[y], z[segments[k][0]][0], z[segments[k][1] - 1][1]) for k, y in every[r.randrange(len(every))]}
            true = np.array([[(kind, z[i][0], z[j - 1][1]) in gold for kind in KINDS] for i, j in segments], float)
            assert np.allclose(_gradient(text, z, gold, weights), (true - share).T @ feats, atol=1e-8)


def test_training_sample_holds_every_kind_and_is_bounded(spark):
    """Rare kinds and long texts are in the sample; its size doesn't grow with the texts."""
    filler = [(f"room {k} was built in {1900 + k % 100} by hand",) for k in range(400)]
    long_text = "word " * 30_000 + "mail a.b@c-d.example.org now " + "word " * 3000
    rare = [(long_text,), ("host 10.1.2.3 is up",), ("card 4387513035237269 paid",), ("call +1 (988) 555-1234 today",), (None,), ("",)]
    docs = spark.createDataFrame(filler + rare, "text string")
    found = training_zones(docs, 10)
    kinds = {k for z in found for k, _, _ in base_spans(z)}
    assert kinds == set(KINDS) and max(map(len, found)) < 5000
    assert sum(not base_spans(z) for z in found) <= 10
    many = spark.createDataFrame([(" ".join(f"u{k}@h{n}.org" + " x" * 60 for n in range(100)),) for k in range(30)], "text string")
    assert len(training_zones(many, 10)) <= 10 * 20
    assert training_zones(docs.where("text is null"), 10) == []


def test_added_spans_touch_no_base_span():
    text = "call +1 (988) 555-1234 or (988) 555-9876, mail x@y.org or x (at) y.org"
    weights = np.random.default_rng(0).normal(0, 2, (len(KINDS), len(FEATURES)))
    for _ in range(40):
        base, every = spans_of(text, weights + np.random.default_rng(_).normal(0, 2, weights.shape))
        for s in set(every) - set(base):
            assert not any(s[1] < b and a < s[2] for _, a, b in base)
