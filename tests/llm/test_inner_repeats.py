import random

import numpy as np

from quizmill.llm.paragraph_dedup import PASSAGE, REACH, in_passages, spliced, units, without_repeats


def prose(r, n):
    return " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))


def run(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    return {r.doc_id: r for r in without_repeats(frame, inside=True).collect()}


def test_copies_that_whole_lines_miss(spark):
    r = random.Random(3)
    shared, kana = prose(r, 62), "".join(chr(0x3041 + r.randrange(80)) for _ in range(70))
    words = prose(r, 60).split()
    wrap = lambda n: "\n".join(" ".join(words[k:k + n]) for k in range(0, len(words), n))
    docs = [(1, f"{prose(r, 80)} {shared} {prose(r, 5)}"), (2, f"{prose(r, 40)} {shared.title()} {prose(r, 40)}"),
            (3, wrap(8)), (4, wrap(7)), (5, f"{prose(r, 12)}\nBye now.\n{prose(r, 12)}"), (6, f"{prose(r, 12)}\nBye now.\n\nend é"), (11, "Bye now.\nend é\nBye now."),
            (7, kana), (8, "".join(chr(0x4e00 + r.randrange(900)) for _ in range(40)) + kana), (9, None), (10, prose(r, 300)), (10, "x"), (None, "own é")]
    got = run(spark, docs)
    texts = dict(docs)
    for d in (1, 3, 5, 7, 9, None):
        assert got[d]._kept == (texts[d] or "") and got[d]._removed == 0
    assert got[2]._removed >= 7 * (62 - 2 * (REACH - 10) // 2) and got[2]._spans == 1
    assert got[4]._removed > 100 and got[8]._removed > 60
    # a short line that stands elsewhere, too, is no passage
    assert all(got[d]._kept == texts[d] and got[d]._repeated == 0 for d in (6, 11))
    assert all(r._bytes - r._removed == len(r._kept.encode()) for r in got.values())


def test_a_run_of_reach_words_holds_a_piece():
    r = random.Random(1)
    for _ in range(200):
        run = prose(r, REACH)
        a, b = f"{prose(r, r.randint(0, 30))} {run} {prose(r, 20)}", f"{prose(r, r.randint(0, 30))}\n{run}"
        text, start, stop, l0, l1, d1, d2, *more = units([a.encode(), b.encode()], 10)
        assert set(d1[text == 0].tolist()) & set(d1[text == 1].tolist())
        alone = units([b.encode()], 10)  # what stands beside a text in its batch doesn't count
        assert all(np.array_equal(x[text == 1], y) for x, y in zip((start, stop, l0, l1, d1, d2, *more), alone[1:]))


def test_spliced():
    assert spliced(b"ab cd ef", [{"start": 3, "stop": 5}]) == (b"ab ef", 1)
    assert spliced(b"a\nb\nc", [{"start": 0, "stop": 2}, {"start": 4, "stop": 5}]) == (b"b", 2)


def test_short_lines_go_with_the_passage_around_them(spark):
    """A wrapped passage goes up to its first and last short line; the same lines among others stay."""
    r = random.Random(9)
    words = prose(r, 90).split()
    wrapped = "\n".join(" ".join(words[k:k + 6]) for k in range(0, 90, 6))
    own = [prose(r, 15) for _ in range(4)]
    docs = [(1, f"{own[0]}\n{wrapped}\n{own[1]}"), (2, f"{own[2]}\n{wrapped}\n{own[3]}"), (3, "\n".join(wrapped.split("\n")[:4]))]
    got = run(spark, docs)
    assert got[1]._kept == docs[0][1] and got[2]._kept == f"{own[2]}\n{own[3]}" and got[3]._kept == docs[2][1]


def stretches(units_of, passage):
    """Plain form of ``in_passages`` for the units (w0, w1, piece) of one text."""
    out, group, end = [], [], None
    for u in [*sorted(units_of), None]:
        if group and (u is None or u[0] > end):
            whole = max(x[1] for x in group) - group[0][0]
            out += [x for x in group if x[2] or (whole >= passage and any(y[2] for y in group))]
            group, end = [], None
        if u is not None:
            group.append(u)
            end = max(end or 0, u[1])
    return out


def test_stretches_against_plain_form(spark):
    r = random.Random(5)
    rows = [(d, 0, w0, w0 + r.randint(1, 30), r.random() < 0.3) for d in range(60) for w0 in r.sample(range(200), r.randint(0, 12))]
    frame = spark.createDataFrame(rows, "doc_id long, th long, w0 int, w1 int, piece boolean")
    got = sorted((x.doc_id, x.w0, x.w1, x.piece) for x in in_passages(frame).collect())
    wanted = sorted((d, *u) for d in range(60) for u in stretches([x[2:] for x in rows if x[0] == d], PASSAGE))
    assert got == wanted


def brute_inner(docs):
    """Kept text by doc_id, unit by unit and place by place; texts without near-copied long lines."""
    found, often = {}, {}
    for d, t in docs:
        found[d] = [(int(a), int(b), int(w0), int(w1), bool(piece), (int(x), int(y))) for _, a, b, _, _, x, y, w0, w1, piece in zip(*units([t.encode()], 10))]
        for u in found[d]:
            often[u[5]] = often.get(u[5], 0) + 1
    first, left = {}, {}
    for d in sorted(found):
        repeated = {(u[2], u[3], u[4], u[0], u[1], u[5]) for u in found[d] if often[u[5]] > 1}
        left[d] = sorted(stretches(repeated, PASSAGE), key=lambda u: u[3])
        for u in left[d]:
            first.setdefault(u[5], (d, u[3]))
    return {d: spliced(t.encode(), [{"start": u[3], "stop": u[4]} for u in left[d] if first[u[5]] != (d, u[3])])[0].decode() for d, t in docs}


def test_inner_repeats_against_brute_force(spark):
    """Passages inside lines, across lines and in wrapped lines, among short lines that many texts share."""
    r = random.Random(21)
    passages = [prose(r, n).split() for n in (30, 55, 70, 120)]
    short = ["Bye now.", "See also", "one two three"]

    def text():
        parts = []
        for _ in range(r.randint(1, 5)):
            kind = r.random()
            if kind < 0.35:
                p = r.choice(passages)
                w = r.choice([5, 8, 200])
                parts.append("\n".join(" ".join(p[k:k + w]) for k in range(0, len(p), w)) if r.random() < 0.6 else f"{prose(r, 60)} {' '.join(p)} {prose(r, 60)}")
            elif kind < 0.6:
                parts.append(r.choice(short))
            else:
                parts.append(prose(r, r.choice([4, 15, 80])))
        return "\n".join(parts)

    docs = [(d, text()) for d in range(40)]
    # lines of a whole passage are left to the bands: here they get words of their own
    docs = [(d, "\n".join(f"{line} {prose(r, 40)}" if len(line.split()) in (30, 55, 70, 120) else line for line in t.split("\n"))) for d, t in docs]
    got = {d: x._kept for d, x in run(spark, docs).items()}
    wanted = brute_inner(docs)
    assert got == wanted and any(wanted[d] != t for d, t in docs)
