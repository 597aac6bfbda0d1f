import random

import numpy as np

from quizmill.llm.packing import QUADRATIC, pack, pack_documents


def plain_pack(lengths, sizes):
    """The same rule, told with lists: best fit, least cost for each expected token, shrink at the end."""
    bins = []
    out = []
    for i, n in enumerate(lengths):
        fits = [(size - used, k) for k, (size, used) in enumerate(bins) if size - used >= n]
        if fits:
            room = min(fits)[0]
            k = [k for r, k in fits if r == room]
        else:
            rest = lengths[i + 1:]
            cost = lambda s: (s + s * s / QUADRATIC) / (n + min(s - n, sum(x for x in rest if x <= s - n)))
            bins.append([min((s for s in sizes if s >= n), key=lambda s: (cost(s), s)), 0])
            k = [len(bins) - 1]
        out.append((n, k))
        bins[k[-1]][1] += n
    return sum(min(s for s in sizes if s >= used) for _, used in bins), len(bins)


def test_pack_against_plain_rule():
    r = random.Random(1)
    for case in range(30):
        sizes = (8, 16, 32, 64)
        lengths = np.array(sorted((r.randint(1, 64) for _ in range(r.randint(1, 80))), reverse=True))
        where, offset, size = pack(lengths, sizes)
        for b in set(where.tolist()):
            at = where == b
            assert sorted(zip(offset[at], lengths[at]))[0][0] == 0
            assert sum(lengths[at]) <= size[at][0] and (size[at][0] == 8 or sum(lengths[at]) > size[at][0] // 2)
            ends = sorted((o, o + n) for o, n in zip(offset[at], lengths[at]))
            assert all(a[1] == b[0] for a, b in zip(ends, ends[1:]))
        total = sum(size[where == b][0] for b in set(where.tolist()))
        want, count = plain_pack(lengths.tolist(), sizes)
        assert abs(total - want) <= 0.1 * want and abs(len(set(where.tolist())) - count) <= 2


def test_every_word_is_packed_once(spark):
    docs = [(k, "w " * (k * 37 % 900)) for k in range(200)] + [(None, "a b"), (5, "w " * 185), (5, "w " * 185), (900, None), (901, ""), (902, "x\n" * 20_000)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumnsRenamed({}).selectExpr("*", "1 as piece", "'z' as length")
    rows = pack_documents(frame, block_tokens=50_000).collect()
    want = sum(len((t or "").split()) + 1 for _, t in docs)
    assert sum(r.length for r in rows) == want
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for members in by.values():
        members.sort(key=lambda r: r.sequence_offset)
        end = 0
        for r in members:
            assert r.sequence_offset == end
            end += r.length
        size = members[0].sequence_length
        assert end <= size and all(r.sequence_length == size for r in members) and (size == 1024 or end > size // 2)
    assert want / sum(m[0].sequence_length for m in by.values()) > 0.9
    assert [r.length for r in sorted((r for r in rows if r.doc_id == 902), key=lambda r: r.piece)] == [8192, 8192, 3617]
    assert pack_documents(frame.limit(0)).count() == 0
