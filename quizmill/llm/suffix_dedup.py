"""Exact substring dedup: every byte inside a string of ``length`` bytes that starts anywhere else, too.

The strings of ``length`` bytes (windows) of all documents are brought together
by anchors: the anchor of a window is its least hashed run of ``gram`` bytes, so
equal windows have equal anchors wherever they stand.  Consecutive windows with
one anchor form a segment.  An anchor seen once has no repeated window.  Equal
segments of an anchor are told by digest and counted with partial sums, so a
group of copies is one row whatever its size; all their bytes go.

Anchors with several different segments are settled on text: one copy of each
segment goes to a bucket of bounded size, whose Burrows-Wheeler transform is
extended backwards breadth first.  Intervals of the strings of length 0, 1, 2, ..
come in that order, which gives the common-prefix values of neighbouring
suffixes by increasing value; it stops at ``length``.  Places without a value by
then share ``length`` bytes or more with a neighbour.  An anchor with more than
``most_segments`` different segments is dealt out anew with whole windows as
anchors, whose classes Spark counts: no bucket holds an unbounded group.

Documents are keyed by (doc_id, hash of text); repeated rows share that key and
count as two places.  Nulls: a null text is empty; a null doc_id is a value of
its own.  Texts shorter than ``length`` lose nothing.  Empty tables give no rows.
"""

from __future__ import annotations


import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .common import add_columns, map_frames, slices, staged, table
from .decontaminate import merged

LENGTH = 200
GRAM = 100
BUCKET_BYTES = 3 << 20
MOST_SEGMENTS = 8192
_CHUNK = 1 << 20
_MASK = np.uint64((1 << 21) - 1)
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_VALUES = np.random.default_rng(3).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of each."""
    if len(_POWERS.get("up", ())) < n:
        n = max(n, _CHUNK + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            out = np.full(n, base, np.uint64)
            out[0] = 1
            _POWERS[name] = np.multiply.accumulate(out)
    return _POWERS["up"], _POWERS["down"]


def segments(blob: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, gram: int):
    """(anchor hash, first byte, size) of all segments in texts laid end to end."""
    n = len(blob)
    grams = n - gram + 1
    if grams < 1 or not (sizes >= length).any():
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    up, down = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUES[blob] * up[:n], out=sums[1:])
    h = (sums[gram:] - sums[:-gram]) * down[:grams]
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    least = (h & ~_MASK) | np.arange(grams, dtype=np.uint64)
    width, span = length - gram + 1, 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if width > span:
        least = np.minimum(least[: span - width], least[width - span:])
    valid = np.zeros(len(least) + 1, np.int32)
    long = sizes >= length
    np.add.at(valid, starts[long], 1)
    np.add.at(valid, np.minimum(starts[long] + sizes[long] - length + 1, len(least)), -1)
    at = np.flatnonzero(np.cumsum(valid[:-1]))
    anchor = (least[at] & _MASK).astype(np.int64)
    new = np.empty(len(at), bool)
    new[:1] = True
    text = np.searchsorted(starts, at, side="right")
    new[1:] = (np.diff(anchor) != 0) | (np.diff(at) != 1) | (np.diff(text) != 0)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(at)) - 1
    return h[anchor[first]], at[first], at[last] - at[first] + length


def _pieces(texts: list[bytes], length: int):
    """(texts laid end to end, their starts, sizes, document, place in it), in chunks; long texts are cut with an overlap."""
    parts = []
    for i, t in enumerate(texts):
        if len(t) >= length:
            parts += [(i, k, t[k: k + _CHUNK - 1 + length]) for k in range(0, len(t) - length + 1, _CHUNK)]
    for part in slices([len(t) for _, _, t in parts], _CHUNK):
        some = parts[part]
        sizes = np.array([len(t) for _, _, t in some], np.int64)
        yield b"".join(t for _, _, t in some), np.cumsum(sizes) - sizes, sizes, np.array([i for i, _, _ in some]), np.array([k for _, k, _ in some])


def keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text").withColumn("text", F.coalesce("text", F.lit(""))).withColumn("th", F.xxhash64("text"))


def anchors(docs: DataFrame, length: int, gram: int, only_hash: bool) -> DataFrame:
    """The segments of all texts: h, and with it doc_id, th, s (first byte), n (bytes) and g (digest)."""
    ship_package(docs.sparkSession)

    def run(batches):
        import pyarrow as pa
        import xxhash
        for batch in batches:
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for blob, starts, sizes, doc, place in _pieces(texts, length):
                h, s, n = segments(np.frombuffer(blob, np.uint8), starts, sizes, length, gram)
                if only_hash:
                    yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64))], names=["h"])
                    continue
                which = np.searchsorted(starts, s, side="right") - 1
                rows = pa.array(doc[which])
                g = np.array([xxhash.xxh3_64_intdigest(blob[a:b]) for a, b in zip(s.tolist(), (s + n).tolist())], np.uint64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("th").take(rows), pa.array((s - starts[which] + place[which]).astype(np.int32)),
                     pa.array(n.astype(np.int32)), pa.array(h.view(np.int64)), pa.array(g.view(np.int64))], names=["doc_id", "th", "s", "n", "h", "g"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, "h long" if only_hash else f"doc_id {kind}, th long, s int, n int, h long, g long")


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of ``text`` (small ints, 0 at the end) in the order of their first ``depth`` symbols or more, by prefix doubling."""
    n = len(text)
    padded = np.concatenate([text.astype(np.int64), np.zeros(7, np.int64)])
    key = np.zeros(n, np.int64)
    for k in range(7):
        key = key * 257 + padded[k: k + n]
    done = 7
    while True:
        order = np.argsort(key, kind="stable")
        if done >= depth:
            return order
        new = np.empty(n, bool)
        new[:1] = False
        new[1:] = np.diff(key[order]) != 0
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        behind = np.zeros(n, np.int64)
        behind[:-done] = rank[done:] + 1
        key = rank * (n + 1) + behind
        done *= 2


def unresolved(text: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Ranks i whose suffix shares ``length`` symbols or more with that of rank i - 1.

    Breadth-first backward extension: level v holds intervals of strings of
    length v; extending them to the left by each symbol that precedes them (the
    transform) gives intervals of length v + 1, and an end of such an interval
    that has no common-prefix value yet gets value v.
    """
    n = len(text)
    bwt = text[order - 1]
    back = np.empty(n, np.int64)  # rank of the suffix one symbol longer
    back[np.argsort(bwt, kind="stable")] = np.arange(n)
    front = text[order]
    known = np.zeros(n + 1, bool)
    left, right = np.array([0]), np.array([n])
    for _ in range(length):
        sizes = right - left
        total = int(sizes.sum())
        if not total:
            break
        owner = np.repeat(np.arange(len(left)), sizes)
        at = np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(left, sizes)
        to = back[at]
        by = np.argsort(to)
        to, owner = to[by], owner[by]
        cut = np.flatnonzero((np.diff(to) != 1) | (np.diff(owner) != 0) | (np.diff(front[to]) != 0)) + 1
        left, right = to[np.append(0, cut)], to[np.append(cut, total) - 1] + 1
        fresh = ~known[right]
        left, right = left[fresh], right[fresh]
        known[right] = True
    known[0] = True
    return np.flatnonzero(~known[:n])


def repeated_windows(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each of several texts, which of its windows are also elsewhere among them (booleans by first byte)."""
    sizes = np.array([len(p) + 1 for p in parts], np.int64)
    starts = np.cumsum(sizes) - sizes
    text = np.zeros(int(sizes.sum()), np.int16)
    inside = np.ones(len(text), bool)
    inside[starts + sizes - 1] = False
    text[inside] = np.frombuffer(b"".join(parts), np.uint8).astype(np.int16) + 1
    order = suffix_order(text, length)
    i = unresolved(text, order, length)
    hit = np.zeros(len(text), bool)
    hit[order[i]] = True
    hit[order[i - 1]] = True
    return [hit[a: a + max(0, z - length)] for a, z in zip(starts.tolist(), sizes.tolist())]


def _runs(hit: np.ndarray) -> list[tuple[int, int]]:
    """(first, last) of the runs of true values."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edge[::2], edge[1::2])]


def repeated_ranges(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES, most_segments: int = MOST_SEGMENTS) -> DataFrame:
    """(doc_id, th, a, b): byte ranges of the texts of ``keyed`` documents to remove; they may overlap."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    often = staged(anchors(docs, length, gram, True).groupBy("h").agg(F.count("*").alias("seen")).where("seen > 1").select("h"), "anchors-seen-again")
    repeated = staged(anchors(docs, length, gram, False).join(often, "h", "left_semi"), "repeated-anchors")
    classes = staged(repeated.groupBy("h", "g").agg(F.count("*").alias("cnt"), F.min(F.struct("doc_id", "th", "s", "n")).alias("one")), "segment-classes")
    copies = repeated.join(classes.where("cnt > 1").select("h", "g"), ["h", "g"], "left_semi").select(
        "doc_id", "th", F.col("s").alias("a"), (F.col("s") + F.col("n")).alias("b"))

    differing = classes.groupBy("h").agg(F.count("*").alias("kinds")).where("kinds > 1")
    wanted = staged(classes.join(differing, "h").select("one.*", "h", "cnt", (F.col("kinds") > most_segments).alias("hot")), "segments-wanted")
    total = wanted.where("not hot").select(F.sum("n")).first()[0] or 0
    buckets = max(1, -(-total // bucket_bytes))
    asked = wanted.select("doc_id", "th", F.struct("s", "n", F.pmod("h", F.lit(buckets)).alias("bucket"), "cnt", "hot").alias("w"))
    asked = asked.groupBy("doc_id", "th").agg(F.collect_list("w").alias("w")).withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    holders = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("doc_id", "th", "text", "w").dropDuplicates(["doc_id", "th"])

    def cut(frames):
        import xxhash
        for frame in frames:
            out = []
            for d, th, text, ws in zip(frame["doc_id"], frame["th"], frame["text"], frame["w"]):
                raw = text.encode()
                for w in ws:
                    s, n, cnt = w["s"], w["n"], w["cnt"]
                    if w["hot"]:
                        for k in range(s, s + n - length + 1):
                            x = xxhash.xxh3_128_intdigest(raw[k: k + length])
                            out.append((None, d, th, k, cnt, (x >> 65), x & ((1 << 63) - 1), None))
                    else:
                        out.append((w["bucket"], d, th, s, cnt, None, None, raw[s: s + n]))
                    if len(out) >= 20_000:
                        yield made(out)
                        out = []
            yield made(out)

    def made(rows):
        frame = pd.DataFrame(rows, columns=["bucket", "doc_id", "th", "s", "cnt", "x", "y", "part"], dtype=object)
        return frame.astype({c: "Int64" for c in ("bucket", "th", "s", "cnt", "x", "y")})

    texts = staged(map_frames(holders, cut, f"bucket long, doc_id {kind}, th long, s int, cnt long, x long, y long, part binary"), "segment-texts")

    def settle(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.reset_index(drop=True)
        out = [(i, a, b) for i, hit in enumerate(repeated_windows(frame["part"].tolist(), length)) if frame["cnt"][i] == 1 for a, b in _runs(hit)]
        at = [i for i, _, _ in out]
        s = frame["s"].to_numpy()[at] if at else np.empty(0, np.int64)
        return pd.DataFrame({"doc_id": frame["doc_id"].iloc[at].tolist(), "th": frame["th"].iloc[at].tolist(),
                             "a": [int(x) + a for x, (_, a, _) in zip(s, out)], "b": [int(x) + b + length for x, (_, _, b) in zip(s, out)]}, dtype=object)

    ship_package(docs.sparkSession)
    partly = texts.where("bucket is not null").groupBy("bucket").applyInPandas(settle, f"doc_id {kind}, th long, a int, b int")
    windows = texts.where("bucket is null")
    twice = windows.groupBy("x", "y").agg(F.sum("cnt").alias("seen")).where("seen > 1").select("x", "y")
    hot = windows.where("cnt = 1").join(twice, ["x", "y"], "left_semi").select("doc_id", "th", F.col("s").alias("a"), (F.col("s") + length).alias("b"))
    return copies.union(partly).union(hot)


def without_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, **limits) -> DataFrame:
    """doc_id, text, _bytes, _removed, _spans and _kept (remaining bytes) of every row of ``docs``."""
    rows = keyed(docs)
    ranges = repeated_ranges(rows, length, gram, **limits).groupBy("doc_id", "th").agg(F.collect_list(F.array("a", "b")).alias("_ranges"))
    ranges = staged(ranges.withColumnsRenamed({"doc_id": "_id", "th": "_th"}), "repeated-ranges")
    joined = rows.join(ranges, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select("doc_id", "text", "_ranges")

    def cut(cols):
        out = {"_bytes": [], "_removed": [], "_spans": [], "_kept": []}
        for text, ranges in zip(cols["text"], cols["_ranges"]):
            raw, gone = text.encode(), merged(ranges or [])
            kept, at = [], 0
            for a, b in gone:
                kept.append(raw[at:a])
                at = b
            out["_kept"].append(b"".join([*kept, raw[at:]]))
            out["_bytes"].append(len(raw))
            out["_removed"].append(sum(b - a for a, b in gone))
            out["_spans"].append(len(gone))
        return out

    return add_columns(joined, ["text", "_ranges"], cut, "_bytes long, _removed long, _spans long, _kept binary").drop("_ranges")


def op3_suffix_interval_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes of each document of ``documents`` inside repeated strings of 200 bytes, and the checksum of the rest."""
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_bytes").alias("n_bytes"), F.col("_removed").alias("n_removed"), F.col("_spans").alias("n_spans"),
                      F.sha2("_kept", 256).alias("kept_sha256"))
