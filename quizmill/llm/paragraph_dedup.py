"""Near-copied paragraphs: min-wise banding, exact Jaccard, removal by components.

A paragraph is a line of a text; those with fewer than ``least_words`` words are
never touched.  Paragraphs are compared as sets of five-word shingles.  Equal
sets are one member.  Bands are tuned so that a pair at the threshold misses all
of them with a chance below ``MISS``; colliding paragraphs are joined and checked
on their full sets (Jaccard similarity of 0.8 or more).  Of each component of
links, with all its copies, the first paragraph stays (smallest doc_id, then
place in the text); the others are removed with their line ends.

``without_repeats(.., inside=True)``, as the query op9 has it, goes on to what
lines of enough words don't show: exact copies (but for the case of A-Z and for
white space) of pieces of ten words or more that begin and end at places chosen by
content, across lines or inside them, and of shorter lines (``units``).  Units
with a copy that overlap or follow each other make a stretch.  A shorter line goes
only as part of a stretch of ``PASSAGE`` words or more that holds a piece: alone, or
among other short lines that stand elsewhere too, it is no passage and stays.  The
first place that the step above left stays; the others go, so every word that
goes is still there in a copy.  Any run of ``REACH`` words that two texts share
holds a whole piece.  A character of a script written without blanks is a word.

Nulls: a null text has no paragraph; a null doc_id comes before all others.
Repeated rows (same doc_id and text) are one document and get the same result.
An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import add_columns, map_frames, slices, staged, table
from .near_nodes import linked
from .shingles import _LOWER, _WHITE, _mix, shingle_sets, signatures
from .suffix_dedup import _VALUES, _powers, keyed

WIDTH = 5
PERCENT = 80
LEAST_WORDS = 10
VALUES = 24
MISS = 1e-5
#: Of ``WINDOW`` consecutive runs of ``GRAM`` words the least hashed one is a place where a piece may begin or end.
WINDOW = 16
GRAM = 3
#: Words of a shared run that surely hold a piece: a window, up to its second end a piece and a window, and the last run.
REACH = 2 * WINDOW + LEAST_WORDS + GRAM
#: Words of a stretch of repeated units from which on its short lines go, too.
PASSAGE = 50
#: Bits of a digest by which units without a copy are told apart before they are sent: a bitmap of 4 MB.
BITS = 25
#: First bytes of characters in U+3000 to U+9FFF, and first two bytes of Thai, Lao, Burmese and Khmer.
_ALONE = np.zeros(256, bool)
_ALONE[0xE3:0xEA] = True
_ALONE_TWO = np.array([0xE0B8, 0xE0B9, 0xE0BA, 0xE0BB, 0xE180, 0xE181, 0xE182, 0xE19E, 0xE19F], np.uint16)


def tuned(threshold: float, values: int = VALUES, miss: float = MISS) -> tuple[int, int]:
    """(bands, rows): the most rows a band whose bands together miss a pair at the threshold with a chance below ``miss``."""
    fits = [r for r in range(1, values + 1) if (1 - threshold**r) ** (values // r) <= miss]
    return values // max(fits), max(fits)


def paragraphs(text: str, least_words: int) -> list[tuple[int, str]]:
    """(line number, line) of the lines with enough words."""
    return [(k, line) for k, line in enumerate(text.split("\n")) if len(line) >= 2 * least_words - 1 and len(line.encode().split()) >= least_words]


def described(rows: DataFrame, width: int, least_words: int) -> DataFrame:
    """doc_id, th, pos, d1, d2 (digest of its set), n and sig of every paragraph."""
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(frames):
        import xxhash
        for frame in frames:
            for part in slices(frame["text"].str.len().tolist(), 2 << 20):
                some = [(d, th, k, p) for d, th, t in zip(frame["doc_id"][part], frame["th"][part], frame["text"][part]) for k, p in paragraphs(t, least_words)]
                if not some:
                    continue
                sets = shingle_sets([p for *_, p in some], width)
                digest = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                yield pd.DataFrame({"doc_id": pd.array([None if pd.isna(d) else d for d, *_ in some], "Int64"), "th": [x[1] for x in some], "pos": [x[2] for x in some],
                                    "d1": [(d >> 64) - (1 << 63) for d in digest], "d2": [(d & ((1 << 64) - 1)) - (1 << 63) for d in digest],
                                    "n": [len(s) for s in sets], "sig": [s.tobytes() for s in signatures(sets, VALUES)]})

    return map_frames(rows, run, f"doc_id {kind}, th long, pos int, d1 long, d2 long, n long, sig binary")


def repeats(rows: DataFrame, width: int = WIDTH, percent: int = PERCENT, least_words: int = LEAST_WORDS, **limits) -> DataFrame:
    """doc_id, th, pos, component, first of every paragraph of ``keyed`` documents that has a copy or near copy."""
    places = staged(described(rows, width, least_words).withColumn("id", F.monotonically_increasing_id()), "paragraph-places")
    # one place stands for all with an equal set
    members = staged(places.groupBy("d1", "d2").agg(F.min("id").alias("id"), (F.count("*") > 1).alias("again")), "paragraph-members")
    bands, size = tuned(percent / 100)
    keys = F.array(*(F.xxhash64(F.lit(b), F.substring("sig", b * size * 4 + 1, size * 4)) for b in range(bands)))

    def sets_of(ids: DataFrame) -> DataFrame:
        asked = places.join(ids, "id", "left_semi").select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.struct("id", "pos").alias("w"))
        asked = asked.groupBy("_id", "_th").agg(F.collect_list("w").alias("w"))
        holders = rows.join(asked.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("text", "w")

        def run(frames):
            for frame in frames:
                for part in slices(frame["text"].str.len().tolist(), 2 << 20):
                    cut = ((text.split("\n"), ws) for text, ws in zip(frame["text"][part], frame["w"][part]))
                    some = [(w["id"], lines[w["pos"]]) for lines, ws in cut for w in ws]
                    sets = shingle_sets([line for _, line in some], width)
                    yield pd.DataFrame({"id": [i for i, _ in some], "items": [s.tobytes() for s in sets]})

        return map_frames(holders, run, "id long, items binary").dropDuplicates(["id"])

    level = places.select("id", "sig").join(members.select("id").hint("shuffle_hash"), "id", "left_semi").select("id", F.explode(keys).alias("key"))
    near = linked(level, places.select("id", "n", "sig"), sets_of, percent, range(VALUES), **limits)
    groups = members.join(near, "id", "left").where("again or component is not null").select("d1", "d2", F.coalesce("component", "id").alias("component"))
    found = staged(places.select("doc_id", "th", "pos", "d1", "d2").join(staged(groups, "paragraph-groups"), ["d1", "d2"]).select("doc_id", "th", "pos", "component"), "paragraphs-found")
    place = F.struct("doc_id", "th", "pos")
    # repeated rows are one document: what is seen again only there has no copy
    firsts = staged(found.groupBy("component").agg(F.min(place).alias("one"), F.max(place).alias("last")).where("one < last").drop("last"), "first-paragraphs")
    return found.join(firsts, "component").select("doc_id", "th", "pos", "component", (place == F.col("one")).alias("first"))


def words(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first byte, byte behind) of all words; characters of scripts without blanks are words, A-Z count as a-z."""
    a = np.frombuffer(raw.translate(_LOWER) + b" ", np.uint8)
    white = _WHITE[a]
    alone = _ALONE[a]
    if (a >= 0xE0).any():
        alone |= np.isin(np.append((a[:-1].astype(np.uint16) << 8) | a[1:], np.uint16(0)), _ALONE_TWO)
    after = np.zeros(len(a), bool)  # a character alone has three bytes; what follows begins a word
    after[3:] = alone[:-3]
    begin = ~white & (np.concatenate([[True], white[:-1]]) | alone | after)
    starts = np.flatnonzero(begin)
    ends = np.flatnonzero(np.concatenate([[False], ~white[:-1]]) & (white | begin))
    up, down = _powers(len(a))
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum(_VALUES[a] * up[: len(a)], out=sums[1:])
    return _mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)), starts, ends


def units(texts: list[bytes], least_words: int) -> tuple[np.ndarray, ...]:
    """(text, first byte, byte behind, first line, last line, d1, d2, first word, word behind, is piece) of the short lines and pieces of texts.

    A short line has fewer than ``least_words`` words in the sense of
    ``paragraphs``; its unit takes the line end along.  Words count from the
    beginning of the text.
    """
    blob = b"\n".join(texts)
    sizes = np.array([len(t) + 1 for t in texts])
    text_at = np.cumsum(sizes) - sizes
    h, first, behind = words(blob)
    raw = np.frombuffer(blob + b"\n", np.uint8)
    line_ends = np.flatnonzero(raw == 10)
    line = np.searchsorted(line_ends, first)  # over all texts; the break between two texts ends a line, too
    own = np.searchsorted(text_at, first, side="right") - 1
    n = len(h)
    up, down = _powers(n + 1)
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x * up[:n], dtype=np.uint64)]) for x in (h, _mix(h + np.uint64(1)))]
    digest = lambda a, b, kind: [_mix(_mix((x[b] - x[a]) * down[a]) + (b - a).astype(np.uint64) * np.uint64(2) + np.uint64(kind)).view(np.int64) for x in sums]

    # short lines: fewer words between blanks than asked for
    a = np.flatnonzero(np.diff(line, prepend=-1))
    b = np.append(a[1:], n)
    blanks = np.concatenate([[0], np.cumsum(_WHITE[raw[np.maximum(first - 1, 0)]] | (first == 0))])
    short = blanks[b] - blanks[a] < least_words
    a, b = a[short], b[short]
    ends = line_ends[line[a]] + 1
    lines = [own[a], np.append(-1, line_ends)[line[a]] + 1, ends, line[a], line[a], *digest(a, b, 0), a, b, np.zeros(len(a), bool)]

    # pieces: from each chosen place to the first one at least so many words on
    pieces = [np.empty(0, np.int64)] * 9 + [np.empty(0, bool)]
    if n >= WINDOW + GRAM:
        grams = _mix(sum(h[j: n - GRAM + 1 + j] * np.uint64(2 * j + 3) for j in range(GRAM)))
        views = np.lib.stride_tricks.sliding_window_view(grams, WINDOW)
        place = np.arange(len(views)) + views.argmin(axis=1)
        place = np.unique(place[own[: len(views)] == own[WINDOW + GRAM - 2:]])
        to = np.searchsorted(place, place + least_words)
        a, b = place[to < len(place)], place[to[to < len(place)]]
        inside = own[a] == own[b]
        a, b = a[inside], b[inside]
        pieces = [own[a], first[a], behind[b - 1], line[a], line[b - 1], *digest(a, b, 1), a, b, np.ones(len(a), bool)]
    out = [np.concatenate(x) for x in zip(lines, pieces)]
    for k in (1, 2):
        out[k] = out[k] - text_at[out[0]]
    out[2] = np.minimum(out[2], sizes[out[0]] - 1)
    before = np.searchsorted(line_ends, text_at)
    first_word = np.searchsorted(own, np.arange(len(texts)))
    for k, zero in ((3, before), (4, before), (7, first_word), (8, first_word)):
        out[k] = out[k] - zero[out[0]]
    return tuple(out)


def digest_bits(digests: DataFrame) -> bytes:
    """A bit for each value of the last ``BITS`` bits of d1 that a row of ``digests`` has.  Its size is fixed, whatever their number."""
    low = digests.select(F.expr(f"d1 & {(1 << BITS) - 1}").alias("b"))
    found = low.groupBy(F.expr("shiftright(b, 6)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 AS int))")).alias("bits")).toArrow()
    words = np.zeros(1 << (BITS - 6), np.int64)
    words[found["word"].to_numpy()] = found["bits"].to_numpy()
    return words.tobytes()


def unit_rows(rows: DataFrame, least_words: int, bits: bytes | None = None) -> DataFrame:
    """d1 of all ``units``; with ``bits`` only of those whose bit is set, and d1, d2 with doc_id, th, start, stop (bytes), l0, l1 (lines), w0, w1 (words), piece, and mixed (a short line of the text is among them)."""
    kind = rows.schema["doc_id"].dataType.simpleString()
    sent = None if bits is None else rows.sparkSession.sparkContext.broadcast(bits)

    def run(frames):
        for frame in frames:
            raw = [t.encode() for t in frame["text"]]
            for part in slices([len(t) for t in raw], 1 << 20):
                found = units(raw[part], least_words)
                if sent is None:
                    yield pd.DataFrame({"d1": found[5]})
                else:
                    b = found[5] & ((1 << BITS) - 1)
                    kept = (np.frombuffer(sent.value, np.int64)[b >> 6] >> (b & 63)) & 1 == 1
                    text, start, stop, l0, l1, d1, d2, w0, w1, piece = (x[kept] for x in found)
                    out = pd.DataFrame({"d1": d1, "d2": d2})
                    out["doc_id"] = frame["doc_id"][part].astype("Int64").take(text).array
                    out["th"] = frame["th"][part].to_numpy()[text]
                    out["start"], out["stop"], out["l0"], out["l1"] = start, stop, l0, l1
                    out["w0"], out["w1"], out["piece"] = w0, w1, piece
                    out["mixed"] = np.isin(text, text[~piece])
                    yield out

    return map_frames(rows, run, "d1 long" if sent is None else
                      f"d1 long, d2 long, doc_id {kind}, th long, start int, stop int, l0 int, l1 int, w0 int, w1 int, piece boolean, mixed boolean")


def in_passages(places: DataFrame) -> DataFrame:
    """Of repeated units: all pieces, and the short lines in stretches of ``PASSAGE`` words or more that hold a piece."""
    text = Window.partitionBy("doc_id", "th")
    ordered = text.orderBy("w0", "w1")
    behind = F.max("w1").over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    stretched = places.withColumn("new", (F.col("w0") > F.coalesce(behind, F.lit(-1))).cast("int"))
    stretched = stretched.withColumn("stretch", F.sum("new").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    whole = Window.partitionBy("doc_id", "th", "stretch")
    sized = stretched.withColumn("words", F.max("w1").over(whole) - F.min("w0").over(whole)).withColumn("held", F.max("piece").over(whole))
    return sized.where(F.col("piece") | (F.col("held") & (F.col("words") >= PASSAGE)))


def inner_repeats(rows: DataFrame, found: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """_id, _th, _cuts (2**32 * start + stop of the bytes to cut) and _units (with a copy) of the documents with repeated ``units``.

    ``found``: _id, _th, _gone (numbers of the lines that go already); units that touch those don't count.
    """
    often = staged(unit_rows(rows, least_words).groupBy("d1").agg(F.count("*").alias("n")).where("n > 1").select("d1"), "repeated-digests")
    # units without a copy stay in their tasks, but for some by chance
    places = unit_rows(rows, least_words, digest_bits(often)).join(often.hint("shuffle_hash"), "d1", "left_semi")
    # dealt once by document; rows with the same id and text are one
    places = places.withColumn("k", F.xxhash64("doc_id", "th")).repartition("k").dropDuplicates(["k", "doc_id", "th", "start", "stop", "d1", "d2"])
    gone = found.where(F.size("_gone") > 0).groupBy(F.xxhash64("_id", "_th").alias("k")).agg(F.collect_list(F.struct("_id", "_th", "_gone")).alias("_docs"))
    touched = F.exists("_docs", lambda x: x["_id"].eqNullSafe(F.col("doc_id")) & (x["_th"] == F.col("th")) & F.exists(x["_gone"], lambda y: (y >= F.col("l0")) & (y <= F.col("l1"))))
    left = places.join(gone.hint("shuffle_hash"), "k", "left").where(F.col("_docs").isNull() | ~touched)
    left = staged(left.select("d1", "d2", "doc_id", "th", "start", "stop", "w0", "w1", "piece", "mixed"), "unit-places")
    # pieces stay in any case, so stretches are needed only where there are short lines
    lines = staged(in_passages(left.where("mixed")).where("not piece").select("d1", "d2", "doc_id", "th", "start", "stop"), "lines-in-passages")
    left = left.where("piece").select(lines.columns).union(lines)
    place = F.struct("doc_id", "th", "start")
    groups = left.groupBy("d1", "d2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first < last").drop("last")
    groups = staged(groups, "unit-groups")  # so that the places of a unit with very many copies can be dealt out in the join
    cut = F.when(place > F.col("first"), F.shiftleft(F.col("start").cast("long"), 32) + F.col("stop"))
    return left.join(groups.hint("shuffle_hash"), ["d1", "d2"]).groupBy(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).agg(
        F.collect_list(cut).alias("_cuts"), F.count("*").alias("_units"))


def spliced(raw: bytes, cuts: list) -> tuple[bytes, int]:
    """``raw`` without the stretches (start, stop), each with the blanks behind it; and how many stretches they make."""
    return without(raw, [(c["start"], c["stop"]) for c in cuts])


def without(raw: bytes, cuts: list[tuple[int, int]]) -> tuple[bytes, int]:
    """``spliced`` for pairs."""
    out, at, n = [], 0, 0
    for start, stop in sorted(cuts):
        while stop < len(raw) and raw[stop] == 32 and raw[stop - 1] != 10:
            stop += 1
        n += start > at or not n
        if start > at:
            out.append(raw[at:start])
        at = max(at, stop)
    kept = b"".join([*out, raw[at:]])
    if at == len(raw) and n and not raw.endswith(b"\n") and kept.endswith(b"\n"):
        kept = kept[:-1]  # the last line is gone, and so is the break before it
    return kept, n


def without_repeats(docs: DataFrame, inside: bool = False, **limits) -> DataFrame:
    """doc_id, text, _bytes, _removed (bytes), _spans (paragraphs gone), _repeated (paragraphs with a copy) and _kept (text left).

    ``inside``: short lines and pieces, too; stretches of them that go count as spans, those with a copy as repeated.
    """
    rows = keyed(docs)
    found = repeats(rows, **limits).groupBy("doc_id", "th").agg(F.collect_list(F.when(~F.col("first"), F.col("pos"))).alias("_gone"), F.size(F.collect_set("pos")).cast("long").alias("_repeated"))
    found = staged(found.withColumnsRenamed({"doc_id": "_id", "th": "_th"}), "repeated-paragraphs")
    if inside:
        inner = inner_repeats(rows, found).withColumnsRenamed({"_id": "_id2", "_th": "_th2"})
        both = found.join(inner, F.col("_id").eqNullSafe(F.col("_id2")) & (F.col("_th") == F.col("_th2")), "full")
        found = staged(both.select(
            F.when(F.col("_th").isNull(), F.col("_id2")).otherwise(F.col("_id")).alias("_id"), F.coalesce("_th", "_th2").alias("_th"), "_gone", "_cuts",
            (F.coalesce("_repeated", F.lit(0)) + F.coalesce("_units", F.lit(0))).cast("long").alias("_repeated")), "repeated-in-all")
    else:
        found = found.withColumn("_cuts", F.lit(None).cast("array<long>"))
    joined = rows.join(found.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")), "left").select(
        "doc_id", "text", "_gone", "_cuts", F.coalesce("_repeated", F.lit(0).cast("long")).alias("_repeated"))

    def cut(cols):
        out = {"_bytes": [], "_removed": [], "_spans": [], "_kept": []}
        for text, gone, cuts in zip(cols["text"], cols["_gone"], cols["_cuts"]):
            skip, raw = set(gone or ()), text.encode()
            spans = len(skip)
            if cuts:
                at = np.cumsum([0, *(len(line) + 1 for line in raw.split(b"\n"))]).tolist()
                kept, spans = without(raw, [(c >> 32, c & 0xFFFFFFFF) for c in cuts] + [(at[k], min(at[k + 1], len(raw))) for k in skip])
                kept = kept.decode()
            else:
                kept = text if not skip else "\n".join(line for k, line in enumerate(text.split("\n")) if k not in skip)
            sizes = len(raw), len(kept.encode())
            for name, value in (("_bytes", sizes[0]), ("_removed", sizes[0] - sizes[1]), ("_spans", spans), ("_kept", kept)):
                out[name].append(value)
        return out

    return add_columns(joined, ["text", "_gone", "_cuts"], cut, "_bytes long, _removed long, _spans long, _kept string").drop("_gone", "_cuts")


def op9_banded_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes, and paragraphs or stretches, of each document of ``documents`` that repeat an earlier one, and the checksum of the rest."""
    out = without_repeats(table(spark, sf_dir, "documents"), inside=True)
    return out.select("doc_id", F.col("_bytes").alias("n_bytes"), F.col("_removed").alias("n_removed"), F.col("_spans").alias("n_spans"),
                      F.col("_repeated").alias("n_repeated"), F.sha2(F.col("_kept").cast("binary"), 256).alias("kept_sha256"))
