"""Best-fit packing of documents into training sequences of several permitted lengths.

Documents longer than the largest permitted length are cut into pieces.  Pieces
are dealt by hash into blocks of about ``block_tokens`` tokens, and each block is
packed by itself: longest piece first, into the open sequence that it fills
best.  If it fits nowhere, a sequence is opened in the permitted length of least
cost for each token that it can be expected to hold: the piece and what is still
to come that fits beside it.  The cost of a sequence has a part linear in its
length and a quadratic one (attention).  At the end every sequence shrinks to
the smallest permitted length that holds its contents.

Only ids and lengths move.  A block holds ``block_tokens`` on average whatever
the input, so a task's memory stays the same.

Nulls: a null or empty text is one piece of length 1 (the end token); doc_id may
be null or repeated, every row is packed.  An empty table gives no rows.  Ties
go by doc_id, text hash and piece.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .common import staged, table

SIZES = (1024, 2048, 4096, 8192)
BLOCK_TOKENS = 2_000_000
#: Cost of a sequence of n tokens: n + n * n / QUADRATIC.
QUADRATIC = 65536


def word_tokens(text: str = "text"):
    """Length of a text: its runs of characters between white space, and an end token."""
    trimmed = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"^\s+|\s+$", "")
    return (F.when(trimmed == "", 0).otherwise(F.size(F.split(trimmed, r"\s+"))) + 1).cast("long")


def pack(lengths: np.ndarray, sizes: tuple = SIZES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset in it, size of it) of each piece, for lengths in descending order."""
    top = max(sizes)
    left = np.bincount(lengths, minlength=top + 1) * np.arange(top + 1)  # tokens still to come, by length
    open_bins: list[list[int]] = [[] for _ in range(top + 1)]  # bins by room
    rooms: list[int] = []  # rooms with an open bin, ascending
    content: list[int] = []
    where, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for i, n in enumerate(lengths.tolist()):
        left[n] -= n
        k = bisect_left(rooms, n)
        if k < len(rooms):
            room = rooms[k]
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms.pop(k)
        else:
            best = None
            for size in sizes:
                if size >= n:
                    filled = n + min(size - n, int(left[: size - n + 1].sum()))
                    cost = (size + size * size / QUADRATIC) / filled
                    if best is None or cost < best[0]:
                        best = (cost, size)
            b, room = len(content), best[1]
            content.append(0)
        where[i], offset[i] = b, content[b]
        content[b] += n
        room -= n
        if room:
            if not open_bins[room]:
                rooms.insert(bisect_left(rooms, room), room)
            open_bins[room].append(b)
    permitted = np.array(sorted(sizes))
    return where, offset, permitted[np.searchsorted(permitted, np.array(content, np.int64))][where]


def pack_documents(docs: DataFrame, length=None, sizes: tuple = SIZES, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece: doc_id, piece, piece_start, length, sequence_id, sequence_length, sequence_offset."""
    top = max(sizes)
    # written once: the sum of all lengths is needed before any piece can be dealt, and splitting texts is the dear part
    lengths = staged(docs.select("doc_id", F.xxhash64("text").alias("h"), (word_tokens() if length is None else length).alias("n")), "lengths")
    blocks = max(1, -(-(lengths.select(F.sum("n")).first()[0] or 0) // block_tokens))
    pieces = lengths.select("doc_id", "h", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / top).cast("long"))).alias("piece"))
    pieces = pieces.select("doc_id", "h", "piece", F.least(F.lit(top).cast("long"), F.col("n") - F.col("piece") * top).alias("length"),
                           F.pmod(F.xxhash64("doc_id", "h", "piece"), F.lit(blocks)).alias("block"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["length", "doc_id", "h", "piece"], ascending=[False, True, True, True], kind="stable", na_position="first")
        where, offset, size = pack(frame["length"].to_numpy(np.int64), sizes)
        return pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "piece": frame["piece"], "piece_start": frame["piece"] * top, "length": frame["length"],
                             "sequence_id": frame["block"] * (1 << 24) + where, "sequence_length": size, "sequence_offset": offset})

    ship_package(docs.sparkSession)
    return pieces.groupBy("block").applyInPandas(
        run, "doc_id long, piece long, piece_start long, length long, sequence_id long, sequence_length long, sequence_offset long")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``documents`` packed into sequences of 1,024 to 8,192 words."""
    return pack_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
