"""Token files: whole texts as token ids in Simple-8b words, written and read by partition.

One part file holds a run of documents in ascending doc_id order:

    magic  | block 0 | block 1 | ...  | footer | footer length (u64) | magic
    block  = n_ids u32, n_words u32, n_escapes u32, 0 u32, words u64[], escapes u64[]
    footer = counts u64[4] (docs, blocks, ids, 0), doc_id i64[], doc_id_is_null u8[], n_tokens i64[],
             block byte offset u64[], first id of the block u64[]

A word carries a selector in its top four bits and 60 bits of payload.  Selector
s > 0 packs ``COUNTS[s]`` ids of ``BITS[s]`` bits each, lowest first.  Selector 0
is an escape: the payload is the index of a raw 64-bit id in the block's escape
list, so that selectors can be read for a whole block at once.  Block offsets
allow any block to be decoded alone.

Nulls: a null text is an empty one (its only id is the end id); a null doc_id
sorts first and is kept as null.  Repeated rows are written as often as they
come; ties in doc_id are ordered by text.  An empty table gives no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import map_frames, open_fs, slices, staged, table, text_bytes, work_dir
from .encoding import encoder, read_tokenizer

MAGIC = b"S8BTOK01"
#: Fixed values of the coding: ids per word and bits per id by selector.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], dtype=np.int64)
BITS = np.array([60, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], dtype=np.uint64)
BLOCK_IDS = 65536
END_ID = 2
#: Characters of text that a task encodes at a time.
BATCH_CHARS = 8 << 20


def encode_block(ids: np.ndarray) -> bytes:
    """Ids (uint64) of one block as bytes: each word takes as many ids as any selector allows there."""
    n = len(ids)
    width = np.frexp(ids.astype(np.float64))[1].astype(np.uint8)  # bit length; may be one more above 2**53
    take, chosen = np.ones(n, np.int64), np.full(n, 14, np.uint8)
    chosen[width > 60] = 0
    runs = {1: width}  # widest id among the next 1, 2, 4, .. ids
    while 2 * max(runs) <= min(n, 60):
        p = max(runs)
        runs[2 * p] = np.maximum(runs[p][:-p], runs[p][p:])
    for s in range(13, 0, -1):
        c = int(COUNTS[s])
        if c > n:
            break
        p = 1 << (c.bit_length() - 1)
        m = runs[p]
        widest = np.maximum(m[: n - c + 1], m[c - p: n - p + 1])
        fits = np.flatnonzero(widest <= BITS[s])
        take[fits], chosen[fits] = c, s
    # words begin at 0 and wherever the word before ends: reached from there by jumps of doubling length
    at, jump = np.zeros(1 if n else 0, np.int64), np.append(np.minimum(np.arange(n) + take, n), n)
    while len(at) and jump[0] < n:
        at, jump = np.concatenate([at, jump[at]]), jump[jump]
    at = np.unique(at)
    at = at[at < n]
    sel = chosen[at]
    words = np.zeros(len(at), np.uint64)
    escapes = ids[at[sel == 0]]
    words[sel == 0] = np.arange(len(escapes), dtype=np.uint64)
    for s in range(1, 15):
        if len(k := np.flatnonzero(sel == s)):
            parts = ids[at[k][:, None] + np.arange(COUNTS[s])] << (BITS[s] * np.arange(COUNTS[s], dtype=np.uint64))
            words[k] = np.bitwise_or.reduce(parts, axis=1) | np.uint64(s << 60)
    return struct.pack("<4I", n, len(words), len(escapes), 0) + words.astype("<u8").tobytes() + escapes.astype("<u8").tobytes()


def decode_block(data: bytes) -> np.ndarray:
    """The ids of one block, selector by selector."""
    n, n_words, n_escapes, _ = struct.unpack_from("<4I", data)
    words = np.frombuffer(data, "<u8", n_words, 16)
    escapes = np.frombuffer(data, "<u8", n_escapes, 16 + 8 * n_words)
    sel = (words >> np.uint64(60)).astype(np.int64)
    first = np.cumsum(COUNTS[sel]) - COUNTS[sel]
    out = np.empty(n, np.uint64)
    payload = words & np.uint64((1 << 60) - 1)
    out[first[sel == 0]] = escapes[payload[sel == 0].astype(np.int64)]
    for s in range(1, 15):
        if len(k := np.flatnonzero(sel == s)):
            mask = np.uint64((1 << int(BITS[s])) - 1)
            out[first[k][:, None] + np.arange(COUNTS[s])] = (payload[k][:, None] >> (BITS[s] * np.arange(COUNTS[s], dtype=np.uint64))) & mask
    return out


class TokenWriter:
    """Writes one part file as a stream; ``close`` puts it in place under its final name."""

    def __init__(self, path: str, attempt: int):
        self.fs, self.path = open_fs(path)
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.tmp = f"{self.path}.{attempt}.tmp"
        self.out = self.fs.open_output_stream(self.tmp)
        self.out.write(MAGIC)
        self.rest = np.empty(0, np.uint64)
        self.ids = 0
        self.offsets, self.firsts, self.doc_ids, self.counts = [], [], [], []

    def add(self, doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> None:
        self.doc_ids += doc_ids
        self.counts.append(counts)
        ids = np.concatenate([self.rest, ids])
        full = len(ids) - len(ids) % BLOCK_IDS
        for k in range(0, full, BLOCK_IDS):
            self._block(ids[k: k + BLOCK_IDS])
        self.rest = ids[full:]

    def _block(self, ids: np.ndarray) -> None:
        self.offsets.append(self.out.tell())
        self.firsts.append(self.ids)
        self.ids += len(ids)
        self.out.write(encode_block(ids))

    def close(self) -> tuple[int, int]:
        if len(self.rest):
            self._block(self.rest)
        counts = np.concatenate(self.counts) if self.counts else np.empty(0, np.int64)
        null = np.array([d is None for d in self.doc_ids], np.uint8)
        footer = b"".join((np.array([len(null), len(self.offsets), self.ids, 0], "<u8").tobytes(),
                           np.array([0 if d is None else d for d in self.doc_ids], "<i8").tobytes(), null.tobytes(),
                           counts.astype("<i8").tobytes(), np.array(self.offsets, "<u8").tobytes(), np.array(self.firsts, "<u8").tobytes()))
        self.out.write(footer + struct.pack("<Q", len(footer)) + MAGIC)
        self.out.close()
        try:
            self.fs.move(self.tmp, self.path)
        except OSError:  # some stores don't replace: another attempt's file has the same bytes
            if self.fs.get_file_info(self.path).type.name != "File":
                raise
            self.fs.delete_file(self.tmp)
        return len(null), self.ids


def read_part(path: str) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc_ids, token counts, ids) of a part file, some documents at a time."""
    fs, inner = open_fs(path)
    with fs.open_input_file(inner) as f:
        size = f.size()
        tail = f.read_at(16, size - 16)
        (length,), magic = struct.unpack("<Q", tail[:8]), tail[8:]
        if magic != MAGIC or f.read_at(8, 0) != MAGIC:
            raise ValueError(f"{path} is no token file")
        footer = f.read_at(length, size - 16 - length)
        docs, blocks, n_ids, _ = (int(x) for x in np.frombuffer(footer, "<u8", 4))
        at = 32
        doc_ids = np.frombuffer(footer, "<i8", docs, at)
        null = np.frombuffer(footer, "u1", docs, at := at + 8 * docs)
        counts = np.frombuffer(footer, "<i8", docs, at := at + docs)
        offsets = np.frombuffer(footer, "<u8", blocks, at := at + 8 * docs).astype(np.int64)
        ends = np.append(offsets[1:], size - 16 - length)
        rest, block = np.empty(0, np.uint64), 0
        for part in slices(counts.tolist(), 4 * BLOCK_IDS):
            need, have, held = int(counts[part].sum()), len(rest), [rest]
            while have < need:
                held.append(decode_block(f.read_at(int(ends[block] - offsets[block]), int(offsets[block]))))
                have += len(held[-1])
                block += 1
            ids = np.concatenate(held)
            rest = ids[need:]
            yield [None if z else int(d) for d, z in zip(doc_ids[part], null[part])], counts[part], ids[:need]


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
                      part_bytes: int = 32 << 20) -> DataFrame:
    """Encode every text and write part files below ``path`` in ascending doc_id order.

    Documents are range partitioned by (doc_id, hash of text), one file a
    partition, ``part_bytes`` of text a file on average.  A task that runs again
    writes the same bytes and puts them in place by a rename.  Returns the
    staged table of (part, n_docs, n_ids), a row a file.
    """
    kind, content = read_tokenizer(tokenizer_path)
    parts = max(1, -(-text_bytes(docs) // part_bytes))

    def write(frames):
        task = TaskContext.get()
        writer = TokenWriter(f"{path}/part-{task.partitionId():06d}.s8b", task.taskAttemptId())
        encode = encoder(kind, content)
        for frame in frames:
            for part in slices(frame["text"].str.len().tolist(), BATCH_CHARS):
                counts, ids = encode.ids_of(frame["text"][part].tolist())
                ids = np.insert(ids, np.cumsum(counts), end_id).astype(np.uint64)
                writer.add([None if pd.isna(d) else int(d) for d in frame["doc_id"][part]], counts + 1, ids)
        n_docs, n_ids = writer.close()
        yield pd.DataFrame({"part": [task.partitionId()], "n_docs": [n_docs], "n_ids": [n_ids]})

    ranged = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
              .repartitionByRange(parts, "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"), "text"))
    written = map_frames(ranged, write, "part int, n_docs long, n_ids long")
    return staged(written, "token-parts")


def read_token_files(path: str, parts: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files, one task a file.

    ``parts`` is what ``write_token_files`` gave; a file starts where the ids of
    the files before it end.
    """
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)

    def read(frames):
        for frame in frames:
            for part, start in zip(frame["part"], frame["first"]):
                for doc_ids, counts, ids in read_part(f"{path}/part-{part:06d}.s8b"):
                    ends = np.cumsum(counts)
                    data = ids.astype("<u4").tobytes()
                    crc = [zlib.crc32(data[4 * (e - c): 4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
                    yield pd.DataFrame({"doc_id": pd.array(doc_ids, "Int64"), "start": start + ends - counts, "n_tokens": counts, "ids_crc32": crc})
                    start += int(ends[-1])

    listed = (parts.select("part", "n_docs", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("first"))
              .where("n_docs > 0").repartition(max(1, parts.count())))
    return map_frames(listed, read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op2_simple8b_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode all documents, write them as token files, and give each document's place and checksum from the files."""
    import public_tokenizers
    path = work_dir(spark, "tokens")
    parts = write_token_files(table(spark, sf_dir, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(path, parts)
