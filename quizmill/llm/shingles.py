"""Word shingles as 64-bit hashes, min-wise signatures, and checked similarity joins."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_frames, sent_if_few, slices, unsent
from .suffix_dedup import _VALUES, _powers

SIGNATURE = 48
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_WHITE = np.zeros(256, bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_CHUNK = 1 << 20
_SEEDS = np.random.default_rng(7).integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _cut(raw: bytes) -> list[bytes]:
    """Parts of about a chunk, cut at white space."""
    out, at = [], 0
    while len(raw) - at > _CHUNK:
        end = at + _CHUNK
        while end < len(raw) and not _WHITE[raw[end]]:
            end += 1
        out.append(raw[at:end])
        at = end
    return [*out, raw[at:]]


def word_hashes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hash, text index) of all words, in order; words end at ASCII white space, A-Z count as a-z."""
    parts = [(i, p) for i, t in enumerate(texts) if t for p in _cut(t.encode().translate(_LOWER))]
    hashes, owners = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for part in slices([len(p) for _, p in parts], _CHUNK):
        some = parts[part]
        a = np.frombuffer(b" ".join(p for _, p in some) + b" ", np.uint8)
        white = _WHITE[a]
        starts = np.flatnonzero(~white & np.concatenate([[True], white[:-1]]))
        ends = np.flatnonzero(white & np.concatenate([[False], ~white[:-1]]))
        up, down = _powers(len(a))
        sums = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(_VALUES[a] * up[: len(a)], out=sums[1:])
        hashes.append(_mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64)))
        own = np.array([i for i, _ in some])
        behind = np.cumsum([len(p) + 1 for _, p in some])
        owners.append(own[np.searchsorted(behind, starts, side="right")])
    return np.concatenate(hashes), np.concatenate(owners)


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    """The distinct hashed shingles of each text, sorted; fewer words than ``width`` are one shingle, none is an empty set."""
    words, owner = word_hashes(texts)
    n = len(words)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    out = []
    grams = np.zeros(max(0, n - width + 1), np.uint64)
    for j in range(width if n >= width else 0):
        grams += words[j: n - width + 1 + j] * _SEEDS[0, j]
    grams = _mix(grams)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            own = grams[a: b - width + 1]
            own.sort()
            new = own[1:] != own[:-1]
            out.append(own if new.all() else own[np.concatenate([[True], new])])
        elif b > a:
            out.append(_mix((words[a:b] * _SEEDS[0, : b - a]).sum(keepdims=True) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray], size: int = SIGNATURE) -> np.ndarray:
    """Min-wise values (uint32) of sets that aren't empty, one row a set."""
    out = np.empty((len(sets), size), np.uint32)
    for part in slices([len(s) for s in sets], 1 << 17):
        some = sets[part]
        values = np.concatenate(some)
        starts = np.cumsum([0, *(len(s) for s in some[:-1])])
        for j in range(size):
            z = (values ^ _SEEDS[1, j]) * _SEEDS[0, 128 + j % 128]
            z ^= z >> np.uint64(29)
            out[part, j] = (np.minimum.reduceat(z * _SEEDS[0, j + 64], starts) >> np.uint64(32)).astype(np.uint32)
    return out


def least_agreement(threshold: float, size: int) -> int:
    """Equal min-wise values that a pair at the threshold reaches but for about one in ten million."""
    return max(1, int(threshold * size - 5.3 * (size * threshold * (1 - threshold)) ** 0.5))


def checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets (id, items) have 100 * intersection >= percent * union, on full sets."""
    left = pairs.join(unsent(sets.withColumnsRenamed({"id": "a", "items": "x"})), "a")
    both = left.join(unsent(sets.withColumnsRenamed({"id": "b", "items": "y"})), "b").select("a", "b", "x", "y")

    def run(frames):
        for frame in frames:
            keep = []
            for x, y in zip(frame["x"], frame["y"]):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            yield frame.loc[np.array(keep, bool), ["a", "b"]]

    return map_frames(both, run, "a long, b long").distinct()


def full_sets(docs: DataFrame, ids: DataFrame, width: int) -> DataFrame:
    """(id, items): the sets of the documents (doc_id, text) in ``ids`` (id; written already)."""
    some = docs.select(F.col("doc_id").alias("id"), "text").join(sent_if_few(ids), "id", "left_semi")

    def run(frames):
        for frame in frames:
            for part in slices(frame["text"].str.len().fillna(0).astype(int).tolist(), 2 << 20):
                sets = shingle_sets([t if isinstance(t, str) else None for t in frame["text"][part]], width)
                yield pd.DataFrame({"id": frame["id"][part].to_numpy(), "items": [s.tobytes() for s in sets]})

    return map_frames(some, run, "id long, items binary").distinct()
