"""Near-copied embeddings by E8 lattice hashing.

Unit vectors are projected on random orthonormal directions, eight for each
lattice block, and each block is decoded to the nearest point of the lattice E8
(the better of two D8 decodings, one shifted by a half).  A table's cell is the
label with the points of its blocks.  A vector stands in its own cell and probes
the neighbouring cells that lie nearest to it.  Vectors that share a cell, one
of them at home, are compared by cosine in double precision.

The number of tables follows from the measured chance that a pair at the
threshold shares a cell of one table, so that all tables miss such a pair with a
chance below ``MISS``.  The number of blocks grows with the logarithm of the
number of vectors, which keeps cells small.  Every pair is counted once: in the
first table, and there in the smaller cell, where it meets; both vectors carry
their cells, so this needs no list of pairs.  Cells of more than ``block``
vectors are dealt out in pairs of blocks.  Equal vectors with equal labels are
one member with a count.

Nulls: a vector that is null, of length 0, zero, or holds a null or a non-finite
component links with nothing, nor does one without a label or vec_id (its
component is its own vec_id).  Vectors of different dimensions are never
compared.  Rows that share a vec_id are vectors each.  An empty table gives no
rows.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship_package
from .common import components, map_frames, staged, table

COSINE = 0.93
SCALE = 3.0  # for 64 dimensions
PROBES = 4
MISS = 1e-5
BLOCK = 2048
#: The 240 shortest points of E8: neighbours of the origin.
NEAR = np.array([v for v in itertools.product((-1, 0, 1), repeat=8) if sum(map(abs, v)) == 2]
                + [v for v in itertools.product((-0.5, 0.5), repeat=8) if sum(x < 0 for x in v) % 2 == 0])
_ODD = np.random.default_rng(8).integers(1, 1 << 62, 64, dtype=np.int64) | 1


def _d8(x: np.ndarray) -> np.ndarray:
    """Nearest points with integer coordinates of an even sum."""
    near = np.rint(x)
    off = x - near
    worst = np.abs(off).argmax(axis=1)
    rows = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    near[rows, worst[rows]] += np.where(off[rows, worst[rows]] >= 0, 1, -1)
    return near


def e8(x: np.ndarray) -> np.ndarray:
    """Nearest points of E8."""
    a, b = _d8(x), _d8(x - 0.5) + 0.5
    return np.where((((x - a) ** 2).sum(axis=1) <= ((x - b) ** 2).sum(axis=1))[:, None], a, b)


def _projection(dim: int, table_no: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng([dim, table_no])
    width = 8 * blocks
    q = np.linalg.qr(r.normal(size=(max(dim, width), width)))[0][:dim]
    return q * SCALE * math.sqrt(max(dim, width) / 64), r.random(width) * 2


def cells(unit: np.ndarray, salt: np.ndarray, table_no: int, blocks: int) -> np.ndarray:
    """Keys of the own cell and of the nearest neighbouring cells (vector x 1 + PROBES) in one table; ``salt``: a number for each label."""
    q, shift = _projection(unit.shape[1], table_no, blocks)
    points = unit @ q + shift
    own = np.empty_like(points)
    extra, step = [], []
    n = len(unit)
    for k in range(blocks):
        at = slice(8 * k, 8 * k + 8)
        own[:, at] = e8(points[:, at])
        off = points[:, at] - own[:, at]
        far = 2 - 2 * off @ NEAR.T  # growth of the squared distance towards each neighbour
        near = np.argpartition(far, PROBES, axis=1)[:, :PROBES]
        extra.append(np.hstack([np.zeros((n, 1)), np.take_along_axis(far, near, axis=1)]))
        step.append(np.concatenate([np.zeros((n, 1, 8)), NEAR[near]], axis=1))
    choices = np.array(list(itertools.product(range(PROBES + 1), repeat=blocks)))
    total = sum(extra[k][:, choices[:, k]] for k in range(blocks))
    total[:, 0] = -1  # the own cell comes first
    best = np.argsort(total, axis=1, kind="stable")[:, : PROBES + 1]
    key = np.full((n, PROBES + 1), 0, np.int64)
    rows = np.arange(n)[:, None]
    with np.errstate(over="ignore"):
        for k in range(blocks):
            moved = own[:, None, 8 * k: 8 * k + 8] + step[k][rows, choices[best, k]]
            key += ((2 * moved).astype(np.int64) * _ODD[(8 * k + np.arange(8)) % 56]).sum(axis=2)
        key = (key + (salt[:, None] * _ODD[57]) + (table_no + 1) * _ODD[58]) * _ODD[59]
        return key ^ (key >> 29)


def hit_rate(dim: int, blocks: int, cosine: float = COSINE, size: int = 8000) -> float:
    """Chance that a pair at the threshold shares a cell of one table with one of the two at home, measured on random pairs."""
    r = np.random.default_rng(1)
    u = r.normal(size=(size, dim))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = r.normal(size=(size, dim))
    w -= (w * u).sum(axis=1, keepdims=True) * u
    w /= np.linalg.norm(w, axis=1, keepdims=True)
    salt = np.zeros(size, np.int64)
    rates = []
    for t in range(4):
        a, b = cells(u, salt, t, blocks), cells(cosine * u + math.sqrt(1 - cosine**2) * w, salt, t, blocks)
        rates.append(((a == b[:, :1]).any(axis=1) | (b == a[:, :1]).any(axis=1)).mean())
    return float(np.mean(rates))


def met(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where rows of cells (pair x table x 1 + PROBES) meet: the smaller common cell by table, or the largest number."""
    none = np.iinfo(np.int64).max
    home_a, home_b = a[:, :, 0], b[:, :, 0]
    at_a = np.where((b == home_a[:, :, None]).any(axis=2), home_a, none)
    at_b = np.where((a == home_b[:, :, None]).any(axis=2), home_b, none)
    return np.minimum(at_a, at_b)


def vector_links(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK, miss: float = MISS) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row (vec_id, embedding, label) of ``vectors``."""
    size = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    good = F.coalesce(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & (size > 0) & (size < float("inf")), F.lit(False))
    rows = vectors.select("vec_id", "embedding", F.col("label").cast("string").alias("label"), good.alias("good"),
                          F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding").alias("h2"))
    members = (rows.where("good").groupBy("label", "h1", "h2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
               .withColumn("id", F.monotonically_increasing_id()))
    members = staged(members, "vector-members")
    n, dim = members.select(F.count("*"), F.coalesce(F.max(F.size("embedding")), F.lit(8))).first()
    blocks = 1 + int(math.log2(max(1, n / 65536)) // 6)
    blocks = max(1, min(blocks, dim // 8, 4))
    tables = max(2, math.ceil(math.log(miss) / math.log(max(1e-9, 1 - hit_rate(max(8, dim), blocks, cosine)))))

    def deal(frames):
        for frame in frames:
            for k in range(0, len(frame), 1024):
                part = frame.iloc[k: k + 1024]
                for d, some in part.groupby(part["embedding"].map(len)):
                    x = np.array(some["embedding"].tolist(), np.float64)
                    salt = some["salt"].to_numpy(np.int64) + d
                    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
                    if d < 8 * blocks:
                        unit = np.hstack([unit, np.zeros((len(unit), 8 * blocks - d))])
                    key = np.stack([cells(unit, salt, t, blocks) for t in range(tables)], axis=1)
                    carried = [c.tobytes() for c in key]
                    vector = [v.tobytes() for v in x]
                    for t in range(tables):
                        for p in range(PROBES + 1):
                            yield pd.DataFrame({"key": key[:, t, p], "table": t, "home": p == 0, "id": some["id"].to_numpy(), "copies": some["copies"].to_numpy(),
                                                "label": some["label"].to_numpy(), "cells": carried, "vector": vector})

    dealt = map_frames(members.select("id", "copies", "label", F.xxhash64("label").alias("salt"), "embedding"), deal,
                       "key long, table int, home boolean, id long, copies long, label string, cells binary, vector binary")
    # cells with nobody at home hold no pair; large cells are dealt out in pairs of blocks
    sizes = dealt.groupBy("key").agg(F.count("*").alias("rows"), F.max("home").alias("any")).where("rows > 1 and any").select(
        "key", F.ceil(F.col("rows") / block).cast("int").alias("parts"))
    sizes = staged(sizes, "cell-sizes")
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    split = dealt.join(sizes, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    split = split.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        here, t = frame["key"].iloc[0], int(frame["table"].iloc[0])
        own, home = frame["own"].to_numpy(), frame["home"].to_numpy(bool)
        ids, copies, label = frame["id"].to_numpy(np.int64), frame["copies"].to_numpy(np.int64), frame["label"].to_numpy()
        x = [np.frombuffer(bytes(v), np.float64) for v in frame["vector"]]
        carried = np.frombuffer(b"".join(map(bytes, frame["cells"])), np.int64).reshape(len(frame), tables, PROBES + 1)
        across = frame["i"].iloc[0] != frame["j"].iloc[0]
        count, root = np.zeros(len(frame), np.int64), list(range(len(frame)))

        def find(k):
            while root[k] != k:
                root[k] = root[root[k]]
                k = root[k]
            return k

        for d in {len(v) for v in x}:
            at = np.array([k for k, v in enumerate(x) if len(v) == d])
            unit = np.array([x[k] for k in at])
            unit /= np.linalg.norm(unit, axis=1, keepdims=True)
            for k in range(0, len(at), 256):
                a, b = np.nonzero(unit[k: k + 256] @ unit.T >= cosine)
                a, b = at[a + k], at[b]
                fits = (a < b) & (home[a] | home[b]) & (label[a] == label[b]) & (ids[a] != ids[b])
                if across:
                    fits &= own[a] != own[b]
                a, b = a[fits], b[fits]
                for z in range(0, len(a), 50_000):
                    i, j = a[z: z + 50_000], b[z: z + 50_000]
                    where = met(carried[i, : t + 1], carried[j, : t + 1])
                    none = np.iinfo(np.int64).max
                    first = (where[:, t] == here) & (where[:, :t] == none).all(axis=1)
                    i, j = i[first], j[first]
                    np.add.at(count, i, copies[j])
                    np.add.at(count, j, copies[i])
                    for u, v in zip(i.tolist(), j.tolist()):
                        u, v = find(u), find(v)
                        if u != v:
                            root[max(u, v)] = min(u, v)
        some = np.flatnonzero(count)
        return pd.DataFrame({"id": ids[some], "links": count[some], "peer": [ids[find(k)] for k in some.tolist()]})

    ship_package(vectors.sparkSession)
    found = staged(split.groupBy("key", "i", "j").applyInPandas(compare, "id long, links long, peer long"), "vector-links")
    counted = found.groupBy("id").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.col("id").alias("a"), F.col("peer").alias("b")), "vectors")
    named = members.select("id", "label", "h1", "h2", "rep", "copies").join(counted, "id", "left").join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    named = named.join(least, "component").select("label", "h1", "h2", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"))
    out = rows.withColumn("label", F.when(F.col("good"), F.col("label"))).join(named, ["label", "h1", "h2"], "left")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op6_e8_lattice_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all ``embeddings`` with equal labels and a cosine of 0.93 or more."""
    return vector_links(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
