"""Linked members of candidate nodes: small nodes pair by pair, large ones by branching and then as families.

A member is (id, n, sig): a set of n items with a min-wise signature.  A node is
a key that several members share.  Nodes of up to ``small`` members are compared
exhaustively, on signatures first and then on the full sets.  Larger ones branch
on further values of the signature while their members differ.  Those whose
members are alike, and those still large after ``depth`` levels, form families,
connected by common members; a family is dealt into blocks of bounded size, and every pair of
blocks is one task that counts the intersections of all its pairs on full sets
and gives back a spanning forest of the links.  So no task holds an unbounded
group, no pair is lost, and what comes out is linear in the members.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import components, staged, unsent
from .shingles import checked, least_agreement

SMALL = 24
DEPTH = 4
#: Members, and items of their sets, of one block of a family.
BLOCK = 1024
BLOCK_ITEMS = 2_000_000
#: Pairs of members of small nodes that are compared at a time.
PAIRS = 1 << 17


def sig_value(j):
    """The j-th value of a signature."""
    return F.substring(F.col("sig"), (j * 4 + 1).cast("int") if not isinstance(j, int) else j * 4 + 1, 4)


def _pairs_in_nodes(nodes: DataFrame, percent: int) -> DataFrame:
    """Likely pairs (a, b) within nodes (members: id, n, sig), all compared with all."""
    ship_package(nodes.sparkSession)

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column("members")
            sizes = np.diff(lists.offsets.to_numpy())
            starts = np.cumsum(sizes) - sizes
            flat = lists.flatten()
            ids, n = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("id", "n"))
            sig = np.frombuffer(b"".join(flat.field("sig").to_pylist()), np.uint32).reshape(len(ids), -1)
            out = [np.empty((2, 0), np.int64)]
            for size in np.unique(sizes).tolist():  # nodes of one size together, so many pairs at a time
                own, (i, j) = starts[sizes == size], np.triu_indices(size, 1)
                step = max(1, PAIRS // max(1, len(i)))
                for k in range(0, len(own) if size > 1 else 0, step):
                    x, y = ((own[k: k + step, None] + at).ravel() for at in (i, j))
                    close = (100 * np.minimum(n[x], n[y]) >= percent * np.maximum(n[x], n[y])) & (ids[x] != ids[y])
                    x, y = x[close], y[close]
                    like = (sig[x] == sig[y]).sum(axis=1) >= least_agreement(percent / 100, sig.shape[1])
                    x, y = ids[x[like]], ids[y[like]]
                    out.append(np.array([np.minimum(x, y), np.maximum(x, y)]))
            a, b = np.unique(np.concatenate(out, axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return nodes.mapInArrow(run, "a long, b long").distinct()


def refined(level: DataFrame, members: DataFrame, values: range, small: int, depth: int) -> tuple[DataFrame, DataFrame]:
    """(small nodes, large nodes to compare as families), each (key, id), of the nodes in ``level``; ``values``: signature values to branch on.

    A large node branches only while it is sparse: where few of its members
    agree on the probed values of their signatures, further values part them.
    """
    nodes = dense = None
    probes = [values.start + k * len(values) // 4 for k in range(4)]
    for d in range(depth + 1):
        counts = level.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
        level = staged(level.join(counts.hint("shuffle_hash"), "key"), f"nodes-{d}")
        found = level.where(F.col("size") <= small).select("key", "id")
        nodes = found if nodes is None else nodes.union(found)
        large = level.where(F.col("size") > small).select("key", "id", "size")
        if not large.take(1):
            break
        large = staged(large.join(unsent(members.select("id", "sig")), "id"), f"large-{d}")
        kinds = sum(F.approx_count_distinct(sig_value(j)) for j in probes)
        alike = large.groupBy("key").agg((kinds < 0.5 * len(probes) * F.max("size")).alias("alike"))
        large = large.join(unsent(staged(alike, f"alike-{d}")), "key")
        family = (large if d == depth else large.where("alike")).select("key", "id")
        dense = family if dense is None else dense.union(family)
        choice = [F.pmod(F.xxhash64("key", F.lit(c)), F.lit(len(values))) + values.start for c in range(2)]
        level = large.where(~F.col("alike")).select(
            "id", F.explode(F.array_distinct(F.array(*(F.xxhash64("key", j, sig_value(j)) for j in choice)))).alias("key"))
    return nodes, dense


def _forest(items: list[np.ndarray], apart: np.ndarray | None, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the links among some sets; ``apart``: only pairs with different values are compared."""
    sizes = np.array([len(x) for x in items])
    values = np.concatenate(items)
    owner = np.repeat(np.arange(len(items)), sizes)
    _, column, seen = np.unique(values, return_inverse=True, return_counts=True)
    shared = seen > 1  # items of a single set are in no intersection
    place = np.cumsum(shared) - 1
    keep = shared[column]
    column, owner = place[column[keep]], owner[keep]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    common = np.zeros((len(items), len(items)), np.float32)
    for first in range(0, int(shared.sum()), 1024):
        a, b = np.searchsorted(column, [first, first + 1024])
        part = np.zeros((len(items), 1024), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        common += part @ part.T
    link = 100 * common.astype(np.int64) >= percent * (sizes[:, None] + sizes[None, :] - common.astype(np.int64))
    if apart is not None:
        link &= apart[:, None] != apart[None, :]
    new, edges = np.ones(len(items), bool), []
    for k in range(len(items)):
        if new[k]:
            new[k] = False
            stack = [k]
            while stack:
                x = stack.pop()
                more = np.flatnonzero(link[x] & new).tolist()
                new[more] = False
                edges += [(x, y) for y in more]
                stack += more
    return edges


def _family_links(families: DataFrame, sets: DataFrame, percent: int, block: int, block_items: int) -> DataFrame:
    """(a, b): spanning forests of the links within families (id, family, n), found on full sets."""
    sizes = families.groupBy("family").agg(F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum("n") / block_items)).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    dealt = families.join(unsent(sizes), "family").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("id", "family", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).join(unsent(sets), "id")

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        across = frame["i"].iloc[0] != frame["j"].iloc[0]
        ids = frame["id"].to_numpy()
        edges = _forest([np.frombuffer(x, np.uint64) for x in frame["items"]], frame["own"].to_numpy() if across else None, percent)
        return pd.DataFrame({"a": [ids[x] for x, _ in edges], "b": [ids[y] for _, y in edges]})

    return dealt.groupBy("family", "i", "j").applyInPandas(compare, "a long, b long")


def linked(level: DataFrame, members: DataFrame, sets_of: Callable[[DataFrame], DataFrame], percent: int, values: range, same: DataFrame | None = None,
           small: int = SMALL, depth: int = DEPTH, block: int = BLOCK, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(id, component) of the members with a link: 100 * intersection >= percent * union.

    ``level``: nodes (key, id); ``sets_of`` gives (id, items) for a frame of ids;
    ``same``: (a, b) that are linked anyway.
    """
    nodes, large = refined(level, members, values, small, depth)
    grouped = nodes.join(unsent(members), "id").groupBy("key").agg(F.collect_list(F.struct("id", "n", "sig")).alias("members"))
    pairs = staged(_pairs_in_nodes(grouped, percent), "likely-pairs")
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b"))
    if large is not None:
        # written: a union whose parts are dealt alike is taken for one table dealt so, which its tasks then aren't
        large = staged(large, "dense-nodes")
        stars = large.join(unsent(large.groupBy("key").agg(F.min("id").alias("b"))), "key").select(F.col("id").alias("a"), "b").distinct()
        families = components(stars, "families").withColumnRenamed("component", "family").join(unsent(members.select("id", "n")), "id")
        families = staged(families, "families")
        ids = ids.union(families.select("id"))
        # pairs of one family are compared there
        of = families.select("id", "family")
        pairs = (pairs.join(unsent(of.withColumnsRenamed({"id": "a", "family": "x"})), "a", "left")
                 .join(unsent(of.withColumnsRenamed({"id": "b", "family": "y"})), "b", "left")
                 .where(F.coalesce(F.col("x") != F.col("y"), F.lit(True))).select("a", "b"))
    sets = staged(sets_of(staged(ids.distinct(), "compared")), "full-sets")
    edges = checked(pairs, sets, percent)
    if large is not None:
        edges = edges.union(_family_links(families, sets, percent, block, block_items))
    return components(edges if same is None else edges.union(same), "near-copies")
