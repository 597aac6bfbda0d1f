"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of word shingles.  Equal sets are one member each.  Every
tree deals the members into nodes by the min-wise token that the node's path
selects; a node with more than ``small`` members branches on two further
tokens, so that a pair at the threshold meets again with a probability above the
one that keeps such a process alive.  Small nodes are compared exhaustively, on
signatures first and then on the full sets.  Independent trees repeat this until
the chance to miss a pair at the threshold is below one in a hundred thousand.

Nodes that still are large after some levels hold members that are alike almost
everywhere; these families are compared as wholes, block by block (see
``near_nodes``).

Nulls: a null text, or one without words, is an empty set and linked with
nothing; a row without doc_id is linked with nothing, too (component_id is null,
kept is true).  Rows with the same doc_id are one node of the graph.  Repeated
texts are linked.  An empty table gives no rows.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import apart, map_frames, slices, staged, table, unsent
from .near_nodes import linked, sig_value
from .shingles import SIGNATURE, full_sets, shingle_sets, signatures

TREES = 8


def described(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n (set size), d1 and d2 (digest of the set), sig (signature, null for an empty set) of every document."""
    def run(frames):
        import xxhash
        for frame in frames:
            for part in slices(frame["text"].str.len().fillna(0).astype(int).tolist(), 2 << 20):
                sets = shingle_sets([t if isinstance(t, str) else None for t in frame["text"][part]], width)
                full = [i for i, s in enumerate(sets) if len(s)]
                sig = signatures([sets[i] for i in full]) if full else ()
                digest = [xxhash.xxh3_128_intdigest(s.tobytes()) for s in sets]
                out = pd.DataFrame({"doc_id": frame["doc_id"][part].astype("Int64").to_numpy(), "n": [len(s) for s in sets],
                                    "d1": [(d >> 64) - (1 << 63) for d in digest], "d2": [(d & ((1 << 64) - 1)) - (1 << 63) for d in digest]})
                out["sig"] = pd.Series([None] * len(out), dtype=object)
                for i, s in zip(full, sig):
                    out.at[i, "sig"] = s.tobytes()
                yield out

    return map_frames(docs.select("doc_id", "text"), run, "doc_id long, n long, d1 long, d2 long, sig binary")


def links(docs: DataFrame, described_docs: DataFrame, same: DataFrame, width: int, percent: int, trees: int = TREES, **limits) -> DataFrame:
    """(id, component) of the documents that are linked with another one with a different set.

    ``docs``: doc_id, text; one document stands for all with an equal set.
    ``same``: (a, b) of ids that are linked anyway.
    """
    members = staged(described_docs.where("sig is not null and doc_id is not null").groupBy("d1", "d2")
                     .agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("sig").alias("sig")).select("id", "n", "sig"), "members")
    roots = F.array(*(F.xxhash64(F.lit(r), sig_value(r)) for r in range(trees)))
    level = members.select("id", F.explode(roots).alias("key"))
    return linked(level, members, lambda ids: full_sets(docs, ids, width), percent, range(trees, SIGNATURE), same, **limits)


def classes(docs: DataFrame, width: int, percent: int, **limits) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    rows = staged(described(docs, width), "described")
    equal = rows.where("n > 0 and doc_id is not null").groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    # a doc_id with several different sets ties their groups together
    often = rows.where("n > 0").groupBy("doc_id").agg(F.count("*").alias("times")).where("times > 1")
    same = (rows.where("n > 0").join(unsent(often), "doc_id", "left_semi").join(unsent(equal), ["d1", "d2"])
            .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct())
    linked = links(docs.select("doc_id", "text"), rows, same, width, percent, **limits)
    out = (rows.select("doc_id", "n", "d1", "d2").join(unsent(equal), ["d1", "d2"], "left")
           .join(unsent(linked.withColumnRenamed("id", "rep")), "rep", "left"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).when(F.col("n") == 0, F.col("doc_id")).otherwise(F.coalesce("component", "rep"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


@apart("doc_id", "text")
def keep_one(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group of near copies (the smallest doc_id); same columns.

    A node is a pair of doc_id and text, so each text of a doc_id is judged by
    itself.  Of rows with the same pair one stays.  Of the rows of a group that
    have no doc_id one stays, too, beside that of the smallest doc_id.  Rows
    without words are linked with nothing and all stay.
    """
    th = F.xxhash64("text")
    rows = docs.withColumn("_node", F.xxhash64(F.col("doc_id").isNull(), F.col("doc_id"), th))
    found = staged(classes(rows.select(F.col("_node").alias("doc_id"), "text"), width, percent).where("n_shingles > 0")
                   .groupBy("doc_id", "component_id").agg(F.count("*").alias("times")), "nodes")
    joint = found.where("doc_id <> component_id").select("component_id").distinct()
    members = found.join(joint, "component_id", "left_semi").select(F.col("doc_id").alias("_node"), "component_id")
    named = members.join(rows.select("_node", "doc_id").distinct(), "_node")
    firsts = named.groupBy("component_id", F.col("doc_id").isNull()).agg(F.min(F.struct("doc_id", "_node"))["_node"].alias("_node"))
    gone = staged(members.join(firsts, "_node", "left_anti").select("_node"), "near-copies")
    left = rows.join(gone, "_node", "left_anti")
    often = found.where("times > 1").select(F.col("doc_id").alias("_node"))
    once = left.join(often, "_node", "left_anti").unionByName(left.join(often, "_node", "left_semi").dropDuplicates(["_node"]))
    return once.select(*docs.columns)


def op7_chosen_path_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies among ``documents``: three-word shingles, Jaccard similarity of 85 % or more."""
    return classes(table(spark, sf_dir, "documents").select("doc_id", "text"), 3, 85)
