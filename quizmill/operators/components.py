"""Connected components of a graph that is an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged, unsent


def components(edges: DataFrame, name: str, most_rounds: int = 60) -> DataFrame:
    """(id, component) for every id of ``edges`` (a, b); component is the smallest id reachable.

    Ids may be of any type that has an order, structs included.  In each round
    every id first points its larger neighbours at the smallest id it knows, then
    itself and its smaller ones: the number of rounds grows with the logarithm of
    a component's size, and an edge costs a few rows a round.  A round's smallest
    ids are written before they meet the edges again, so that the edges of an id
    with very many can be dealt out in the join.  Ids without an edge aren't in
    the result.  Nothing of the graph is sent to the
    driver.  More than ``most_rounds`` rounds raise an error; that would be a
    defect, not a matter of the data.
    """
    def lowest(both: DataFrame) -> DataFrame:
        return staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), f"{name}-lowest")

    pointed = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = staged(pointed, f"{name}-edges")
    for _ in range(most_rounds):
        ends = now.select(F.col("a").alias("x"), F.lit(1).alias("out"), F.lit(0).alias("into")).union(now.select("b", F.lit(0), F.lit(1)))
        if not ends.groupBy("x").agg(F.sum("out").alias("out"), F.max("into").alias("into")).where("out > 1 or out + into > 1").take(1):
            return now.select(F.col("a").alias("id"), F.col("b").alias("component")).union(now.select("b", "b").distinct())
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = staged(both.join(unsent(lowest(both)), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .where("a <> b").distinct(), f"{name}-large")
        large = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        met = large.join(unsent(lowest(large)), "a")
        now = staged(met.select(F.col("b").alias("a"), F.col("m").alias("b")).union(met.select("a", F.col("m").alias("b")))
                     .where("a <> b").distinct(), f"{name}-small")
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")
