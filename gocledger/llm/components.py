"""Distributed union-find: connected components of an edge table, DataFrame operations only.

Alternating large-star and small-star rounds (Kiveris et al., "Connected
Components in MapReduce and Beyond"): every node hangs its neighbours below the
smallest node it sees until all edges point straight at their component's
smallest node.  Rounds grow with the logarithm of the component size, not with
its diameter; every step is a partial aggregation or an equi-join, so a hub
that touches a third of all nodes is combined map-side or split by AQE's skew
join.  Each round is written to the shared folder, and the round before it is
deleted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gocledger.llm.common import Scratch


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def connected_components(edges: DataFrame, scratch: Scratch, name: str = "components") -> DataFrame:
    """(node, component) for every node of ``edges`` (columns a, b of one orderable type).

    ``component`` is the smallest node that can be reached.  Null ends and
    self-loops are ignored; an empty edge table gives an empty result; repeated
    and reversed edges count once.
    """
    start = scratch.mark()
    cur = scratch.cut(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    seen = _digest(cur)
    while seen[0]:
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (both.join(low, "a").where(F.col("b") > F.col("a"))
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        low2 = large.groupBy("a").agg(F.min("b").alias("m"))
        below = large.join(low2, "a")
        small = (low2.select("a", F.col("m").alias("b"))
                 .unionByName(below.where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b")))
                 .distinct())
        last = scratch.mark()
        nxt = scratch.cut(small, name)
        scratch.drop(start, last)
        cur, before, seen = nxt, seen, _digest(nxt)
        if seen == before:
            break
    return (cur.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(cur.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct())
