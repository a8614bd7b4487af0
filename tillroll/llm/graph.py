"""Connected components of links between ids of type long."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tillroll.llm.storage import saved


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    return tuple(row)


def components(links: DataFrame) -> DataFrame:
    """node and component, the smallest node that it can reach, for every node of a link (a, b).

    Links may repeat, point either way or join a node to itself. Alternating
    steps hang every node's larger neighbours, then its smaller ones, on the
    smallest; each keeps what is connected, and at the end every node hangs on
    the smallest of its component. Minima are combined before they move; the joins
    bring a node's links to one row, so that a hub's links meet in one task unless
    adaptive execution splits it, but are never gathered in memory. Each round is
    written as a table to the checkpoint folder.
    """
    nodes = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges = saved(nodes)
    single = edges.where("a = b").select(F.col("a").alias("node"))
    edges = edges.where("a <> b")
    before = None
    while (now := _signature(edges)) != before:
        before = now
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("b", "m"), F.struct(F.col("a").alias("b"), "m"))).alias("x"))
            .select(F.col("x.b").alias("a"), F.col("x.m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        edges = saved(small)
    roots = edges.select(F.col("b").alias("node")).distinct()
    hung = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    alone = single.join(hung, "node", "left_anti").join(roots, "node", "left_anti")
    return hung.unionByName(roots.select("node", F.col("node").alias("component"))).unionByName(
        alone.select("node", F.col("node").alias("component"))
    )
