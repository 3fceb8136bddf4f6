"""Connected components of a link table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veleta.llm.common import release, stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """One star step over undirected links (a, b): neighbours are hung on the smallest one around."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    if larger:
        low = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("low"))
        out = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b"))
    else:
        down = both.filter("b < a")
        low = down.groupBy("a").agg(F.min("b").alias("low"))
        hung = down.join(low, "a")
        out = hung.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b")))
    return out.filter("a <> b").distinct()


def _flat(edges: DataFrame) -> bool:
    """Whether every node hangs on one node only, and that on none."""
    ends = edges.select(F.col("a").alias("v"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("b").alias("v"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    per_node = ends.groupBy("v").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return per_node.filter("up > 1 or (up > 0 and down > 0)").isEmpty()


def roots(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links(a, b)`` but the roots; root is the smallest node of
    the component.  Link tables are written between the steps and never collected; a hub's links are
    aggregated before they are shuffled and its join is left to skew handling.  The result is a
    stored table."""
    edges = stored(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .distinct(), "links")
    while not _flat(edges):
        last, edges = edges, stored(_star(_star(edges, True), False), "links")
        release(last)
    out = stored(edges.select(F.col("a").alias("node"), F.col("b").alias("root")), "roots")
    release(edges)
    return out
