"""Connected components by contracting stars, each round written to the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import written


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame, *, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) of every node that has a link; root is the least node it reaches.

    A round moves the larger neighbours of every node to the least one (large star), then
    the smaller ones (small star); after a number of rounds that grows with the logarithm
    of the longest path nothing changes. Nodes are joined with the least neighbour of
    each, never gathered, so a node of any degree is dealt out like others. Links of a
    node with itself and repeated links change nothing; no links give no rows.
    """
    edges = links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b").distinct()
    edges = written(edges, "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = written(large, "large-star")
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").select(
            F.explode(
                F.array(
                    F.struct(F.col("a").alias("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        )
        edges = written(small.select("e.a", "e.b").filter("a <> b").distinct(), "small-star")
        before, mark = mark, _mark(edges)
        if mark == before:
            break
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        roots.select("node", F.col("node").alias("root"))
    )
