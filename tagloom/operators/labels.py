"""Interval labels of a tree of any depth.

Every tag gets its number in a walk from the roots down and the number of the last tag below
it, so "at or below" is a test of a range and needs no chain of ancestors. Sizes, numbers and
depths are made by pointer doubling: in round k every tag knows the tag 2 ** k steps up, and
what lies between them is added up at once, so a tree of depth d takes log d joins. A tag
whose pointer never ends stands on a cycle or below one; it is reported, not numbered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.session import stored


def _join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """A join that shuffles both sides. The tables of every round would each go through the
    driver if they were broadcast, which Spark does by their size in files."""
    return left.join(right.hint("merge"), on, how)


def _climb(nodes: DataFrame, value: str) -> tuple[DataFrame, DataFrame]:
    """Values added up from every node to its root, as ``(id, value)``, and the nodes without
    a root. ``nodes`` has ``id, up`` (null at a root) and the value.

    A round that ends no pointer is the last: of the nodes whose pointers still run, one with
    a root would have a node above it that ended in this round.
    """
    at = nodes.select("id", "up", value)
    done, running = at.where("up is null"), at.where("up is not null")
    for _ in range(nodes.count().bit_length() + 1):
        if not running.take(1):
            break
        above = done.unionByName(running).select(F.col("id").alias("_id"), F.col("up").alias("_up"), F.col(value).alias("_v"))
        at = _join(running, above, F.col("up") == F.col("_id"), "left").select(
            "id", F.col("_up").alias("up"), (F.col(value) + F.coalesce("_v", F.lit(0))).alias(value)
        )
        at = stored(at, "climb")
        ended, running = at.where("up is null"), at.where("up is not null")
        if not ended.take(1):
            break
        done = done.unionByName(ended)
    return done.select("id", value), running.select("id")


def _sizes(nodes: DataFrame) -> DataFrame:
    """``(id, up, size)``: how many nodes are at or below each; nodes have a root."""
    at = nodes.select("id", "up", F.col("up").alias("_jump"), F.lit(1).cast("bigint").alias("size"))
    while at.where("_jump is not null").take(1):
        # what the nodes this far below hold; many of one node are summed before they are sent
        below = at.where("_jump is not null").groupBy(F.col("_jump").alias("_to")).agg(F.sum("size").alias("_more"))
        above = at.select(F.col("id").alias("_id"), F.col("_jump").alias("_next"))
        at = _join(at, below, F.col("id") == F.col("_to"), "left")
        at = _join(at, above, F.col("_jump") == F.col("_id"), "left").select(
            "id", "up", F.col("_next").alias("_jump"), (F.col("size") + F.coalesce("_more", F.lit(0))).alias("size")
        )
        at = stored(at, "sizes")
    return at.select("id", "up", "size")


def _before(nodes: DataFrame, order: list[Column]) -> DataFrame:
    """Adds ``before``: the sizes of a node's earlier siblings, summed up.

    Siblings are dealt in ranges of their order, so those of one parent may lie in many
    tasks: each sums its own, and one row a parent and range says what comes before it.
    """
    ranged = nodes.repartitionByRange(F.col("up").asc_nulls_first(), *order).withColumn("_range", F.spark_partition_id())
    ranged = stored(ranged, "siblings")
    here = Window.partitionBy("_range", "up").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    totals = ranged.groupBy("_range", "up").agg(F.sum("size").alias("_sum"))
    ahead = Window.partitionBy("up").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.withColumn("_ahead", F.coalesce(F.sum("_sum").over(ahead), F.lit(0)))
    totals = totals.select(F.col("_range").alias("_r"), F.col("up").alias("_u"), "_ahead")
    mine = ranged.withColumn("_mine", F.coalesce(F.sum("size").over(here), F.lit(0)))
    return _join(mine, totals, (F.col("_range") == F.col("_r")) & F.col("up").eqNullSafe(F.col("_u"))).select(
        *nodes.columns, (F.col("_ahead") + F.col("_mine")).alias("before")
    )


def tree_labels(tags: DataFrame, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(id, pid, first, last, depth)`` of every tag with a root, and the ``id`` of the others.

    ``first`` is the tag's number from 1 in a walk of the whole forest, ``last`` the greatest
    number at or below it, ``depth`` 1 at a root. Siblings stand by ``order`` (null first) and
    id. A tag whose parent is not in the table is a root; ids are unique and not null.
    """
    nodes = tags.select("id", "pid", *([F.col(order).alias("_order")] if order else [F.lit(None).cast("int").alias("_order")]))
    known = nodes.select(F.col("id").alias("up"))
    nodes = stored(_join(nodes, known, F.col("pid") == F.col("up"), "left"), "nodes")
    depths, lost = _climb(nodes.withColumn("depth", F.lit(1).cast("bigint")), "depth")
    rooted = _join(nodes, depths, "id")
    sized = _join(_sizes(rooted), rooted.select("id", "pid", "_order", "depth"), "id")
    placed = _before(sized, [F.col("_order").asc_nulls_first(), F.col("id").asc()])
    firsts, _ = _climb(placed.withColumn("first", F.col("before") + 1), "first")
    out = _join(placed, firsts, "id").select("id", "pid", "first", (F.col("first") + F.col("size") - 1).alias("last"), "depth")
    return out, lost


def at_or_below(labels: DataFrame, ids: list[int]) -> DataFrame:
    """Labels of all tags at or below the ids, once each: those whose number lies in a range."""
    asked = labels.where(F.col("id").isin(*ids)).select("first", "last")
    ranges = asked.orderBy("first").collect()  # at most as many as there are ids
    test = F.lit(False)
    covered = 0
    for r in ranges:
        if r["first"] > covered:  # the others lie inside one before
            test = test | F.col("first").between(r["first"], r["last"])
            covered = r["last"]
    return labels.where(test)


def above(labels: DataFrame, tag_id: int) -> DataFrame:
    """Labels of the tags above one: those whose range holds its number."""
    mine = labels.where(F.col("id") == tag_id).select("first").take(1)
    if not mine:
        return labels.where(F.lit(False))
    return labels.where(F.lit(mine[0]["first"]).between(F.col("first"), F.col("last")) & (F.col("id") != tag_id))
