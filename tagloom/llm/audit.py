"""How filters act together: every order of five filters, step by step.

Each document is reduced to a mask of the filters it fails, and the table to cells: how
many documents of a part have a mask, and how many of them are good or toxic. A recursive
query then extends prefixes of filters by one unused letter a level, joins the cells of
the part and carries the bits applied so far; a level's rows are the metrics of that step.
A prefix is computed once, however many orders begin with it.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import words, written

LETTERS = "ABCDE"
SAME = 1 << LETTERS.index("E")
MASKS = 1 << len(LETTERS)


def own_mask(text: Column) -> Column:
    """Bits of the filters A to D that a text fails by itself."""
    found = words(text)
    n, body = F.size(found), F.coalesce(text, F.lit(""))
    fails = (
        n < 200,
        100 * F.size(F.array_distinct(found)).cast("long") < 50 * n.cast("long"),
        100 * F.regexp_count(body, F.lit("[A-Z]")).cast("long") > 2 * F.length(body).cast("long"),
        body.rlike("[#$%&*|]"),
    )
    out = F.lit(0)
    for i, fail in enumerate(fails):
        out = out + F.when(fail, 1 << i).otherwise(0)
    return out


def cells(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text: str = "text", part: str = "source", good: str = "quality", toxic: str = "toxic"
) -> DataFrame:
    """part, mask, n, good, toxic: the documents of a part that fail the filters of a mask."""
    slim = docs.select(
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")), 256)).alias("_sha"),
        own_mask(F.col(text)).alias("_own"),
    )
    # copies under one id are one row before they are sent; rows without an id lie by their text
    slim = slim.groupBy("_id", "part", "_sha", "_own").agg(F.count(F.lit(1)).alias("_n"))
    slim = slim.withColumn("_lane", F.when(F.col("_id").isNull(), F.xxhash64("_sha")).otherwise(0))
    marks = labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("_of")).agg(
        F.coalesce(F.bool_or(F.col(good) == 1), F.lit(False)).alias("_good"),
        F.coalesce(F.bool_or(F.col(toxic) == 1), F.lit(False)).alias("_toxic"),
    )
    marked = slim.join(marks.withColumn("_to", F.lit(0).cast("long")), (F.col("_id") == F.col("_of")) & (F.col("_lane") == F.col("_to")), "left").select(
        "_id", "part", "_sha", "_own", "_n", *[F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("_good", "_toxic")]
    )
    # of a text: how many rows a kind has, and how many of them have the least id there
    named = F.col("_id").isNotNull()
    kinds = marked.groupBy("_sha", "part", "_own", "_good", "_toxic").agg(
        F.sum("_n").alias("_all"),
        F.coalesce(F.sum(F.when(named, F.col("_n"))), F.lit(0)).alias("_named"),
        F.min(F.when(named, F.struct("_id", "_n"))).alias("_least"),
    )
    # a text has at most four rows a part by now
    first = F.min("_least._id").over(Window.partitionBy("_sha"))
    kinds = kinds.withColumn(
        "_later", F.col("_named") - F.when(F.col("_least._id") == first, F.col("_least._n")).otherwise(0)
    )
    split = kinds.select(
        "part",
        "_good",
        "_toxic",
        F.inline(
            F.array(
                F.struct(F.col("_own").alias("mask"), (F.col("_all") - F.col("_later")).alias("n")),
                F.struct(F.col("_own").bitwiseOR(F.lit(SAME)).alias("mask"), F.col("_later").alias("n")),
            )
        ),
    )
    return split.groupBy("part", "mask").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("_good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("_toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def _sum(value: str, condition: str) -> str:
    return f"aggregate(filter(c.cells, x -> {condition}), 0L, (s, x) -> s + x.{value})"


LOST = "(x.mask & p.l.bit) != 0 AND (x.mask & p.applied) = 0"
STEPS = f"""
WITH RECURSIVE steps(part, prefix, letter, applied, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost) AS (
  SELECT part, '', '', 0, 0, 0L, 0L, 0L, 0L, 0L, 0L FROM {{cells}}
  UNION ALL
  SELECT p.part, p.prefix || p.l.letter, p.l.letter, p.applied | p.l.bit, p.step + 1,
    {_sum("n", "(x.mask & (p.applied | p.l.bit)) = 0")},
    {_sum("n", LOST)},
    {_sum("n", "(x.mask & p.l.bit) != 0 AND (x.mask & p.applied) != 0")},
    {_sum("n", "x.mask = p.l.bit")},
    {_sum("good", LOST)},
    {_sum("toxic", LOST)}
  FROM (
    SELECT part, prefix, applied, step, explode(filter(array(
      {", ".join(f"named_struct('letter', '{c}', 'bit', {1 << i})" for i, c in enumerate(LETTERS))}
    ), x -> (applied & x.bit) = 0)) AS l FROM steps
  ) p JOIN {{cells}} c ON c.part = p.part
)
SELECT * FROM steps LIMIT ALL
"""


def prefixes(cell_rows: DataFrame) -> DataFrame:
    """The metrics of every part and prefix of filters, by a recursive query.

    A part has 325 prefixes, from 5 of one letter to 120 of all five; its cells, at most
    ``MASKS``, are one row.
    """
    cells_of = cell_rows.filter("n > 0").groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return cell_rows.sparkSession.sql(STEPS, cells=written(cells_of, "cells")).filter("step > 0")


def interactions(docs: DataFrame, labels: DataFrame, **names: str) -> DataFrame:
    """One row per part, order of the filters and step: part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    A part is a value of the column ``part`` (``source``), null the empty string. Null texts
    are empty. The filters fail a document: A with under 200 words, B with fewer different
    words than half of all, C with over 2 capitals A-Z in 100 characters, D with any of
    ``#$%&*|``, E if a document of a smaller id has its text, in whatever part. A row without
    an id has no smaller one and is no smaller one; rows of one id are none to each other.
    Every row counts as often as it occurs. A label of 1 in any row of an id counts; rows
    without an id have no labels. An empty table gives no rows; other columns are not read.
    """
    order = [F.lit("".join(o)) for o in permutations(LETTERS)]
    left = F.factorial(F.lit(len(LETTERS)) - F.col("step"))  # orders that begin with a prefix
    return (
        prefixes(cells(docs, labels, **names))
        .withColumn("shapley", F.sum(F.col("removed") * left).over(Window.partitionBy("part", "letter")))
        .withColumn("filter_order", F.explode(F.filter(F.array(*order), lambda o: o.startswith(F.col("prefix")))))
        .select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    )
