"""Pages of a large ordered result, read from where they are.

The rows are written once, in ranges of their order, and beside them how many rows a range
has and with which row it begins. Page k, or the page behind a row, then reads the ranges
that hold it, however deep it is; nothing before it is read or sorted again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

RANGE = "page_range"


@dataclass(frozen=True)
class PageIndex:
    """Where the rows are, their schema, their order as ``(column, descending)``, and the ranges in order:
    number, rows before it, rows in it, and its first row's values of the order."""

    path: str
    schema: str
    order: tuple[tuple[str, bool], ...]
    ranges: tuple[tuple[int, int, int, tuple], ...]

    @property
    def total(self) -> int:
        return sum(n for _, _, n, _ in self.ranges)


def _sorted(order: Sequence[tuple[str, bool]]) -> list[Column]:
    """Least first with nulls first, or greatest first with nulls last."""
    return [F.desc(c) if down else F.asc(c) for c, down in order]


def write_pages(df: DataFrame, path: str, order: Sequence[str | tuple[str, bool]], parts: int) -> PageIndex:
    """Write the rows in ``parts`` ranges of the order, which must be total, and their index.

    Range borders come from Spark's sample of the order; a column says which range a row is
    in, and its folder can be left out of a scan by name. The index has a row a range.
    """
    keys = tuple((o, False) if isinstance(o, str) else (o[0], bool(o[1])) for o in order)
    by = _sorted(keys)
    ranged = df.repartitionByRange(parts, *by).withColumn(RANGE, F.spark_partition_id())
    ranged.sortWithinPartitions(*by).write.mode("errorifexists").partitionBy(RANGE).parquet(f"{path}/rows")
    rows = _rows(df.sparkSession, path, df.schema.json()).select(RANGE, *[c for c, _ in keys])
    # Spark keeps one row a range and task before it looks for the first of all
    first = rows.withColumn("_at", F.row_number().over(Window.partitionBy(RANGE).orderBy(*by))).where("_at = 1").drop("_at")
    index = rows.groupBy(RANGE).agg(F.count("*").alias("n")).join(first, RANGE).withColumn("schema", F.lit(None).cast("string"))
    about = df.sparkSession.range(1).select(F.lit(-1).alias(RANGE), F.lit(df.schema.json()).alias("schema"))
    index.unionByName(about, allowMissingColumns=True).coalesce(1).write.mode("errorifexists").parquet(f"{path}/index")
    return open_pages(df.sparkSession, path, keys)


def _rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    shape = T.StructType.fromJson(json.loads(schema)).add(RANGE, T.IntegerType())
    return spark.read.schema(shape).parquet(f"{path}/rows")


def open_pages(spark: SparkSession, path: str, order: Sequence[str | tuple[str, bool]]) -> PageIndex:
    """The index of pages written before; it has a row a range."""
    keys = tuple((o, False) if isinstance(o, str) else (o[0], bool(o[1])) for o in order)
    before, ranges = 0, []
    about, *rows = spark.read.parquet(f"{path}/index").orderBy(RANGE).collect()
    for r in rows:
        ranges.append((r[RANGE], before, r["n"], tuple(r[c] for c, _ in keys)))
        before += r["n"]
    return PageIndex(path, about["schema"], keys, tuple(ranges))


def read_page(spark: SparkSession, index: PageIndex, number: int, size: int) -> DataFrame:
    """Page ``number``, from 1, of ``size`` rows; smaller numbers mean the first page."""
    start = max(0, (number - 1) * size)
    held = [(r, before) for r, before, n, _ in index.ranges if before < start + size and start < before + n]
    rows = _rows(spark, index.path, index.schema)
    if not held:
        return rows.where(F.lit(False)).drop(RANGE)
    found = rows.where(F.col(RANGE).isin(*[r for r, _ in held])).drop(RANGE)
    return found.orderBy(*_sorted(index.order)).offset(start - held[0][1]).limit(size)


def read_after(spark: SparkSession, index: PageIndex, row: Sequence, size: int) -> DataFrame:
    """The ``size`` rows behind a row, given by its values of the order's columns.

    Only the range that the row falls into is read, and those behind it that a page of that
    size can reach. The row need not exist any more.
    """
    rows = _rows(spark, index.path, index.schema)
    at = max([0, *[i for i, (*_, first) in enumerate(index.ranges) if not _comes_after(index.order, first, row)]])
    wanted, left = [], size
    for i, (r, _, n, _) in enumerate(index.ranges[at:]):
        if left > 0:
            wanted.append(r)
            left -= n if i else 0  # of the first one all rows may lie before
    found = rows.where(F.col(RANGE).isin(*wanted) & _behind(index.order, row)).drop(RANGE)
    return found.orderBy(*_sorted(index.order)).limit(size)


def _comes_after(order: Sequence[tuple[str, bool]], row: Sequence, other: Sequence) -> bool:
    """Whether a row comes behind another one."""
    for (_, down), a, b in zip(order, row, other, strict=True):
        if a != b:
            if a is None or b is None:
                return (a is None) == down
            return (a < b) == down
    return False


def _behind(order: Sequence[tuple[str, bool]], row: Sequence) -> Column:
    """Whether a row comes behind the given one; nulls come first going up, last going down."""
    out, same = F.lit(False), F.lit(True)
    for (name, down), value in zip(order, row, strict=True):
        column, given = F.col(name), F.lit(value)
        if value is None:
            later = F.lit(False) if down else column.isNotNull()
        elif down:
            later = column.isNull() | (column < given)
        else:
            later = F.coalesce(column > given, F.lit(False))
        out = out | (same & later)
        same = same & column.eqNullSafe(given)
    return out
