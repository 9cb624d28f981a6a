"""Cells: one row per (rowkey, family, qualifier, value, ts), all values text.

Queries see the newest version of every cell, like a store that keeps several
versions and shows one. Equal timestamps are settled by the greater value.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import broadcast_if, is_small

CELL = ["rowkey", "family", "qualifier"]


def rows_to_cells(
    df: DataFrame, key: str, family: str, fields: Sequence[str] | None = None, ts: Column | None = None
) -> DataFrame:
    """One cell per non-null field of every row that has a key."""
    names = list(fields) if fields is not None else [c for c in df.columns if c != key]
    cells = F.array(
        *[F.struct(F.lit(n).alias("qualifier"), F.col(n).cast("string").alias("value")) for n in names]
    )
    stamp = F.lit(0).cast("bigint") if ts is None else ts.cast("bigint")
    return (
        df.where(F.col(key).isNotNull())
        .select(F.col(key).cast("string").alias("rowkey"), stamp.alias("ts"), F.explode(cells).alias("c"))
        .where("c.value is not null")
        .select("rowkey", F.lit(family).alias("family"), "c.qualifier", "c.value", "ts")
    )


def sort_cells(cells: DataFrame, partitions: int | None = None) -> DataFrame:
    """Total order by key, then qualifier. The ranges are cut over the whole cell
    name, so the cells of one heavy key may span several partitions."""
    order = ["rowkey", "family", "qualifier", "ts"]
    spread = cells.repartitionByRange(partitions, *order) if partitions else cells.repartitionByRange(*order)
    return spread.sortWithinPartitions(*order)


def latest(cells: DataFrame) -> DataFrame:
    """Newest version of every cell."""
    newest = F.max(F.struct("ts", "value"))
    return cells.groupBy(*CELL).agg(newest.alias("_v")).select(
        *CELL, F.col("_v.value").alias("value"), F.col("_v.ts").alias("ts")
    )


def cells_to_rows(
    cells: DataFrame, family: str, fields: Sequence[str], key: str = "row", all_rows: bool = False
) -> DataFrame:
    """The declared fields of one family as columns, newest version each.

    One aggregation by key serves all fields. A row must have at least one of them, or
    with ``all_rows`` any cell of the family.
    """
    wanted = cells.where(F.col("family") == family)
    if not all_rows:
        wanted = wanted.where(F.col("qualifier").isin(*fields))
    newest = [
        F.max(F.when(F.col("qualifier") == f, F.struct("ts", "value")))["value"].alias(f) for f in fields
    ]
    return wanted.groupBy(F.col("rowkey").alias(key)).agg(*newest)


def scan(cells: DataFrame, family: str) -> DataFrame:
    """Every row of a family as a map from qualifier to value."""
    pairs = F.map_from_entries(F.sort_array(F.collect_list(F.struct("qualifier", "value"))))
    return latest(cells.where(F.col("family") == family)).groupBy("rowkey").agg(pairs.alias("cells"))


def time_range(cells: DataFrame, start: int, stop: int) -> DataFrame:
    """Newest versions among the cells written in ``[start, stop)``."""
    return latest(cells.where((F.col("ts") >= start) & (F.col("ts") < stop)))


def get(cells: DataFrame, key: str) -> DataFrame:
    return latest(cells.where(F.col("rowkey") == key))


def multi_get(cells: DataFrame, keys: DataFrame, column: str = "rowkey") -> DataFrame:
    """Cells of the rows named in a table of keys."""
    wanted = keys.select(F.col(column).alias("rowkey"))
    wanted = broadcast_if(is_small(wanted), wanted)
    return latest(cells.join(wanted, "rowkey", "left_semi"))


def key_range(cells: DataFrame, start: str, stop: str) -> DataFrame:
    """Rows from ``start`` up to but without ``stop``, in byte order."""
    return latest(cells.where((F.col("rowkey") >= start) & (F.col("rowkey") < stop)))


def _first(keys: DataFrame, n: int | None) -> DataFrame:
    return keys if n is None else keys.orderBy("rowkey").limit(n)


def value_contains(cells: DataFrame, family: str, qualifier: str, text: str, n: int | None = None) -> DataFrame:
    """Rows whose newest value contains the text; both the value test and the
    page size hold."""
    return _first(_newest(cells, family, qualifier).where(F.contains("value", F.lit(text))), n)


def value_equals(cells: DataFrame, family: str, qualifier: str, value: str) -> DataFrame:
    return _newest(cells, family, qualifier).where(F.col("value") == value)


def _newest(cells: DataFrame, family: str, qualifier: str) -> DataFrame:
    one = cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier))
    return latest(one).select("rowkey", "value")


def has_qualifier(cells: DataFrame, family: str, qualifier: str, n: int | None = None) -> DataFrame:
    keys = cells.where((F.col("family") == family) & (F.col("qualifier") == qualifier)).select("rowkey").distinct()
    return _first(keys, n)


def match_all(cells: DataFrame, family: str, wanted: Mapping[str, str], n: int | None = None) -> DataFrame:
    """Rows whose named cells all have the given values."""
    rows = _wide(cells, family, wanted)
    test = F.lit(True)
    for name, value in wanted.items():
        test = test & F.coalesce(F.col(name) == value, F.lit(False))
    return _first(rows.where(test).select("rowkey"), n)


def match_any(cells: DataFrame, family: str, wanted: Mapping[str, str], n: int | None = None) -> DataFrame:
    rows = _wide(cells, family, wanted)
    test = F.lit(False)
    for name, value in wanted.items():
        test = test | F.coalesce(F.col(name) == value, F.lit(False))
    return _first(rows.where(test).select("rowkey"), n)


def _wide(cells: DataFrame, family: str, wanted: Mapping[str, str]) -> DataFrame:
    return cells_to_rows(cells, family, list(wanted), key="rowkey")


def count_contains(cells: DataFrame, family: str, qualifier: str, text: str) -> DataFrame:
    return value_contains(cells, family, qualifier, text).agg(F.count("*").alias("n"))


def all_row_keys(cells: DataFrame) -> DataFrame:
    return cells.select("rowkey").distinct()


def upsert(cells: DataFrame, changes: DataFrame) -> DataFrame:
    """Last write wins per cell; a new snapshot."""
    return latest(cells.unionByName(changes))


def update_qualifier(cells: DataFrame, keys: DataFrame, family: str, qualifier: str, value: Column, ts: int) -> DataFrame:
    """Write one qualifier of many rows; ``keys`` has ``rowkey`` and what ``value`` reads."""
    changes = keys.select(
        "rowkey",
        F.lit(family).alias("family"),
        F.lit(qualifier).alias("qualifier"),
        value.cast("string").alias("value"),
        F.lit(ts).cast("bigint").alias("ts"),
    )
    return upsert(cells, changes)


def delete_rows(cells: DataFrame, keys: DataFrame) -> DataFrame:
    gone = keys.select("rowkey")
    return cells.join(broadcast_if(is_small(gone), gone), "rowkey", "left_anti")
