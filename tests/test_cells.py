import pytest
from pyspark.sql import functions as F

from tagloom.operators import cells
from tagloom.session import small_table

CELLS = "rowkey string, family string, qualifier string, value string, ts bigint"
DATA = [
    ("1", "f", "a", "old", 1), ("1", "f", "a", "new", 2), ("1", "f", "b", "x", 1), ("2", "f", "a", "newer", 5),
    ("10", "f", "b", "x", 1), ("10", "g", "a", "other", 9), ("3", "f", "a", "t1", 7), ("3", "f", "a", "t2", 7),
]


@pytest.fixture(scope="module")
def store(spark):
    return small_table(spark, DATA, CELLS)


def keys(df):
    return [r["rowkey"] for r in df.collect()]


def test_round_trip(spark, rows):
    df = small_table(spark, [(1, "a", None), (2, None, "b"), (None, "x", "y")], "id bigint, p string, q string")
    made = cells.rows_to_cells(df, "id", "f")
    assert rows(made.select("rowkey", "qualifier", "value")) == {("1", "p", "a"), ("2", "q", "b")}
    assert rows(cells.cells_to_rows(made, "f", ["p", "q"])) == {("1", "a", None), ("2", None, "b")}


def test_sorted_cells_are_in_total_order(store):
    parts = cells.sort_cells(store, 3).select("rowkey", "family", "qualifier", "ts").rdd.glom().collect()
    flat = [tuple(r) for part in parts for r in part]
    assert flat == sorted(flat) and len(flat) == len(DATA)


def test_newest_version(store, rows):
    assert rows(cells.latest(store)) == {
        ("1", "f", "a", "new", 2), ("1", "f", "b", "x", 1), ("2", "f", "a", "newer", 5), ("10", "f", "b", "x", 1),
        ("10", "g", "a", "other", 9), ("3", "f", "a", "t2", 7),
    }


def test_scan(store):
    got = {r["rowkey"]: r["cells"] for r in cells.scan(store, "f").collect()}
    assert got == {"1": {"a": "new", "b": "x"}, "2": {"a": "newer"}, "10": {"b": "x"}, "3": {"a": "t2"}}


def test_time_range_sees_the_newest_inside(store, rows):
    assert rows(cells.time_range(store, 1, 2).select("rowkey", "value")) == {("1", "old"), ("1", "x"), ("10", "x")}


def test_keys(spark, store):
    assert sorted(keys(cells.get(store, "1"))) == ["1", "1"]
    assert set(keys(cells.key_range(store, "1", "2"))) == {"1", "10"}
    wanted = small_table(spark, [("2",), ("2",), ("9",)], "rowkey string")
    assert keys(cells.multi_get(store, wanted)) == ["2"]
    assert set(keys(cells.all_row_keys(store))) == {"1", "2", "3", "10"}


def test_values(store):
    assert keys(cells.value_contains(store, "f", "a", "new", 1)) == ["1"]
    assert sorted(keys(cells.value_contains(store, "f", "a", "new"))) == ["1", "2"]
    assert keys(cells.value_equals(store, "f", "a", "old")) == []
    assert keys(cells.has_qualifier(store, "f", "b", 5)) == ["1", "10"]
    assert keys(cells.match_all(store, "f", {"a": "new", "b": "x"})) == ["1"]
    assert sorted(keys(cells.match_any(store, "f", {"a": "newer", "b": "x"}))) == ["1", "10", "2"]
    assert cells.count_contains(store, "f", "b", "x").first()["n"] == 2


def test_changes(spark, store, rows):
    target = small_table(spark, [("1", "z")], "rowkey string, v string")
    changed = cells.update_qualifier(store, target, "f", "a", F.col("v"), 3)
    assert ("1", "f", "a", "z", 3) in rows(changed)
    late = cells.update_qualifier(store, target, "f", "a", F.col("v"), 0)
    assert ("1", "f", "a", "new", 2) in rows(late)
    assert set(keys(cells.delete_rows(store, target))) == {"2", "3", "10"}
