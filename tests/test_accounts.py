"""The account index against a look at all users."""

import re

import pytest

from tagloom.operators import accounts, search

USERS = "id bigint, mobile string, email string, qq string, id_card string"


@pytest.fixture(scope="module")
def users(spark):
    rows = [(i, f"13{i:09d}", f"c{i}@mail.example.com", str(i + 10000), None if i % 3 else f"1101{i:013d}X") for i in range(2000)]
    rows += [(5000 + i, "13999999999", None, None, None) for i in range(700)]  # one number for many
    rows += [(1, "13000000001", None, "10001", None), (None, "13000000002", None, None, None), (9000, None, None, None, None)]
    return spark.createDataFrame(rows, USERS).repartition(4)


def numbers(spark, values):
    return spark.createDataFrame([(v,) for v in values], "num string")


ASKED = ["13000000001", "13000000001", "c5@mail.example.com", "10001", "13999999999", "11010000000000300X", "13000000002", "nobody", None, ""]


def found(df):
    return sorted(tuple(r) for r in df.collect()) if df is not None else []


@pytest.mark.parametrize("buckets", [1, 7, 64])
def test_same_as_over_all_users(spark, users, tmp_path, buckets):
    index = accounts.write_accounts(users, str(tmp_path / "index"), buckets=buckets)
    key = lambda r: (r[0], r[1], r[2] is None, r[2] or 0)
    asked = numbers(spark, ASKED)
    got = sorted((tuple(r) for r in accounts.find_accounts(spark, index, asked).collect()), key=key)
    want = sorted((tuple(r) for r in search.lookup_users(asked, users).collect()), key=key)
    assert got == want and len(got) > 700


def test_reads_only_the_buckets_asked_for(spark, users, tmp_path):
    index = accounts.write_accounts(users, str(tmp_path / "index"), buckets=64)
    out = accounts.find_accounts(spark, index, numbers(spark, ["13000000007", "10042", "nobody"]))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and re.search(r"PartitionFilters: \[.*bucket", plan)
    rows = spark.read.schema(accounts.SCHEMA).parquet(index.path)
    assert rows.select("bucket").distinct().count() > 32
    assert found(out) == [("10042", "qq", 42), ("13000000007", "mobile", 7)]


def test_a_number_of_many_users_is_written_by_several_tasks(spark, users, tmp_path):
    # so few rows would be put back together into one task
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        accounts.write_accounts(users, str(tmp_path / "index"), buckets=16, lanes=4)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = spark.read.parquet(str(tmp_path / "index")).where("num = '13999999999'").selectExpr("input_file_name() AS f").groupBy("f").count()
    counts = [r["count"] for r in files.collect()]
    assert sum(counts) == 700 and len(counts) >= 2


def test_empty(spark, users, tmp_path):
    index = accounts.write_accounts(users.limit(0), str(tmp_path / "none"), buckets=8)
    assert accounts.find_accounts(spark, index, numbers(spark, ASKED)).count() == 0
    index = accounts.write_accounts(users, str(tmp_path / "all"), buckets=8)
    assert accounts.find_accounts(spark, index, numbers(spark, [])).count() == 0
    with pytest.raises(Exception, match="(?i)exists"):
        accounts.write_accounts(users, str(tmp_path / "all"), buckets=8)
