"""Bands as a table against the tests of short lists and against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagloom.operators import intervals, stats
from tagloom.specs import Rule, bands, in_order, parse_band
from tagloom.session import small_table


def table(spark, rules):
    return intervals.band_table(small_table(spark, [(r.text, r.tag_id, r.order) for r in rules], "rule string, tag_id bigint, `order` int"))


TEXTS = ["1-5", "3~4", ">=10", ">12", "<=0", "<-3", "<0-2", "7day", "6", "0.5-0.7", "-2--1", "60second-299second", "9-8.5", "20-11", "1.0-1"]


def test_every_form_of_a_band(spark):
    found = {(r.place.id, r.lo, r.hi, r.lo_open, r.hi_open) for r in table(spark, [Rule(i, t) for i, t in enumerate(TEXTS)]).collect()}
    want = {(b.tag_id, b.lo, b.hi, b.lo_open, b.hi_open) for b in (parse_band(Rule(i, t)) for i, t in enumerate(TEXTS))}
    assert found == want
    with pytest.raises(Exception, match="not a band rule: often"):
        table(spark, [Rule(1, "often")]).collect()


@pytest.mark.parametrize("dtype", ["bigint", "double", "decimal(14,3)", "int"])
@pytest.mark.parametrize("parts", [1, 7])
def test_same_as_the_list(spark, dtype, parts):
    rng = random.Random(f"{dtype}{parts}")
    rules = [Rule(i, t, rng.choice([None, 1, 2, i])) for i, t in enumerate(TEXTS, start=100)]
    values = [x / 4 for x in range(-30, 130)] + [None, 299.0, 300.0, 1e9] + [3.0] * 40
    if dtype == "double":
        values += [math.nan, math.inf, -math.inf, 0.1 + 0.2, 0.7, 0.5]
    df = spark.createDataFrame([(i % 150, v) for i, v in enumerate(values)], "id long, v double").select("id", F.col("v").cast(dtype).alias("v"))
    want = sorted(map(tuple, stats.range_tag(df, "id", F.col("v"), bands(rules)).collect()), key=repr)
    got = sorted(map(tuple, intervals.interval_tag(df, "id", "v", table(spark, rules), parts=parts).collect()), key=repr)
    assert got == want and len(got) == len(values)


def test_no_bands_and_no_values(spark):
    df = spark.createDataFrame([(1, 2.0), (2, None)], "id long, v double")
    none = table(spark, [Rule(1, "1-2")]).limit(0)
    assert sorted(map(tuple, intervals.interval_tag(df, "id", "v", none).collect())) == [(1, None), (2, None)]
    assert intervals.interval_tag(df.limit(0), "id", "v", table(spark, [Rule(1, "1-2")])).collect() == []
    everything = table(spark, [Rule(1, ">=5"), Rule(2, "<5")])
    assert sorted(map(tuple, intervals.interval_tag(df, "id", "v", everything).collect()), key=repr) == [(1, 2), (2, None)]


def test_whole_numbers_beyond_a_double(spark):
    big = 1 << 60
    df = spark.createDataFrame([(i, big + i) for i in range(5)], "id long, v long")
    rules = [Rule(1, f"{big + 1}-{big + 2}"), Rule(2, f">{big + 3}")]
    assert sorted(map(tuple, intervals.interval_tag(df, "id", "v", table(spark, rules)).collect())) == [(0, None), (1, 1), (2, 1), (3, None), (4, 2)]


def test_a_hundred_thousand_bands_over_a_million_values(spark):
    """Long, short, nested and equal bands; a third of the values is one number."""
    n, m = 100_000, 1_000_000
    lo = "CAST((id * 7919) % 1000003 AS BIGINT)"
    width = "CASE WHEN id % 1000 = 0 THEN 200000 WHEN id % 10 = 0 THEN 300 ELSE id % 7 END"
    rules = spark.range(n).selectExpr(
        f"CONCAT(CAST({lo} AS STRING), '-', CAST({lo} + {width} AS STRING)) AS rule", "id AS tag_id", "CAST((id * 31) % 977 AS INT) AS `order`"
    )
    df = spark.range(m).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 500000 ELSE (id * 104729) % 1300007 END AS v")
    out = intervals.interval_tag(df, "id", "v", intervals.band_table(rules), parts=16)
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "Python" not in plan
    got = out.toPandas().sort_values("id")["tag_id"].to_numpy()
    i = np.arange(n)
    starts = i * 7919 % 1000003
    ends = starts + np.where(i % 1000 == 0, 200000, np.where(i % 10 == 0, 300, i % 7))
    # painted from the last band to the first
    held = np.full(1_400_000, -1)
    for at in sorted(range(n), key=lambda t: (t * 31 % 977, t), reverse=True):
        held[starts[at] : ends[at] + 1] = at
    j = np.arange(m)
    want = held[np.where(j % 3 == 0, 500000, j * 104729 % 1300007)].astype(float)
    want[want < 0] = np.nan
    assert np.array_equal(got.astype(float), want, equal_nan=True)


def test_a_hot_value_is_spread(spark):
    df = spark.range(30_000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 50.0 ELSE CAST(id AS DOUBLE) END AS v")
    points = df.selectExpr("v AS d")
    ranges = intervals._Ranges(points, 30)
    assert max(ranges.shares) >= 9 and len(ranges.borders) < 25
    rules = in_order([Rule(1, "0-49"), Rule(2, "50"), Rule(3, ">50")])
    out = intervals.interval_tag(df, "id", "v", table(spark, rules), parts=30)
    assert dict(map(tuple, out.groupBy("tag_id").count().collect())) == {1: 33, 2: 10_001, 3: 30_000 - 10_034}
