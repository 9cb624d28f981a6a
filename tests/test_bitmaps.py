"""Bitmaps and pages against the lists they stand for."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tagloom.operators import bitmaps, composite, pages, search


@pytest.fixture(scope="module")
def profile(spark):
    rng = random.Random(4)
    rows = [(u, rng.sample(range(10, 40), rng.randrange(0, 8))) for u in range(1, 600)]
    rows += [(u * 32_768, [10, 11, u]) for u in range(1, 20)] + [(-5, [10, 11]), (0, [10, 12]), (1 << 40, [11]), (7, [10, 10]), (None, [10]), (8, None)]
    rows += [(u, [10]) for u in range(70_000, 70_100)]
    return spark.createDataFrame(rows, "user_id long, tag_ids array<long>").repartition(5)


def sets(profile):
    held = {}
    for u, tags in profile.collect():
        if u is not None:
            held.setdefault(u, set()).update(tags or [])
    return held


def test_any_all_and_counts(spark, profile, rows):
    held, maps = sets(profile), bitmaps.tag_bitmaps(profile)
    assert rows(bitmaps.members(bitmaps.any_of(maps, [10, 25]))) == {(u,) for u, t in held.items() if t & {10, 25}}
    assert rows(bitmaps.members(bitmaps.all_of(maps, [10, 11, 11]))) == {(u,) for u, t in held.items() if {10, 11} <= t}
    assert rows(bitmaps.members(bitmaps.all_of(maps, [10, 9999]))) == set()
    assert bitmaps.count_users(bitmaps.all_of(maps, [10, 11])).first()[0] == sum({10, 11} <= t for t in held.values())
    assert bitmaps.count_users(bitmaps.all_of(maps, [9999])).first()[0] == 0
    assert rows(bitmaps.members(maps)) == {(t, u) for u, tags in held.items() for t in tags}
    want = {}
    for tags in held.values():
        for t in tags:
            want[t] = want.get(t, 0) + 1
    assert {(r.tag_id, r.user_count) for r in bitmaps.tag_counts(maps).collect()} == set(want.items())
    assert bitmaps.members(bitmaps.user_bitmaps(profile)).count() == len(held)


@pytest.mark.parametrize("groups", [1, 2, 70])
def test_composite_rules(spark, profile, rows, groups):
    held, maps = sets(profile), bitmaps.tag_bitmaps(profile)
    rules = [(i, [(10 + (i + j) % 30, "or" if (i + j) % 3 else "and") for j in range(groups * 2)]) for i in range(12)]
    want = {
        (mid, u) for mid, members in rules for u, t in held.items() if all(t & set(g) for g in composite.groups_of(members))
    }
    assert rows(bitmaps.members(bitmaps.eval_merge_bitmaps(maps, rules))) == want
    assert groups > 2 or want
    with pytest.raises(ValueError):
        bitmaps.eval_merge_bitmaps(maps, rules + rules[:1])


# ---------------------------------------------------------------- pages




def ranges_of(df):
    """Ranges that the scan of a page is left with."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    (found,) = set(re.findall(r"PartitionFilters: \[[^\]]*page_range#\d+ (?:IN \(([\d,]+)\)|= (\d+))", plan))
    return (found[0] or found[1]).split(",")


def test_a_deep_page_reads_its_ranges_only(spark, tmp_path):
    df = spark.range(100_000).select(((F.col("id") * 7919) % 100_003).alias("k"), F.col("id").alias("v")).repartition(9)
    index = pages.write_pages(df, str(tmp_path / "p"), ["k"], 20)
    assert index.total == 100_000 and len(index.ranges) == 20
    order = [r.k for r in df.orderBy("k").collect()]
    for number in (1, 2, 450, 900, 1000, 0, -3):
        found = pages.read_page(spark, index, number, 100)
        start = max(0, (number - 1) * 100)
        assert [r.k for r in found.collect()] == order[start : start + 100]
    deep = pages.read_page(spark, index, 900, 100)
    assert len(ranges_of(deep)) <= 2
    plan = deep._jdf.queryExecution().executedPlan().toString()
    limits = [int(x.split(",")[0]) for x in plan.split("TakeOrderedAndProject(limit=")[1:]]
    assert limits and max(limits) <= 100_000 // 20 + 2_000 + 100
    assert pages.read_page(spark, index, 1001, 100).collect() == []
    for at in (0, 1234, 89_900, 99_950, 99_999):
        after = pages.read_after(spark, index, (order[at],), 100)
        assert [r.k for r in after.collect()] == order[at + 1 : at + 101]
        assert len(ranges_of(after)) <= 2
    assert [r.k for r in pages.read_after(spark, index, (-1,), 5).collect()] == order[:5]
    assert [r.k for r in pages.read_after(spark, pages.open_pages(spark, str(tmp_path / "p"), ["k"]), (order[50_000] - 0.5,), 3).collect()] == order[50_000:50_003]


def test_mixed_orders_nulls_and_no_rows(spark, tmp_path):
    rng = random.Random(1)
    rows = [(rng.choice([None, 1, 2, 3]), rng.choice([None, "a", "b", "é"]), i) for i in range(500)]
    df = spark.createDataFrame(rows, "a int, b string, c long")
    order = [("a", True), "b", ("c", True)]
    index = pages.write_pages(df, str(tmp_path / "m"), order, 6)
    want = [tuple(r) for r in df.orderBy(F.desc("a"), F.asc("b"), F.desc("c")).collect()]
    for number in (1, 7, 25):
        assert [tuple(r) for r in pages.read_page(spark, index, number, 20).collect()] == want[(number - 1) * 20 : number * 20]
    for at in (0, 99, 250, 498, 499):
        assert [tuple(r) for r in pages.read_after(spark, index, want[at], 20).collect()] == want[at + 1 : at + 21]
    empty = pages.write_pages(df.limit(0), str(tmp_path / "e"), order, 6)
    assert empty.total == 0 and pages.read_page(spark, empty, 1, 5).collect() == [] == pages.read_after(spark, empty, (1, "a", 2), 5).collect()


def test_search_pages_equal_the_sorted_ones(spark, profile, tmp_path, rows):
    found = bitmaps.members(bitmaps.any_of(bitmaps.tag_bitmaps(profile), [10]))
    index = pages.write_pages(found, str(tmp_path / "s"), ["user_id"], 4)
    for number in (1, 3, 9):
        assert rows(pages.read_page(spark, index, number, 17)) == rows(search.page(found, ["user_id"], number, 17))


def test_tags_of_few_users_far_apart_take_few_bytes(spark, rows):
    # 300 users a tag, no two in one bucket: a bitmap of four kilobytes each would be 24 MB
    held = spark.range(6_000).select((F.col("id") * 40_009 - 3_000_000).alias("user_id"), F.array(F.col("id") % 20, F.lit(99).cast("long")).alias("tag_ids"))
    maps = bitmaps.tag_bitmaps(held)
    assert sum(len(bytes(r.users)) if isinstance(r.users, (bytes, bytearray)) else 8 for r in maps.collect()) <= 16 * 6_000
    both = bitmaps.members(bitmaps.eval_merge_bitmaps(maps, [(1, [(3, "or"), (4, "and"), (99, "and")]), (2, [(3, "and"), (4, "and")])]))
    assert rows(both) == {(1, i * 40_009 - 3_000_000) for i in range(6_000) if i % 20 in (3, 4)}


def test_every_bit_of_a_bucket_and_ends_of_the_numbers(spark, rows):
    users = [*range(-130, 130), (1 << 63) - 1, -(1 << 63)]
    maps = bitmaps.tag_bitmaps(spark.createDataFrame([(u, [7]) for u in users], "user_id long, tag_ids array<long>"))
    assert rows(bitmaps.members(maps)) == {(7, u) for u in users}
    assert bitmaps.tag_counts(maps).first()["user_count"] == len(users) == bitmaps.count_users(maps).first()[0]
