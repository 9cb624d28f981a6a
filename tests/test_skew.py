"""One key with a third of all rows: right results, and plans that share its work."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom import seeds
from tagloom.operators import composite, profile, score, search, stats
from tagloom.session import small_table


@pytest.fixture(scope="module")
def orders(spark):
    hot = F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 997)
    codes = F.array(*[F.lit(c) for c in ("alipay", "wxpay", "chinapay", "cod", "other")])
    return spark.range(60_000).select(
        hot.alias("u"),
        F.col("id").alias("sn"),
        (F.col("id") % 1000 / 4).alias("amount"),
        F.timestamp_seconds(F.col("id") * 977 % 10_000_000).alias("t"),
        F.get(codes, (F.col("id") * 7 % 5).cast("int")).alias("code"),
    )


def _pandas(df):
    return df.toPandas()


def test_aggregates_over_a_hot_user(orders):
    whole = _pandas(orders)
    got = _pandas(score.rfm(orders, "u", "t", "sn", "amount", "1970-06-01")).set_index("u").sort_index()
    want = whole.groupby("u").agg(n=("sn", "count"), m=("amount", "sum")).sort_index()
    assert (got["frequency"] == want["n"]).all() and (got["monetary"] == want["m"]).all()
    top = _pandas(stats.most_used_payment(orders, "u", "code", seeds.PAYMENT)).set_index("u")
    counts = whole.groupby(["u", "code"]).size()
    for user in (0, 1, 5):
        best = min(counts[user].items(), key=lambda kv: (-kv[1], kv[0]))
        assert (top.loc[user, "code"], top.loc[user, "n"]) == best


def test_hot_tag_and_hot_user_in_a_profile(spark, rows):
    rng = random.Random(3)
    data = [(0 if i % 3 == 0 else rng.randrange(1, 400), 1 if i % 3 == 1 else rng.randrange(2, 60)) for i in range(6000)]
    pairs = small_table(spark, data, "user_id bigint, tag_id bigint").repartition(8)
    want = {}
    for u, t in data:
        want.setdefault(u, set()).add(t)
    lists = profile.collapse_profile(pairs)
    assert rows(lists) == {(u, tuple(sorted(t))) for u, t in want.items()}
    counts = {r["tag_id"]: r["user_count"] for r in search.tag_user_count(lists).collect()}
    assert counts[1] == sum(1 in t for t in want.values())
    top = [r["user_id"] for r in search.top_users_per_tag(profile.explode_profile(lists), 5).where("tag_id = 1").orderBy("rn").collect()]
    assert top == sorted(u for u, t in want.items() if 1 in t)[:5]


def test_top_n_is_cut_before_the_shuffle(spark):
    pairs = spark.range(1000).select((F.col("id") % 7).alias("tag_id"), F.col("id").alias("user_id"))
    plan = search.top_users_per_tag(pairs, 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_visit_slots_shrink_before_the_shuffle(spark):
    """A hot user's events reach the window as one row per slot and map task."""
    logs = spark.range(200_000).select(
        F.lit(1).alias("u"), F.timestamp_micros(F.col("id") * 100_000).alias("t")
    )
    visits = stats.sessions(logs, "u", "t", 1800)
    plan = visits._jdf.queryExecution().executedPlan().toString()
    # plans print from the top: the last partial aggregation lies below the window
    assert plan.rindex("partial_min(_t") > plan.rindex("Window [")
    assert [r["events"] for r in visits.collect()] == [200_000]


def test_rules_on_a_hot_tag(spark, rows):
    pairs = spark.range(3000).select(F.col("id").alias("user_id"), F.lit(1).cast("bigint").alias("tag_id")).unionByName(
        spark.range(0, 3000, 10).select(F.col("id").alias("user_id"), F.lit(2).cast("bigint").alias("tag_id"))
    )
    members = small_table(spark, [(7, 1, 1, "and"), (7, 2, 2, "and")], "merge_tag_id bigint, seq int, basic_tag_id bigint, connector string")
    assert rows(composite.eval_merge_table(pairs, members)) == {(u, 7) for u in range(0, 3000, 10)}
