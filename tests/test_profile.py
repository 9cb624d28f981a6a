import itertools
import random

import pytest
from pyspark.sql import functions as F

from tagloom import seeds
from tagloom.operators import composite, profile, search
from tagloom.session import small_table

PROFILE = "user_id bigint, tag_ids array<bigint>"
PAIRS = "user_id bigint, tag_id bigint"


@pytest.fixture(scope="module")
def old(spark):
    return small_table(spark, [(1, [50, 850]), (2, []), (3, [7])], PROFILE)


def test_merge(spark, rows, old):
    new = small_table(spark, [(1, 85), (1, 50), (2, 5), (4, 9), (4, 9), (None, 1), (3, None)], PAIRS)
    merged = profile.merge_profile(old, new)
    want = {(1, (50, 850, 85)), (2, (5,)), (3, (7,)), (4, (9,))}
    assert rows(merged) == want
    assert rows(profile.merge_profile(merged, new)) == want


def test_merge_order_of_rows_does_not_matter(spark, rows, old):
    data = [(u, t) for u in range(1, 6) for t in (3, 85, 50)]
    results = set()
    for seed in range(3):
        random.Random(seed).shuffle(data)
        results.add(frozenset(rows(profile.merge_profile(old, small_table(spark, data, PAIRS).repartition(seed + 1)))))
    assert len(results) == 1


def test_merge_many_is_one_merge_after_the_other(spark, rows, old):
    parts = [small_table(spark, [(1, 9), (5, 2)], PAIRS), small_table(spark, [(1, 10), (2, 9)], PAIRS)]
    step = profile.merge_profile(profile.merge_profile(old, parts[0]), parts[1])
    assert rows(profile.merge_many(old, parts)) == rows(step)


def test_replace_siblings(spark, rows, old):
    parents = small_table(spark, [(50, 8), (51, 8), (7, 9)], "tag_id bigint, parent_id bigint")
    got = profile.replace_siblings(old, small_table(spark, [(1, 51), (2, 51), (3, 51)], PAIRS), parents)
    assert rows(got) == {(1, (850, 51)), (2, (51,)), (3, (7, 51))}


def test_comma_lists(spark):
    df = small_table(spark, [("5,50, 7",), ("",), (None,)], "t string")
    got = [r[0] for r in df.select(profile.decode_tags(F.col("t"))).collect()]
    assert got == [[5, 50, 7], [], None]
    back = df.select(profile.encode_tags(profile.decode_tags(F.col("t")))).collect()
    assert [r[0] for r in back] == ["5,50,7", "", None]


def test_pivot(spark, rows):
    pairs = small_table(spark, [(1, 50), (1, 83), (1, 84), (2, 51)], PAIRS)
    tags = small_table(spark, [(50, 8), (51, 8), (83, 14), (84, 14)], "id bigint, pid bigint")
    assert rows(profile.pivot_profile(pairs, tags, [8, 14])) == {(1, 50, 83), (2, 51, None)}


def test_upsert_wide_leaves_other_columns(spark, rows):
    a = small_table(spark, [(1, "a", "b"), (2, "c", None)], "id bigint, x string, y string")
    b = small_table(spark, [(1, None, "n"), (3, "z", "m")], "id bigint, y string, z string")
    assert rows(profile.upsert_wide(a, b)) == {(1, "a", "b", "n"), (2, "c", None, None), (3, None, "z", "m")}


# ---------------------------------------------------------------- composite tags


def test_condition_texts():
    assert composite.parse_condition("97 or 98 and 132") == [(97, "or"), (98, "and"), (132, "and")]
    assert composite.groups_of(composite.parse_condition("97 or 98 and 132 or 133 and 214 and")) == [[97, 98], [132, 133], [214]]
    with pytest.raises(ValueError):
        composite.parse_condition("97 xor 98")


def test_seeded_composite(spark, rows):
    users = [(1, [97, 133, 214]), (2, [50, 98, 132, 214]), (3, [97, 98, 214]), (4, [97, 132])]
    df = small_table(spark, users, PROFILE)
    assert rows(composite.eval_merge_tags(df, seeds.COMPOSITES[:1])) == {(1, 1), (2, 1)}


def test_composites_against_brute_force(spark, rows):
    rng = random.Random(5)
    tags = range(1, 7)
    users = [(i, list(held)) for i, held in enumerate(itertools.chain.from_iterable(itertools.combinations(tags, n) for n in range(7)))]
    rules = [
        (m, [(rng.choice(tags), rng.choice(["and", "or"])) for _ in range(rng.randrange(1, 6))]) for m in range(1, 25)
    ]

    def meets(held, members):
        text = "".join(
            f"{tag in held} {') and (' if c == 'and' else 'or'} " if i + 1 < len(members) else str(tag in held)
            for i, (tag, c) in enumerate(members)
        )
        return eval(f"({text})")

    want = {(u, m) for u, held in users for m, members in rules if meets(held, members)}
    df = small_table(spark, users, PROFILE)
    table = small_table(
        spark,
        [(m, i, t, c) for m, members in rules for i, (t, c) in enumerate(members)],
        "merge_tag_id bigint, seq int, basic_tag_id bigint, connector string",
    )
    assert rows(composite.eval_merge_tags(df, rules)) == want
    pairs = profile.explode_profile(df)
    assert rows(composite.eval_merge_table(pairs, table)) == want
    texts = [(m, " ".join(f"{t} {c}" for t, c in members)) for m, members in rules]
    texts = small_table(spark, texts, "merge_tag_id bigint, condition string")
    assert rows(composite.eval_merge_texts(pairs, texts)) == want


# ---------------------------------------------------------------- search


def test_users_by_all_tags_both_ways(spark, rows, old):
    assert rows(search.users_by_tags_all(old, [50, 850])) == {(1,)}
    assert rows(search.users_by_tags_all_pairs(profile.explode_profile(old), [50, 850, 50])) == {(1,)}
    assert rows(search.count_users_by_tags(old, [5])) == {(0,)}


def test_counts(spark, rows, old):
    assert rows(search.tag_user_count(old)) == {(50, 1, 1), (850, 1, 1), (7, 1, 1)}
    assert rows(search.all_user_count(old)) == {(3, 2)}
    assert rows(search.tag_share(old)) == {(50, 1, 1 / 3), (850, 1, 1 / 3), (7, 1, 1 / 3)}


def test_pages_cut_the_whole_order(spark):
    df = spark.range(25).withColumnRenamed("id", "user_id").repartition(4)
    pages = [[r[0] for r in search.page(df, ["user_id"], n, 10).collect()] for n in (0, 1, 2, 3, 4)]
    assert pages == [list(range(10)), list(range(10)), list(range(10, 20)), list(range(20, 25)), []]


def test_upsert_drops_rows_without_key(spark, rows):
    from tagloom.operators.profile import upsert_wide

    table = spark.createDataFrame([(1, "a"), (None, "b")], "id int, x string")
    out = upsert_wide(upsert_wide(table, table), spark.createDataFrame([(None, "c"), (2, "d")], "id int, x string"))
    assert rows(out) == {(1, "a"), (2, "d")}


def test_capitals_in_conditions(spark, rows):
    from tagloom.operators.composite import condition_groups, eval_merge_groups, member_groups, parse_conditions

    rules = spark.createDataFrame([(1, "97 OR 98 AND 132"), (2, "97 or 98 and 132"), (3, "97 And 98")], "merge_tag_id bigint, condition string")
    pairs = spark.createDataFrame([(1, 98), (1, 132), (2, 97), (2, 98), (3, 132)], "user_id int, tag_id bigint")
    want = {(1, 1), (1, 2), (2, 3)}
    assert rows(eval_merge_groups(pairs, condition_groups(rules))) == want
    assert rows(eval_merge_groups(pairs, member_groups(parse_conditions(rules)))) == want


def test_composites_mean_the_same_at_any_length(spark, rows):
    from collections import Counter

    df = spark.createDataFrame(
        [(1, [10]), (1, [20]), (2, [10, 20]), (2, [10, 20]), (3, [20, 10, 10, None]), (4, []), (5, None), (6, [30]), (7, [7, 30])],
        "user_id long, tag_ids array<long>",
    )
    own = [
        (1, [(10, "and"), (20, "and")]),
        (2, [(10, "or"), (30, "and")]),
        (3, [(30, "or"), (10, "and"), (20, "or"), (7, "and")]),
        (4, [(10, "and")]),
        (4, [(30, "and")]),  # listed twice: either form
    ]
    filler = [(1000 + i, [(5000 + i, "and"), (10, "and")]) for i in range(250)]
    results = []
    for n in (0, composite.CASE_LIMIT - len(own), composite.CASE_LIMIT - len(own) + 1, 250):
        results.append(Counter(map(tuple, composite.eval_merge_tags(df, own + filler[:n]).collect())))
    assert results[0] == Counter(
        {(1, 2): 1, (1, 4): 1, (2, 1): 2, (2, 2): 2, (2, 3): 2, (2, 4): 2, (3, 1): 1, (3, 2): 1, (3, 3): 1, (3, 4): 1, (6, 2): 1, (6, 4): 1, (7, 2): 1, (7, 3): 1, (7, 4): 1}
    )
    assert all(r == results[0] for r in results)


def test_replace_siblings_holds_no_list_of_all_children(spark, rows):
    # a list of 6,000 siblings for each of 6,000 children would be 36 million ids
    children = 6_000
    parents = small_table(spark, [(t, 1) for t in range(children)] + [(9_000, 2), (9_001, 2), (9_002, None)], "tag_id long, parent_id long")
    held = [(1, [5, 9_000]), (2, [5, 7, None]), (3, [9_002]), (4, []), (5, [5]), (5, [8, 77_777])]
    old = small_table(spark, held, "user_id long, tag_ids array<long>")
    new = small_table(spark, [(1, 6), (2, 9_001), (3, 9_002), (5, 9), (7, 5), (None, 5), (4, None)], PAIRS)
    got = profile.replace_siblings(old, new, parents)
    want = {(1, (9_000, 6)), (2, (5, 7, 9_001)), (3, (9_002,)), (4, ()), (5, (9,)), (5, (77_777, 9)), (7, (5,))}
    assert rows(got) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "_siblings" not in plan
