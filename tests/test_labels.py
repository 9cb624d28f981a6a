"""Interval labels against walks, and counts kept by difference against recounts."""

import random

import pytest
from pyspark.sql import functions as F

from tagloom.operators import labels, search
from tagloom.session import stored


def walk(rows):
    """(first, last, depth) by a walk; ids without a root are left out."""
    ids = {i for i, *_ in rows}
    children = {}
    for i, p, o in rows:
        children.setdefault(p if p in ids else None, []).append((o is not None, o or 0, i))
    out, count = {}, 0
    stack = [(i, 1, False) for *_, i in sorted(children.get(None, []), reverse=True)]
    while stack:
        i, depth, done = stack.pop()
        if done:
            out[i] = (out[i][0], count, depth)
            continue
        count += 1
        out[i] = (count, None, depth)
        stack.append((i, depth, True))
        stack += [(c, depth + 1, False) for *_, c in sorted(children.get(i, []), reverse=True)]
    return out


def forest():
    rng = random.Random(3)
    rows = [(1, -1, None)] + [(i, i - 1, None) for i in range(2, 41)]  # a chain of 40
    rows += [(100 + i, rng.choice([1, 5, 39, *range(100, 100 + i)]) if i else 40, rng.choice([None, 1, 2])) for i in range(120)]
    rows += [(500 + i, 10, i % 3) for i in range(300)]  # one parent of many
    rows += [(900, None, None), (901, 900, None), (950, 77777, 4)]
    rows += [(2000, 2001, None), (2001, 2002, None), (2002, 2000, None), (2003, 2000, None), (2004, 2003, None), (2010, 2010, None)]
    return rows


def test_labels_of_any_depth_and_cycles(spark):
    rows = forest()
    df = spark.createDataFrame(rows, "id long, pid long, place int").repartition(7)
    found, lost = labels.tree_labels(df, "place")
    want = walk(rows)
    assert {r.id: (r.first, r.last, r.depth) for r in found.collect()} == want
    assert {r.id for r in lost.collect()} == {2000, 2001, 2002, 2003, 2004, 2010}
    parent = {i: p for i, p, _ in rows}

    def up(i):
        out = []
        while parent.get(i) in want:
            i = parent[i]
            out.append(i)
        return out

    for ids in ([10], [1], [950], [40, 10, 901], [2000], [4242], [900, 901]):
        below = {i for i in want if set(ids) & {i, *up(i)}}
        assert {r.id for r in labels.at_or_below(found, ids).collect()} == below
    for i in (40, 1, 501, 901, 2003):
        assert {r.id for r in labels.above(found, i).collect()} == set(up(i))
    empty, none = labels.tree_labels(df.limit(0))
    assert empty.collect() == [] == none.collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_by_difference(spark, rows, seed):
    rng = random.Random(seed)

    def version():
        rows = [(u, rng.sample(range(1, 9), rng.randrange(0, 6))) for u in rng.sample(range(40), 25)]
        return spark.createDataFrame([*rows, (1000, None), (None, [1, 2])], "user_id long, tag_ids array<long>").where("user_id is not null")

    versions = [version() for _ in range(5)]
    counts = search.tag_user_count(versions[0])
    for old, new in zip(versions, versions[1:]):
        counts = search.updated_counts(counts, search.tag_count_changes(old, new))
        assert rows(counts) == rows(search.tag_user_count(new))
    assert search.tag_count_changes(versions[0], versions[0]).collect() == []
    gone = search.updated_counts(counts, search.tag_count_changes(versions[-1], versions[0].where(F.lit(False))))
    assert gone.collect() == []


def test_rounds_follow_the_depth_and_send_no_table_through_the_driver(spark, monkeypatch, rows):
    # chains of 4 under one root, and a cycle of two with a tail, which never ends
    tree = [(i, -1 if i == 0 else 0 if i % 4 == 1 else i - 1) for i in range(400)]
    tree += [(1000, 1001), (1001, 1000), (1002, 1001)]
    plans = []

    def kept(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return stored(df, name)

    monkeypatch.setattr(labels, "stored", kept)
    found, lost = labels.tree_labels(spark.createDataFrame(tree, "id long, pid long"))
    assert rows(lost.select("id")) == {(1000,), (1001,), (1002,)}
    assert {(r["id"], r["depth"]) for r in found.collect()} == {(i, 1 if i == 0 else 2 + (i - 1) % 4) for i in range(400)}
    # depth 5 is known after three rounds, one more finds that nothing ends; 403 nodes have nine bits
    assert sum(name == "climb" for name, _ in plans) <= 4 + 3
    plans.append(("out", found._jdf.queryExecution().executedPlan().toString()))
    assert not [name for name, plan in plans if "Broadcast" in plan]
