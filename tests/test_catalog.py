import json

import pytest
from pyspark.sql import functions as F

from tagloom.operators import catalog, search
from tagloom.session import small_table

TREE = [
    (1, "root", 1, -1), (2, "mall", 2, 1), (3, "people", 3, 2), (4, "money", 3, 2), (8, "gender", 4, 3), (9, "empty", 4, 3),
    (22, "band", 4, 4), (50, "male", 5, 8), (51, "female", 5, 8), (132, "high", 5, 22),
]


@pytest.fixture(scope="module")
def tags(spark):
    return small_table(spark, TREE, "id bigint, name string, level int, pid bigint")


@pytest.mark.parametrize("limit", [100_000, 0])
def test_paths(tags, rows, monkeypatch, limit):
    """With and without broadcasts."""
    monkeypatch.setattr(catalog, "is_small", lambda df: limit > 0)
    got = {r["id"]: r["path"] for r in catalog.tag_path(tags).collect()}
    assert got[50] == "root --- mall --- people --- gender" and got[8] == got[50]
    assert got[9] == "root --- mall --- people" and got[1] == "root"
    full = {r["id"]: r["path"] for r in catalog.tag_path(tags, include_leaf=True).collect()}
    assert full[132] == "root --- mall --- money --- band --- high" and full[1] == "root"
    assert rows(catalog.leaf_tags(tags, [3])) == {(50,), (51,)}
    assert rows(catalog.leaf_tags(tags, [51, 4])) == {(51,), (132,)}
    assert rows(catalog.leaf_paths(tags).select("tag_id", "l1", "l2", "l3", "l4", "l5")) == {
        (50, 1, 2, 3, 8, 50), (51, 1, 2, 3, 8, 51), (132, 1, 2, 4, 22, 132)
    }


def test_closure(tags, rows):
    pairs = rows(catalog.closure(tags).select("ancestor_id", "tag_id"))
    parent = {i: p for i, _, _, p in TREE}
    want = set()
    for i in parent:
        up = i
        while up in parent:
            want.add((up, i))
            up = parent[up]
    assert pairs == want


def test_subtree(tags, rows):
    got = rows(catalog.subtree(tags, 3).select("id", "relation"))
    assert got == {(3, "self"), (8, "descendant"), (9, "descendant"), (50, "descendant"), (51, "descendant"), (1, "ancestor"), (2, "ancestor")}


def test_portraits(spark, tags):
    pairs = small_table(spark, [(1, 50), (1, 132), (2, 51), (2, 999)], "user_id bigint, tag_id bigint")
    flat = search.portrait(pairs, tags)
    assert flat.count() == 3
    merges = small_table(spark, [(1, 4)], "user_id bigint, merge_tag_id bigint")
    tree = {r["user_id"]: r for r in search.portrait_tree(flat, merges=merges).select("user_id", F.to_json("tags").alias("t"), "merge_tags").collect()}
    assert tree[1]["merge_tags"] == [4] and tree[2]["merge_tags"] is None

    def names(nodes):
        return {n["name"]: names(n.get("children", [])) for n in nodes}

    assert names(json.loads(tree[1]["t"])) == {"root": {"mall": {"people": {"gender": {"male": {}}}, "money": {"band": {"high": {}}}}}}
    assert names(json.loads(tree[2]["t"])) == {"root": {"mall": {"people": {"gender": {"female": {}}}}}}
    graph = {(r["source"], r["target"]): r["children"] for r in search.portrait_graph(catalog.leaf_paths(tags)).collect()}
    assert graph == {
        ("user", "root"): 1, ("root", "mall"): 2, ("mall", "people"): 1, ("mall", "money"): 1,
        ("people", "gender"): 2, ("money", "band"): 1, ("gender", "male"): 0, ("gender", "female"): 0, ("band", "high"): 0,
    }


def test_visible_tags(spark, rows, tags):
    live = tags.withColumn("state", F.when(F.col("id") == 51, -1).otherwise(3))
    users = small_table(spark, [(7, 50), (7, 51), (8, 132)], "user_id bigint, tag_id bigint")
    roles = small_table(spark, [(2, 8, 1), (2, 9, 2), (3, 22, 1)], "role_id bigint, tag_id bigint, tag_type int")
    seen = lambda u, r: rows(catalog.visible_tags(live, users, roles, u, r).select("id"))
    assert seen(7, 2) == {(50,), (8,)}
    assert seen(7, 1) == {(50,), (132,), (8,), (22,)}


def test_lookup(spark, rows):
    users = small_table(
        spark,
        [(1, "13800000001", "a1@x.com", "10001", "110101199001011234"), (2, "13800000002", None, "10002", "13800000001")],
        "id bigint, mobile string, email string, qq string, id_card string",
    )
    asked = small_table(spark, [("13800000001",), ("13800000001",), ("a1@x.com",), ("10002",), ("zz",)], "num string")
    assert rows(search.lookup_users(asked, users)) == {
        ("13800000001", "mobile", 1), ("a1@x.com", "email", 1), ("10002", "qq", 2)
    }


def test_broken_paths_stay_apart(spark):
    """Two leaves whose chains break at different tags are two roots, not one null node."""
    tree = [(1, "top", 1, -1), (2, "b", 2, 1), (3, "c", 3, 2), (4, "d", 4, 3), (5, "whole", 5, 4)]
    tree += [(14, "d2", 4, 90), (15, "half", 5, 14), (16, "half too", 5, 14), (25, "alone", 5, 91), (26, "other", 5, 92)]
    tags = spark.createDataFrame(tree, "id long, name string, level int, pid long")
    pairs = spark.createDataFrame([(1, t) for t in (5, 15, 16, 25, 26)] + [(2, 26)], "user_id long, tag_id long")
    flat = search.portrait(pairs, tags)
    shown = {r.user_id: json.loads(r.t) for r in search.portrait_tree(flat).select("user_id", F.to_json("tags").alias("t")).collect()}
    assert [n["id"] for n in shown[1]] == [1, 14, 25, 26] and [n["id"] for n in shown[2]] == [26]
    assert [n["id"] for n in shown[1][1]["children"]] == [15, 16] and shown[1][2]["children"] == []
    edges = {(r.source, r.target, r.category, r.children) for r in search.portrait_graph(flat).collect()}
    assert ("user", "d2", "d2", 2) in edges and ("user", "alone", "alone", 0) in edges and ("user", "top", "top", 1) in edges
    assert len(edges) == 5 + 3 + 2 and not any(s is None or t is None for s, t, *_ in edges)
