"""Queries over the five-level tag tree and its companions.

A tag table has ``id, name, level, pid`` and, where a query needs them,
``order, state, business, ctime``. The tree may hold a tag per product, so what
is broadcast is counted first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagloom.session import broadcast_if, is_small

DEPTH = 5
LEAF = 5


def small_tree(tags: DataFrame) -> bool:
    """Whether the leaves are few enough to broadcast."""
    return is_small(tags.where(F.col("level") == LEAF))


def ancestry(tags: DataFrame) -> DataFrame:
    """Every tag with its chain from itself up to the root.

    The bounded self-joins climb among the inner nodes only; the leaves, which
    may be as many as the products, are joined once, to their parent's chain.
    """
    node = F.struct("id", "name", "level")
    inner = tags.where(F.col("level") < LEAF)
    small = is_small(inner)
    climb = inner.select(F.col("id").alias("_id"), F.array(node).alias("_chain"), F.col("pid").alias("_up"))
    step = inner.select(F.col("id").alias("_pid"), F.col("pid").alias("_next"), node.alias("_node"))
    for _ in range(DEPTH - 2):
        climb = climb.join(broadcast_if(small, step), F.col("_up") == F.col("_pid"), "left").select(
            "_id",
            F.when(F.col("_node").isNull(), F.col("_chain"))
            .otherwise(F.concat("_chain", F.array("_node")))
            .alias("_chain"),
            F.col("_next").alias("_up"),
        )
    own = F.array(node)
    return tags.join(broadcast_if(small, climb), F.col("pid") == F.col("_id"), "left").select(
        "id",
        "name",
        "level",
        F.when(F.col("_chain").isNull(), own).otherwise(F.concat(own, "_chain")).alias("chain"),
    )


def closure(tags: DataFrame) -> DataFrame:
    """Pairs of an ancestor and a tag below it; a tag is its own ancestor."""
    return ancestry(tags).select(
        F.explode("chain").alias("_a"), F.col("id").alias("tag_id"), F.col("level").alias("tag_level")
    ).select(F.col("_a.id").alias("ancestor_id"), F.col("_a.level").alias("ancestor_level"), "tag_id", "tag_level")


def leaf_paths(tags: DataFrame) -> DataFrame:
    """Level-5 tags with the id and name of each level, ``l1`` to ``l5``; levels above a
    missing ancestor are null."""
    full = ancestry(tags).where(F.col("level") == LEAF)
    columns = [F.col("id").alias("tag_id")]
    for level in range(1, DEPTH + 1):
        at = F.get("chain", F.lit(DEPTH - level))
        columns += [at["id"].alias(f"l{level}"), at["name"].alias(f"l{level}_name")]
    return full.select(*columns)


def tag_path(tags: DataFrame, include_leaf: bool = False, separator: str = " --- ") -> DataFrame:
    """Names from level 1 down; by default a tag without children is not named."""
    parents = tags.select(F.col("pid").alias("id")).distinct().withColumn("_has", F.lit(True))
    names = F.transform(F.reverse("chain"), lambda n: n["name"])
    shown = ancestry(tags).join(parents, "id", "left")
    if not include_leaf:
        names = F.when(F.col("_has").isNull(), F.slice(names, 1, F.size(names) - 1)).otherwise(names)
    return shown.select("id", F.array_join(names, separator).alias("path"))


def leaf_tags(tags: DataFrame, ids: Sequence[int]) -> DataFrame:
    """Level-5 tags at or below any of the ids, once each."""
    above = F.transform("chain", lambda n: n["id"])
    wanted = F.array(*[F.lit(i).cast("bigint") for i in ids])
    return (
        ancestry(tags)
        .where((F.col("level") == LEAF) & F.arrays_overlap(above, wanted))
        .select(F.col("id").alias("tag_id"))
    )


def subtree(tags: DataFrame, tag_id: int) -> DataFrame:
    """The tag, everything below it and its ancestors, each with its relation."""
    chains = ancestry(tags)
    above = F.transform("chain", lambda n: n["id"])
    below = chains.where(F.array_contains(above, F.lit(tag_id).cast("bigint"))).select(
        "id", "level", F.when(F.col("id") == tag_id, "self").otherwise("descendant").alias("relation")
    )
    up = (
        chains.where(F.col("id") == tag_id)
        .select(F.explode("chain").alias("n"))
        .select("n.id", "n.level", F.lit("ancestor").alias("relation"))
        .where(F.col("id") != tag_id)
    )
    return below.unionByName(up)


def search_tags(tags: DataFrame, name: str) -> DataFrame:
    """Live tags whose name contains the text."""
    return tags.where(F.contains(F.col("name"), F.lit(name)) & (F.col("state") != -1)).distinct()


def visible_tags(
    tags: DataFrame,
    user_grants: DataFrame,
    role_grants: DataFrame,
    user_id: int,
    role_id: int,
    super_role: int = 1,
) -> DataFrame:
    """Live tags granted to the user or to the role (basic tags only); the super
    role sees every grant."""
    users = user_grants if role_id == super_role else user_grants.where(F.col("user_id") == user_id)
    roles = role_grants.where("tag_type = 1")
    roles = roles if role_id == super_role else roles.where(F.col("role_id") == role_id)
    granted = users.select("tag_id").unionByName(roles.select("tag_id")).distinct()
    return tags.where(F.col("state") != -1).join(granted, F.col("id") == F.col("tag_id"), "left_semi")


def tag_audit(
    tags: DataFrame, user_tags: DataFrame, merge_tags: DataFrame, user_merge_tags: DataFrame, name: str = ""
) -> DataFrame:
    """Basic and composite tags with who applied for them, without repeats."""
    basic = tags.where(F.contains("name", F.lit(name))) if name else tags
    left = basic.alias("t").join(user_tags.alias("u"), F.col("t.id") == F.col("u.tag_id"), "left").select(
        F.col("u.id").alias("id"),
        F.col("t.id").alias("tag_id"),
        F.col("t.name").alias("name"),
        F.col("t.business").alias("business"),
        F.lit(1).alias("type"),
        F.col("t.level").alias("level"),
        F.col("t.state").alias("state"),
        F.col("u.user_id").alias("apply_user_id"),
        F.col("t.ctime").alias("ctime"),
    )
    right = user_merge_tags.alias("a").join(
        merge_tags.alias("m"), F.col("m.id") == F.col("a.merge_tag_id"), "left"
    )
    right = right.where(F.contains("m.name", F.lit(name))) if name else right
    right = right.select(
        F.col("a.id").alias("id"),
        F.col("m.id").alias("tag_id"),
        F.col("m.name").alias("name"),
        F.col("m.condition").alias("business"),
        F.lit(2).alias("type"),
        F.lit(-1).alias("level"),
        F.col("a.state").alias("state"),
        F.col("a.user_id").alias("apply_user_id"),
        F.col("m.ctime").alias("ctime"),
    )
    return left.unionByName(right).distinct()


def tag_audit_list(audit: DataFrame, page: int, size: int) -> DataFrame:
    """One page, newest first."""
    return audit.orderBy(F.desc("ctime"), "type", "tag_id", "id").offset(max(0, (page - 1) * size)).limit(size)


def tags_per_merge_tag(members: DataFrame) -> DataFrame:
    return members.groupBy("merge_tag_id").agg(F.count("*").alias("members"))


def tag_count_by_level(tags: DataFrame) -> DataFrame:
    return tags.groupBy("level").agg(F.count("*").alias("tags"))


def merge_tag_members(merge_tags: DataFrame, members: DataFrame, tags: DataFrame, disabled: int = 6) -> DataFrame:
    """Members of every composite tag that is not disabled."""
    live = merge_tags.where(F.col("state") != disabled).select(
        F.col("id").alias("merge_tag_id"), F.col("name").alias("merge_name")
    )
    basic = tags.select(F.col("id").alias("basic_tag_id"), F.col("name").alias("tag_name"), "level")
    return (
        members.join(live, "merge_tag_id")
        .join(basic, "basic_tag_id")
        .select("merge_tag_id", "merge_name", "seq", "basic_tag_id", "tag_name", "level", "connector")
    )
