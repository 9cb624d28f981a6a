"""User profiles: one row per user with the list of tags."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.session import broadcast_if, is_small

SEPARATOR = ","
# Tags that a pivot writes into its plan.
LISTED_CHILDREN = 1_000


def decode_tags(text: Column) -> Column:
    """Comma list to array, each tag once; parts that are no number are left out, so
    the empty text is the empty list."""
    return F.array_except(F.split(text, SEPARATOR).try_cast("array<bigint>"), F.array(F.lit(None).cast("bigint")))


def encode_tags(tags: Column) -> Column:
    return F.array_join(tags.cast("array<string>"), SEPARATOR)


def explode_profile(profile: DataFrame, user: str = "user_id", tags: str = "tag_ids") -> DataFrame:
    """One row per user and tag, without repeats.

    The outer form with a filter behind it says the same as a plain explode. For
    the plain form Spark puts a size test below it, which would compute a list
    that is made on the way a second time.
    """
    rows = profile.select(user, F.explode_outer(F.array_distinct(tags)).alias("tag_id"))
    return rows.where("tag_id is not null")


def collapse_profile(pairs: DataFrame, user: str = "user_id", tag: str = "tag_id") -> DataFrame:
    """One row per user with the sorted list; rows without user or tag are ignored.

    ``collect_set`` drops repeats before the shuffle and while merging, so a user
    with many rows ships no more than the distinct tags.
    """
    return (
        pairs.where(F.col(user).isNotNull() & F.col(tag).isNotNull())
        .groupBy(F.col(user).alias("user_id"))
        .agg(F.sort_array(F.collect_set(F.col(tag).cast("bigint"))).alias("tag_ids"))
    )


def merge_profile(existing: DataFrame, new: DataFrame, user: str = "user_id", tag: str = "tag_id") -> DataFrame:
    """Full merge of new ``(user, tag)`` rows into a profile.

    Unknown users are added, unknown tags appended behind the known ones, known
    tags left alone; merging twice changes nothing.
    """
    added = collapse_profile(new, user, tag).withColumnRenamed("tag_ids", "_new")
    none = F.array().cast("array<bigint>")
    return (
        existing.where("user_id is not null")
        .join(added, "user_id", "full_outer")
        .select("user_id", F.array_union(F.coalesce("tag_ids", none), F.coalesce("_new", none)).alias("tag_ids"))
    )


def replace_siblings(existing: DataFrame, new: DataFrame, parents: DataFrame) -> DataFrame:
    """Like ``merge_profile``, but a user's new tag ousts the old ones of the same
    parent. ``parents`` has ``(tag_id, parent_id)``.

    New tags are told by their parents, and so are the tags held by users who got new ones;
    no row holds the children of a parent, of which there may be millions. A user without
    new tags passes through.
    """
    kin = broadcast_if(is_small(parents), parents.where("parent_id is not null").select("tag_id", "parent_id").distinct())
    fresh = new.where("user_id is not null and tag_id is not null").join(kin, "tag_id", "left")
    added = fresh.groupBy("user_id").agg(
        F.sort_array(F.collect_set(F.col("tag_id").cast("bigint"))).alias("_new"),
        F.collect_set("parent_id").alias("_renewed"),
    )
    known = existing.where("user_id is not null")
    renewed = known.join(added.where(F.size("_renewed") > 0).select("user_id", "_renewed"), "user_id")
    old = renewed.select("user_id", "_renewed", F.explode_outer("tag_ids").alias("tag_id")).where("tag_id is not null")
    ousted = (
        old.join(kin, "tag_id")
        .where(F.array_contains("_renewed", F.col("parent_id")))
        .groupBy("user_id")
        .agg(F.collect_set(F.col("tag_id").cast("bigint")).alias("_ousted"))
    )
    none = F.array().cast("array<bigint>")
    held = F.array_compact(F.coalesce("tag_ids", none))
    stays = F.sort_array(F.array_except(held, F.coalesce("_ousted", none)))
    return (
        known.join(added.drop("_renewed"), "user_id", "full_outer")
        .join(ousted, "user_id", "left")
        .select("user_id", F.array_union(stays, F.coalesce("_new", none)).alias("tag_ids"))
    )


def merge_many(existing: DataFrame, outputs: Sequence[DataFrame]) -> DataFrame:
    """All tag outputs ``(user_id, tag_id)`` in one pass over the profile."""
    return merge_profile(existing, reduce(DataFrame.unionByName, outputs))


def pivot_profile(pairs: DataFrame, tags: DataFrame, parents: Sequence[int], user: str = "user_id") -> DataFrame:
    """One column per level-4 tag. ``tags`` has ``(id, pid)``; the least tag wins
    where a user holds two of one parent. The parents are listed, so no job runs
    to find them."""
    children = tags.where(F.col("pid").isin(*parents)).select(F.col("id").alias("tag_id"), "pid")
    with_parent = pairs.join(broadcast_if(is_small(children), children), "tag_id")
    columns = [
        F.min(F.when(F.col("pid") == p, F.col("tag_id"))).alias(f"tag_{p}") for p in parents
    ]
    return with_parent.groupBy(F.col(user)).agg(*columns)


def pivot_lists(profile: DataFrame, tags: DataFrame, parents: Sequence[int], user: str = "user_id") -> DataFrame:
    """The same from profile rows: a user's tags are in one row already, so the columns are
    looked up there and nothing is shuffled. Users with none of the tags are left out.

    The children of the parents are one small row of lists if they are few; beyond that the
    tags are taken apart and joined.
    """
    children = tags.where(F.col("pid").isin(*parents)).select(F.col("id").alias("tag_id"), "pid")
    if not is_small(children, LISTED_CHILDREN):
        return pivot_profile(explode_profile(profile, user), tags, parents, user)
    listed: dict[int, list[int]] = {p: [] for p in parents}
    for row in children.collect():  # counted before
        listed[row["pid"]].append(row["tag_id"])
    columns = []
    for p in parents:
        ids = F.array(*[F.lit(i) for i in sorted(listed[p])]).cast("array<bigint>")
        columns.append(F.array_min(F.array_intersect("tag_ids", ids)).alias(f"tag_{p}"))
    return profile.select(user, *columns).where(F.coalesce(*[F.col(f"tag_{p}") for p in parents]).isNotNull())


def upsert_wide(old: DataFrame, new: DataFrame, key: str = "id") -> DataFrame:
    """Column-wise upsert: a new value replaces the old one, a missing one leaves it.
    Rows without a key belong to nobody and are left out."""
    old, new = old.where(F.col(key).isNotNull()), new.where(F.col(key).isNotNull())
    fresh = [c for c in new.columns if c != key]
    names = [c for c in old.columns if c != key] + [c for c in fresh if c not in old.columns]
    joined = old.alias("o").join(new.alias("n"), key, "full_outer")
    columns = []
    for name in names:
        sides = [F.col(f"n.{name}")] if name in fresh else []
        sides += [F.col(f"o.{name}")] if name in old.columns else []
        columns.append(F.coalesce(*sides).alias(name))
    return joined.select(key, *columns)
