"""Tags as bitmaps: users in buckets, one bitmap per tag and bucket that has users of it.

A bucket holds ``BUCKET`` users side by side; its bitmap is one whole number whose bits say
which of them have a tag. "Any" is their union, "all" their intersection, a composite rule
both, so a question over tags reads one short row per 64 users that stand together, instead
of every user's list. A bucket without a user of the tag has no row: a tag of few users
spread over all takes no more rows than it has users, however many users there are. User
ids are whole numbers, best close together; negative ones have buckets of their own. The
index is built by one aggregate, partial before the shuffle, and keeps the tags apart that
a user holds once or often alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.operators.composite import Members, groups_of
from tagloom.operators.profile import explode_profile
from tagloom.session import BROADCAST_ROWS, broadcast_if, is_small, small_table

# Users of a bucket: bits of a long.
BUCKET = 64


def _bucket(user: str) -> Column:
    return F.shiftright(F.col(user).cast("bigint"), 6).alias("bucket")


def _union(user: str) -> Column:
    """One bit per user of a bucket."""
    bit = F.col(user).cast("bigint").bitwiseAND(F.lit(BUCKET - 1)).cast("int")
    return F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("users")


def tag_bitmaps(profile: DataFrame, user: str = "user_id", tags: str = "tag_ids") -> DataFrame:
    """``(tag_id, bucket, users)`` of a profile; rows without a user are nobody's."""
    pairs = explode_profile(profile.where(F.col(user).isNotNull()), user, tags)
    return pairs.groupBy("tag_id", _bucket(user)).agg(_union(user))


def user_bitmaps(profile: DataFrame, user: str = "user_id") -> DataFrame:
    """``(bucket, users)`` of all users, for shares and complements."""
    held = profile.where(F.col(user).isNotNull())
    return held.groupBy(_bucket(user)).agg(_union(user))


def members(bitmaps: DataFrame, user: str = "user_id") -> DataFrame:
    """The users of bitmaps with their other columns, one row each."""
    rest = [c for c in bitmaps.columns if c not in ("bucket", "users")]
    bits = F.filter(F.sequence(F.lit(0), F.lit(BUCKET - 1)), lambda i: F.getbit("users", i) == 1)
    return bitmaps.select(*rest, "bucket", F.explode(bits).alias("_bit")).select(*rest, (F.col("bucket") * BUCKET + F.col("_bit")).alias(user))


def any_of(bitmaps: DataFrame, ids: Sequence[int]) -> DataFrame:
    """``(bucket, users)`` with at least one of the tags."""
    return bitmaps.where(F.col("tag_id").isin(*ids)).groupBy("bucket").agg(F.bit_or("users").alias("users"))


def all_of(bitmaps: DataFrame, ids: Sequence[int]) -> DataFrame:
    """``(bucket, users)`` with all of the tags; a bucket that lacks a tag has none."""
    wanted = sorted(set(ids))
    found = bitmaps.where(F.col("tag_id").isin(*wanted)).groupBy("bucket").agg(
        F.bit_and("users").alias("users"), F.count("*").alias("_n")
    )
    return found.where(F.col("_n") == len(wanted)).select("bucket", "users")


def count_users(bitmaps: DataFrame) -> DataFrame:
    """How many users bitmaps of different buckets hold."""
    return bitmaps.agg(F.coalesce(F.sum(F.bit_count("users")), F.lit(0)).alias("users"))


def tag_counts(bitmaps: DataFrame, tag_type: int = 1) -> DataFrame:
    """Users per tag, in the shape of the stored counts."""
    return bitmaps.groupBy("tag_id").agg(F.sum(F.bit_count("users")).alias("user_count")).select(
        "tag_id", F.lit(tag_type).alias("tag_type"), "user_count"
    )


def rule_groups(rules: Sequence[tuple[int, Members]]) -> list[tuple[int, int, int, int]]:
    """Rules as rows ``(merge_tag_id, grp, need, tag_id)``."""
    out = set()
    for mid, rule in rules:
        groups = groups_of(rule)
        out |= {(mid, g, len(groups), tag) for g, group in enumerate(groups) for tag in group}
    return sorted(out)


def composite_bitmaps(bitmaps: DataFrame, groups: DataFrame) -> DataFrame:
    """``(merge_tag_id, bucket, users)`` of rules given as ``(merge_tag_id, grp, need, tag_id)``:
    the union of a group's tags, then the intersection of a rule's groups.

    Rules meet the bitmaps by tag; a user with many tags or a tag with many users is no more
    than its bits. Any number of rules and groups. The bits of a rule and bucket are dealt
    once, for groups and rules alike: there is little to put together before, as a tag has
    one row a bucket.
    """
    met = bitmaps.join(broadcast_if(is_small(groups), groups.distinct()), "tag_id")
    met = met.select("merge_tag_id", "bucket", "grp", "need", "users").repartition("merge_tag_id", "bucket")
    either = met.groupBy("merge_tag_id", "bucket", "grp", "need").agg(F.bit_or("users").alias("users"))
    both = either.groupBy("merge_tag_id", "bucket", "need").agg(F.bit_and("users").alias("users"), F.count("*").alias("_n"))
    return both.where((F.col("_n") == F.col("need")) & (F.col("users") != 0)).select("merge_tag_id", "bucket", "users")


def eval_merge_bitmaps(bitmaps: DataFrame, rules: Sequence[tuple[int, Members]]) -> DataFrame:
    """``composite_bitmaps`` of rules that the driver holds; an id may be listed once."""
    if len({mid for mid, _ in rules}) < len(rules):
        raise ValueError("a composite tag is listed twice")
    rows = rule_groups(rules)
    table = small_table(bitmaps.sparkSession, rows, "merge_tag_id bigint, grp int, need int, tag_id bigint")
    return composite_bitmaps(bitmaps, broadcast_if(len(rows) <= BROADCAST_ROWS, table))
