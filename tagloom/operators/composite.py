"""Composite tags: and/or rules over basic tags.

The connector of a member belongs to the member behind it, ``or`` binds tighter
than ``and``, and the last connector has nothing to join. A rule is therefore a
list of groups; a user qualifies with at least one tag out of every group.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom.operators.match import CASE_LIMIT, tag_list
from tagloom.session import BROADCAST_ROWS, broadcast_if, is_small, small_table

_MEMBER = re.compile(r"(\d+)\s*(and|or)?", re.IGNORECASE)

Members = Sequence[tuple[int, str]]


def parse_condition(text: str) -> list[tuple[int, str]]:
    """``97 or 98 and 132 and`` to members with their connectors; a missing last
    connector reads as ``and``."""
    if not re.fullmatch(r"\s*\d+(\s+(and|or)\s+\d+)*(\s+(and|or))?\s*", text, re.IGNORECASE):
        raise ValueError(f"not a composite condition: {text!r}")
    return [(int(m[1]), (m[2] or "and").lower()) for m in _MEMBER.finditer(text)]


def parse_conditions(rules: DataFrame, key: str = "merge_tag_id", text: str = "condition") -> DataFrame:
    """Member rows ``(key, seq, basic_tag_id, connector)`` from a table of texts."""
    tokens = F.expr(rf"regexp_extract_all(lower({text}), '(\\d+)\\s*(and|or)?', 0)")
    return (
        rules.select(key, F.posexplode(tokens).alias("seq", "_m"))
        .select(
            key,
            (F.col("seq") + 1).alias("seq"),
            F.regexp_extract("_m", r"(\d+)", 1).cast("bigint").alias("basic_tag_id"),
            F.coalesce(F.nullif(F.regexp_extract("_m", r"(and|or)", 1), F.lit("")), F.lit("and")).alias("connector"),
        )
    )


def groups_of(members: Members) -> list[list[int]]:
    groups: list[list[int]] = [[]]
    for i, (tag, connector) in enumerate(members):
        groups[-1].append(tag)
        if connector == "and" and i + 1 < len(members):
            groups.append([])
    return groups


def condition(tags: Column, members: Members) -> Column:
    """The rule as a test on a user's tag list."""
    test = F.lit(True)
    for group in groups_of(members):
        test = test & F.arrays_overlap(tags, F.array(*[F.lit(t).cast("bigint") for t in group]))
    return test


def eval_merge_tags(
    profile: DataFrame, rules: Sequence[tuple[int, Members]], user: str = "user_id", tags: str = "tag_ids"
) -> DataFrame:
    """``(user, merge_tag_id)`` for every rule a user meets.

    A profile row is a user: rows of one user are not put together, and repeated rows give
    repeated rows. A rule listed twice is met if either form is. Short rule lists become
    tests on the profile row; of long ones only those are tested that have a tag of the
    row in their first group. Neither shuffles the profile, and both give the same rows.
    """
    if len(rules) > CASE_LIMIT:
        return _eval_long(profile, rules, user, tags)
    met = [
        F.when(condition(F.col(tags), members), F.lit(mid).cast("bigint")) for mid, members in rules
    ]
    rows = profile.select(user, F.explode_outer(tag_list(met)).alias("merge_tag_id"))
    return rows.where("merge_tag_id is not null")


def _eval_long(profile: DataFrame, rules: Sequence[tuple[int, Members]], user: str, tags: str) -> DataFrame:
    """Rules found by the tags of their first groups, then tested as a whole in the row."""
    forms: dict[int, list[list[list[int]]]] = {}
    for mid, members in rules:
        forms.setdefault(mid, []).append(groups_of(members))
    rows = []
    for mid, ways in forms.items():
        firsts = sorted({tag for groups in ways for tag in groups[0]})
        rows += [(tag, mid, firsts, ways) for tag in firsts]
    schema = "tag_id bigint, merge_tag_id bigint, firsts array<bigint>, ways array<array<array<bigint>>>"
    index = broadcast_if(len(rows) <= BROADCAST_ROWS, small_table(profile.sparkSession, rows, schema))
    held = F.col("_held")
    found = profile.select(user, F.col(tags).alias("_held"), F.explode_outer(F.array_distinct(tags)).alias("tag_id")).join(index, "tag_id")
    # a rule is tested once a row: where its least tag out of the first groups led to it
    once = F.col("tag_id") == F.array_min(F.array_intersect(held, F.col("firsts")))
    met = F.exists("ways", lambda way: F.forall(way, lambda group: F.coalesce(F.arrays_overlap(held, group), F.lit(False))))
    return found.where(once & met).select(user, "merge_tag_id")


def condition_groups(rules: DataFrame, key: str = "merge_tag_id", text: str = "condition") -> DataFrame:
    """Rule texts as rows ``(merge_tag_id, tag_id, grp, need)``: the ``and`` parts of a
    text are its groups, the ``or`` parts their tags. Each text is taken apart in
    its own row, so nothing is shuffled."""
    body = F.regexp_replace(F.lower(F.trim(F.col(text))), r"\s+(and|or)$", "")
    groups = F.split(body, r"\s+and\s+")
    return (
        rules.select(F.col(key).alias("merge_tag_id"), groups.alias("_g"))
        .select("merge_tag_id", F.size("_g").alias("need"), F.posexplode("_g").alias("grp", "_t"))
        .select("merge_tag_id", "need", "grp", F.explode(F.split("_t", r"\s+or\s+")).alias("_t"))
        .select("merge_tag_id", F.col("_t").cast("bigint").alias("tag_id"), "grp", "need")
    )


def member_groups(members: DataFrame) -> DataFrame:
    """The same from stored member rows: the group of a member is how many ``and``
    stand before it, and a rule needs one more than its last group number."""
    rule = Window.partitionBy("merge_tag_id")
    before = rule.orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    number = F.coalesce(F.sum(F.when(F.col("connector") == "and", 1).otherwise(0)).over(before), F.lit(0))
    return (
        members.select("merge_tag_id", F.col("basic_tag_id").alias("tag_id"), number.cast("int").alias("grp"))
        .withColumn("need", F.max("grp").over(rule) + 1)
    )


def eval_merge_groups(pairs: DataFrame, groups: DataFrame, user: str = "user_id") -> DataFrame:
    """``(user, merge_tag_id)`` where the groups hit are as many as the rule has."""
    return (
        pairs.join(groups, "tag_id")
        .groupBy(user, "merge_tag_id", "need")
        .agg(F.size(F.collect_set("grp")).alias("_hit"))  # at most as many as the rule has groups
        .where("_hit = need")
        .select(user, "merge_tag_id")
    )


def eval_merge_texts(pairs: DataFrame, rules: DataFrame, key: str = "merge_tag_id", text: str = "condition") -> DataFrame:
    """Rules as a table of texts."""
    groups = condition_groups(rules, key, text)
    return eval_merge_groups(pairs, broadcast_if(is_small(groups), groups))


def eval_merge_table(pairs: DataFrame, members: DataFrame, user: str = "user_id") -> DataFrame:
    """Rules as a table of members."""
    return eval_merge_groups(pairs, broadcast_if(is_small(members), member_groups(members)), user)


def merge_tag_user_count(matches: DataFrame) -> DataFrame:
    """Users per composite tag, in the shape of the tag counts (type 2)."""
    return matches.groupBy(F.col("merge_tag_id").alias("tag_id")).agg(F.count("*").alias("user_count")).select(
        "tag_id", F.lit(2).alias("tag_type"), "user_count"
    )
