"""Equality tags: the first rule whose text equals the value gives the tag."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.columns import map_literal
from tagloom.session import BROADCAST_ROWS, broadcast_if, is_small, small_table
from tagloom.specs import Rule, in_order

# Longer rule lists are looked up by a hash join instead of within the row.
CASE_LIMIT = 200


def first_tags(rules: Sequence[Rule]) -> dict[str, int]:
    """Tag by rule text; of several rules with one text the first counts."""
    first: dict[str, int] = {}
    for rule in in_order(rules):
        first.setdefault(rule.text, rule.tag_id)
    return first


def match_column(value: Column, rules: Sequence[Rule]) -> Column:
    """Tag of the rule that equals the value, else null."""
    if not rules:
        return F.lit(None).cast("bigint")
    return map_literal(first_tags(rules), "bigint")[value.cast("string")]


def match_tag(
    df: DataFrame, key: str, column: str, rules: Sequence[Rule], out: str = "tag_id"
) -> DataFrame:
    """``(key, tag)`` for every row; null where no rule fits."""
    if len(rules) > CASE_LIMIT:
        return match_tag_join(df, key, column, rules, out)
    return df.select(key, match_column(F.col(column), rules).alias(out))


def match_tag_join(
    df: DataFrame, key: str, column: str, rules: Sequence[Rule], out: str = "tag_id"
) -> DataFrame:
    """The same tags with the rules as a table, for long rule lists."""
    first = first_tags(rules)
    table = small_table(df.sparkSession, list(first.items()), f"_rule string, `{out}` bigint")
    table = broadcast_if(len(first) <= BROADCAST_ROWS, table)
    return df.join(table, F.col(column).cast("string") == F.col("_rule"), "left").select(key, out)


def match_tag_table(
    df: DataFrame, key: str, column: str, rules: DataFrame, out: str = "tag_id"
) -> DataFrame:
    """Rules from a table ``(rule, tag_id, order)``; duplicates keep the first."""
    first = rules.groupBy(F.col("rule").alias("_rule")).agg(
        F.min(F.struct(F.coalesce("order", F.lit(-1)).alias("o"), F.col("tag_id").alias("t")))["t"].alias(out)
    )
    first = broadcast_if(is_small(rules), first)
    return df.join(first, F.col(column).cast("string") == F.col("_rule"), "left").select(key, out)


def match_many(df: DataFrame, key: str, columns: Mapping[str, Column]) -> DataFrame:
    """Several tags over one scan, one column each."""
    return df.select(key, *[tag.alias(name) for name, tag in columns.items()])


def tag_list(columns: Sequence[Column]) -> Column:
    """The distinct tags of a row as a list without nulls.

    ``array_except`` stays in generated code, where a filter with a lambda would not.
    """
    return F.array_except(F.array(*columns), F.array(F.lit(None).cast("bigint")))
