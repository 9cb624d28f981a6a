"""Tag jobs: from a source description to a new profile version."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagloom.operators.match import match_column, tag_list
from tagloom.operators.profile import explode_profile
from tagloom.operators.stats import day_number, rule_band
from tagloom.sinks.writers import write_merged_profile
from tagloom.sources.readers import read_source
from tagloom.specs import Rule, SourceSpec


MATCH, RANGE, DAY = "match", "range", "day"


@dataclass(frozen=True)
class TagJob:
    """One level-4 tag over a user table: the column, its rules, how they apply.

    ``match`` compares text, ``range`` numbers, ``day`` dates as yyyyMMdd numbers.
    """

    name: str
    column: str
    rules: tuple[Rule, ...]
    kind: str = MATCH

    def value(self) -> Column:
        """What the rules look at."""
        raw = F.col(self.column)
        if self.kind == MATCH:
            return raw.cast("string")
        if self.kind == RANGE:
            return raw.try_cast("double")
        if self.kind == DAY:
            return day_number(raw)
        raise ValueError(f"unknown kind of tag job: {self.kind!r}")

    def tag(self, value: Column) -> Column:
        return match_column(value, self.rules) if self.kind == MATCH else rule_band(value, self.rules)


def _values(users: DataFrame, key: str, jobs: Sequence[TagJob]) -> DataFrame:
    """The key and one prepared value per job, so that no rule prepares it again."""
    return users.select(F.col(key), *[j.value().alias(f"_{j.name}") for j in jobs])


def _tags(jobs: Sequence[TagJob]) -> list[Column]:
    return [j.tag(F.col(f"_{j.name}")).alias(j.name) for j in jobs]


def run_wide(users: DataFrame, key: str, jobs: Sequence[TagJob]) -> DataFrame:
    """All jobs over one scan, one column per tag."""
    return _values(users, key, jobs).select(key, *_tags(jobs))


def run_profile(users: DataFrame, key: str, jobs: Sequence[TagJob]) -> DataFrame:
    """All jobs over one scan as profile rows, without a shuffle; the key is unique."""
    return _values(users, key, jobs).select(
        F.col(key).alias("user_id"), F.sort_array(tag_list(_tags(jobs))).alias("tag_ids")
    )


def run_pairs(users: DataFrame, key: str, jobs: Sequence[TagJob]) -> DataFrame:
    """All jobs over one scan as ``(user_id, tag_id)`` rows."""
    return explode_profile(run_profile(users, key, jobs))


def tag_source(
    spark: SparkSession, spec: SourceSpec, key: str, jobs: Sequence[TagJob], root: str, version: int, base: int | None = None
) -> str:
    """Read a source, tag it and merge the result into the next profile version."""
    pairs = run_pairs(read_source(spark, spec), key, jobs)
    return write_merged_profile(pairs.withColumn("user_id", F.col("user_id").try_cast("bigint")), root, version, base)
