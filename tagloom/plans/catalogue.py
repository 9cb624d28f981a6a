"""The whole tag catalogue as a few jobs.

A level-4 tag says in its rule text where its rows are, which column is the user and what
is measured; its level-5 tags say which values of the measure they stand for. All rule
texts are taken apart in Spark and brought together by source and user column. Every
source then is one scan: measures of single rows are one projection, measures over the
rows of a user are one aggregate, whatever number of tags they serve. The tags of all
sources go into the profile in one merge.

Besides the source (``inType``, ``dbTable`` and so on) a rule text has the lines

- ``selectFieldNames``: the user column first, then the others. ``#`` parts two sources,
  in tables and fields: the first field of the first is joined to the second one of the
  second, whose first field is the user.
- ``measure``: a name of ``MEASURES`` with its columns, as ``latest(code,time,order)``
- ``asOf``: the day that counts as today, if not the one that the job gives
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagloom import seeds
from tagloom.functions.columns import day, device_type, exact_sum, exact_sum_of, rule_value, zodiac
from tagloom.operators import ml, score
from tagloom.operators.match import match_column, match_tag_table, tag_list
from tagloom.operators.profile import explode_profile
from tagloom.operators.stats import day_number, rule_band, visit_duration
from tagloom.session import is_small
from tagloom.sinks.writers import write_merged_profile
from tagloom.sources.readers import read_source
from tagloom.specs import Rule, SourceSpec, in_order, parse_rule

# Tags with more values than this are looked up in the tag table; fewer are part of the plan.
LIST_LIMIT = 10_000
# Level-4 tags whose plan the driver holds.
PLAN_LIMIT = 100_000

ROW, AGGREGATE, VISITS, CLUSTER = "row", "aggregate", "visits", "cluster"
MATCH, BAND, TAG = "match", "band", "tag"


@dataclass(frozen=True)
class CatalogueTag:
    """A level-4 tag: what it measures and the values it tells apart; ``rules`` is empty if
    they are too many for the plan."""

    tag_id: int
    measure: str
    arguments: tuple[str, ...]
    as_of: str
    rules: tuple[Rule, ...]
    long: bool = False


@dataclass(frozen=True)
class SourcePlan:
    """Tags that one pass over a source gives: its parts (two are joined), the user column,
    how their rows are used, and the tags."""

    specs: tuple[SourceSpec, ...]
    key: str
    style: str
    tags: tuple[CatalogueTag, ...]


# ---------------------------------------------------------------- measures


class Rows:
    """Rows of a source with its columns in the types that measures need."""

    def __init__(self, df: DataFrame, as_of: str) -> None:
        self.df, self.as_of = df, as_of

    def text(self, name: str) -> Column:
        return F.col(name).cast("string")

    def number(self, name: str) -> Column:
        return F.col(name).try_cast("double") if isinstance(self.df.schema[name].dataType, T.StringType) else F.col(name)

    def total(self, name: str, scale: int = 2) -> Column:
        """Money of a column whose texts, if it has any, were made numbers before."""
        return exact_sum(self.df, name, scale)


# A measure of the rows of a user: aggregates by name, and the value made of them.
Parts = tuple[dict[str, Column], Callable[..., Column]]


def _days(rows: Rows, time: str) -> Parts:
    return {"last": F.max(time)}, lambda last: F.datediff(day(rows.as_of), F.to_date(last))


def _average(rows: Rows, amount: str) -> Parts:
    return {"sum": rows.total(amount), "n": F.count(amount)}, lambda sum, n: F.try_divide(sum, n)


def _ratio(rows: Rows, part: str, whole: str) -> Parts:
    def tenths(part: Column, whole: Column) -> Column:
        return F.floor(F.try_divide(part, whole) * 10 + F.lit(0.5)) / F.lit(10.0)

    return {"part": rows.total(part, 4), "whole": rows.total(whole, 4)}, tenths


def _mode(value: Column) -> Parts:
    """The most frequent value, of several the least; nulls don't count."""
    return {"top": F.mode(value, deterministic=True)}, lambda top: top


def _hour(rows: Rows, time: str) -> Parts:
    hour = F.hour(F.col(time).cast("timestamp"))
    return _mode(F.when(hour == 0, 24).otherwise(hour))


def _latest(rows: Rows, value: str, time: str, tie: str) -> Parts:
    last = F.max(F.struct(F.col(time).alias("t"), F.col(tie).alias("i"), rows.text(value).alias("v")))
    return {"last": last}, lambda last: last["v"]


def _sensitivity(rows: Rows, paid: str, coupon: str) -> Parts:
    off, held = rows.number(coupon), rows.number(paid) + rows.number(coupon)
    decimal = all(isinstance(rows.df.schema[c].dataType, T.DecimalType) for c in (paid, coupon))
    aggregates = {
        "dotn": F.count(F.when(off > 0, 1)),
        "otn": F.count(F.when(off >= 0, 1)),
        "dat": rows.total(coupon, 4),
        "rat": exact_sum_of(held, decimal, 4),
    }
    return aggregates, lambda dotn, otn, dat, rat: reduce(lambda a, b: a + b, score.psm_terms(dotn, otn, dat, rat))


def _activity(rows: Rows, time: str, url: str) -> Parts:
    aggregates = {"last": F.max(time), "n": F.count(url), "different": F.countDistinct(url)}

    def share(last: Column, n: Column, different: Column) -> Column:
        recency = F.datediff(day(rows.as_of), F.to_date(last))
        steps = ((recency, seeds.SIX_RECENCY), (n, seeds.SIX_FREQUENCY), (different, seeds.SIX_ENGAGEMENT))
        total = reduce(lambda a, b: a + b, [F.coalesce(rule_band(v, r, "int"), F.lit(0)) for v, r in steps])
        return F.floor(total * 10 / F.lit(18.0) + F.lit(0.5)) / F.lit(10.0)

    return aggregates, share


def _ballot(colour: str, kind: str) -> Column:
    """What a good votes for: 1 male, 2 female, null if its colour or kind is not known."""
    colour, kind = F.col(colour).cast("string"), F.col(kind).cast("string")
    known = colour.isin([t for t, code in seeds.COLOUR_CODES.items() if code]) & kind.isin(
        [t for t, code in seeds.PRODUCT_TYPES.items() if code]
    )
    female = colour.isin(*seeds.FEMALE_COLOURS) | kind.isin(*seeds.FEMALE_TYPES)
    return F.when(known, F.when(female, 2).otherwise(1))


def _ballot_name(colour: str, kind: str) -> str:
    return f"_ballot_{colour}_{kind}"


def _vote(rows: Rows, colour: str, kind: str) -> Parts:
    """Rule 1 or 2 if at least 0.6 of the goods known by colour and kind vote for it."""
    name = _ballot_name(colour, kind)
    ballot = F.col(name) if name in rows.df.columns else _ballot(colour, kind)
    aggregates = {"male": F.count(F.when(ballot == 1, 1)), "female": F.count(F.when(ballot == 2, 1))}

    def majority(male: Column, female: Column) -> Column:
        return F.when(F.try_divide(male, male + female) >= 0.6, "1").when(F.try_divide(female, male + female) >= 0.6, "2")

    return aggregates, majority


# name: number of arguments, how rows are used, how values are told apart, what is measured
MEASURES: dict[str, tuple[int | None, str, str, Callable | None]] = {
    "text": (1, ROW, MATCH, lambda rows, c: rows.text(c)),
    "number": (1, ROW, BAND, lambda rows, c: rows.number(c)),
    "day": (1, ROW, BAND, lambda rows, c: day_number(F.col(c))),
    "sign": (1, ROW, MATCH, lambda rows, c: zodiac(F.to_date(c))),
    "days_since": (1, AGGREGATE, BAND, _days),
    "total": (1, AGGREGATE, BAND, lambda rows, c: ({"sum": rows.total(c)}, lambda sum: sum)),
    "average": (1, AGGREGATE, BAND, _average),
    "largest": (1, AGGREGATE, BAND, lambda rows, c: ({"max": F.max(rows.number(c))}, lambda max: max)),
    "ratio": (2, AGGREGATE, BAND, _ratio),
    "mode": (1, AGGREGATE, MATCH, lambda rows, c: _mode(rows.text(c))),
    "device": (1, AGGREGATE, MATCH, lambda rows, c: _mode(device_type(F.col(c)))),
    "hour": (1, AGGREGATE, BAND, _hour),
    "latest": (3, AGGREGATE, MATCH, _latest),
    "sensitivity": (2, AGGREGATE, BAND, _sensitivity),
    "activity": (2, AGGREGATE, BAND, _activity),
    "vote": (2, AGGREGATE, MATCH, _vote),
    "visits": (2, VISITS, TAG, None),
    "cluster": (None, CLUSTER, TAG, None),
}
# arguments that have to be numbers before they are summed
MONEY = {"total": 1, "average": 1, "ratio": 2, "sensitivity": 2, "cluster": 99}
_CALL = re.compile(r"\s*(\w+)\s*\(([^()]*)\)\s*")


# ---------------------------------------------------------------- the plan


def rule_table(tags: DataFrame, list_limit: int = LIST_LIMIT) -> DataFrame:
    """One row per live level-4 tag that measures something: its source lines, its measure
    and its values in order (null where there are more than ``list_limit``)."""
    live = F.coalesce(F.col("state"), F.lit(0)) != -1
    lines = ("inType", "selectFieldNames", "whereFieldNames", "whereFieldValues", "family", "measure", "asOf")
    top = tags.where((F.col("level") == 4) & live & (rule_value(F.col("rule"), "measure") != "")).select(
        "id", "rule", *[F.trim(rule_value(F.col("rule"), n)).alias(n) for n in lines]
    )
    values = tags.where((F.col("level") == 5) & live & F.col("rule").isNotNull())
    # values are counted before any list is made of them
    few = values.groupBy("pid").agg(F.count("*").alias("n"))
    value = F.struct(F.col("order").isNotNull().alias("o1"), F.col("order").alias("o2"), "id", F.col("rule").alias("text"))
    lists = (
        values.join(few.where(F.col("n") <= list_limit).select("pid"), "pid")
        .groupBy("pid")
        .agg(F.sort_array(F.collect_list(value)).alias("rules"))
    )
    return (
        top.join(few.withColumnRenamed("pid", "id"), "id")
        .join(lists.withColumnRenamed("pid", "id"), "id", "left")
        .select(*top.columns, "rules")
    )


def compile_catalogue(tags: DataFrame, list_limit: int = LIST_LIMIT) -> list[SourcePlan]:
    """All tags of the table as plans, one per source, user column and use of the rows.

    The driver holds the rule texts of level-4 tags and their short lists, which are counted
    first; a table with more such tags than ``PLAN_LIMIT`` is refused, not cut.
    """
    table = rule_table(tags, list_limit)
    if not is_small(table, PLAN_LIMIT):
        raise ValueError(f"more than {PLAN_LIMIT} measured tags")
    plans: dict[tuple, list] = {}
    for row in table.orderBy("id").collect():
        call = _CALL.fullmatch(row["measure"])
        name = call[1] if call else row["measure"]
        arguments = tuple(a.strip() for a in call[2].split(",") if a.strip()) if call else ()
        if name not in MEASURES or MEASURES[name][0] not in (None, len(arguments)):
            raise ValueError(f"tag {row['id']} has an unknown measure: {row['measure']!r}")
        specs = parse_rule(row["rule"])
        if len(specs) > 2 or any(not s.fields for s in specs) or (len(specs) == 2 and len(specs[1].fields) < 2):
            raise ValueError(f"tag {row['id']} does not name its user column")
        key = specs[-1].fields[0]
        rules = tuple(Rule(v["id"], v["text"], v["o2"]) for v in row["rules"] or ())
        tag = CatalogueTag(row["id"], name, arguments, row["asOf"], rules, row["rules"] is None)
        style = MEASURES[name][1]
        place = tuple((s.kind, s.table, s.family, s.where, s.option("sql")) for s in specs)
        joined = specs[0].fields[0] + "=" + specs[1].fields[1] if len(specs) == 2 else ""
        group = (place, key, joined, style, tag.tag_id if style in (VISITS, CLUSTER) else 0)
        plans.setdefault(group, []).append((specs, tag))
    return [_one_plan(group, members) for group, members in sorted(plans.items(), key=lambda g: repr(g[0]))]


def _one_plan(group: tuple, members: list) -> SourcePlan:
    """The first tag's source with the fields of all."""
    first = members[0][0]
    specs = []
    for i, spec in enumerate(first):
        fields = tuple(dict.fromkeys(f for s, _ in members for f in s[i].fields))
        specs.append(SourceSpec(spec.kind, spec.table, spec.family, fields, spec.where, spec.options))
    return SourcePlan(tuple(specs), group[1], group[3], tuple(t for _, t in members))


# ---------------------------------------------------------------- running it


def read_plan(spark: SparkSession, plan: SourcePlan) -> DataFrame:
    """The rows of a plan: one source, or two joined. The user column leads.

    Rows without a user are nobody's and go before anything is joined or summed up. Goods
    vote before the join, which then moves a number instead of two texts.
    """
    left = read_source(spark, plan.specs[0])
    if len(plan.specs) == 1:
        return left.select(*plan.specs[0].fields).where(F.col(plan.key).isNotNull())
    link, other = plan.specs[0].fields[0], plan.specs[1].fields[1]
    right = read_source(spark, plan.specs[1]).select(*plan.specs[1].fields).where(F.col(plan.key).isNotNull())
    right = right.withColumnRenamed(other, "_link")
    names = [f for f in plan.specs[0].fields if f not in right.columns]
    votes = {t.arguments for t in plan.tags if t.measure == "vote" and set(t.arguments) <= set(names)}
    ballots = [_ballot(*a).alias(_ballot_name(*a)) for a in sorted(votes)]
    both = left.select(*[F.col(f) for f in names], *ballots, F.col(link).alias("_left")).join(right, F.col("_left") == F.col("_link"))
    return both.drop("_left", "_link")


def _told(tag: CatalogueTag, value: Column, compare: str) -> Column:
    rules = in_order(tag.rules)
    return match_column(value, rules) if compare == MATCH else rule_band(value, rules)


def _numbers(rows: DataFrame, plan: SourcePlan) -> DataFrame:
    """Columns that are summed up, as numbers where the source has texts."""
    asked = {a for t in plan.tags for a in t.arguments[: MONEY.get(t.measure, 0)]}
    texts = [c for c in rows.columns if c in asked and isinstance(rows.schema[c].dataType, T.StringType)]
    return rows.withColumns({c: F.col(c).try_cast("double") for c in texts}) if texts else rows


def _values(rows: DataFrame, plan: SourcePlan, as_of: str) -> DataFrame:
    """The user and one value per tag, in columns named by the tags."""
    key = F.col(plan.key).alias("user_id")
    if plan.style == ROW:
        made = [MEASURES[t.measure][3](Rows(rows, t.as_of or as_of), *t.arguments).alias(f"v{t.tag_id}") for t in plan.tags]
        return rows.select(key, *made)
    parts: dict[str, Column] = {}
    values = []
    for t in plan.tags:
        found, finish = MEASURES[t.measure][3](Rows(rows, t.as_of or as_of), *t.arguments)
        parts |= {f"a{t.tag_id}_{n}": c for n, c in found.items()}
        values.append(finish(**{n: F.col(f"a{t.tag_id}_{n}") for n in found}).alias(f"v{t.tag_id}"))
    return rows.groupBy(key).agg(*[c.alias(n) for n, c in parts.items()]).select("user_id", *values)


def run_plan(spark: SparkSession, plan: SourcePlan, as_of: str, tags: DataFrame | None = None) -> DataFrame:
    """``(user_id, tag_ids)`` of one plan. Values of tags with long lists are looked up in
    ``tags``, which is only needed for them."""
    rows = _numbers(read_plan(spark, plan), plan)
    if plan.style == VISITS:
        t = plan.tags[0]
        time, gap = t.arguments
        made = visit_duration(rows, plan.key, time, in_order(t.rules), int(gap))
        return made.select(F.col(plan.key).alias("user_id"), tag_list([F.col("tag_id")]).alias("tag_ids"))
    if plan.style == CLUSTER:
        t = plan.tags[0]
        return _clustered(rows, plan.key, t).select("user_id", tag_list([F.col("tag_id")]).alias("tag_ids"))
    values = _values(rows, plan, as_of)
    short = [t for t in plan.tags if not t.long]
    told = [_told(t, F.col(f"v{t.tag_id}"), MEASURES[t.measure][2]) for t in short]
    out = values.select("user_id", F.sort_array(tag_list(told)).alias("tag_ids"))
    for t in plan.tags:
        if t.long:
            more = _looked_up(values.select("user_id", f"v{t.tag_id}"), t, tags)
            out = out.unionByName(more.select("user_id", tag_list([F.col("tag_id")]).alias("tag_ids")))
    return out


def _looked_up(values: DataFrame, tag: CatalogueTag, tags: DataFrame | None) -> DataFrame:
    """Tags whose values are a table of any length."""
    if tags is None:
        raise ValueError(f"tag {tag.tag_id} needs the tag table")
    live = F.coalesce(F.col("state"), F.lit(0)) != -1
    rules = tags.where((F.col("pid") == tag.tag_id) & (F.col("level") == 5) & live & F.col("rule").isNotNull())
    rules = rules.select(F.col("rule"), F.col("id").alias("tag_id"), "order")
    if MEASURES[tag.measure][2] == MATCH:
        return match_tag_table(values, "user_id", f"v{tag.tag_id}", rules)
    from tagloom.operators.intervals import band_table, interval_tag

    return interval_tag(values, "user_id", f"v{tag.tag_id}", band_table(rules))


def _clustered(rows: DataFrame, key: str, tag: CatalogueTag) -> DataFrame:
    """As many clusters as the tag has values; their ranks are the values' order."""
    columns = list(tag.arguments)
    features = rows.select(F.col(key).alias("user_id"), *[F.col(c).cast("double").alias(c) for c in columns])
    points = ml.assemble(ml.compress(features, columns), columns)
    model = ml.kmeans_fit(points, len(tag.rules), seed=10, weight="weight")
    return ml.cluster_tags(ml.assemble(features, columns), "user_id", model, in_order(tag.rules))


def run_catalogue(spark: SparkSession, tags: DataFrame, as_of: str, list_limit: int = LIST_LIMIT) -> DataFrame:
    """``(user_id, tag_id)`` of every measured tag of the table."""
    outputs = [run_plan(spark, p, as_of, tags) for p in compile_catalogue(tags, list_limit)]
    if not outputs:
        raise ValueError("no tag of the table measures anything")
    numbered = [o.select(F.col("user_id").try_cast("bigint").alias("user_id"), "tag_ids") for o in outputs]
    return explode_profile(reduce(DataFrame.unionByName, numbered)).where("user_id is not null")


def tag_catalogue(
    spark: SparkSession, tags: DataFrame, as_of: str, root: str, version: int, base: int | None = None
) -> str:
    """Run the catalogue and merge it into the next version of the profile."""
    return write_merged_profile(run_catalogue(spark, tags, as_of), root, version, base)
