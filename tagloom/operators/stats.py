"""Statistic tags: an aggregate or derived value, then the band it falls into."""

from __future__ import annotations

import json
import operator
from bisect import bisect_left, insort
from collections.abc import Sequence
from decimal import Decimal
from math import inf

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tagloom import seeds
from tagloom.functions.columns import day, device_type, exact_sum, zodiac
from tagloom.operators.match import match_column
from tagloom.specs import Band, Rule, bands

# A longer chain of comparisons makes a method the JVM no longer compiles; longer lists are
# searched, with the same tests and the same answers.
BAND_LIMIT = 64

ZODIAC_TAGS = {r.text: r.tag_id for r in seeds.ZODIAC}


# ---------------------------------------------------------------- bands


def _literal(value: Decimal) -> Column:
    return F.lit(int(value)) if value == value.to_integral_value() else F.lit(float(value))


def in_band(value: Column, band: Band) -> Column:
    tests = []
    if band.lo is not None:
        lo = _literal(band.lo)
        tests.append(value > lo if band.lo_open else value >= lo)
    if band.hi is not None:
        hi = _literal(band.hi)
        tests.append(value < hi if band.hi_open else value <= hi)
    if len(tests) == 2:
        return tests[0] | tests[1] if band.wraps else tests[0] & tests[1]
    return tests[0] if tests else value.isNotNull()


def band_column(value: Column, items: Sequence[Band], dtype: str = "bigint") -> Column:
    """Tag of the first band that holds the value, tried in the given order."""
    chain = None
    for band in items:
        tag = F.lit(band.tag_id).cast(dtype)
        test = in_band(value, band)
        chain = F.when(test, tag) if chain is None else chain.when(test, tag)
    return F.lit(None).cast(dtype) if chain is None else chain


def rule_band(value: Column, rules: Sequence[Rule], dtype: str = "bigint") -> Column:
    return band_column(value, bands(rules), dtype)


def range_tag(
    df: DataFrame, key: str, value: Column, items: Sequence[Band], out: str = "tag_id"
) -> DataFrame:
    if len(items) > BAND_LIMIT:
        return range_tag_join(df, key, value, items, out)
    return df.select(key, value.alias("_v")).select(key, band_column(F.col("_v"), items).alias(out))


def _candidates(items: Sequence[Band]) -> tuple[list[float], list[list[int]]]:
    """Sorted bounds, and for each stretch between two of them (and the ends) the bands, by
    number, that can hold a value there or in a stretch beside it: in their order, up to
    the first that covers all of it."""
    spans = []
    for i, band in enumerate(items):
        lo = -inf if band.lo is None else float(band.lo)
        hi = inf if band.hi is None else float(band.hi)
        spans += [(lo, inf, i), (-inf, hi, i)] if band.wraps else [(lo, hi, i)] if lo <= hi else []
    edges = sorted({x for lo, hi, _ in spans for x in (lo, hi) if abs(x) != inf})
    marks = [-inf, *edges, inf]
    # a stretch with its neighbours reaches from one mark to the third behind it
    starts, ends = sorted(spans), sorted(spans, key=lambda s: s[1])
    active: list[tuple[int, float, float]] = []
    opened = closed = 0
    out = []
    for k in range(len(edges) + 1):
        low, high = marks[max(0, k - 1)], marks[min(len(marks) - 1, k + 2)]
        while opened < len(starts) and starts[opened][0] <= high:
            lo, hi, i = starts[opened]
            insort(active, (i, lo, hi))
            opened += 1
        while closed < len(ends) and ends[closed][1] < low:
            lo, hi, i = ends[closed]
            active.pop(bisect_left(active, (i, lo, hi)))
            closed += 1
        found: list[int] = []
        for i, lo, hi in active:
            if i not in found:
                found.append(i)
            if (lo < low or lo == -inf) and (hi > high or hi == inf):
                break
        out.append(found)
    return edges, out


def range_tag_join(
    df: DataFrame, key: str, value: Column, items: Sequence[Band], out: str = "tag_id"
) -> DataFrame:
    """The same tags for long lists: a binary search among the bounds, as doubles, leaves a
    few bands, and those are tried in their order by the tests of ``in_band``, on the value
    in its own type. Neighbouring stretches count too, so rounding to a double loses none.
    """
    edges, stretches = _candidates(items)

    def side(bound: Decimal | None, open_: bool) -> dict:
        if bound is None:
            return {"i": None, "d": None, "open": False}
        whole = bound == bound.to_integral_value()
        return {"i": int(bound) if whole else None, "d": None if whole else float(bound), "open": open_}

    shown = [
        {"lo": side(b.lo, b.lo_open), "hi": side(b.hi, b.hi_open), "wraps": b.wraps, "tag": b.tag_id} for b in items
    ]
    bound = "struct<i:bigint,d:double,open:boolean>"
    schema = f"array<array<struct<lo:{bound},hi:{bound},wraps:boolean,tag:bigint>>>"
    lists = F.from_json(F.lit(json.dumps([[shown[i] for i in s] for s in stretches])), schema)
    rows = df.select(key, value.alias("_v")).withColumn("_d", F.col("_v").cast("double"))
    if edges:
        # NaN gets the bucket behind the last; like the greatest value it is in no band with an upper bound
        cut = Bucketizer(splits=[-inf, *edges, inf], inputCol="_d", outputCol="_at", handleInvalid="keep")
        rows = cut.transform(rows)
    else:
        rows = rows.withColumn("_at", F.lit(0.0))
    v = F.col("_v")

    def test(bound: Column, strict, loose) -> Column:
        """Null where there is no such bound."""

        def held(x: Column) -> Column:
            return F.when(bound["open"], strict(v, x)).otherwise(loose(v, x))

        return F.when(bound["i"].isNotNull(), held(bound["i"])).when(bound["d"].isNotNull(), held(bound["d"]))

    def holds(band: Column) -> Column:
        above, below = test(band["lo"], operator.gt, operator.ge), test(band["hi"], operator.lt, operator.le)
        return F.when(band["wraps"], above | below).otherwise(
            F.coalesce(above, v.isNotNull()) & F.coalesce(below, v.isNotNull())
        )

    stretch = F.get(lists, F.least(F.col("_at").cast("int"), F.lit(len(edges))))
    first = F.get(F.filter(stretch, lambda b: F.coalesce(holds(b), F.lit(False))), F.lit(0))
    return rows.select(key, F.when(v.isNotNull(), first["tag"]).alias(out))


# ---------------------------------------------------------------- tags


def age_band(df: DataFrame, key: str, birthday: str, rules: Sequence[Rule], out: str = "tag_id") -> DataFrame:
    """Decade of birth; the birthday may be written with or without dashes."""
    return range_tag(df, key, day_number(F.col(birthday)), bands(rules), out)


def day_number(text: Column) -> Column:
    """A date text, dashed or not, as a number that reads yyyyMMdd."""
    return F.translate(text.cast("string"), "-", "").try_cast("int")


def purchase_cycle(
    orders: DataFrame, user: str, finished: str, as_of: str, rules: Sequence[Rule], out: str = "tag_id"
) -> DataFrame:
    """Days since the last finished order, in bands."""
    last = orders.groupBy(user).agg(F.max(finished).alias("_last"))
    days = F.datediff(day(as_of), F.to_date("_last"))
    return last.select(user, days.alias("days")).select(user, "days", rule_band(F.col("days"), rules).alias(out))


def most_frequent(df: DataFrame, user: str, column: str, out: str = "value") -> DataFrame:
    """Each user's most frequent value and its count; equal counts take the least
    value. A missing value counts 0, so it stands only for users who have no other.
    Counting per value first leaves a busy user one row per value."""
    counts = df.groupBy(user, column).agg(F.count(column).alias("_n"))
    best = F.min(F.struct((-F.col("_n")).alias("n"), F.col(column).alias("v")))
    return (
        counts.groupBy(user)
        .agg(best.alias("_best"))
        .select(user, F.col("_best.v").alias(out), (-F.col("_best.n")).alias("n"))
    )


def most_used_payment(
    orders: DataFrame, user: str, code: str, rules: Sequence[Rule], out: str = "tag_id"
) -> DataFrame:
    top = most_frequent(orders, user, code, "code")
    return top.select(user, "code", "n", match_column(F.col("code"), rules).alias(out))


def latest_payment(
    orders: DataFrame, user: str, code: str, paid: str, order_id: str, rules: Sequence[Rule], out: str = "tag_id"
) -> DataFrame:
    """Payment of each user's last order; a later order id settles equal times."""
    last = orders.groupBy(user).agg(F.max(F.struct(paid, order_id, code)).alias("_last"))
    code_col = F.col("_last").getField(code)
    return last.select(
        user,
        F.col("_last").getField(order_id).alias("order_id"),
        code_col.alias("code"),
        match_column(code_col, rules).alias(out),
    )


def payment_counts(orders: DataFrame, user: str, code: str, rules: Sequence[Rule]) -> DataFrame:
    """Recognised payments per user, most first."""
    tagged = orders.select(user, match_column(F.col(code), rules).alias("_tag")).where("_tag is not null")
    return tagged.groupBy(user).agg(F.count("_tag").alias("n")).orderBy(F.desc("n"), user)


def zodiac_tag(df: DataFrame, key: str, birthday: Column, out: str = "tag_id") -> DataFrame:
    sign = zodiac(birthday)
    rules = [Rule(tag, name) for name, tag in ZODIAC_TAGS.items()]
    return df.select(key, sign.alias("sign")).select(key, "sign", match_column(F.col("sign"), rules).alias(out))


def order_value(
    orders: DataFrame, user: str, amount: str, average: Sequence[Rule], largest: Sequence[Rule]
) -> DataFrame:
    """Average order value and largest order of each user, in bands."""
    agg = orders.groupBy(user).agg(
        F.try_divide(exact_sum(orders, amount), F.count(amount)).alias("avg_order"),
        F.max(amount).alias("max_order"),
    )
    return agg.select(
        user,
        "avg_order",
        "max_order",
        rule_band(F.col("avg_order"), average).alias("avg_tag"),
        rule_band(F.col("max_order"), largest).alias("max_tag"),
    )


def spending_band(orders: DataFrame, user: str, amount: str, rules: Sequence[Rule]) -> DataFrame:
    total = orders.groupBy(user).agg(exact_sum(orders, amount).alias("total"))
    return total.select(user, "total", rule_band(F.col("total"), rules).alias("tag_id"))


def discount_depth(
    orders: DataFrame, user: str, paid: str, receivable: str, rules: Sequence[Rule]
) -> DataFrame:
    """Share of the receivable sum that was paid, in tenths, then its band."""
    sums = orders.groupBy(user).agg(
        F.try_divide(exact_sum(orders, paid, 4), exact_sum(orders, receivable, 4)).alias("_ratio")
    )
    tenths = F.floor(F.col("_ratio") * 10 + F.lit(0.5)) / F.lit(10.0)
    return sums.select(user, tenths.alias("depth")).select(
        user, "depth", rule_band(F.col("depth"), rules).alias("tag_id")
    )


def last_login(logs: DataFrame, user: str, time: str, as_of: str, rules: Sequence[Rule]) -> DataFrame:
    last = logs.groupBy(user).agg(F.max(time).alias("_last"))
    days = F.datediff(day(as_of), F.to_date("_last"))
    return last.select(user, days.alias("days")).select(
        user, "days", rule_band(F.col("days"), rules).alias("tag_id")
    )


def favourite_tag(df: DataFrame, user: str, label: Column, rules: Sequence[Rule]) -> DataFrame:
    """Most frequent label per user and its tag: page type, device, category, brand.
    Rows without a label do not count."""
    labelled = df.select(user, label.alias("_label")).where("_label is not null")
    top = most_frequent(labelled, user, "_label", "label")
    return top.select(user, "label", "n", match_column(F.col("label"), rules).alias("tag_id"))


def device_tag(logs: DataFrame, user: str, user_agent: str, rules: Sequence[Rule]) -> DataFrame:
    return favourite_tag(logs, user, device_type(F.col(user_agent)), rules)


def sessions(logs: DataFrame, user: str, time: str, gap_seconds: int = 1800) -> DataFrame:
    """Visits: runs of events no more than ``gap_seconds`` apart.

    All events of one gap-long slot belong to the same visit, so each slot first
    shrinks to its first and last time by ordinary partial aggregation. Only the
    slots, whose number is bounded by the time span and not by the events, are
    then ordered per user.
    """
    gap = gap_seconds * 1_000_000
    micros = F.unix_micros(F.col(time).cast("timestamp"))
    slots = (
        logs.select(user, micros.alias("_t"))
        .where("_t is not null")
        .groupBy(user, (F.col("_t") - F.pmod(F.col("_t"), F.lit(gap))).alias("_slot"))
        .agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"), F.count("*").alias("_n"))
    )
    by_user = Window.partitionBy(user).orderBy("_slot")
    starts = F.when(F.col("_first") - F.lag("_last").over(by_user) <= gap, 0).otherwise(1)
    return (
        slots.withColumn("_new", starts)
        .withColumn("session", F.sum("_new").over(by_user.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy(user, "session")
        .agg(
            F.min("_first").alias("start_us"),
            F.max("_last").alias("end_us"),
            F.sum("_n").alias("events"),
        )
    )


def visit_duration(
    logs: DataFrame, user: str, time: str, rules: Sequence[Rule], gap_seconds: int = 1800
) -> DataFrame:
    """Mean visit length of a user in whole seconds, in bands."""
    visits = sessions(logs, user, time, gap_seconds)
    micros = F.sum(F.col("end_us") - F.col("start_us"))
    per_user = visits.groupBy(user).agg(
        F.count("*").alias("visits"),
        F.floor(micros / F.count("*") / F.lit(1_000_000)).alias("seconds"),
    )
    return per_user.select(user, "visits", "seconds", rule_band(F.col("seconds"), rules).alias("tag_id"))


def browsing_hours(logs: DataFrame, user: str, time: str, rules: Sequence[Rule]) -> DataFrame:
    """Most frequent hour of a user, midnight counting as 24, in bands."""
    hour = F.hour(time)
    top = most_frequent(logs.select(user, F.when(hour == 0, 24).otherwise(hour).alias("_h")), user, "_h", "hour")
    return top.select(user, "hour", "n", rule_band(F.col("hour"), rules).alias("tag_id"))
