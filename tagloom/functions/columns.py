"""Scalar helpers over columns."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: account formats, tried in this order. Repeated groups are
# written as character runs with a look ahead for what a run must not contain:
# Java matches a repeated group by recursion, so a long text would overflow the
# stack of the executor, and nested repeats take exponential time.
ACCOUNT_FORMATS = {
    "mobile": r"^((17[0-9])|(14[0-9])|(13[0-9])|(15[^4,\D])|(18[0,5-9]))\d{8}\z",
    "email": (
        r"^(?!.*[-|.]{2})[a-z0-9A-Z][a-z0-9A-Z|.-]*[a-z0-9A-Z]"
        r"@(?!.*-[a-z0-9A-Z]*-)[a-z0-9A-Z][a-z0-9A-Z.-]*\.[a-zA-Z]{2,}\z"
    ),
    "qq": r"^[0-9]\d{4,11}\z",
    "id_card": r"^(\d{15}|\d{17}[0-9Xx])\z",
}
# --- fixed values: other formats, matched against the whole value
URL_FORMAT = r"^https?://(?![^/]*\.\.)[\w-][\w.-]*\.[\w-]+(/[\w ./?%&=-]*)?\z"
IP_PART = r"(25[0-5]|2[0-4]\d|[0-1]\d{2}|[1-9]?\d)"
IP_FORMAT = rf"^{IP_PART}(\.{IP_PART}){{3}}\z"

# --- fixed values: first day of the sign that starts in each month, from January
ZODIAC_STARTS = (20, 19, 21, 21, 21, 22, 23, 23, 23, 23, 22, 22)
ZODIAC = (
    "capricorn",
    "aquarius",
    "pisces",
    "aries",
    "taurus",
    "gemini",
    "cancer",
    "leo",
    "virgo",
    "libra",
    "scorpio",
    "sagittarius",
)


def mask(value: Column) -> Column:
    """Keep three characters at both ends; shorter than six stays, null becomes ''."""
    size = F.length(value)
    middle = F.repeat(F.lit("*"), (size - 6).cast("int"))
    return (
        F.when(value.isNull(), "")
        .when(size < 6, value)
        .otherwise(F.concat(F.substring(value, 1, 3), middle, F.substring(value, -3, 3)))
    )


def mask_name(value: Column) -> Column:
    return F.concat(F.substring(value, 1, 1), F.lit("**"))


def classify_account(value: Column) -> Column:
    """Kind of account number: the first format that fits, else null."""
    chain = None
    for kind, pattern in ACCOUNT_FORMATS.items():
        test = value.rlike(pattern)
        chain = F.when(test, kind) if chain is None else chain.when(test, kind)
    return chain


def digits_to_date(value: Column) -> Column:
    """Date from any text whose digits read yyyyMMdd; null if there is no such day.

    The text must have exactly eight digits and form a real calendar day.
    """
    digits = F.regexp_replace(value, r"\D", "")
    return F.when(
        F.length(digits) == 8, F.try_to_timestamp(digits, F.lit("yyyyMMdd")).cast("date")
    )


def days_since(value: Column, as_of: str | Column) -> Column:
    return F.datediff(day(as_of), digits_to_date(value))


def zodiac(day: Column) -> Column:
    """Sign of a date by its cut-off days; the last sign wraps over the year end."""
    month, dom = F.month(day), F.dayofmonth(day)
    starts = F.array(*[F.lit(d) for d in ZODIAC_STARTS])
    signs = F.array(*[F.lit(s) for s in ZODIAC])
    index = month - F.when(dom < F.element_at(starts, month), 1).otherwise(0)
    return F.element_at(signs, (index % 12 + 1).cast("int"))


def epoch_seconds(value: Column) -> Column:
    """Timestamp from epoch seconds held as text; text that is no number is null."""
    return F.timestamp_seconds(value.try_cast("bigint"))


def exact_sum(df: DataFrame, name: str, scale: int = 2) -> Column:
    """Sum of money, returned as a double.

    Doubles are counted in whole units of ``10**-scale``, so for such amounts neither
    the order of the rows nor the number of partitions shows in the result. What an
    amount has below a unit is added apart and isn't lost. A sum with NaN or infinity
    is what doubles make of it. Decimals already add exactly.
    """
    return exact_sum_of(F.col(name), isinstance(df.schema[name].dataType, T.DecimalType), scale)


def exact_sum_of(amount: Column, decimal: bool, scale: int = 2) -> Column:
    """The same of any expression, of which it has to be said whether it is a decimal."""
    if decimal:
        return F.sum(amount).cast("double")
    whole = F.coalesce(units(amount, scale), F.lit(0).cast("bigint"))
    one = F.lit(float(10**scale))
    # beyond a long's range all is rest; a rest that is no more than the rounding of the
    # amount itself, as products of prices have, is none
    value = amount.cast("double")
    rest = value - whole.cast("double") / one
    rest = F.when(F.abs(rest) < F.abs(value) * F.lit(2.0**-49), F.lit(0.0)).otherwise(rest)
    some = F.when(amount.isNotNull(), whole)
    return F.sum(some).cast("double") / one + F.sum(rest)


def units(value: Column, scale: int = 2) -> Column:
    """Whole units of an amount; null where a long can't hold them."""
    return F.rint(value * F.lit(float(10**scale))).try_cast("bigint")


def literal(text: str) -> str:
    """Text as a literal of an SQL expression."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal(table: Mapping[str, int], dtype: str) -> Column:
    """A fixed table as a map that the optimizer folds to one literal.

    A lookup in it is a short loop. A chain of comparisons would make one long
    method, which the JVM stops compiling once it is too long.
    """
    entries = ", ".join(f"{literal(k)}, {v}" for k, v in table.items())
    return F.expr(f"cast(map({entries}) as map<string, {dtype}>)")


def rule_value(rule: Column, name: str) -> Column:
    """Value of one ``key=value`` line in a rule text, up to the end of the line;
    only the first ``=`` separates. Empty where the key is missing."""
    return F.regexp_extract(rule, rf"(?:^|[\r\n])\s*{name}=([^\r\n]*)", 1)


def device_type(user_agent: Column) -> Column:
    """Device family named in a user agent. Phones are tested before desktops,
    because their agents also carry a desktop word."""
    agent = F.lower(user_agent)

    def names(*words: str) -> Column:
        return reduce(or_, [agent.contains(w) for w in words])

    return (
        F.when(names("android"), "Android")
        .when(names("iphone", "ipad", "ios"), "IOS")
        .when(names("windows"), "Windows")
        .when(names("mac os", "macos", "macintosh"), "Mac")
        .when(names("linux"), "Linux")
    )


def day(value: str | Column) -> Column:
    """``as_of`` given as text or as a column."""
    return F.to_date(F.lit(value)) if isinstance(value, str) else F.to_date(value)
