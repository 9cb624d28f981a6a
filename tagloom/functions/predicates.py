"""Row filters: the bracket language of source specs, cell filters, cut-off dates."""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.columns import day

_COMPARE: dict[str, Callable[[Column, Column], Column]] = {
    "eq": operator.eq,
    "ne": operator.ne,
    "gt": operator.gt,
    "lt": operator.lt,
    "ge": operator.ge,
    "le": operator.le,
}
_TERM = re.compile(r"(.*?)\[(.*?)\](.*)", re.DOTALL)


def where_dsl(text: str, numeric: bool = False) -> Column:
    """``a[GT]v,b[eq]w`` as one predicate; all terms must hold.

    A row that lacks the column passes. Text is compared byte by byte unless
    ``numeric`` asks for numbers; a value that is no number then fails.
    """
    terms = [_term(t, numeric) for t in text.split(",") if t.strip()]
    return reduce(operator.and_, terms, F.lit(True))


def where_fields(text: str) -> list[str]:
    """The columns that conditions ask for, each once."""
    return list(dict.fromkeys(_parts(t)[1] for t in text.split(",") if t.strip()))


def _parts(text: str) -> re.Match:
    m = _TERM.fullmatch(text.strip())
    if not m:
        raise ValueError(f"not a condition: {text!r}")
    return m


def _term(text: str, numeric: bool) -> Column:
    m = _parts(text)
    name, op, value = m[1], m[2].lower(), m[3]
    if op not in _COMPARE:
        raise ValueError(f"unknown operator {m[2]!r} in {text!r}")
    column = F.col(name)
    if numeric:
        test = F.coalesce(_COMPARE[op](column.try_cast("double"), F.lit(float(value))), F.lit(False))
    else:
        test = _COMPARE[op](column, F.lit(value))
    return column.isNull() | test


def cell(name: str, op: str, value: str | None = None) -> Column:
    """One cell filter. A row that lacks the column fails, except for ``null``."""
    column = F.col(name)
    if op == "null":
        return column.isNull()
    if op == "not_null":
        return column.isNotNull()
    if op == "substring":
        test = F.contains(F.lower(column), F.lit(str(value).lower()))
    elif op == "regex":
        test = column.rlike(str(value))
    elif op in _COMPARE:
        test = _COMPARE[op](column, F.lit(value))
    else:
        raise ValueError(f"unknown cell filter {op!r}")
    return F.coalesce(test, F.lit(False))


def all_of(tests: Iterable[Column]) -> Column:
    return reduce(operator.and_, tests, F.lit(True))


def any_of(tests: Iterable[Column]) -> Column:
    return reduce(operator.or_, tests, F.lit(False))


def relative_day(text: str, as_of: str | Column) -> Column:
    """Cut-off day ``0.5y`` / ``1m`` / ``60d`` before ``as_of``.

    Years count 365 days each, months are calendar months.
    """
    m = re.fullmatch(r"(\d+(?:\.\d+)?)([ymd])", text.strip())
    if not m:
        raise ValueError(f"not a relative time: {text!r}")
    amount, unit = float(m[1]), m[2]
    if unit == "m":
        return F.add_months(day(as_of), -int(amount))
    return F.date_sub(day(as_of), int(amount * 365) if unit == "y" else int(amount))


def epoch_millis(value: Column) -> Column:
    return F.unix_millis(value.cast("timestamp"))
