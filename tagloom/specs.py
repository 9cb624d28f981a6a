"""Rules, bands and source descriptions, all immutable driver-side values."""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from decimal import Decimal


@dataclass(frozen=True)
class Rule:
    """One level-5 tag: its id, its rule text and its place among its siblings."""

    tag_id: int
    text: str
    order: int | None = None


def rules(pairs: Iterable[tuple[str, int]]) -> list[Rule]:
    return [Rule(tag_id, text) for text, tag_id in pairs]


def in_order(items: Iterable[Rule]) -> list[Rule]:
    """First match wins, so siblings are tried by ``order`` and then by id."""
    return sorted(items, key=lambda r: (r.order is not None, r.order or 0, r.tag_id))


@dataclass(frozen=True)
class Band:
    """``lo .. hi``; a missing bound is unbounded; ``lo > hi`` wraps around."""

    tag_id: int
    lo: Decimal | None = None
    hi: Decimal | None = None
    lo_open: bool = False
    hi_open: bool = False

    @property
    def wraps(self) -> bool:
        return self.lo is not None and self.hi is not None and self.lo > self.hi


_NUM = r"-?\d+(?:\.\d+)?"
_UNIT = r"(?:second|day)?"
_RANGE = re.compile(rf"({_NUM}){_UNIT}[-~]({_NUM}){_UNIT}")
_UP_TO = re.compile(rf"<({_NUM})-({_NUM}){_UNIT}")
_BOUND = re.compile(rf"(>=|>|<=|<)({_NUM}){_UNIT}")
_WITHIN = re.compile(r"(\d+)day")
_POINT = re.compile(rf"({_NUM})")


def parse_band(rule: Rule) -> Band:
    """The band grammar: ``a-b``, ``a~b``, ``>=x``, ``>x``, ``<=x``, ``<x``,
    ``<a-b`` (anything up to b), ``Nday`` (within N days) and ``x``."""
    text = rule.text.strip()
    if m := _UP_TO.fullmatch(text):
        return Band(rule.tag_id, hi=Decimal(m[2]))
    if m := _BOUND.fullmatch(text):
        value = Decimal(m[2])
        if m[1][0] == ">":
            return Band(rule.tag_id, lo=value, lo_open=m[1] == ">")
        return Band(rule.tag_id, hi=value, hi_open=m[1] == "<")
    if m := _WITHIN.fullmatch(text):
        return Band(rule.tag_id, hi=Decimal(m[1]))
    if m := _RANGE.fullmatch(text):
        return Band(rule.tag_id, Decimal(m[1]), Decimal(m[2]))
    if m := _POINT.fullmatch(text):
        return Band(rule.tag_id, Decimal(m[1]), Decimal(m[1]))
    raise ValueError(f"not a band rule: {rule.text!r}")


def bands(items: Iterable[Rule]) -> list[Band]:
    return [parse_band(r) for r in in_order(items)]


def close_gaps(items: Iterable[Band]) -> list[Band]:
    """Half-open bands without holes: each one reaches up to the start of the
    next, and the outermost two are unbounded."""
    ordered = sorted(items, key=lambda b: (b.lo is not None, b.lo or 0))
    out = []
    for i, band in enumerate(ordered):
        lo = band.lo if i else None
        if i + 1 < len(ordered):
            out.append(Band(band.tag_id, lo, ordered[i + 1].lo, hi_open=True))
        else:
            out.append(Band(band.tag_id, lo))
    return out


# ------------------------------------------------------------------ sources

HBASE, RDBMS, HIVE, HDFS = "hbase", "rdbms", "hive", "hdfs"

# Accepted spellings of a source type.
KINDS = {
    "hbase": HBASE,
    "rdbms": RDBMS,
    "mysql": RDBMS,
    "postgresql": RDBMS,
    "oracle": RDBMS,
    "hive": HIVE,
    "hdfs": HDFS,
}


@dataclass(frozen=True)
class SourceSpec:
    """Where a tag reads its rows from. Two specs never share their options."""

    kind: str
    table: str = ""
    family: str = ""
    fields: tuple[str, ...] = ()
    where: str = ""
    options: tuple[tuple[str, str], ...] = field(default=())

    def option(self, name: str, default: str = "") -> str:
        return dict(self.options).get(name, default)


def parse_rule(text: str) -> list[SourceSpec]:
    """Read the ``key=value`` lines of a level-4 rule.

    Only the first ``=`` separates, so a JDBC address keeps its parameters.
    ``#`` inside table, family or field list describes a second source.
    """
    pairs: dict[str, str] = {}
    for line in re.split(r"\r\n|\r|\n", text or ""):
        key, sep, value = line.partition("=")
        if sep:
            pairs[key.strip()] = value.strip()
    kind = KINDS.get(pairs.get("inType", "").lower())
    if kind is None:
        raise ValueError(f"unknown source type in rule: {pairs.get('inType')!r}")
    table = {
        HBASE: pairs.get("hbaseTable", ""),
        HDFS: pairs.get("inPath", ""),
    }.get(kind, pairs.get("dbTable") or pairs.get("table", ""))
    fields = pairs.get("selectFieldNames") or pairs.get("inFields", "")
    tables, families, lists = table.split("#"), pairs.get("family", "").split("#"), fields.split("#")
    return [
        SourceSpec(
            kind=kind,
            table=one,
            family=families[min(i, len(families) - 1)],
            fields=tuple(f for f in lists[min(i, len(lists) - 1)].split(",") if f),
            where=_where_text(pairs),
            options=tuple(sorted(pairs.items())),
        )
        for i, one in enumerate(tables)
    ]


def _where_text(pairs: dict[str, str]) -> str:
    names = [n for n in pairs.get("whereFieldNames", "").split(",") if n]
    values = pairs.get("whereFieldValues", "").split(",")
    return ",".join(f"{n}[eq]{v}" for n, v in zip(names, values))
