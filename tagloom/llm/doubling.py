"""Repeated word sequences by level-wise doubling.

Windows of a few words that occur once can't be part of longer ones that repeat. So only
those repeated at one length are extended to twice that length, until the length asked
for is reached or none is left. At that length a window's first place in the corpus
keeps its words, every later one loses them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tagloom.llm import ragged
from tagloom.llm.blocks import (
    NO_ID,
    Block,
    answers,
    ask,
    bits_of,
    cells,
    deal,
    in_several,
    load,
    owned_first,
    packed_low,
)
from tagloom.llm.common import written

SENT = "bin int, block int, hashes binary, docs binary, alone long"
SLICE = 1 << 20


def levels(start: int, length: int) -> list[int]:
    """start, twice that and so on; the last is ``length``."""
    out = [min(start, length)]
    while out[-1] < length:
        out.append(min(2 * out[-1], length))
    return out


class Words:
    """The words of a block and the hashes of their windows."""

    def __init__(self, block: Block) -> None:
        self.block = block
        self.starts, self.ends, self.first = ragged.word_spans(block.data, block.offsets)
        self.doc = np.repeat(np.arange(len(block.ids)), np.diff(self.first))
        self.hashes = self._word_hashes()
        self.width = 1
        self.candidate = np.ones(len(self.starts), bool)

    def _word_hashes(self) -> np.ndarray:
        out, n = np.zeros(len(self.starts), np.uint64), len(self.starts)
        at = 0
        while at < n:  # a slice of text at a time, or one longer word
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + SLICE, "right")))
            part = self.block.data[low : self.ends[to - 1]]
            out[at:to] = ragged.byte_hashes(part, self.starts[at:to] - low, self.ends[at:to] - low)
            at = to
        return out

    def widen(self, width: int) -> None:
        """Windows of more words: two of the width so far, overlapping or side by side."""
        step = width - self.width
        n = max(0, len(self.hashes) - step)
        with np.errstate(over="ignore"):
            self.hashes = ragged.mixed(
                self.hashes[:n] * np.uint64(ragged.MULTIPLIER) + self.hashes[step:] + np.uint64(width)
            )
        last = np.arange(n) + width - 1
        fits = last < len(self.doc)
        fits[fits] = self.doc[last[fits]] == self.doc[: len(fits)][fits]
        self.candidate = self.candidate[:n] & self.candidate[step:] & fits
        self.width = width

    def different(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Candidates' positions; their different hashes, first positions, and which each has."""
        at = np.flatnonzero(self.candidate)
        values, first, back = np.unique(self.hashes[at], return_index=True, return_inverse=True)
        return at, values, first, back

    def climb(self, widths: list[int], flags: list[dict[int, bytes]], n: int) -> None:
        """Up to the last of ``widths``, dropping what each level's answers rule out."""
        for i, width in enumerate(widths):
            step = width
            while self.width < step:
                self.widen(min(2 * self.width, step))
            if i < len(flags):
                at, values, _, back = self.different()
                times = np.bincount(back, minlength=len(values))
                self.candidate[at] = (answers(values, n, flags[i]) | (times > 1))[back]


def _flags(tables: pa.Table, level: int) -> dict[int, bytes]:
    mine = tables.filter(pa.compute.equal(tables["level"], level))
    return bits_of(mine)


def repeated_words(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = 20,
    start: int = 5,
    with_text: bool = True,
    block_bytes: int = 16 << 20,
) -> DataFrame:
    """Per document: id_col, n_words, n_removed, kept_sha256, kept (the words left; null without ``with_text``).

    Words are unchanged runs between white space. A word goes if a window of ``length``
    words over it also starts earlier: in a document with a smaller id, or before in the
    same one; windows are judged on the input. The words left are joined by one space.

    Windows are compared by 64-bit hashes, made anew at each level; one that is alone is
    taken for repeated only if its hash meets another's at all levels. Null and empty
    texts have no words. Rows without an id come before all others, repeated ids one after
    another, in the order of their texts. An empty table gives no rows; other columns are
    not read.
    """
    from pyspark.sql import functions as F

    dealt, n = deal(docs, id_col=id_col, text=text, block_bytes=block_bytes)
    steps = levels(start, length)
    flags: DataFrame | None = None
    try:
        for level, width in enumerate(steps):
            last = width == length

            def send(table: pa.Table, answered: pa.Table | None, level: int = level, last: bool = last) -> pa.Table:
                block = load(table)
                w = Words(block)
                w.climb(steps[: level + 1], [_flags(answered, i) for i in range(level)] if answered is not None else [], n)
                at, values, first, back = w.different()
                rows, alone = [], int((np.bincount(back, minlength=len(values)) > 1).sum())
                for number, some in cells(values, n):
                    if last:
                        mine = block.ids[w.doc[at[first[some]]]].astype("<i8").tobytes()
                        rows.append((number, block.number, values[some].astype("<u8").tobytes(), mine, alone))
                    else:
                        rows.append((number, block.number, packed_low(values[some]), None, alone))
                    alone = 0
                types = (pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.int64())
                names = ("bin", "block", "hashes", "docs", "alone")
                return pa.table({c: pa.array([r[i] for r in rows], t) for i, (c, t) in enumerate(zip(names, types))})

            sent = _with_answers(dealt, flags, send, SENT)
            found = ask(sent, owned_first if last else in_several).withColumn("level", F.lit(level))
            found = written(found, f"level-{width}")
            flags = found if flags is None else flags.unionByName(found)

        def kept(table: pa.Table, answered: pa.Table | None) -> pa.Table:
            block = load(table)
            w = Words(block)
            w.climb(steps, [_flags(answered, i) for i in range(len(steps) - 1)], n)
            at, values, first, back = w.different()
            again = answers(values, n, _flags(answered, len(steps) - 1))[back]
            own = np.ones(len(at), bool)
            own[first] = False  # the block's first window of a hash stays, unless another block has it before
            return _cut(w, at[again | own], length, with_text)

        out = _with_answers(dealt, flags, kept, OUT)
        out = written(out, "kept-words")
    finally:
        dealt.unpersist()
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))).withColumnRenamed("doc_id", id_col)


OUT = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _with_answers(dealt: DataFrame, flags: DataFrame | None, work, schema: str) -> DataFrame:
    """Runs ``work`` on every block with the answers to it."""
    if flags is None:
        return dealt.groupBy("block").applyInArrow(lambda t: work(t, None), schema)

    def both(fragments: pa.Table, answered: pa.Table) -> pa.Table:
        return work(fragments, answered)

    return dealt.groupBy("block").cogroup(flags.groupBy("block")).applyInArrow(both, schema)


def _cut(w: Words, gone: np.ndarray, length: int, with_text: bool) -> pa.Table:
    """The documents without the words of the windows at ``gone``."""
    n = len(w.starts)
    edge = np.zeros(n + 1, np.int64)
    edge[gone] += 1
    np.subtract.at(edge, gone + length, 1)
    left = np.cumsum(edge[:n]) == 0
    starts, ends = w.starts[left], w.ends[left] + 1  # a word and the one byte behind it
    shown = np.zeros(len(w.block.data) + 1, np.int8)
    shown[starts] += 1
    shown[ends] -= 1
    mine = np.cumsum(shown[:-1], dtype=np.int8).astype(bool)
    line = w.block.data[mine]
    reach = np.cumsum(ends - starts)
    line[reach - 1] = 32
    raw = line.tobytes()
    before = np.concatenate(([0], np.cumsum(left)))[w.first]
    at = np.concatenate(([0], reach))[before].tolist()
    texts = [raw[a : max(a, b - 1)] for a, b in zip(at[:-1], at[1:])]
    total = np.diff(w.first)
    return pa.table(
        {
            "doc_id": pa.array(w.block.ids),
            "n_words": pa.array(total, pa.int64()),
            "n_removed": pa.array(total - np.diff(before), pa.int64()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
            "kept": pa.array(texts, pa.binary()).cast(pa.string()) if with_text else pa.nulls(len(texts), pa.string()),
        }
    )
