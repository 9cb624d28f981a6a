"""Near duplicates by SimHash and deletion-variant signatures.

Fingerprints at most ``k`` bits apart, cut into k // 2 + 1 segments, have one segment
that differs by at most one bit. Every segment is indexed as it is and with each of its
bits taken out. Equal segments meet under the first, segments one bit apart under the
variant without that bit, one having it 0 and the other 1: a pair meets once a segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm import ragged
from tagloom.llm.common import written
from tagloom.llm.components import components
from tagloom.session import broadcast_if, is_small

BITS = 64
SEED = 42


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _shingle_hashes(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of all shingles, and the first shingle of every text (one more at the end)."""
    import xxhash

    data = data + ((data >= 65) & (data <= 90)) * np.uint8(32)
    starts, ends, first = ragged.word_spans(data, offsets)
    # words once more, one space apart
    size = ends - starts + 1
    spaced = np.concatenate((data, [np.uint8(32)]))
    at = np.cumsum(size) - size
    line = ragged.gather(spaced, starts, size) if len(starts) else data[:0]
    if len(starts):
        line[at + size - 1] = 32
    words = np.diff(first)
    shingles = np.where(words >= n, words - n + 1, np.minimum(words, 1))
    edges = np.concatenate(([0], np.cumsum(shingles)))
    doc = np.repeat(np.arange(len(words)), shingles)
    low = first[:-1][doc] + np.arange(edges[-1]) - edges[doc]
    high = np.minimum(low + n, first[1:][doc]) - 1
    raw, digest = line.tobytes(), xxhash.xxh64_intdigest
    begin, end = at[low].tolist(), (at[high] + size[high] - 1).tolist()
    hashes = np.fromiter((digest(raw[a:b], SEED) for a, b in zip(begin, end)), np.uint64, len(begin))
    return hashes, edges


def _votes(hashes: np.ndarray, edges: np.ndarray, step: int = 1 << 18) -> np.ndarray:
    """Fingerprint of every text: a bit is set if over half its hashes set it."""
    n = len(edges) - 1
    votes = np.zeros((n, BITS), np.int64)
    for a in range(0, len(hashes), step):
        b = min(a + step, len(hashes))
        bits = np.unpackbits(hashes[a:b].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        low, high = np.searchsorted(edges, [a, b - 1], "right") - 1
        at = np.maximum(edges[low : high + 1], a) - a
        some = np.diff(np.concatenate((at, [b - a]))) > 0  # texts without shingles have no votes
        votes[low : high + 1][some] += np.add.reduceat(bits, at[some], axis=0, dtype=np.int64)
    out = np.packbits(2 * votes > np.diff(edges)[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(out).view("<i8").reshape(-1)


def fingerprints(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", shingle: int = 3, work_bytes: int = 4 << 20
) -> DataFrame:
    """(doc_id, fp) of every document; a text without words has 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in ragged.portions(batch, "text", work_bytes):
                fp = _votes(*_shingle_hashes(*ragged.joined(part["text"]), shingle))
                yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(fp)], names=["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def _segments(k: int) -> list[tuple[int, int]]:
    n = k // 2 + 1
    return [(BITS * i // n, BITS * (i + 1) // n) for i in range(n)]


def _span(low: int, high: int) -> int:
    return (1 << high) - (1 << low)


def _variants(fp: Column, k: int) -> Column:
    """Array of (slot, key, side): side 2 for the segment as it is, else the bit taken out."""
    rows = []
    for low, high in _segments(k):
        mask = _span(low, high)
        for p in [None, *range(low, high)] if k else [None]:
            slot = low * (BITS + 1) + (BITS if p is None else p)
            left = fp.bitwiseAND(F.lit(_signed(mask if p is None else mask & ~(1 << p))))
            side = F.lit(2) if p is None else F.shiftrightunsigned(fp, p).bitwiseAND(F.lit(1)).cast("int")
            rows.append(F.struct(F.lit(slot).alias("slot"), F.xxhash64(F.lit(slot), left).alias("key"), side.alias("side")))
    return F.array(*rows)


def _stars(hot: DataFrame, k: int) -> DataFrame:
    """Links within crowded keys, without pairs.

    Members of a key agree on its segment, but for the bit taken out. With every choice of
    the bits they may still differ in taken out as well, equal rests are at most ``k`` bits
    apart, all of them, so the least stands for each; and every pair within ``k`` bits has
    such a choice. A member costs as many rows as there are choices.
    """
    links = None
    for low, high in _segments(k):
        others = [p for p in range(BITS) if not low <= p < high]
        for exact in (True, False):
            masks = [_signed(~sum(1 << p for p in c) & (2**64 - 1)) for c in combinations(others, k if exact else k - 1)] if exact or k else []
            if not masks:
                continue
            inside = F.col("slot").between(low * (BITS + 1), low * (BITS + 1) + BITS)
            mine = hot.filter(inside & ((F.col("side") == 2) if exact else (F.col("side") < 2)))
            segment = _signed(~_span(low, high) & (2**64 - 1))
            rest = mine.select("key", "fp", F.explode(F.array(*[F.lit(m) for m in masks])).alias("mask")).select(
                "fp", F.xxhash64("key", "mask", F.col("fp").bitwiseAND(F.col("mask")).bitwiseAND(F.lit(segment))).alias("r")
            )
            hub = rest.groupBy("r").agg(F.min("fp").alias("hub"))
            some = rest.join(hub, "r").filter("fp <> hub").select(F.col("fp").alias("a"), F.col("hub").alias("b"))
            links = some if links is None else links.union(some)
    return links


def links(prints: DataFrame, *, max_distance: int = 2, crowded: int = 256) -> DataFrame:
    """Links (a, b) between different fingerprints at most ``max_distance`` bits apart.

    Every such pair is linked, directly or through others: keys of up to ``crowded``
    fingerprints join and verify their pairs, larger ones link through the least member
    of each finer key.
    """
    k = max_distance
    rows = prints.select("fp", F.explode(_variants(F.col("fp"), k)).alias("v")).select("fp", "v.slot", "v.key", "v.side")
    # counted in part before the shuffle, and few keys are shared: the rows then stay where they
    # are, or meet in a join that splits a crowded key
    counts = written(rows.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared-keys")
    sized = written(rows.join(broadcast_if(is_small(counts), counts), "key"), "shared-variants")
    few = sized.filter(F.col("n") <= crowded)
    ours = few.filter("side <> 1").select("key", "side", F.col("fp").alias("a"))
    theirs = few.filter("side <> 0").select("key", F.col("side").alias("_side"), F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= k
    met = (F.col("side") + F.col("_side") == 1) | ((F.col("side") == 2) & (F.col("_side") == 2) & (F.col("a") < F.col("b")))
    pairs = ours.join(theirs, "key").filter(near & met).select("a", "b")
    # a fingerprint counts once a key, and crowded keys are rare: mostly this stays empty
    crowd = sized.filter(F.col("n") > crowded).select("fp", "slot", "key", "side")
    return pairs.union(_stars(crowd, k)) if crowd.take(1) else pairs


def near_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    shingle: int = 3,
    max_distance: int = 2,
    crowded: int = 256,
) -> DataFrame:
    """id_col, fp, component_id: the least id among documents reachable over links.

    Texts are lower-cased in A-Z and cut into words at white space; shingles repeat as
    they occur, a shorter text is one shingle. Null and empty texts have fingerprint 0 and
    are linked like others. Repeated rows give repeated rows. A null id is never the least
    unless a component has no other. An empty table gives no rows; other columns are not read.
    """
    prints = written(fingerprints(docs, id_col=id_col, text=text, shingle=shingle), "fingerprints")
    first = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "different")
    found = written(links(first.select("fp"), max_distance=max_distance, crowded=crowded), "links")
    groups = written(components(found), "components")
    least = (
        groups.join(first, groups["node"] == first["fp"]).groupBy("root").agg(F.min("first").alias("least"))
    )
    named = groups.join(least, "root").select(F.col("node").alias("fp"), "least")
    classes = written(
        first.join(named, "fp", "left").select("fp", F.coalesce("least", "first").alias("component_id")), "classes"
    )
    return prints.join(classes, "fp").select(F.col("doc_id").alias(id_col), "fp", "component_id")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", by_row: bool = False, **options) -> DataFrame:
    """The documents without their near duplicates: of each component the least id stays.

    All columns are kept. Rows that repeat an id are one document, of which one row
    stays; rows without an id stay. With ``by_row`` rows without an id, and rows that repeat
    an id with different texts, are documents of their own; each component keeps a row of its
    least id, or one row without an id if it has no other.
    """
    found = written(near_duplicates(docs, id_col=id_col, **options).select(id_col, "component_id"), "near-duplicates")
    gone = found.filter(F.col(id_col) != F.col("component_id")).select(id_col)
    left = docs.join(broadcast_if(is_small(gone), gone.distinct()), id_col, "left_anti").select(*docs.columns)
    if found.groupBy(id_col).count().filter(F.col(id_col).isNull() | (F.col("count") > 1)).take(1):
        if by_row:
            return _row_of_each(docs, id_col, **options)
        named = left.filter(F.col(id_col).isNotNull()).dropDuplicates([id_col])
        left = named.unionByName(left.filter(F.col(id_col).isNull()))
    return left


def _row_of_each(docs: DataFrame, id_col: str, *, text: str = "text", **options) -> DataFrame:
    """``one_of_each`` of rows under a hash of id and text."""
    keyed = docs.withColumn("_od_key", F.xxhash64(id_col, text))
    found = near_duplicates(keyed, id_col="_od_key", text=text, **options).select("_od_key", "component_id").distinct()
    found = written(found, "near-duplicate-rows")
    # one of a group: the least id's row, a row without an id only where no other is
    rank = F.struct(F.col(id_col).isNull().alias("_none"), F.col(id_col).alias("_od_id"), "_od_key")
    least = keyed.select(rank.alias("_rank"), "_od_key").join(found, "_od_key").groupBy("component_id")
    least = least.agg(F.min("_rank").alias("_least")).select("_least._od_key")
    return keyed.join(least, "_od_key", "left_semi").dropDuplicates(["_od_key"]).select(*docs.columns)
