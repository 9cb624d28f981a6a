"""Best-fit packing with several permitted sequence lengths.

Best fit needs only how many pieces have each length. That histogram has at most as
many entries as the longest sequence has tokens, so the driver plans with it whatever
the corpus holds; Spark counts, ranks the pieces of a length and looks their place up.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import WORD, written
from tagloom.session import broadcast_if, small_table


def default_costs(capacities: tuple[int, ...]) -> dict[int, float]:
    """Tokens to be computed, and attention that grows with the square of a sequence."""
    return {c: c + c * c / (8 * max(capacities)) for c in capacities}


@dataclass
class Plan:
    """Slots: (length, first rank, last rank + 1, first bin, pieces a bin, offset in the bin).
    Bins: (first bin, last bin + 1, used, capacity). Both cover runs of like bins."""

    slots: list[tuple[int, int, int, int, int, int]] = field(default_factory=list)
    bins: list[tuple[int, int, int, int]] = field(default_factory=list)


def _fill(room: int, lengths: list[int], left: dict[int, int]) -> int:
    """Tokens that the longest remaining pieces put into one bin's room."""
    used, at = 0, len(lengths)
    while room > used and at:
        at = bisect_left(lengths, room - used + 1, 0, at)
        if at:
            at -= 1
            used += lengths[at] * min(left[lengths[at]], (room - used) // lengths[at])
    return used


def plan(histogram: dict[int, int], capacities: tuple[int, ...], costs: dict[int, float]) -> Plan:
    """Best-fit decreasing over a histogram of lengths.

    Longest pieces come first; each goes to the open bin with the least room that holds
    it, the lowest numbered among equals. A bin that took a piece has less room than any
    other that would hold the next one of that length, so like pieces fill bin after bin
    and runs of like bins are handled at once. Where no bin has room, one is opened of
    the size that costs least per token, once the remaining pieces have filled it.
    At the end every bin shrinks to the least size for its contents.
    """
    sizes = sorted(capacities)
    out, open_bins, rooms, count = Plan(), {}, [], 0  # room -> runs of bins with it
    lengths, left = sorted(histogram), dict(histogram)

    def least(used: int) -> int:
        return sizes[bisect_left(sizes, used)]

    def add(room: int, run: tuple[int, int, int]) -> None:
        if room not in open_bins:
            open_bins[room] = []
            insort(rooms, room)
        insort(open_bins[room], run)

    def put(length: int, rank: int, take: int, run: tuple[int, int, int], room: int) -> int:
        """Puts up to ``take`` pieces into a run of bins; returns how many it took."""
        first, last, size = run
        each = room // length
        full = min(last - first, take // each)
        if full:
            out.slots.append((length, rank, rank + full * each, first, each, size - room))
            add(room - each * length, (first, first + full, size))
        done, rest = full * each, take - full * each
        if rest and first + full < last:
            out.slots.append((length, rank + done, rank + done + rest, first + full, rest, size - room))
            add(room - rest * length, (first + full, first + full + 1, size))
            done, full = take, full + 1
        if first + full < last:
            add(room, (first + full, last, size))
        return done

    while lengths:
        length = lengths.pop()
        total, rank = left.pop(length), 0
        while rank < total:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                run = open_bins[room].pop(0)
                if not open_bins[room]:
                    del open_bins[room]
                    rooms.pop(at)
                rank += put(length, rank, total - rank, run, room)
                continue
            best = None
            for size in sizes[bisect_left(sizes, length) :]:
                each = min(size // length, total - rank)
                used = each * length + _fill(size - each * length, lengths, left)
                score = (costs[least(used)] / used, -size)
                if best is None or score < best[0]:
                    best = (score, size, each)
            _, size, each = best
            bins = max(1, (total - rank) // each)
            rank += put(length, rank, bins * each, (count, count + bins, size), size)
            count += bins
    for room in rooms:
        out.bins += [(a, b, size - room, least(size - room)) for a, b, size in open_bins[room]]
    out.bins.sort()
    return out


def placed(p: Plan) -> list[tuple[int, int, int, int, int, int, int, int]]:
    """Slots cut where the final bins change: slot fields, then used and capacity."""
    starts, rows = [b[0] for b in p.bins], []
    for length, low, high, first, each, offset in p.slots:
        last = first + (high - low) // each
        at = bisect_left(starts, first + 1) - 1
        while at < len(p.bins) and p.bins[at][0] < last:
            a, b, used, size = p.bins[at]
            a, b = max(a, first), min(b, last)
            rows.append((length, low + (a - first) * each, low + (b - first) * each, a, each, offset, used, size))
            at += 1
    return rows


def word_tokens(text: Column) -> Column:
    """Words of a text and one end token."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)) + 1


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    length: Column | None = None,
    capacities: tuple[int, ...] = (512, 1024, 2048, 4096),
    costs: dict[int, float] | None = None,
    buckets: int = 1024,
) -> DataFrame:
    """Where every piece of every document goes.

    Columns: id_col, piece, start (token of the document it begins at), n_tokens, bin_id,
    bin_offset, bin_used, bin_capacity. Documents longer than the largest capacity are
    cut into pieces of it and a rest; nothing is dropped. ``length`` is the number of
    tokens, by default the words of ``text`` and one; null or negative counts as 0, and
    such documents have no piece. Repeated rows are packed each; null ids are kept;
    an empty table gives no rows. Other columns are ignored.

    Pieces of one length are ranked within ``buckets`` hash buckets, whose counts are
    then added up, so that a length most documents share is spread like any other.
    """
    sizes = tuple(sorted(capacities))
    length = word_tokens(F.col("text")) if length is None else length
    most = sizes[-1]
    # rows without an id, or with one id, are dealt by their texts
    salt = F.xxhash64("text") if "text" in docs.columns else F.lit(0)
    n = F.greatest(F.coalesce(length.cast("long"), F.lit(0)), F.lit(0))
    cut = (
        docs.select(F.col(id_col).alias("_doc"), n.alias("_n"), salt.alias("_salt"))
        .filter("_n > 0")
        .select("_doc", "_n", "_salt", F.explode(F.sequence(F.lit(0), F.ceil(F.col("_n") / most) - 1)).alias("piece"))
        .select(
            "_doc",
            "piece",
            (F.col("piece") * most).alias("start"),
            F.least(F.col("_n") - F.col("piece") * most, F.lit(most)).cast("int").alias("n_tokens"),
            F.pmod(F.xxhash64("_doc", "_salt", "piece"), F.lit(buckets)).cast("int").alias("_bucket"),
        )
    )
    pieces = written(cut, "pieces")
    counts = written(pieces.groupBy("n_tokens", "_bucket").agg(F.count(F.lit(1)).alias("_count")), "piece-counts")
    histogram = {r[0]: r[1] for r in counts.groupBy("n_tokens").agg(F.sum("_count")).collect()}  # at most ``most`` rows
    planned = placed(plan(histogram, sizes, costs or default_costs(sizes)))
    names = ("_length", "_low", "_high", "_first", "_each", "_offset", "bin_used", "bin_capacity")
    kinds = ("int", "long", "long", "long", "long", "int", "int", "int")
    slots = small_table(docs.sparkSession, planned, ", ".join(f"{a} {k}" for a, k in zip(names, kinds)))
    before = Window.partitionBy("n_tokens").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("n_tokens", "_bucket", F.coalesce(F.sum("_count").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("n_tokens", "_bucket").orderBy("_doc", "piece")
    ranked = pieces.withColumn("_row", F.row_number().over(within)).join(base, ["n_tokens", "_bucket"])
    rank = F.col("_rank")
    return (
        ranked.withColumn("_rank", F.col("_base") + F.col("_row") - 1)
        .join(
            # its size follows the permitted lengths, not the corpus
            broadcast_if(True, slots),
            (F.col("n_tokens") == F.col("_length")) & (rank >= F.col("_low")) & (rank < F.col("_high")),
        )
        .withColumn("_in", rank - F.col("_low"))
        .select(
            F.col("_doc").alias(id_col),
            "piece",
            "start",
            "n_tokens",
            (F.col("_first") + F.floor(F.col("_in") / F.col("_each"))).alias("bin_id"),
            (F.col("_offset") + F.pmod("_in", "_each") * F.col("n_tokens")).cast("int").alias("bin_offset"),
            "bin_used",
            "bin_capacity",
        )
    )
