"""Repair of the structure of conversations by the cheapest edits.

A sound conversation is empty, or an optional system turn and then pairs of a user's and
an assistant's turn. Turns are kept, given another role, deleted or inserted; a dynamic
program over the turns and four states (nothing yet, after system, user, assistant) finds
the least cost, and of the cheapest edits those whose initials come first in ASCII.

The costs are made backward, from the last turn. Only every r-th vector of four costs is
stored, r about the square root of the number of turns; walking forward, a block's vectors
are made again from the one stored at its end. A conversation so takes a byte a turn and
some r vectors, however long it is. Turns come to it sorted by Spark, one after another,
and texts pass through once more, behind the edits, without being held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COSTS = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
ROLES = {"u": "user", "a": "assistant"}
# the state behind a turn of each initial, and what a turn may be in each state
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
# what can be inserted, or made of a turn, in each state: one role, and the state behind it
TURN = (("u", USER), ("u", USER), ("a", ASSISTANT), ("u", USER))
INITIALS = "sua"
# a turn as one byte: its initial's place in INITIALS (3 for any other) times 4, plus its fault
BLANK, DUPLICATE, TRUNCATED = 1, 2, 3
COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
BATCH = 4096
Vector = tuple[int, int, int, int]


def _closed(costs: list[int]) -> Vector:
    """Least costs once turns may be inserted before what comes."""
    start, system, user, assistant = costs
    step = COSTS[INSERT]
    user, assistant = min(user, step + assistant), min(assistant, step + user)
    return min(start, step + user), min(system, step + user), user, assistant


END: Vector = _closed([0, 1 << 60, 1 << 60, 0])


def _options(code: int, state: int) -> Iterator[tuple[str, int, int]]:
    """Edits of a turn in a state: initial, cost, state behind it."""
    initial, fault = (INITIALS + "?")[code >> 2], code & 3
    yield DELETE, COSTS[DELETE], state
    if fault in (BLANK, DUPLICATE):
        return
    extra = TRUNCATED_COST if fault == TRUNCATED else 0
    if initial in NEXT[state]:
        yield KEEP, COSTS[KEEP] + extra, NEXT[state][initial]
    yield REROLE, COSTS[REROLE] + extra, TURN[state][1]


OPTIONS = [[sorted(_options(code, state)) for state in range(4)] for code in range(16)]


def _before(code: int, after: Vector) -> Vector:
    """Least costs before a turn, from those behind it."""
    return _closed([min(cost + after[to] for _, cost, to in OPTIONS[code][state]) for state in range(4)])


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """Cost and initials of the cheapest edits, of several the least in ASCII."""
    n = len(codes)
    r = max(1, isqrt(n))
    stored, now = {n: END}, END
    for i in range(n - 1, -1, -1):
        now = _before(codes[i], now)
        if i % r == 0:
            stored[i] = now
    audit, state = [], START
    for a in range(0, n, r):
        b = min(a + r, n)
        block = [stored[b]]
        for i in range(b - 1, a, -1):
            block.append(_before(codes[i], block[-1]))
        block.append(stored[a])
        for i in range(a, b):
            here, after = block[b - i], block[b - i - 1]
            while True:
                edits = ((e, to) for e, cost, to in OPTIONS[codes[i]][state] if cost + after[to] == here[state])
                edit, to = min(edits, default=(REROLE, state))
                # an insertion that costs no more comes before keeping, behind deleting
                if edit != DELETE and COSTS[INSERT] + here[TURN[state][1]] == here[state]:
                    audit.append(INSERT)
                    state = TURN[state][1]
                    continue
                audit.append(edit)
                state = to
                break
    while state in (SYSTEM, USER):
        audit.append(INSERT)
        state = TURN[state][1]
    return stored[0][START] if n else END[START], "".join(audit)


def _turns(turns: DataFrame, conv: str, turn: str, role: str, text: str, weight: str | None) -> DataFrame:
    """Turns with nulls as one space, a key for their role and text, and faults of their own."""
    rows = turns.select(
        F.col(conv).alias("_conv"),
        F.col(turn).alias("_turn"),
        F.coalesce(F.col(role), F.lit(" ")).alias("_role"),
        F.coalesce(F.col(text), F.lit(" ")).alias("_text"),
        (F.col(weight) if weight else F.lit(1)).cast("long").alias("_n"),
    )
    last = F.regexp_extract("_text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    return rows.withColumns(
        {
            # the length tells where the role ends
            "_key": F.sha2(F.concat(F.length("_role").cast("string"), F.lit(":"), "_role", "_text"), 256),
            "_fault": F.when(last == "", BLANK).when(~last.isin(".", "!", "?"), TRUNCATED).otherwise(0),
        }
    )


class Numbers:
    """Of sorted turn numbers the least, the greatest and how many there are."""

    def __init__(self) -> None:
        self.least = self.greatest = None
        self.different = 0

    def add(self, number: int | None) -> None:
        if number is not None and number != self.greatest:
            self.least = number if self.least is None else self.least
            self.greatest = number
            self.different += 1

    def gaps(self) -> int:
        return self.greatest - self.least + 1 - self.different if self.different else 0


def _found(codes: bytearray) -> tuple:
    """Blank, duplicate, truncated and illegal turns, cost and edits of a conversation."""
    faults, illegal, last = [0, 0, 0, 0], 0, None
    for code in codes:
        faults[code & 3] += 1
        illegal += last is not None and (last, code >> 2) not in ((0, 1), (1, 2), (2, 1))
        last = code >> 2
    return (*faults[1:], illegal, *cheapest_edits(bytes(codes)))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows))
    rows.clear()
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _repaired_role(edit: str, role: str, state: int) -> str:
    return role if edit == KEEP else ROLES[TURN[state][0]]




def audits(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", weight: str | None = None) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit."""
    rows = _turns(turns, conv, turn, role, text, weight)
    return _audits(rows).withColumnRenamed("_conv", conv)


def _audits(rows: DataFrame) -> DataFrame:
    # equal turns of one number become one row with their count, before they are sent
    same = (
        rows.withColumn("_gone", F.col("_n") <= 0)
        .select(
            "_conv",
            "_gone",
            *[F.when(~F.col("_gone"), F.col(c)).alias(c) for c in ("_turn", "_key", "_fault")],
            F.when(~F.col("_gone"), F.col("_role")).alias("_role"),
            F.greatest("_n", F.lit(0)).alias("_n"),
        )
        .groupBy("_conv", "_gone", "_turn", "_role", "_key", "_fault")
        .agg(F.sum("_n").alias("_n"))
    )
    # a role and text is first seen in its least turn: it needs no row of another conversation
    first = same.filter("NOT _gone").groupBy("_conv", "_key").agg(
        F.min(F.struct(F.col("_turn").isNotNull().alias("known"), F.col("_turn").alias("turn"))).alias("first"),
        F.count(F.lit(1)).alias("places"),
    )
    again = first.filter("places > 1").select(F.col("_conv").alias("_c"), F.col("_key").alias("_k"), F.col("first.turn").alias("_first"))
    coded = same.join(again, F.col("_conv").eqNullSafe(F.col("_c")) & (F.col("_key") == F.col("_k")), "left").select(
        "_conv",
        "_turn",
        "_role",
        "_key",
        "_n",
        F.when((F.col("_fault") != BLANK) & F.col("_k").isNotNull() & ~F.col("_turn").eqNullSafe(F.col("_first")), DUPLICATE)
        .otherwise(F.col("_fault"))
        .alias("_fault"),
    )
    order = ["_conv", F.col("_turn").asc_nulls_first(), "_role", "_key"]
    ddl = f"_conv {rows.schema['_conv'].dataType.simpleString()}, {COUNTS}"
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        codes, numbers, current = bytearray(), Numbers(), None
        for batch in batches:
            for conv, number, name, n, fault in zip(*[batch[c].to_pylist() for c in ("_conv", "_turn", "_role", "_n", "_fault")]):
                if current is None or current[0] != conv:
                    if current is not None:
                        out.append((current[0], numbers.gaps(), *_found(codes)))
                    codes, numbers, current = bytearray(), Numbers(), (conv,)
                if n:
                    numbers.add(number)
                    place = INITIALS.find(name[:1]) if name else -1
                    kind = (3 if place < 0 else place) << 2
                    codes.append(kind | fault)
                    # equal turns behind the first are blank like it, or its duplicates
                    codes.extend(bytes([kind | (BLANK if fault == BLANK else DUPLICATE)]) * (n - 1))
            if len(out) >= BATCH:
                yield _table(out, schema)
        if current is not None:
            out.append((current[0], numbers.gaps(), *_found(codes)))
        if out:
            yield _table(out, schema)

    return coded.repartition("_conv").sortWithinPartitions(*order).mapInArrow(run, ddl)


def _beside(rows: DataFrame, edits: DataFrame) -> DataFrame:
    """Every conversation's edits, and behind them its turns in order, in one partition."""
    turn = rows.schema["_turn"].dataType
    nothing = F.lit(None)
    heads = edits.select(
        "_conv", F.lit(0).alias("_seq"), nothing.cast(turn).alias("_turn"), nothing.cast("string").alias("_role"),
        nothing.cast("string").alias("_key"), F.lit(0).cast("long").alias("_n"), F.col("audit").alias("_text"),
        F.struct("gaps", "blank", "duplicate", "truncated", "illegal", "cost").alias("_found"),
    )
    body = rows.filter("_n > 0").select(
        "_conv", F.lit(1).alias("_seq"), "_turn", "_role", "_key", "_n",
        F.when(F.col("_fault") != BLANK, F.col("_text")).alias("_text"), nothing.cast(heads.schema["_found"].dataType).alias("_found"),
    )
    return heads.unionByName(body).repartition("_conv").sortWithinPartitions(
        "_conv", "_seq", F.col("_turn").asc_nulls_first(), "_role", "_key"
    )


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conversation, its findings or None, edit, role, text): a row with findings and the
    edits as its text opens a conversation, one for every turn that stays or comes follows."""
    audit, at, state, current = "", 0, START, None

    def inserted() -> Iterator[tuple]:
        nonlocal at, state
        while at < len(audit) and audit[at] == INSERT:
            initial, state = TURN[state]
            at += 1
            yield current, None, INSERT, ROLES[initial], ""

    for batch in batches:
        for conv, seq, role, n, text, found in zip(*[batch[c].to_pylist() for c in ("_conv", "_seq", "_role", "_n", "_text", "_found")]):
            if seq == 0:
                yield from inserted()
                audit, at, state, current = text, 0, START, conv
                yield conv, found, "", "", text
                continue
            for _ in range(n):
                yield from inserted()
                edit = audit[at]
                at += 1
                if edit == DELETE:
                    continue
                name = _repaired_role(edit, role, state)
                state = NEXT[state][role[:1]] if edit == KEEP else TURN[state][1]
                yield current, None, edit, name, text
    yield from inserted()


def repair(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", weight: str | None = None) -> DataFrame:
    """One row per conversation: conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns stand by number, null first; turns of one number by role, then by the digest of
    role and text. Equal turns of one number are duplicates of the first. ``weight`` names a
    column that says how often a row counts; a conversation whose rows count nothing has
    zeros, no edits and the digest of no text. Null roles and texts are one space; rows
    without a conversation form one of their own. Roles are known by their first letter, an
    unknown or empty one has to be replaced or deleted. An empty table gives no rows; other
    columns are ignored. A conversation is one result row by definition: its turns pass one
    task in order, as codes and then as texts, but are never held there as a whole.
    """
    rows = _turns(turns, conv, turn, role, text, weight)
    mixed = _beside(rows, _audits(rows))
    ddl = f"_conv {rows.schema['_conv'].dataType.simpleString()}, {COUNTS}, repaired_sha256 string"
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        head, digest, between = None, hashlib.sha256(), ""
        for conv, found, _, name, body in _walk(batches):
            if found is None:
                digest.update(f"{between}{name}:{body}".encode())
                between = "\n"
                continue
            if head is not None:
                out.append((*head, digest.hexdigest()))
                if len(out) >= BATCH:
                    yield _table(out, schema)
            head, digest, between = (conv, *found.values(), body), hashlib.sha256(), ""
        if head is not None:
            out.append((*head, digest.hexdigest()))
        if out:
            yield _table(out, schema)

    return mixed.mapInArrow(run, ddl).withColumnRenamed("_conv", conv)


def repaired_turns(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", weight: str | None = None) -> DataFrame:
    """The repaired conversations turn by turn: conv, position, role, text, edit (K, R or I).

    Rows and cases as in ``repair``; positions count from 0.
    """
    rows = _turns(turns, conv, turn, role, text, weight)
    mixed = _beside(rows, _audits(rows))
    ddl = f"_conv {rows.schema['_conv'].dataType.simpleString()}, position long, role string, text string, edit string"
    schema = to_arrow_schema(T.StructType.fromDDL(ddl))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        position = size = 0
        for conv, found, edit, name, body in _walk(batches):
            if found is not None:
                position = 0
                continue
            out.append((conv, position, name, body, edit))
            position, size = position + 1, size + len(body)
            if size > 1 << 20 or len(out) >= BATCH:
                yield _table(out, schema)
                size = 0
        if out:
            yield _table(out, schema)

    return mixed.mapInArrow(run, ddl).withColumnRenamed("_conv", conv)


def damaged(turns: DataFrame, *, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with faults put in by a hash of conversation and number, and a column ``weight``.

    Of crc32 of ``conv:turn`` modulo 20, 0 drops a row (weight 0), 1 empties its text, 2 takes
    its full stops, exclamation and question marks, 3 repeats it (weight 2), 4 gives it to the
    user. Null numbers, roles and texts read as one space.
    """

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(shown(conv), F.lit(":"), shown(turn))) % 20
    return turns.select(
        F.col(conv),
        F.col(turn),
        F.when(kind == 4, "user").otherwise(shown(role)).alias(role),
        F.when(kind == 1, "").when(kind == 2, F.translate(shown(text), ".!?", "")).otherwise(shown(text)).alias(text),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).cast("long").alias("weight"),
    )
