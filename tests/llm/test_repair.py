import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest

from tagloom.llm import repair
from tagloom.llm.queries import op12_conversation_repair

SF = "/root/testdata/sf0.001"
COST = {"K": 0, "R": 2, "D": 3, "I": 2}


def every_repair(turns):
    """(cost, audit, initials) of all ways to edit some (initial, fault) turns, up to two insertions a place."""
    gaps = [""] + ["u", "a"] + ["uu", "ua", "au", "aa"]
    choices = []
    for initial, fault in turns:
        own = [("D", "", 3)]
        if fault not in (1, 2):
            own += [(e, r, COST[e] + (fault == 3)) for e, r in (("K", initial), ("R", "u"), ("R", "a"))]
        choices.append(own)
    for edits in itertools.product(*choices):
        for inserts in itertools.product(gaps, repeat=len(turns) + 1):
            audit = initials = ""
            for g, e in itertools.zip_longest(inserts, edits):
                audit, initials = audit + "I" * len(g), initials + g
                if e:
                    audit, initials = audit + e[0], initials + e[1]
            if re.fullmatch("(s?(ua)+)?", initials):
                yield sum(e[2] for e in edits) + 2 * sum(map(len, inserts)), audit


def best(turns):
    """The same by a memo over turns and initials so far."""
    n = len(turns)
    follows = {"": "su", "s": "u", "u": "a", "a": "u"}

    @cache
    def least(i, last, inserted):
        found = []
        if i == n and last in ("", "a"):
            found.append((0, ""))
        if inserted < 3:
            for r in "ua":
                if r in follows[last]:
                    c, a = least(i, r, inserted + 1)
                    found.append((c + 2, "I" + a))
        if i < n:
            initial, fault = turns[i]
            c, a = least(i + 1, last, 0)
            found.append((c + 3, "D" + a))
            if fault not in (1, 2):
                for e, r in (("K", initial), ("R", "u"), ("R", "a")):
                    if r and r in follows[last]:
                        c, a = least(i + 1, r, 0)
                        found.append((c + COST[e] + (fault == 3), e + a))
        return min(found, default=(1 << 60, ""))

    for i in range(n, 0, -1):  # from the end, so that no call goes deep
        for last in follows:
            least(i, last, 0)
    return least(0, "", 0)


def codes(turns):
    return bytes(("sua".find(i) if i in "sua" else 3) << 2 | f for i, f in turns)


def test_against_every_repair():
    kinds = [(i, f) for i in "sua?" for f in range(4)]
    assert repair.cheapest_edits(b"") == (0, "")
    for n in (1, 2):
        for turns in itertools.product(kinds, repeat=n):
            want = min(every_repair(turns))
            assert repair.cheapest_edits(codes(turns)) == want == best(turns), turns


def test_long_conversations_against_a_memo():
    rng = random.Random(3)
    kinds = [(i, f) for i in "suaua?" for f in (0, 0, 0, 1, 2, 3)]
    for n in [*range(3, 60), 99, 100, 101, 240]:
        for _ in range(5):
            turns = tuple(rng.choice(kinds) for _ in range(n))
            assert repair.cheapest_edits(codes(turns)) == best(turns), turns


def brute(rows):
    """What the contract says of (conv, turn, role, text) rows, by conversation."""
    damaged = {}
    for conv, turn, role, text in rows:
        out = damaged.setdefault(conv, [])
        shown = [" " if v is None else str(v) for v in (conv, turn)]
        kind = zlib.crc32(":".join(shown).encode()) % 20
        role, text = (" " if v is None else v for v in (role, text))
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for conv, turns in damaged.items():
        digest = lambda t: hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], digest(t)))
        seen, coded = set(), []
        for _, role, text in turns:
            inner = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = 1 if not inner else 2 if (role, text) in seen else 0 if inner[-1] in ".!?" else 3
            seen.add((role, text))
            coded.append((role[:1] if role[:1] in ("s", "u", "a") else "?", fault))
        cost, audit = best(tuple(coded))
        numbers = {t[0] for t in turns} - {None}
        lines, last, at = [], "", 0
        for e in audit:
            role = {"": "user", "s": "user", "u": "assistant", "a": "user"}[last]
            if e == "I":
                lines.append(f"{role}:")
            else:
                if e == "D":
                    at += 1
                    continue
                role = turns[at][1] if e == "K" else role
                lines.append(f"{role}:{turns[at][2]}")
                at += 1
            last = role[:1]
        faults = [f for _, f in coded]
        legal = [("s", "u"), ("u", "a"), ("a", "u")]
        yield (
            conv,
            max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0,
            *[faults.count(f) for f in (1, 2, 3)],
            sum((a[0], b[0]) not in legal for a, b in zip(coded, coded[1:])),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        ), lines


def hostile():
    rng = random.Random(8)
    rows = []
    for conv in range(150):
        for turn in range(rng.randrange(1, 9)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = rng.choice(["Yes.", "No!", "Why?", "cut", "", " \t\n", None, "é 你好。", "Ok. \n", "Yes."])
            rows.append((conv, rng.choice([turn, turn, turn, None, -turn]), role, text))
    rows += [(500, t, ("user", "assistant")[t % 2], f"turn {t}." + "." * (t % 3)) for t in range(700)]
    rows += [(501, 3, "user", "Same.")] * 40 + [(502, None, None, None)] * 3 + [(503, None, "user", "Hm.")]
    rows += [(None, t, ("user", "assistant")[t % 2], f"no id {t}.") for t in range(6)]
    rows += [(504, 1, "user", "long " * 60000 + ".")] + rows[:5]
    return rows


def frame(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.selectExpr("*", "1 AS _turn", "'x' AS _key", "2 AS cost", "3 AS audit", "4 AS _n").repartition(5)


def plain(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_hostile_conversations(spark):
    turns = repair.damaged(frame(spark, hostile()))
    want = list(brute(hostile()))
    assert plain(repair.repair(turns, weight="weight")) == sorted((w for w, _ in want), key=repr)
    assert plain(repair.audits(turns, weight="weight")) == sorted((w[:-1] for w, _ in want), key=repr)
    back = {}
    for r in repair.repaired_turns(turns, weight="weight").orderBy("conv_id", "position").collect():
        back.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        assert r.position == len(back[r.conv_id]) - 1 and r.edit in "KRI"
    assert back == {w[0]: lines for w, lines in want if lines}
    assert repair.repair(turns.limit(0), weight="weight").collect() == []
    assert repair.repaired_turns(turns.limit(0)).collect() == []


def test_all_rows_dropped(spark):
    gone = next(t for t in range(1000) if zlib.crc32(f"9:{t}".encode()) % 20 == 0)
    out = repair.repair(repair.damaged(frame(spark, [(9, gone, "user", "Hi.")])), weight="weight").collect()
    assert list(map(tuple, out)) == [(9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@pytest.mark.parametrize("sf", [SF, "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert plain(op12_conversation_repair(spark, sf)) == sorted((w for w, _ in brute(rows)), key=repr)
