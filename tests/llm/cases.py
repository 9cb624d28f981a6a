"""Documents that try the operators: nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars int, h long, fp long, line string, block int, "
    "key string, score double, removed int, first string, bin int, n int, word string, _id int"
)
EXTRA = (7, 8, "x", 9, "k", 0.5, 1, "f", 2, 3, "w", 4)
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau".split()


def prose(rng: random.Random, words: int, per_line: int = 12) -> str:
    out = [rng.choice(WORDS) + str(rng.randrange(30)) for _ in range(words)]
    return "\n".join(" ".join(out[i : i + per_line]) for i in range(0, words, per_line))


def texts() -> list[tuple[int | None, str | None]]:
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(1, 120)) for _ in range(25)]
    rows: list[tuple[int | None, str | None]] = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 7]) for i in range(20)]  # copies
    rows += [(200 + i, base[i] + "\n" + base[i + 1]) for i in range(6)]  # shared passages
    rows += [(300 + i, base[i].replace("alpha", "alphA", 1) + "!") for i in range(8)]
    rows += [(400, None), (401, ""), (402, " \t\n\x0b\x0c\r "), (403, "one"), (404, "one two"), (405, "é è 你好 \U0001f600")]
    rows += [(406, " ".join(["spam"] * 300)), (407, prose(rng, 6000)), (408, "a" * 5000), (409, "\n" * 50)]
    rows += [(0, base[0]), (0, base[0]), (3, base[4]), (None, base[2]), (None, None), (None, "no id at all " * 12)]
    return rows


def frame(spark, rows=None):
    rows = texts() if rows is None else rows
    langs = ("en", None, "fr")
    full = [(d, t, langs[i % 3], "hot" if i % 2 else None, len(t or ""), *EXTRA) for i, (d, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def unique_ids() -> list[tuple[int, str]]:
    """The rows with an id, each id once."""
    seen: dict[int, str] = {}
    for d, t in texts():
        if d is not None and d not in seen:
            seen[d] = t or ""
    return sorted(seen.items())


def even_and_odd() -> tuple[str, str]:
    """The letter a where a place has an even number of one bits, else b, and the other way
    round: sums of powers modulo 2 ** 64 can't tell these two apart."""
    even = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    return even, even.translate(str.maketrans("ab", "ba"))
