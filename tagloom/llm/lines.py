"""Line dedup by a segment-partition edit join, in DataFrame operations alone.

Two lines at most ``t`` edits apart, one of them cut into t + 1 segments, have a segment
in common: as a substring of the other, at a place that moved by few characters. So the
segments of every line are indexed with the line's length, every line probes the indexes
of its own length and the ``t`` below with the substrings that could match, and the
candidates are verified. Most lines share no key with another, so the keys of all lines
first tell which do, and only those are joined.

Lines made from one template share a segment without being near. Keys that many lines
index are not joined: their lines are cut finer, and as t edits hit at most t of the
pieces, all the others together make the key.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import combinations, product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import written
from tagloom.session import broadcast_if, is_small

# A line that more than one in so many lines equals is common; there are fewer than that.
COMMON_SHARE = 10_000
CLASSES = 15
# Lines, by hash, that go along with every task: some 10 MB
SUSPECTS = 1_000_000
# A key that more lines index is taken apart into finer ones.
CROWDED = 256
# So many pieces more than edits are cut then, beyond the one that is always left.
FINER = 6
STEPS = [1 << i for i in range(20, -1, -1)]


def _lines(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(doc_id, row, line_no, line, h) of every line that has a word; ``row`` tells rows of one id apart by their text."""
    cut = F.split(F.coalesce(F.col(text).cast("string"), F.lit("")), "\n")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("row"), F.posexplode_outer(cut).alias("line_no", "line"))
    return rows.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]")).withColumn("h", F.xxhash64("line"))


def _segment(n: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Begin and length of segment i of a line of n characters; the last ones are longer by one."""
    size, more = F.floor(n / parts), n % parts
    start = size * i + F.greatest(F.lit(0), more - (parts - i))
    return start.cast("int"), (size + (F.lit(parts - i) <= more).cast("int")).cast("int")


def _indexed(t: int) -> Column:
    """Keys of a line's own segments."""
    n, keys = F.col("n"), []
    for i in range(t + 1):
        start, size = _segment(n, i, t + 1)
        keys.append(F.xxhash64(n, F.lit(i), F.substring(F.col("line"), start + 1, size)))
    return F.array(*keys)


def _probes(t: int) -> Column:
    """Keys of the substrings that can match a segment of a line as long or up to t shorter.

    Before segment i at most i edits fell, behind it at most t - i: that bounds how far
    a match moved, from the left and from the right.
    """
    n, keys = F.col("n"), []
    for shorter in range(t + 1):
        length = n - shorter
        for i in range(t + 1):
            start, size = _segment(length, i, t + 1)
            for moved in range(-i, i + 1):
                if abs(moved - shorter) <= t - i:
                    keys.append(F.xxhash64(length, F.lit(i), F.substring(F.col("line"), start + moved + 1, size)))
    return F.array(*keys)


def _blocks(t: int, probing: bool) -> list[dict]:
    """Per choice of t pieces to leave out, and per way the lines' lengths may run apart in
    them: the runs of pieces between, each with how far it moved.

    An insertion counts for the piece before it (at the very beginning for the first), so
    nothing moves inside a run.
    """
    parts, rows = t + 1 + FINER, []
    ways = [w for w in product(range(-t, t + 1), repeat=t) if sum(map(abs, w)) <= t and sum(w) >= 0]
    for number, out in enumerate(combinations(range(parts), t)):
        seen = set()
        for way in ways if probing else [(0,) * t]:
            edges, moved, runs = [-1, *out, parts], 0, []
            for i, (low, high) in enumerate(zip(edges, edges[1:])):
                moved += way[i - 1] if i else 0
                if low + 1 < high:
                    runs.append((low + 1, high, moved))
            if (tuple(runs), sum(way)) not in seen:
                seen.add((tuple(runs), sum(way)))
                rows.append({"c": number, "shorter": sum(way), "runs": [dict(zip("abm", r)) for r in runs]})
    return rows


def _finer(texts: DataFrame, t: int, probing: bool) -> DataFrame:
    """(key, h, bag): the finer keys of a line, or those of the lines as long or up to t shorter that it may be near to."""
    parts = t + 1 + FINER
    kind = "array<struct<c:int,shorter:int,runs:array<struct<a:int,b:int,m:int>>>>"
    rows = texts.select("h", "bag", "n", "line", F.explode(F.from_json(F.lit(json.dumps(_blocks(t, probing))), kind)).alias("_c"))
    length = F.col("n") - F.col("_c.shorter")

    def begin(i: Column) -> Column:
        return (F.floor(length / parts) * i + F.greatest(F.lit(0), length % parts - (parts - i))).cast("int")

    def run(r: Column) -> Column:
        return F.substring(F.col("line"), begin(r["a"]) + r["m"] + 1, begin(r["b"]) - begin(r["a"]))

    return rows.select(F.xxhash64(length, "_c.c", F.transform("_c.runs", run)).alias("key"), "h", "bag")


def _candidates(texts: DataFrame, t: int, crowded: int) -> DataFrame:
    """Pairs (x, y) of line hashes that share a key and about their characters; every pair within t edits is among them."""

    def met(index: DataFrame, probe: DataFrame) -> DataFrame:
        index = index.select("key", F.col("h").alias("a"), F.col("bag").alias("_l"))
        probe = probe.select("key", F.col("h").alias("b"), F.col("bag").alias("_r"))
        found = probe.join(index, "key").filter((F.col("a") != F.col("b")) & _alike(F.col("_l"), F.col("_r"), t))
        return found.select(F.least("a", "b").alias("x"), F.greatest("a", "b").alias("y"))

    index = texts.select(F.explode(_indexed(t)).alias("key"), "h", "bag")
    probe = texts.select(F.explode(_probes(t)).alias("key"), "h", "bag")
    sizes = index.groupBy("key").agg(F.count(F.lit(1)).alias("_n"))
    full = written(sizes.filter(F.col("_n") > crowded).select("key"), "line-crowded")
    if t == 0 or not full.take(1):
        return met(index, probe).distinct()
    hint = broadcast_if(is_small(full), full)

    def inside(keys: DataFrame) -> DataFrame:
        mine = written(keys.join(hint, "key", "left_semi").select("h").distinct(), "line-crowds")
        return texts.join(broadcast_if(is_small(mine, SUSPECTS), mine), "h", "left_semi")

    finer = met(_finer(inside(index), t, False), _finer(inside(probe), t, True))
    return met(index.join(hint, "key", "left_anti"), probe).union(finer).distinct()


def _bag(line: Column) -> Column:
    """How often characters of each of some classes occur, modulo 16, in 4 bits each."""
    units = F.array(*[F.lit(1 << 4 * i).cast("long") for i in range(CLASSES)])
    mask = F.lit((1 << 4 * CLASSES) - 1)
    return F.aggregate(
        F.split(line, ""),
        F.lit(0).cast("long"),
        lambda s, c: (s + F.get(units, F.ascii(c) % CLASSES)).bitwiseAND(mask),
    )


def _alike(a: Column, b: Column, t: int) -> Column:
    """An edit changes the counts of two classes by one at most."""
    middle, mask = F.lit(sum(8 << 4 * i for i in range(CLASSES))), F.lit((1 << 4 * CLASSES) - 1)
    apart = (a - b + middle).bitwiseAND(mask)  # each difference, plus 8
    nibbles = [F.shiftrightunsigned(apart, 4 * i).bitwiseAND(F.lit(15)) for i in range(CLASSES)]
    return reduce(lambda x, y: x + y, [F.abs(d - 8) for d in nibbles]) <= 2 * t


def _same_ends(df: DataFrame) -> DataFrame:
    """``a`` and ``b`` without the beginning and end they share, found by halving steps."""
    room = F.least(F.length("a"), F.length("b"))

    def most(equal, limit: Column) -> Column:
        return F.aggregate(
            F.array(*[F.lit(s) for s in STEPS]),
            F.lit(0),
            lambda n, s: F.when((n + s <= limit) & equal(n + s), n + s).otherwise(n),
        )

    head = most(lambda n: F.substring(F.col("a"), F.lit(1), n) == F.substring(F.col("b"), F.lit(1), n), room)
    df = df.withColumn("_head", head)

    def tail(x: str, n: Column) -> Column:
        return F.substring(F.col(x), F.length(x) - n + 1, n)

    df = df.withColumn("_tail", most(lambda n: tail("a", n) == tail("b", n), room - F.col("_head")))
    cut = {
        x: F.substring(F.col(x), F.col("_head") + 1, F.length(x) - F.col("_head") - F.col("_tail")) for x in ("a", "b")
    }
    return df.withColumns({f"_{x}": F.when(F.length(c) > 0, F.split(c, "")).otherwise(F.array().cast("array<string>")) for x, c in cut.items()})


def edits(df: DataFrame, t: int) -> DataFrame:
    """Adds ``edits``: the edit distance of the strings ``a`` and ``b`` if it is at most ``t``, else a larger number.

    Columns of the distance table are words of 2t + 1 bits around the main diagonal: where
    a value is one more or less than the one above. Each character of ``b`` turns one word
    into the next with an addition and some logic; the distance is counted along the
    diagonal that ends in the last cell.
    """
    band, mask = 2 * t + 1, (1 << (2 * t + 1)) - 1
    m, n = F.size("_a"), F.size("_b")

    def matches(c: Column, j: Column) -> Column:
        bits = [
            F.when(F.coalesce(F.get("_a", j - t + k) == c, F.lit(False)), F.lit(1 << k)).otherwise(0) for k in range(band)
        ]
        return reduce(lambda x, y: x.bitwiseOR(y), bits)

    df = _same_ends(df).withColumn("_eq", F.transform("_b", matches)).withColumn("_d", m - n)
    state = "up int, down int, score int, j int"
    start = F.struct(
        F.lit(mask & ~((1 << t) - 1)).alias("up"), F.lit(0).alias("down"), F.abs("_d").alias("score"), F.lit(0).alias("j")
    ).cast(f"struct<{state.replace(' ', ':').replace(',:', ',')}>")

    def let(value: Column, use) -> Column:
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def step(s: Column, eq: Column) -> Column:
        up, down, j = s["up"], s["down"], s["j"] + 1
        still = ((eq.bitwiseAND(up) + up).bitwiseXOR(up)).bitwiseOR(eq).bitwiseOR(down).bitwiseAND(F.lit(mask))

        def onward(d: Column) -> Column:
            right = down.bitwiseOR((d.bitwiseOR(up)).bitwiseXOR(F.lit(mask)))
            left = d.bitwiseAND(up)
            lower = F.shiftright(d, 1)
            hit = F.floor(d / F.expr(f"CAST(pow(2, {t} + _d) AS INT)")).cast("int") % 2
            return F.struct(
                left.bitwiseOR(lower.bitwiseOR(right).bitwiseXOR(F.lit(mask))).alias("up"),
                lower.bitwiseAND(right).alias("down"),
                (s["score"] + F.when(j > -F.col("_d"), 1 - hit).otherwise(0)).cast("int").alias("score"),
                j.cast("int").alias("j"),
            )

        return let(still, onward)

    counted = F.aggregate("_eq", start, step, lambda s: s["score"])
    far = F.abs("_d") > t
    return df.withColumn(
        "edits", F.when(far, F.lit(t + 1)).when((m == 0) | (n == 0), F.greatest(m, n)).otherwise(counted)
    ).drop("_head", "_tail", "_a", "_b", "_eq", "_d")


def repeated_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", max_edits: int = 2, min_chars: int = 24
) -> DataFrame:
    """(id_col, line_no, near) of every line that goes; ``near`` if no equal line stands before.

    A line goes if an equal line stands before it, in a document with a smaller id or
    earlier in its own, or if the first of its equals is within ``max_edits`` edits of an
    earlier line; lines of under ``min_chars`` characters are only compared whole. Judged
    on the input: lines that go count as earlier lines too.

    Lines without a word stay, and so do null and empty texts. Rows without an id come
    first. Rows that have the same id, or none, stand in the order of the hashes of their
    texts; those of the same id and text are one document. Lines are told apart by 64-bit
    hashes. An empty table gives no rows; other columns are not read.
    """
    gone = _repeated(docs, id_col, text, max_edits, min_chars)
    return gone.select(F.col("doc_id").alias(id_col), "line_no", "near")


def _repeated(docs: DataFrame, id_col: str, text: str, t: int, min_chars: int) -> DataFrame:
    """(doc_id, row, line_no, near) of every line that goes."""
    lines = _lines(docs, id_col, text)
    place = F.struct("doc_id", "row", "line_no")
    firsts = lines.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times"))
    firsts = written(firsts, "first-lines")
    total = firsts.agg(F.sum("times")).first()[0] or 0
    # at most COMMON_SHARE rows: each holds more than its share of the lines
    common = firsts.filter(F.col("times") > total / COMMON_SHARE).select(F.col("h").alias("_h"), "first")
    once = lines.withColumn("n", F.length("line")).filter(F.col("n") >= min_chars).join(
        broadcast_if(True, common), F.col("h") == F.col("_h"), "left"
    ).filter(F.col("_h").isNull() | place.eqNullSafe(F.col("first")))
    # lines that share a key with another one: a row each, however many share it; the
    # probes of a line's own length, not moved, are its indexed keys
    met = once.select("h", F.explode_outer(_probes(t)).alias("key"))
    key = Window.partitionBy("key")
    met = met.withColumns({"_least": F.min("h").over(key), "_most": F.max("h").over(key)})
    suspects = written(met.filter("_least <> _most").select("h").distinct(), "line-suspects")
    some = lines.join(broadcast_if(is_small(suspects, SUSPECTS), suspects), "h", "left_semi")
    texts = some.groupBy("h").agg(F.first("line").alias("line"))
    texts = written(texts.withColumns({"n": F.length("line"), "bag": _bag(F.col("line"))}), "line-texts")

    pairs = written(_candidates(texts, t, CROWDED), "line-pairs")
    ids = pairs.select(F.explode(F.array("x", "y")).alias("h")).distinct()
    ids = broadcast_if(is_small(ids), ids)
    both = pairs.join(texts.select(F.col("h").alias("x"), F.col("line").alias("a")), "x").join(
        texts.select(F.col("h").alias("y"), F.col("line").alias("b")), "y"
    )
    # written before it is filtered: a filter would take the arrays' definitions into their own lambdas
    near = written(edits(both, t).select("x", "y", "edits"), "line-edits").filter(F.col("edits") <= t)
    begins = written(firsts.join(ids, "h", "left_semi").select("h", "first"), "line-begins")
    later = (
        near.join(begins.select(F.col("h").alias("x"), F.col("first").alias("_x")), "x")
        .join(begins.select(F.col("h").alias("y"), F.col("first").alias("_y")), "y")
        .select(F.when(F.col("_x") < F.col("_y"), F.col("y")).when(F.col("_y") < F.col("_x"), F.col("x")).alias("_later"))
        .filter("_later is not null")
        .distinct()
    )
    later = written(later, "later-lines")
    seen = lines.select("doc_id", "row", "line_no", "h").join(firsts.select("h", "first"), "h")
    mine = place.eqNullSafe(F.col("first"))
    return (
        seen.join(broadcast_if(is_small(later), later), F.col("h") == F.col("_later"), "left")
        .filter(~mine | F.col("_later").isNotNull())
        .select("doc_id", "row", "line_no", mine.alias("near"))
    )


def removed_by_document(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """(id_col, removed): the ascending numbers of the lines that go; documents that lose none are left out."""
    gone = repeated_lines(docs, id_col=id_col, **options)
    return gone.groupBy(id_col).agg(F.array_sort(F.collect_set("line_no")).alias("removed"))


def dedup_lines(
    docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", max_edits: int = 2, min_chars: int = 24
) -> DataFrame:
    """The documents without repeated lines, all columns kept; a document may be left empty.

    ``n_chars`` follows the text where there is such a column. Every row loses its own
    lines, also one without an id or with the id of another.
    """
    gone = _repeated(docs, id_col, text, max_edits, min_chars).groupBy("doc_id", "row")
    gone = gone.agg(F.array_sort(F.collect_set("line_no")).alias("_ld_gone"))
    gone = gone.select(F.col("doc_id").alias("_ld_id"), F.col("row").alias("_ld_row"), "_ld_gone")
    same = F.col(id_col).eqNullSafe(F.col("_ld_id")) & (F.xxhash64(text) == F.col("_ld_row"))
    joined = docs.join(gone, same, "left")
    some = F.col("_ld_gone").isNotNull()
    joined = joined.withColumn("_ld_lines", F.when(some, F.split(text, "\n")))
    left = F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), F.col("_ld_gone"))
    joined = joined.withColumn("_ld_left", F.when(some, left))
    shown = F.array_join(F.transform("_ld_left", lambda i: F.get("_ld_lines", i)), "\n")
    out = joined.withColumn(text, F.when(some, shown).otherwise(F.col(text)))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(some, F.length(text).cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
