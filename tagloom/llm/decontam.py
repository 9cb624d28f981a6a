"""Benchmark decontamination on templates.

Text becomes a template: numbers, names and units turn into typed slots, the rest
into lower-case words without punctuation. A slot keeps its value behind ``=``, so
one array of tokens gives both the template and what filled it. Windows of template
words meet in a hash join; a document holds an item if it holds enough of the item's
windows and the items' slot values map one to one onto the document's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagloom.llm.common import written
from tagloom.session import broadcast_if, is_small

UNITS = (
    "kg g mg lb lbs oz km m cm mm mi miles mile ft feet foot inch inches yards yd l ml litres liters gallons "
    "s sec seconds min minutes h hours hour days day weeks week months month years year "
    "percent degrees dollars cents euros euro pounds usd eur kmh mph w kw v hz kb mb gb tb"
).split()
# Each begins with the one character that is rare, so that most places fail at once.
NAME = r"\p{Lu}(?<=[^.!?:;\s][^\S\n]\p{Lu})[\p{L}'’-]*"
_UNIT = "(" + "|".join(UNITS) + r")(?!\p{L})"
NUMBER = r"\p{N}(?<![\p{L}\p{N}=]\p{N})\p{N}*(?:[.,:/]\p{N}+)*(?:(?![\p{L}\p{N}])|(?=" + _UNIT + "))"
UNIT = r"(<num=[^>]*>[^\S\n]*)" + _UNIT
TOKEN = r"[\p{L}\p{M}\p{N}]+|<[a-z]+=[^>]*>"


def tokens(text: Column) -> Column:
    """Template words of a text; slots read ``<kind=value>``.

    A name is a capitalised word inside a sentence, a unit a word of ``UNITS`` behind
    a number.
    """
    slots = F.coalesce(text, F.lit(""))
    for sign in "<>=":
        slots = F.replace(slots, F.lit(sign), F.lit(" "))
    slots = F.regexp_replace(slots, NAME, "<name=$0>")
    slots = F.lower(F.regexp_replace(slots, NUMBER, "<num=$0>"))
    slots = F.regexp_replace(slots, UNIT, "$1 <unit=$2>")
    return F.regexp_extract_all(slots, F.lit(TOKEN), F.lit(0))


def plain(text: Column) -> Column:
    """Lower-case words and digits of a text, whatever stands around them."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def _hashes(toks: str) -> Column:
    return F.transform(
        F.col(toks), lambda t: F.xxhash64(F.when(t.startswith("<"), F.substring_index(t, "=", 1)).otherwise(t))
    )


def _wider(df: DataFrame, step: int) -> DataFrame:
    """Two windows ``step`` words apart make the longer one."""
    pairs = F.transform(
        F.slice("_x", F.lit(1), F.greatest(F.size("_x") - step, F.lit(0))),
        lambda h, i: F.xxhash64(h, F.get("_x", i + step)),
    )
    return df.withColumn("_y", pairs).drop("_x").withColumnRenamed("_y", "_x")


def _windows(df: DataFrame, width: int) -> DataFrame:
    """``_x``: the hash of every window of template words, from ``_h``; none if there are fewer."""
    df, done = df.withColumn("_x", F.col("_h")), 1
    while done < width:
        step = min(done, width - done)
        df, done = _wider(df, step), done + step
    return df


def _stretches(df: DataFrame, line: list[str]) -> DataFrame:
    """``_stretch``: alike for windows of a diagonal side by side; a diagonal has at most the item's windows."""
    return df.withColumn("_stretch", F.col("_i") - F.row_number().over(Window.partitionBy(*line).orderBy("_i")))


def _exact(docs: DataFrame, items: DataFrame, width: int) -> DataFrame:
    """(_doc, _item, _p, _i, _w): windows of plain words of ``_iw`` that stand in ``_dw`` word for word."""
    some = items.withColumn("_h", F.transform("_iw", lambda w: F.xxhash64(w))).withColumn("_w", F.least(F.size("_iw"), F.lit(width)))
    hashed = docs.select("_doc", F.transform("_dw", lambda w: F.xxhash64(w)).alias("_h"))
    keys = items.limit(0).select("_item", F.lit(0).alias("_w"), F.lit(0).alias("_i"), F.lit(0).cast("long").alias("_x"))
    found = docs.limit(0).select("_doc", F.lit(0).alias("_w"), F.lit(0).alias("_p"), F.lit(0).cast("long").alias("_x"))
    for w in sorted(r[0] for r in some.select("_w").distinct().collect()):  # at most ``width`` values
        at = _windows(some.filter(F.col("_w") == w), w).select("_item", "_w", F.posexplode_outer("_x").alias("_i", "_x"))
        keys = keys.unionByName(at)
        found = found.unionByName(
            _windows(hashed, w).select("_doc", F.lit(w).alias("_w"), F.posexplode_outer("_x").alias("_p", "_x"))
        )
    keys = written(keys.filter("_x is not null").distinct(), "benchmark-words")
    hits = found.filter("_x is not null").join(broadcast_if(is_small(keys), keys), ["_x", "_w"])
    return written(hits.select("_doc", "_item", "_p", "_i", "_w").distinct(), "words-found")


def _whole(docs: DataFrame, items: DataFrame, text: str) -> DataFrame:
    """(_doc, _item): items that fill a line or sentence of a document by themselves."""
    keys = items.select("_item", F.array_join("_iw", " ").alias("_line")).distinct()
    pieces = F.transform(F.split(F.coalesce(text, F.lit("")), r"[.!?;:\n\r]+"), lambda s: F.array_join(plain(s), " "))
    lines = docs.select(F.xxhash64(text).alias("_doc"), F.explode_outer(F.array_distinct(pieces)).alias("_line"))
    return lines.join(broadcast_if(is_small(keys), keys), "_line").select("_doc", "_item")


def unsearched(benchmark: DataFrame, *, item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The items that no search can find: without an id or without a word, all columns kept."""
    return benchmark.filter(F.col(item).isNull() | (F.size(plain(F.col(item_text))) == 0))


def _held(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str,
    item: str,
    item_text: str,
    *,
    width: int,
    min_words: int,
    min_literals: int,
    min_share: float,
    min_run: int,
    min_exact_run: int,
    min_exact_words: int,
) -> DataFrame:
    """``contaminated`` for texts: ``_doc`` is the hash of a text, ``_item`` an item it holds."""
    every = benchmark.select(
        F.col(item).alias("_id"), tokens(F.col(item_text)).alias("_own"), plain(F.col(item_text)).alias("_iw"),
        # as the item reads behind a word
        F.slice(tokens(F.concat(F.lit("x "), F.ltrim(item_text))), 2, 1 << 30).alias("_inner"),
    ).filter(F.col("_id").isNotNull() & (F.size("_iw") > 0))
    versions = F.when(F.col("_own") == F.col("_inner"), F.array("_own")).otherwise(F.array("_own", "_inner"))
    items = (
        every.select("_id", F.posexplode(versions).alias("_v", "_it"))
        .select(F.struct(F.col("_id").alias("id"), F.col("_v").alias("v")).alias("_item"), "_it")
        .filter(F.size("_it") >= min_words)
        .withColumn("_h", _hashes("_it"))
        .withColumn("_w", F.least(F.size("_it"), F.lit(width)))
    )
    widths = [r[0] for r in items.select("_w").distinct().collect()]  # at most ``width`` values
    base = docs.select(F.xxhash64(text).alias("_doc"), tokens(F.col(text)).alias("_dt"))
    hashed = base.select("_doc", _hashes("_dt").alias("_h"))
    no_items = items.limit(0).select("_item", F.lit(0).alias("_w"), F.lit(0).alias("_i"), F.lit(0).cast("long").alias("_x"))
    keys, found = no_items, base.limit(0).select("_doc", F.lit(0).alias("_w"), F.lit(0).alias("_p"), F.lit(0).cast("long").alias("_x"))
    for w in sorted(widths):
        at = _windows(items.filter(F.col("_w") == w), w).select("_item", "_w", "_it", F.posexplode_outer("_x").alias("_i", "_x"))
        literal = F.size(F.filter(F.slice("_it", F.col("_i") + 1, F.lit(w)), lambda t: ~t.contains("=")))
        keys = keys.unionByName(at.filter(literal >= min(min_literals, w)).select("_item", "_w", "_i", "_x"))
        found = found.unionByName(
            _windows(hashed, w).select("_doc", F.lit(w).alias("_w"), F.posexplode_outer("_x").alias("_p", "_x"))
        )
    # the outer form of explode keeps Spark from filtering on the size of the array first,
    # for which it would write the array's definition into its own lambdas
    keys, found = keys.filter("_x is not null"), found.filter("_x is not null")
    keys = written(keys.distinct(), "benchmark-windows")
    small = is_small(keys)
    hits = written(
        found.join(broadcast_if(small, keys), ["_x", "_w"]).select("_doc", "_item", "_w", "_p", "_i").distinct(), "windows-found"
    )
    # slots are read again, for the few documents that have a window
    few = hits.select("_doc").distinct()
    held = base.join(broadcast_if(is_small(few), few), "_doc", "left_semi")
    kept_items = items.select("_item", "_it").dropDuplicates(["_item"])
    paired = hits.join(held.dropDuplicates(["_doc"]), "_doc").join(broadcast_if(small, kept_items), "_item")
    slots = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.col("_w") - 1),
            lambda j: F.struct(
                F.get("_it", F.col("_i") + j).alias("ours"), F.get("_dt", F.col("_p") + j).alias("theirs")
            ),
        ),
        lambda s: s["ours"].contains("="),
    )
    diagonal = ["_doc", "_item", "_diagonal"]
    paired = paired.withColumn("_slots", slots).select(
        "_doc", "_item", "_i", "_w", (F.col("_p") - F.col("_i")).alias("_diagonal"), "_slots"
    )
    paired = written(_stretches(paired.dropDuplicates([*diagonal, "_i"]), diagonal), "windows-in-stretches")
    # each pair of values once; then a value of the item must occur in one pair only
    line = [*diagonal, "_stretch"]
    cut = paired.select(*line, F.explode_outer("_slots").alias("_s"))
    pairs = cut.groupBy(*line, F.col("_s.ours").alias("ours"), F.col("_s.theirs").alias("theirs")).agg(F.lit(1).alias("_one"))
    pairs = pairs.filter(F.col("ours").isNotNull())
    checked = pairs.groupBy(*line).agg(
        F.count(F.lit(1)).alias("_pairs"),
        F.size(F.collect_set("ours")).alias("_ours"),
        F.bool_and(F.col("ours") == F.col("theirs")).alias("_same"),
    )
    total = keys.groupBy("_item").agg(F.countDistinct("_i").alias("item_windows"))
    places = paired.withColumn("_run", F.count(F.lit(1)).over(Window.partitionBy(*line)) + F.col("_w") - 1).drop("_slots")
    templates = (
        places.join(checked, line, "left")
        .filter(F.col("_pairs").isNull() | (F.col("_pairs") == F.col("_ours")))
        .groupBy("_doc", "_item")
        .agg(
            F.countDistinct("_i").alias("n_windows"),
            F.max("_run").alias("run"),
            F.coalesce(F.max("_ours"), F.lit(0)).cast("long").alias("n_slots"),
            F.bool_and(F.coalesce("_same", F.lit(True))).alias("verbatim"),
        )
        .join(broadcast_if(small, total), "_item")
        .filter((F.col("n_windows") >= F.lit(min_share) * F.col("item_windows")) | (F.col("run") >= min_run))
    )
    templates = templates.withColumn("_item", F.col("_item.id"))
    words = docs.select(F.xxhash64(text).alias("_doc"), plain(F.col(text)).alias("_dw"))
    # whether templates see every window of an item as it stands
    possible = items.filter("_item.v = 0").groupBy("_item").agg(F.max(F.size("_it") - F.col("_w") + 1).alias("_possible"))
    covered = total.join(possible, "_item").filter("item_windows = _possible").select(F.col("_item.id").alias("_item"), F.lit(True).alias("_covered"))
    every = every.select(F.col("_id").alias("_item"), "_iw")
    short, every = every.filter(F.size("_iw") < min_exact_words), every.filter(F.size("_iw") >= min_exact_words)
    lengths = every.groupBy("_item").agg(F.max(F.size("_iw") - F.least(F.size("_iw"), F.lit(width)) + 1).cast("long").alias("item_windows"))
    needed = F.when(F.col("_covered"), F.lit(1.0)).otherwise(F.lit(min_share))
    at = _exact(words, every, width).withColumn("_diagonal", F.col("_p") - F.col("_i"))
    runs = _stretches(at, diagonal).withColumn("_run", F.count(F.lit(1)).over(Window.partitionBy(*line)) + F.col("_w") - 1)
    exact = (
        runs.groupBy("_doc", "_item")
        .agg(F.countDistinct("_i").alias("n_windows"), F.max("_run").alias("run"))
        .join(broadcast_if(is_small(every), lengths.join(covered, "_item", "left")), "_item")
        .filter((F.col("n_windows") >= needed * F.col("item_windows")) | (F.col("run") >= min_exact_run))
        .withColumns({"n_slots": F.lit(0).cast("long"), "verbatim": F.lit(True)})
    )
    counts = ["n_windows", "item_windows", "run", "n_slots"]
    exact = exact.select("_doc", "_item", *counts, "verbatim")
    out = templates.select("_doc", "_item", *counts, "verbatim").unionByName(exact)
    if short.take(1):
        one = F.lit(1).cast("long")
        whole = _whole(docs, short, text).join(short.select("_item", F.size("_iw").cast("long").alias("run")).distinct(), "_item")
        whole = whole.withColumns({"n_windows": one, "item_windows": one, "n_slots": F.lit(0).cast("long"), "verbatim": F.lit(True)})
        out = out.unionByName(whole.select(*[F.col(c).cast(out.schema[c].dataType) if c in counts else c for c in out.columns]))
    return written(out, "items-held")


def _named(docs: DataFrame, held: DataFrame, id_col: str, text: str, item: str) -> DataFrame:
    """The pairs of ``_held`` with the ids of the documents that have the text."""
    ids = docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_doc")).filter(F.col("_id").isNotNull())
    pairs = ids.join(broadcast_if(is_small(held), held), "_doc").groupBy("_id", "_item")
    # what the templates found comes first, it has slots
    both = pairs.agg(F.max(F.struct("n_slots", "n_windows", "item_windows", "run")).alias("_best"), F.bool_or("verbatim").alias("verbatim"))
    share = (F.col("_best.n_windows") / F.col("_best.item_windows")).alias("share")
    return both.select(
        F.col("_id").alias(id_col), F.col("_item").alias(item), "_best.n_windows", "_best.item_windows", share, "_best.run", "_best.n_slots", "verbatim"
    )


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    width: int = 8,
    min_words: int = 5,
    min_literals: int = 4,
    min_share: float = 0.5,
    min_run: int = 13,
    min_exact_run: int = 20,
    min_exact_words: int = 4,
) -> DataFrame:
    """Pairs of a document and a benchmark item it holds.

    Columns: id_col, item, n_windows (different windows of the item found),
    item_windows (those it has), share (the one by the other), run (template words of the
    longest stretch found), n_slots (its slots seen there), verbatim (all slots filled
    alike).

    Templates: an item's first word is a word where the item begins a sentence and a name
    behind a word; both readings are searched. Items of ``min_words`` words up to ``width`` are one window of their own
    length. Windows need ``min_literals`` words that are no slots, else any table of names
    would match. Windows side by side on one diagonal (document position less item position)
    are a stretch: in it one item value must stand for one document value; stretches that
    break this don't count. ``min_share`` of the item's windows must be left, or a stretch of
    ``min_run`` template words, however long the item is.

    Word for word: every item that has a word is also searched as it is, in lower case and
    without punctuation. One of under ``min_exact_words`` words must fill a line or sentence
    of the document by itself, else "the" would name every document; items without a word
    can't be searched, ``unsearched`` names them. Of longer ones all windows must be found; ``min_share`` of them if templates leave
    some of its windows out (items under ``min_words``, windows under ``min_literals``); a
    stretch of ``min_exact_run`` words is enough for any item, also inside a stretch whose
    slots clash.
    Such pairs count plain windows, have no slots and are verbatim.

    Texts are searched under their 64-bit hash. Null texts never match, and rows without
    an id are searched but not named. Repeated rows of a document or item count once. Empty
    tables give no rows; other columns are ignored.
    """
    limits = dict(min_words=min_words, min_literals=min_literals, min_share=min_share, min_run=min_run, min_exact_run=min_exact_run, min_exact_words=min_exact_words)
    held = _held(docs, benchmark, text, item, item_text, width=width, **limits)
    return _named(docs, held, id_col, text, item)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text: str = "text", unnamed: bool = False, **options
) -> DataFrame:
    """The documents that hold no benchmark item, all columns kept.

    A row without an id stays; with ``unnamed`` it goes if its text holds an item. Rows
    with an id go with every row of it.
    """
    key = docs
    if unnamed:  # a row without an id is named by its text
        name = F.struct(F.col(id_col).alias("id"), F.when(F.col(id_col).isNull(), F.xxhash64(text)).alias("text"))
        key = docs.withColumn("_dc_name", name)
    by = "_dc_name" if unnamed else id_col
    bad = written(contaminated(key, benchmark, id_col=by, text=text, **options).select(by).distinct(), "contaminated")
    return key.join(broadcast_if(is_small(bad), bad), by, "left_anti").select(*docs.columns)
