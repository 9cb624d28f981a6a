"""Quality rules whose thresholds follow the data of a language and source."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import words, written
from tagloom.session import broadcast_if, is_small

INDEX_BITS = 22
FEATURES = ("symbol_rate", "word_length", "dup_line_rate", "repeat_rate")
# The rank whose quantile a fence starts from, and how many of its distances to the median the
# fence stands beyond: about seven standard deviations if a feature were normal. Every seventh document of a
# group may be junk by symbols and word lengths; lines and words repeat in few documents, so
# their fences start further out.
TAILS = {"symbol_rate": (0.85, 7.0), "word_length": (0.85, 7.0), "dup_line_rate": (0.99, 2.0), "repeat_rate": (0.99, 2.0)}
# What one symbol, letter, line or repeated window changes in a feature, as a multiple of one
# in the median document's words or lines: no distance counts for less.
STEPS = {"symbol_rate": (1.0, "n_words"), "word_length": (1.0, "n_words"), "dup_line_rate": (1.0, "n_lines"), "repeat_rate": (3.0, "n_words")}
SIZES = ("n_words", "n_lines")
RELATIVE = dict(zip(FEATURES, (("n_symbols", "n_words"), ("word_chars", "n_words"), ("n_dup_lines", "n_lines"), ("n_repeat_words", "n_words"))))


def _covered(starts: Column, width: int) -> Column:
    """Positions that windows of a width at sorted starts cover."""
    steps = F.transform(
        starts, lambda p, i: F.least(F.lit(width), F.coalesce(F.get(starts, i + 1) - p, F.lit(width))).cast("long")
    )
    return F.aggregate(steps, F.lit(0).cast("long"), lambda a, b: a + b)


def _repeated_starts(df: DataFrame) -> DataFrame:
    """Adds ``_at``: sorted positions of the hashes ``_sh`` found twice or more.

    A hash and its position share one long, so that sorting longs puts equal hashes
    side by side; texts too long for the position's bits sort pairs instead. Each array
    is a column of its own: written inside a lambda it would be built for every element.
    """
    mask = (1 << INDEX_BITS) - 1
    n, longs = F.size("_sh"), F.array().cast("array<bigint>")
    some = F.size(F.array_distinct("_sh")) < n

    def place(v: Column) -> Column:
        return v.bitwiseAND(F.lit(mask)).cast("int")

    def same(a: Column, b: Column) -> Column:
        near = F.shiftright(a, INDEX_BITS) == F.shiftright(b, INDEX_BITS)
        return F.coalesce(near & (F.get("_sh", place(a)) == F.get("_sh", place(b))), F.lit(False))

    def equal(a: Column, b: Column) -> Column:
        return F.coalesce(a["h"] == b["h"], F.lit(False))

    packed = F.sort_array(F.transform("_sh", lambda h, i: h.bitwiseAND(F.lit(~mask)).bitwiseOR(i.cast("long"))))
    pairs = F.transform("_sh", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    df = df.withColumns(
        {
            "_packed": F.when(some & (n <= mask), packed).otherwise(longs),
            "_pairs": F.when(some & (n > mask), F.sort_array(pairs)).otherwise(F.slice(pairs, 1, 0)),
        }
    )
    short = F.filter(
        "_packed", lambda v, i: same(v, F.get("_packed", i - 1)) | same(v, F.get("_packed", i + 1))
    )
    long = F.filter("_pairs", lambda v, i: equal(v, F.get("_pairs", i - 1)) | equal(v, F.get("_pairs", i + 1)))
    at = F.when(n <= mask, F.transform(short, place)).otherwise(F.transform(long, lambda v: v["i"]))
    return df.withColumn("_at", F.sort_array(at)).drop("_packed", "_pairs", "_sh")


def measures(docs: DataFrame, *, id_col: str = "doc_id", text: str = "text", groups: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """Counts of every whole text: n_words, word_chars, n_lines, n_symbols, n_dup_lines, n_repeat_words."""
    body = F.coalesce(F.col(text), F.lit(""))
    base = docs.select(F.col(id_col).alias("doc_id"), *[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)], body.alias("_text"))
    split = base.withColumn("_words", words(F.col("_text"))).withColumn(
        "_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    hashed = split.select(
        "doc_id",
        *[f"_g{i}" for i in range(len(groups))],
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_wh"),
    )
    shingled = hashed.withColumn(
        "_sh",
        F.when(
            F.col("n_words") >= 3,
            F.transform(
                F.slice("_wh", F.lit(1), F.size("_wh") - 2),
                lambda h, i: F.xxhash64(h, F.get("_wh", i + 1), F.get("_wh", i + 2)),
            ),
        ).otherwise(F.array().cast("array<bigint>")),
    ).drop("_wh")
    return _repeated_starts(shingled).withColumn("n_repeat_words", _covered(F.col("_at"), 3)).drop("_at")


def sketches(measured: DataFrame, keys: list[str], k: int) -> DataFrame:
    """A mergeable quantile sketch of every feature and size per group, over documents the base rules keep."""
    return measured.filter(~F.col("base_failed")).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.kll_sketch_agg_double(F.col(f).cast("double"), k).alias(f) for f in (*FEATURES, *SIZES)],
    )


def merged(tables: DataFrame, keys: list[str], k: int) -> DataFrame:
    """Sketches of coarser groups, from those of finer ones."""
    return tables.groupBy(*keys).agg(F.sum("n").alias("n"), *[F.kll_merge_agg_double(f, k).alias(f) for f in (*FEATURES, *SIZES)])


def own_fences(tables: DataFrame) -> DataFrame:
    """Lowest and highest value of every feature by a group's own sketches."""

    def quantile(name: str, rank: float) -> Column:
        return F.kll_sketch_get_quantile_double(name, F.lit(rank))

    def bounds(f: str) -> Column:
        (rank, width), (unit, size) = TAILS[f], STEPS[f]
        low, mid, high = (quantile(f, q) for q in (round(1 - rank, 4), 0.5, rank))
        step = F.lit(unit) / quantile(size, 0.5)
        return F.struct(
            (low - F.lit(width) * F.greatest(mid - low, step)).alias("low"),
            (high + F.lit(width) * F.greatest(high - mid, step)).alias("high"),
        )

    return tables.filter("n > 0").select("*", F.struct(*[bounds(f).alias(f) for f in FEATURES]).alias("fence")).drop(*FEATURES, *SIZES)


def drawn(own: Column, coarser: Column, n: Column, prior: int) -> Column:
    """Fences of ``n`` documents, drawn towards the coarser group's as if that had ``prior``."""

    def towards(f: str, side: str) -> Column:
        n_ = n.cast("double")
        return (n_ * own[f][side] + F.lit(float(prior)) * coarser[f][side]) / (n_ + F.lit(float(prior)))

    return F.struct(*[F.struct(*[towards(f, s).alias(s) for s in ("low", "high")]).alias(f) for f in FEATURES])


def quality_rules(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text: str = "text",
    groups: tuple[str, str] = ("lang", "source"),
    min_words: int = 50,
    max_repeat_percent: int = 50,
    prior: int = 100,
    k: int = 4096,
) -> DataFrame:
    """doc_id, the counts, the group's fences, base_failed and kept, a row per document.

    A document fails the base rules with under ``min_words`` words or over
    ``max_repeat_percent`` percent of its words in repeated windows. The others are held
    against fences of their language and source, which the sketches of these documents alone
    decide: the quantile of each feature far out (``TAILS``), and beyond it some of its
    distances to the median, or of the least step that the median document can make
    (``STEPS``) where all documents but a few are alike. The fence of a group of n documents
    is drawn towards that of its language, and that towards the one of all, by n against
    ``prior``, so that no group is too small to have one and none jumps at a size. Sketches
    hold ``k`` values exactly and more with a rank error of about 1 / k.

    Null and empty texts have no words and fail. Null languages and sources are groups
    like others. Repeated rows count as often as they occur; other columns are ignored.
    """
    g = [f"_g{i}" for i in range(len(groups))]
    m = measures(docs, id_col=id_col, text=text, groups=groups)
    m = m.withColumn(
        "base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    )
    for f, (part, whole) in RELATIVE.items():
        m = m.withColumn(f, F.coalesce(F.try_divide(F.col(part).cast("double"), F.col(whole).cast("double")), F.lit(0.0)))
    m = written(m, "measures")
    finest = written(sketches(m, g, k), "sketches")
    coarse = merged(finest, g[:1], k)
    top = own_fences(merged(coarse, [], k)).select("fence").scalar()  # of all: one row
    lang = own_fences(coarse).select(F.col("_g0").alias("_lang"), drawn(F.col("fence"), top, F.col("n"), prior).alias("_mid"))
    bounds = (
        own_fences(finest)
        .join(lang, F.col("_g0").eqNullSafe(F.col("_lang")), "left")
        .select(*[F.col(c).alias(f"_b{c}") for c in g], drawn(F.col("fence"), F.col("_mid"), F.col("n"), prior).alias("fence"))
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_b{c}")) for c in g])
    inside = reduce(
        lambda a, b: a & b,
        [F.col(f).between(F.col("fence")[f]["low"], F.col("fence")[f]["high"]) for f in FEATURES],
    )
    return (
        m.join(broadcast_if(is_small(finest), bounds), same, "left")
        .withColumn("kept", ~F.col("base_failed") & F.coalesce(inside, F.lit(False)))
        .drop(*g, *[f"_b{c}" for c in g])
    )
